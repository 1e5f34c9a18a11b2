"""Toxicity by misspelling-tolerant lexicon matching.

The lexicon is learned from labelled rows: words that toxic texts have and clean ones lack, in
many different contexts (so that a copied toxic passage does not make its ordinary words
suspicious).  Its trie is intersected with Levenshtein automata: one deterministic automaton over
sets of (trie node, edits) is unfolded as words need it, so a word is judged by one table
lookup a letter.  A hit that stands in quotation marks or near a word of reporting counts apart
from open abuse, and a misspelled hit apart from an exact one; a logistic model over the binary
logarithms of these sums, each plus one, gives the score, so further abuse always raises it.

Copies of a text are one text to the lexicon, and count with their number in the weights.
Learning reads about ``SAMPLE`` labelled ids, those whose hash lies below the share of them that
this is, so the lexicon is as large as the words of that sample make it; everything else covers
all rows and whole texts.

Defined results: null text counts as empty; a text without hits, empty ones too, gets the base
score; without toxic training rows every score is that of an empty lexicon; rows with a null id or
label teach nothing and are not held out; repeated rows are scored alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, crc_mod, materialize, texts_of, tune

FOLDS, HELD_OUT = 5, 0
SAMPLE = 60_000
#: A term needs so many toxic texts and different contexts, and such a ratio of toxic to clean rates.
SUPPORT, RATIO = 3, 20.0
NEAR = 6  # words on either side that make up a hit's context
FLUSH, REMEMBERED, STATES = 200_000, 300_000, 100_000
_WORD = re.compile(r"[^\W_]+(?:[@$!*'_-]+[^\W_]+)*")
_MARK = re.compile(r"[\"“”„«»]")
#: Words of reporting; a hit near one is likely spoken about rather than meant.
REPORTING = frozenset("said says called wrote quoted quote dit écrit cité sagte schrieb zitat dijo escribió cita".split())
FEATURES = ("exact", "exact_quoted", "near", "near_quoted")
#: Weights before any evidence: open abuse counts most, quoted misspellings least.
PRIOR = np.array([-3.0, 3.0, 0.7, 1.0, 0.2])


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def edits_for(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Automaton:
    """All words within reach of a lexicon, as a lazily unfolded deterministic automaton."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        self.reach = [0]  # most edits that any term below a node allows
        for k, t in enumerate(terms):
            at, most = 0, edits_for(t)
            self.reach[0] = max(self.reach[0], most)
            for c in t:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.reach.append(0)
                at = self.next[at][c]
                self.reach[at] = max(self.reach[at], most)
            self.ends[at] = k
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.start = self.number({0: 0})

    def number(self, found: dict[int, int]) -> int:
        """State of a set of nodes with their least edits, after skipping letters of terms."""
        todo = list(found)
        while todo:
            node = todo.pop()
            e = found[node] + 1
            for child in self.next[node].values():
                if e <= self.reach[child] and e < found.get(child, 99):
                    found[child] = e
                    todo.append(child)
        key = frozenset(found.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(found)
            self.moves.append({})
        return self.numbers[key]

    def step(self, state: int, c: str) -> int:
        found: dict[int, int] = {}
        for node, e in self.sets[state].items():
            if e < self.reach[node]:
                found[node] = min(e + 1, found.get(node, 99))  # a letter too many
            for letter, child in self.next[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[child] and cost < found.get(child, 99):
                    found[child] = cost
        to = self.number(found)
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the closest term within its reach."""
        if len(self.sets) > STATES:
            self.clear()
        at = self.start
        for c in word:
            to = self.moves[at].get(c)
            at = self.step(at, c) if to is None else to
            if not self.sets[at]:
                return None
        return min(((e, self.ends[n]) for n, e in self.sets[at].items() if n in self.ends and e <= edits_for(self.terms[self.ends[n]])), default=None)


class Scorer:
    """lexicon: weight of each term; exempt: words of clean texts that only look like a term."""

    def __init__(self, lexicon: dict[str, float], exempt: frozenset[str], weights: np.ndarray):
        self.automaton = Automaton(sorted(lexicon))
        self.strength = [lexicon[t] for t in self.automaton.terms]
        self.exempt, self.weights = exempt, weights
        self.known: dict[str, tuple[int, int] | None] = {}

    def look_up(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        for w in words:
            if w not in self.known:
                self.known[w] = None if w in self.exempt else self.automaton.match(w)

    def features(self, text: str) -> list[float]:
        """Strength of hits: exact or misspelled, open or quoted."""
        out = [0.0] * 4
        text = text.lower()  # which may move the places of what follows
        places = list(_WORD.finditer(text))
        names = [m.group() for m in places]
        for at, w in enumerate(names):
            hit = self.known.get(w)
            if hit is None:
                continue
            a, b = max(0, at - NEAR), min(len(names), at + NEAR + 1)
            before = _MARK.findall(text[places[a].start() : places[at].start()])
            after = _MARK.search(text[places[at].end() : places[b - 1].end() + 1])
            quoted = bool(len(before) % 2 and after) or not REPORTING.isdisjoint(names[a:b])
            out[2 * (hit[0] > 0) + quoted] += self.strength[hit[1]]
        return out

    def rows(self, texts: list[str]) -> list[list[float]]:
        split = [set(words_of(t)) for t in texts]
        self.look_up(set().union(*split))
        known = self.known
        return [self.features(t) if any(known[w] is not None for w in words) else [0.0] * 4 for t, words in zip(texts, split, strict=True)]

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.log2(1 + np.array(self.rows(texts), float).reshape(-1, 4))
        return 1 / (1 + np.exp(-(self.weights[0] + x @ self.weights[1:])))


def _count(it):
    """Texts, toxic and clean, that each word occurs in."""
    toxic, clean = Counter(), Counter()

    def out():
        keys = list(toxic.keys() | clean.keys())
        rows = pa.record_batch([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], names=["word", "toxic", "clean"])
        toxic.clear()
        clean.clear()
        return rows

    for b in batches(it):
        for label, text in zip(b.column("toxic").to_pylist(), texts_of(b.column("text")), strict=True):
            (toxic if label else clean).update(set(words_of(text)))
        if len(toxic) + len(clean) > FLUSH:
            yield out()
    if toxic or clean:
        yield out()


def _contexts(words: frozenset[str]):
    def run(it):
        for b in batches(it):
            found = set()
            for text in texts_of(b.column("text")):
                names = ["", *words_of(text), ""]
                found.update((w, f"{p} {n}") for p, w, n in zip(names, names[1:], names[2:], strict=False) if w in words)
            yield pa.record_batch([pa.array([w for w, _ in found], pa.string()), pa.array([c for _, c in found], pa.string())], names=["word", "context"])

    return run


def _look_alikes(lexicon: list[str]):
    def run(it):
        a = Automaton(lexicon)
        for b in batches(it):
            words = b.column("word").to_pylist()
            yield b.filter(pa.array([(m := a.match(w)) is not None and m[0] > 0 for w in words], pa.bool_()))

    return run


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: np.ndarray = PRIOR, ridge: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Logistic weights by Newton's method for rows that stand ``n`` times, drawn towards ``prior``; hits never speak for a clean text."""
    x = np.hstack([np.ones((len(x), 1)), np.log2(1 + x)])
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        grad = x.T @ (n * (p - y)) + ridge * (w - prior)
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1.0, 4 / max(1e-9, np.abs(move).max()))
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(move).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], frozenset[str], np.ndarray]:
    """docs: doc_id, text; labels: doc_id, toxic.  Returns the lexicon, look-alikes of clean texts and the weights."""
    spark = docs.sparkSession
    tune(spark)
    usable = labels.where(F.col("toxic").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    share = min(1.0, sample / max(1, usable.count()))
    # One threshold instead of a sort: about ``sample`` rows of 12 bytes are broadcast at any size of the corpus.
    chosen = usable.where(F.xxhash64("doc_id").cast("double") <= F.lit((2 * share - 1) * 2.0**63))
    lessons = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    # Copies are merged: support, like contexts, counts distinct texts.
    lessons = materialize(lessons.groupBy("toxic", "text").agg(F.count(F.lit(1)).alias("copies")), "lessons")
    counted = materialize(lessons.mapInArrow(_count, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "words")
    n = {r.toxic: r.n for r in lessons.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    ratio = ((F.col("toxic") + 0.1) / F.lit(bad + 1.0)) / ((F.col("clean") + 0.1) / F.lit(good + 1.0))
    suspects = counted.where((F.col("toxic") >= SUPPORT) & (ratio >= RATIO)).select("word", "toxic", ratio.alias("ratio")).collect()
    words = frozenset(r.word for r in suspects)
    held = lessons.where("toxic = 1").mapInArrow(_contexts(words), "word string, context string").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    contexts = {r.word: r.n for r in held.collect()} if words else {}
    lexicon = {r.word: float(min(2.0, np.log10(1 + r.ratio * np.log1p(contexts[r.word])))) for r in suspects if contexts.get(r.word, 0) >= max(SUPPORT, r.toxic / 2)}
    exempt: frozenset[str] = frozenset()
    if lexicon:
        alike = counted.where("clean > 0 AND toxic <= clean").mapInArrow(_look_alikes(sorted(lexicon)), counted.schema)
        exempt = frozenset(r.word for r in alike.select("word").collect())
    shared = spark.sparkContext.broadcast((lexicon, exempt))

    def rows(it):
        s = Scorer(*shared.value, PRIOR)
        for b in batches(it):
            x = s.rows(texts_of(b.column("text")))
            yield pa.record_batch([b.column("toxic"), b.column("copies"), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "copies", "x"])

    # Alike rows count once with their number; few combinations differ, and the sample bounds them.
    summed = lessons.mapInArrow(rows, "toxic int, copies long, x array<double>").groupBy("toxic", "x").agg(F.sum("copies").alias("n")).collect()
    if not bad:
        return lexicon, exempt, PRIOR
    x, y, n = np.array([r.x for r in summed], float).reshape(-1, 4), np.array([r.toxic == 1 for r in summed], float), np.array([r.n for r in summed], float)
    return lexicon, exempt, fit(x, y, n)


def score_documents(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text)."""
    tune(docs.sparkSession)
    kind, shared = docs.schema["doc_id"].dataType.simpleString(), docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        s = Scorer(*shared.value)
        for b in batches(it):
            p = s.scores(texts_of(b.column("text")))
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below one half."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        s = Scorer(*shared.value)
        for b in batches(it):
            yield b.filter(pa.array(s.scores(texts_of(b.column(b.schema.get_field_index(text_col)))) < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
