"""Language identification, words first.

A word seen in training is scored by its log frequency in each language; an unseen word falls
back to its 5-grams, and wherever such a gram is unknown to ever shorter ones down to single
letters.  Counts cover all training texts, and every word and gram counts, however rare.

Words frequent enough that fewer than ``HEAVY`` of them can exist travel with the tasks; all others
meet their scores in a join on the word.  Grams are looked up once for each distinct unseen word: in
a table that travels with the tasks while there are at most ``GRAMS_TOLD`` of them, beyond that in a
join on the gram, with the same result.  So nothing unbounded is sent to every task.

With base_l = log(SMOOTH / (words of l + SMOOTH * (distinct words + 1))), a text of n words scores
n * base_l plus, for each word, what it adds to that: log((its count in l + SMOOTH) / SMOOTH) if it
is known, else a fifth of the sum of its grams' logs less base_l.  The score that is returned is the
chosen language's posterior probability.

Defined results: null text, or text without a letter, is ``und`` with score 0; without any
training row every text is; rows with a null id or language teach nothing and are not held out;
ties go to the language first in the alphabet; repeated rows count as often as they stand there;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, crc_mod, materialize, texts_of, tune

FOLDS, HELD_OUT = 4, 2
LONGEST, SMOOTH = 5, 0.5
#: Words that hold more than so small a share of all training words travel with the tasks.
HEAVY = 1_000_000
#: Distinct grams that travel with the tasks at most.
GRAMS_TOLD = 500_000
FLUSH = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    # Beyond ASCII the pattern takes in signs such as superscripts; a word has a letter.
    return found if text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    framed = f"<{word}>"
    return [framed[k : k + n] for k in range(len(framed) - n + 1)]


def _rows(counts: dict[str, Counter], key: str):
    langs, keys, ns = [], [], []
    for lang, c in counts.items():
        langs += [lang] * len(c)
        keys += c.keys()
        ns += c.values()
    counts.clear()
    return pa.record_batch([pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(ns, pa.int64())], names=["lang", key, "n"])


def _count_words(it):
    counts: dict[str, Counter] = defaultdict(Counter)
    for b in batches(it):
        for lang, text in zip(b.column("lang").to_pylist(), texts_of(b.column("text")), strict=True):
            counts[lang].update(words_of(text))
        if sum(map(len, counts.values())) > FLUSH:
            yield _rows(counts, "word")
    if counts:
        yield _rows(counts, "word")


def _count_grams(it):
    counts: dict[str, Counter] = defaultdict(Counter)
    for b in batches(it):
        for lang, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            own = counts[lang]
            for size in range(1, LONGEST + 1):
                for g in grams_of(word, size):
                    own[g] += n
        if sum(map(len, counts.values())) > FLUSH:
            yield _rows(counts, "gram")
    if counts:
        yield _rows(counts, "gram")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to as many tasks as a shuffle has, whatever their size in bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


@dataclass
class Model:
    """Tables of counts (words: lang, word, n; grams: lang, gram, n), and by language their totals."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    word_total: np.ndarray
    letter_total: np.ndarray
    distinct_words: int
    distinct_grams: int

    @property
    def base(self) -> np.ndarray:
        return np.log(SMOOTH) - np.log(self.word_total + SMOOTH * (self.distinct_words + 1))

    @property
    def gram_base(self) -> np.ndarray:
        return np.log(SMOOTH) - np.log(self.letter_total + SMOOTH * (self.distinct_grams + 1))


def train(docs: DataFrame) -> Model:
    """docs: doc_id, text, lang.  Learns from rows with a language whose id is not in the held-out fold."""
    tune(docs.sparkSession)
    lessons = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).select("lang", "text")
    words = materialize(lessons.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    grams = materialize(_spread(words, "word").mapInArrow(_count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    # One row a language.
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    letters = {r.lang: r.n for r in grams.where(F.length("gram") == 1).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    return Model(langs, words, grams, np.array([totals[x] for x in langs], float), np.array([letters[x] for x in langs], float), words.select("word").distinct().count(), grams.select("gram").distinct().count())


def _index(model: Model, lang: Column) -> Column:
    """Number of a language."""
    return (F.array_position(F.array(*map(F.lit, model.langs)), lang) - 1).cast("int")


def _numbers(values: np.ndarray, index: Column) -> Column:
    """The value of each language number."""
    return F.element_at(F.array(*[F.lit(float(x)) for x in values]), index + 1)


def known_scores(model: Model, words: DataFrame) -> DataFrame:
    """word, l, add: what each known word adds in the languages that have it."""
    return words.select("word", _index(model, F.col("lang")).alias("l"), (F.log(F.col("n") + SMOOTH) - math.log(SMOOTH)).alias("add"))


def _table(rows: DataFrame, n_langs: int) -> tuple[dict[str, int], np.ndarray]:
    """Rows of keys, language numbers and what they add, as a number for each key and a matrix; its last row, of no key, adds nothing."""
    found = rows.toArrow().combine_chunks()
    keys = pc.dictionary_encode(found.column(0)).combine_chunks()
    out = np.zeros((len(keys.dictionary) + 1, n_langs))
    out[keys.indices.to_numpy(), found.column(1).to_numpy()] = found.column(2).to_numpy()
    return {k: n for n, k in enumerate(keys.dictionary.to_pylist())}, out


def _speller(shared):
    """word, l, add of distinct words, by a table of grams in memory."""

    def run(it):
        index, more, gram_base, base = shared.value
        for b in batches(it):
            words, found = b.column("word").to_pylist(), []
            for w in words:
                framed, own = f"<{w}>", []
                for end in range(1, len(framed) + 1):
                    for n in range(min(LONGEST, end), 0, -1):
                        k = index.get(framed[end - n : end])
                        if k is not None:
                            own.append(k)
                            break
                found.append(own or [len(index)])  # a word without any known gram counts as one place of nothing known
            size = np.fromiter(map(len, found), np.int64, len(found))
            sums = np.add.reduceat(more[np.fromiter(itertools.chain.from_iterable(found), np.int64, int(size.sum()))], np.cumsum(size) - size, axis=0)
            add = (sums + size[:, None] * gram_base) / LONGEST - base
            n = len(base)
            yield pa.record_batch([pa.array(np.repeat(np.array(words, object), n), pa.string()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(words)), pa.int32()), pa.array(add.ravel(), pa.float64())], names=["word", "l", "add"])

    return run


def unseen_scores(model: Model, words: DataFrame, told: int = GRAMS_TOLD) -> DataFrame:
    """word, l, add: what each of the distinct words adds by the longest known grams that end at each of its places."""
    if model.distinct_grams <= told:
        index, more = _table(model.grams.select("gram", _index(model, F.col("lang")).alias("l"), (F.log(F.col("n") + SMOOTH) - math.log(SMOOTH)).alias("add")), len(model.langs))
        shared = words.sparkSession.sparkContext.broadcast((index, more, model.gram_base, model.base))
        return _spread(words, "word").mapInArrow(_speller(shared), "word string, l int, add double")
    framed, every = F.concat(F.lit("<"), F.col("word"), F.lit(">")), F.sequence(F.lit(0), F.lit(len(model.langs) - 1))
    cut = F.transform(F.sequence(F.lit(1), F.length("framed")), lambda e: F.transform(F.sequence(F.lit(1), F.least(e, F.lit(LONGEST))), lambda n: F.struct(e.alias("end"), n.alias("size"), F.substring(F.col("framed"), e - n + 1, n).alias("gram"))))
    places = _spread(words, "word").select("word", framed.alias("framed")).select("word", F.inline(F.flatten(cut)))
    by = model.grams.groupBy("gram").agg(F.collect_list(F.struct(_index(model, F.col("lang")).alias("l"), (F.log(F.col("n") + SMOOTH) - math.log(SMOOTH)).alias("more"))).alias("by"))  # one entry a language
    longest = places.join(by, "gram").groupBy("word", "end").agg(F.max_by("by", "size").alias("by"))
    found = longest.groupBy("word").agg(F.count(F.lit(1)).alias("places"))
    more = longest.select("word", F.inline("by")).groupBy("word", "l").agg(F.sum("more").alias("more"))
    # A word without any known gram counts as one place of nothing known.
    whole = words.join(found, "word", "left").select("word", F.coalesce("places", F.lit(1)).alias("places"), F.explode(every).alias("l"))
    added = (F.col("places") * _numbers(model.gram_base, F.col("l")) + F.coalesce("more", F.lit(0.0))) / LONGEST
    return whole.join(more, ["word", "l"], "left").select("word", "l", (added - _numbers(model.base, F.col("l"))).alias("add"))


def _reader(shared, n_langs: int):
    """Each text's words: how many, what the heavy ones add by language, and the others with their numbers."""

    def run(it):
        index, add = shared.value
        row = TaskContext.get().partitionId() << 33
        for b in batches(it):
            split = [words_of(t) for t in texts_of(b.column("text"))]
            per = np.fromiter(map(len, split), np.int64, len(split))
            at = np.fromiter(map(index.get, itertools.chain.from_iterable(split), itertools.repeat(-1)), np.int64, int(per.sum()))
            stops = np.cumsum(per)
            # The last row adds nothing: it stands for light words.
            sums = np.zeros((len(split), n_langs))
            some = np.flatnonzero(per)
            if len(some):
                sums[some] = np.add.reduceat(add[at], (stops - per)[some], axis=0)
            light = [Counter(itertools.compress(words, (at[e - n : e] < 0).tolist())) for words, n, e in zip(split, per.tolist(), stops.tolist(), strict=True)]
            ends = pa.array(np.concatenate(([0], np.cumsum([len(c) for c in light]))), pa.int32())
            entries = pa.StructArray.from_arrays([pa.array([w for c in light for w in c], pa.string()), pa.array([n for c in light for n in c.values()], pa.int32())], names=["word", "n"])
            yield pa.record_batch(
                [b.column("doc_id"), b.column("held_out"), pa.array(np.arange(row, row + len(split)), pa.int64()), pa.array(per, pa.int64()), pa.array(list(sums), pa.list_(pa.float64())), pa.ListArray.from_arrays(ends, entries)],
                names=["doc_id", "held_out", "row", "n", "heavy", "light"],
            )
            row += len(split)

    return run


def identify(docs: DataFrame, model: Model, heavy: int = HEAVY, told: int = GRAMS_TOLD) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    tune(spark)
    held = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    if not model.langs:
        return docs.select("doc_id", held.alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    floor = model.word_total.sum() / heavy
    totals = materialize(model.words.groupBy("word").agg(F.sum("n").alias("all")), "totals")
    often = totals.where(F.col("all") > floor).select("word")
    # Fewer than ``heavy`` words are above the floor.
    shared = spark.sparkContext.broadcast(_table(known_scores(model, model.words.join(often, "word", "left_semi")), len(model.langs)))

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.select("doc_id", held.alias("held_out"), "text")
    schema = f"doc_id {kind}, held_out boolean, row long, n long, heavy array<double>, light array<struct<word: string, n: int>>"
    read = materialize(marked.mapInArrow(_reader(shared, len(model.langs)), schema), "read")
    new = read.select(F.explode("light.word").alias("word")).distinct()
    unseen = materialize(unseen_scores(model, new.join(totals, "word", "left_anti"), told), "unseen")
    rarely = known_scores(model, model.words.join(totals.where(F.col("all") <= floor).select("word"), "word", "left_semi"))
    met = read.select("row", F.inline("light")).join(rarely.unionByName(unseen), "word")
    sums = met.groupBy("row", "l").agg(F.sum(F.col("n") * F.col("add")).alias("add")).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("l", "add"))).alias("by"))

    base = F.array(*[F.lit(float(x)) for x in model.base])
    total = F.transform("heavy", lambda x, k: x + F.col("n") * F.element_at(base, k + 1) + F.coalesce(F.try_element_at(F.col("by"), k), F.lit(0.0)))
    scored = read.drop("light").join(sums, "row", "left").select("doc_id", "held_out", "n", total.alias("total"))
    best = scored.withColumn("best", F.array_max("total")).withColumn("at", F.array_position("total", F.col("best")).cast("int"))
    posterior = 1.0 / F.aggregate("total", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("best")))
    lettered = F.col("n") > 0
    return best.select("doc_id", "held_out", F.when(lettered, F.element_at(F.array(*map(F.lit, model.langs)), F.col("at"))).otherwise("und").alias("lang_pred"), F.when(lettered, posterior).otherwise(0.0).alias("score"))
