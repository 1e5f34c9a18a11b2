"""Language-model scoring with a causal self-attention model on subword ids.

A word is either repeated from the text so far or spelt in subwords up to its end.  Every subword is
predicted by attention: the vocabulary is a binary tree (first whether a word begins, then classes of
subwords, then subwords), and at each node on the way to a subword the model turns by

    sigmoid(what the corpus says there after the previous subword + state . vector of the node)

where the state is that of a causal self-attention layer over the window.  The turns of a node add
up to one, so all subwords do, and a text's score is a proper log-probability.

Training counts every word of the corpus once, distributed; from that table come the word-unigram
base score and the corpus's own turns.  The network is trained in numpy on every subword of every
training text, each once a pass: texts become ids once, in a table of their windows, every part of
that table trains from the same weights, and the weights the parts end with are averaged row by row
in Spark, ``ROUNDS`` times.  The heaviest nodes of the tree are worked on as one matrix, the others
turn by turn.

Texts are scored in windows of ``WINDOW`` subwords that overlap by ``OVERLAP``; each subword is
scored once, in the window that shows it most context, by masked attention over batches of windows.

Words frequent enough that only ``HEAVY`` of them can exist are broadcast with their counts; all
others meet their counts in a join on the word, so nothing that grows with the vocabulary is sent
to every task.

Defined results: null text counts as empty, which is its end token alone; rows with a null id are
neither learned from nor held out; repeated rows count as often as they stand there; without
training rows every count is zero; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, crc_mod, materialize, tune
from quire.llm.subwords import encoder

FOLDS, HELD_OUT = 7, 2
END = b" "  # no word holds a space
HEAVY = 1_000_000
FLUSH, REMEMBERED = 400_000, 150_000
#: Subwords with rows of their own, and nodes with columns of their own, in the table of the corpus's turns.
FREQUENT = 1_536
BACKOFF = 2.0
WIDTH, WINDOW, OVERLAP = 16, 16, 4
#: Classes of subwords that begin words, and of others.
OPENING, INNER = 24, 48
#: Neighbours that tell classes apart.
SEEN = 128
#: The weight of the text's own words, and the number of them that earns half of it.
RECENT, RECENT_FROM = 0.15, 30
#: Bytes of a slice, where windows of slices are asked for.
SLICE = 128
#: Times that the trainers are averaged, windows a step, windows shuffled at once, and the rate.
ROUNDS, BATCH, SHUFFLED, RATE = 1, 256, 8_192, 0.1
#: Bytes of text, and windows, that are worked on at once; windows in one row of a table.
PIECE, ROWS, BLOCK = 512 << 10, 2_048, 512
#: Nodes that are worked on as one matrix; results do not depend on it.
DENSE = 32


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a column of texts, the number of each word that stands in it, and how many words each text has.

    A-Z are lowered; words end at \\x20 and \\x09-\\x0D; a null text has none.
    """
    whole = texts.take(pa.array(np.arange(len(texts))))  # a copy: these kernels misread slices
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(whole.cast(pa.large_string()), "")))
    flat, per = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        before = np.concatenate(([0], np.cumsum(full)))
        stops = np.cumsum(per)
        per = before[stops] - before[stops - per]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), per


class Words(dict):
    """Ids of words met lately, worked out when first asked for."""

    def __init__(self, encoder, signs: dict[bytes, bytes], older: dict[bytes, bytes]):
        self.encoder, self.signs, self.older = encoder, signs, older

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word[-1:] in self.signs and word[-2:-1].isalnum():  # signs after a letter or digit are pre-tokens of their own
                return self[word[:-1]] + self.signs[word[-1:]]
            ids = self.encoder.word(word.decode("utf-8", "replace"))
        self[word] = ids
        return ids


class Ids:
    """Subword ids of single words, each with the space before it."""

    def __init__(self, tokenizer: str):
        self.encoder = encoder(tokenizer, plain=True)  # the end id closes texts and never stands in one
        self.end = self.encoder.library.get_vocab_size() - 1
        self.signs = {x.encode(): self.encoder.ids([x])[0] for x in ".,;:!?"}
        self.known = Words(self.encoder, self.signs, {})

    def many(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = Words(self.encoder, self.signs, dict(self.known))
        return list(map(self.known.__getitem__, words))


@functools.lru_cache(maxsize=2)
def ids_for(tokenizer: str) -> Ids:
    return Ids(tokenizer)


# ---------------------------------------------------------------- counting


class Counts(dict):
    """Words with how often they were met."""

    def add(self, words: list[bytes], numbers: np.ndarray, per: np.ndarray) -> None:
        get = self.get
        self.update({w: get(w, 0) + n for w, n in zip(words, np.bincount(numbers, minlength=len(words)).tolist(), strict=True)})
        self[END] = get(END, 0) + len(per)

    def out(self) -> list[pa.Array]:
        rows = [pa.array(list(self.keys()), pa.binary()), pa.array(list(self.values()), pa.int64())]
        self.clear()
        return rows


def _count_words(it):
    counts = Counts()
    for b in batches(it, 2 << 20):
        counts.add(*split_words(b.column("text")))
        if len(counts) > FLUSH:
            yield pa.record_batch(counts.out(), names=["word", "n"])
    if counts:
        yield pa.record_batch(counts.out(), names=["word", "n"])


def _read_once(tokenizer: str):
    """Rows with a word and its count, and rows with the ids of up to ``BLOCK`` windows and the one before them."""

    def run(it):
        counts, ids = Counts(), ids_for(tokenizer)
        names, kind = ["word", "n", "coded"], id_kind(ids.end)

        def told():
            rows = counts.out()
            return pa.record_batch([*rows, pa.nulls(len(rows[0]), pa.binary())], names=names)

        for b in batches(it, PIECE):
            c = coded(b.column("text"), ids)
            counts.add(c.words, c.numbers, c.per)
            # Every text closes with the end id, so what stands before any id is the one before it in the row of windows.
            flat = np.concatenate(([ids.end], whole_windows(c.out, c.ends, ids.end)[1].ravel())).astype(kind)
            rows = [flat[a : a + BLOCK * WINDOW + 1].tobytes() for a in range(0, len(flat) - 1, BLOCK * WINDOW)]
            yield pa.record_batch([pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.int64()), pa.array(rows, pa.binary())], names=names)
            if len(counts) > FLUSH:
                yield told()
        if counts:
            yield told()

    return run


def id_kind(end: int) -> str:
    """How ids lie in tables."""
    return "<u2" if end < 1 << 16 else "<u4"


def read_once(lessons: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """Word counts (word, n) and windows (coded) of every text, read and split once."""
    both = materialize(lessons.select("text").mapInArrow(_read_once(tokenizer), "word binary, n long, coded binary"), "lessons")
    counted = both.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counted, "words"), both.where(F.col("coded").isNotNull()).select("coded")


def count_words(lessons: DataFrame) -> DataFrame:
    """word, n over every text; the end token is the word of one space."""
    return materialize(lessons.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def _pair_rows(tokenizer: str):
    """(before, after, n): successions inside words; -1 stands for the space between words."""

    def run(it):
        ids = ids_for(tokenizer)
        keys, sums, held = [], [], 0

        def out():
            # (before + 1) and (after + 1) in one number; equal pairs added up
            u, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(u), np.int64)
            np.add.at(n, at, np.concatenate(sums))
            return pa.record_batch([pa.array((u >> 32) - 1, pa.int32()), pa.array((u & 0xFFFFFFFF) - 1, pa.int32()), pa.array(n, pa.int64())], names=["before", "after", "n"])

        for b in batches(it, 256 << 10):
            words, ns = b.column("word").to_pylist(), np.array(b.column("n").to_pylist(), np.int64)
            end = np.array([w == END for w in words])
            parts = ids.many([w for w in words if w != END])
            sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            seq = np.frombuffer(b"".join(parts), "<u4").astype(np.int64) + 1
            stops = np.cumsum(sizes)
            before = np.concatenate(([0], seq[:-1]))[: len(seq)]
            before[stops - sizes] = 0
            weight = np.repeat(ns[~end], sizes)
            keys += [before << 32 | seq, seq[stops - 1] << 32, np.full(int(end.sum()), ids.end + 1)]
            sums += [weight, ns[~end], ns[end]]
            held += len(seq)
            if held > 2_000_000:
                yield out()
                keys, sums, held = [], [], 0
        if keys:
            yield out()

    return run


# ---------------------------------------------------------------- the tree


@dataclass
class Tree:
    """Ways from the root to every id.  Node 0 asks whether a word begins; turns are numbered 2 * node + side."""

    opening: np.ndarray  # id -> whether it begins a word (the end id does)
    start: np.ndarray  # id -> its first turn in ``turns``, node 0 left out
    size: np.ndarray  # id -> how many turns it takes
    turns: np.ndarray
    nodes: int

    def ways(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All turns of all ids in a row, and where each id's begin."""
        size = self.size[ids]
        first = np.cumsum(size, dtype=np.int32) - size
        return self.turns.take(np.arange(int(first[-1] + size[-1]) if len(size) else 0, dtype=np.int32) + np.repeat(self.start[ids] - first, size)), first


def _huffman(weights: list[float]) -> list[tuple[int, ...]]:
    """Ways to the leaves of a binary tree by weight: (node, side) as 2 * node + side, nodes numbered from the heaviest."""
    if len(weights) < 2:
        return [()] * len(weights)
    heap = [(w, k, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    children, n = {}, len(weights)
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        children[n] = (x, y)
        heapq.heappush(heap, (a + b, n, n))
        n += 1
    out: list[tuple[int, ...]] = [()] * len(weights)
    todo = [(n - 1, ())]
    while todo:
        at, way = todo.pop()
        if at < len(weights):
            out[at] = way
            continue
        for side, child in enumerate(children[at]):
            todo.append((child, (*way, 2 * (n - 1 - at) + side)))
    return out


def plant(opening: np.ndarray, kind: np.ndarray, weight: np.ndarray) -> Tree:
    """The tree of all ids: within those that begin words and those that don't, by class and then by weight."""
    ways: list[tuple[int, ...]] = [()] * len(kind)
    free = 1
    for side in (True, False):
        members = [np.flatnonzero((opening == side) & (kind == c)) for c in np.unique(kind[opening == side]).tolist()]
        top = _huffman([float(weight[m].sum()) for m in members])
        base, free = free, free + max(0, len(members) - 1)
        for m, above in zip(members, top, strict=True):
            head = tuple(t + 2 * base for t in above)
            for i, below in zip(m.tolist(), _huffman(weight[m].tolist()), strict=True):
                ways[i] = head + tuple(t + 2 * free for t in below)
            free += max(0, len(m) - 1)
    size = np.fromiter(map(len, ways), np.int32, len(ways))
    return Tree(opening, (np.cumsum(size) - size).astype(np.int32), size, np.fromiter(itertools.chain.from_iterable(ways), np.int32, int(size.sum())), free)


@dataclass
class Statistics:
    """What the corpus itself says at the nodes of the tree, as odds of the other side for every turn."""

    tree: Tree
    place: np.ndarray  # id -> row of ``after``; all but the frequent share the last
    column: np.ndarray  # node -> column of ``after``, or -1 where the previous subword makes no difference
    after: np.ndarray  # row, column -> log odds of side 1
    alone: np.ndarray  # node -> log odds of side 1 whatever went before
    heavy: np.ndarray  # the nodes most often turned at, node 0 first

    def odds(self, before: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Log odds of side 1 at nodes after the given ids."""
        at = self.column[node]
        return np.where(at >= 0, self.after[self.place[before], at], self.alone[node])


def _kmeans(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            own = near == c
            if own.any():
                v = (x[own] * weight[own, None]).sum(axis=0)
                centres[c] = v / max(1e-9, float(np.linalg.norm(v)))
    return near


def _neighbours(size: int, context: np.ndarray, tokenizer: str):
    """(id, context, n): how often ids share a window with each of the frequent ``context`` ids."""
    at = np.full(size, -1, np.int64)
    at[context] = np.arange(len(context))

    def run(it):
        sums, one = np.zeros((size, len(context)), np.float32), np.float32(1)
        flat = sums.ravel()
        for ids in (x[a : a + ROWS] for _, x in _held(it, tokenizer) for a in range(0, len(x), ROWS)):
            near = np.zeros((len(ids), len(context)), bool)
            seen = at.take(ids)
            row, place = np.nonzero(seen >= 0)
            near[row, seen[row, place]] = True
            row, met = np.nonzero(near)
            np.add.at(flat, (ids.take(row, axis=0) * len(context) + met[:, None]).ravel(), one)
        i, c = np.nonzero(sums)
        for a in range(0, len(i), 100_000):
            x, y = i[a : a + 100_000], c[a : a + 100_000]
            yield pa.record_batch([pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(sums[x, y], pa.float64())], names=["id", "context", "n"])

    return run


def statistics(counted: DataFrame, windows: DataFrame, tokenizer: str, frequent: int = FREQUENT) -> tuple[Statistics, np.ndarray]:
    """Turns by successions over all distinct words, weighted by their counts; and vectors of ids by their neighbours in ``windows`` (ids, or the texts they are cut from)."""
    spark, ids = counted.sparkSession, ids_for(tokenizer)
    size = ids.end + 1
    pairs = materialize(counted.mapInArrow(_pair_rows(tokenizer), "before int, after int, n long").groupBy("before", "after").agg(F.sum("n").alias("n")), "pairs")
    after = pairs.where("after >= 0").groupBy("after").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("before") < 0, F.col("n")).otherwise(0)).alias("first")).toArrow()
    total = np.zeros(size)  # at most one row a vocabulary entry
    total[after["after"].to_numpy()] = after["n"].to_numpy()
    top = np.argsort(-total, kind="stable")
    place = np.full(size, frequent, np.int32)
    place[top[:frequent]] = np.arange(min(frequent, size))
    opening = np.array([(ids.encoder.library.id_to_token(k) or "").startswith("Ġ") for k in range(size)])
    opening[ids.end] = True

    met = windows.mapInArrow(_neighbours(size, top[:SEEN], tokenizer), "id int, context int, n double").groupBy("id", "context").agg(F.sum("n").alias("n")).toArrow()  # at most SEEN rows an id
    near = np.zeros((size, SEEN))
    near[met["id"].to_numpy(), met["context"].to_numpy()] = met["n"].to_numpy()
    expected = near.sum(axis=1, keepdims=True) * near.sum(axis=0) / max(1.0, near.sum())
    near = np.maximum(0, np.sqrt(near) - np.sqrt(expected))
    rng = np.random.default_rng(7)
    values, axes = np.linalg.eigh(near.T @ near)
    flat = near @ axes[:, np.argsort(-values)[:WIDTH]]
    flat /= np.maximum(1e-9, np.linalg.norm(flat, axis=1, keepdims=True))
    weight, kind = total + 0.05, np.zeros(size, np.int64)
    for side, n in ((True, OPENING), (False, INNER)):
        rows = np.flatnonzero(opening == side)
        kind[rows] = _kmeans(flat[rows], weight[rows], n, rng)
    tree = plant(opening, kind, weight)

    # Every node by its weight; the heaviest have columns, and each way is known as far as it has them.
    turned = np.bincount(tree.turns, weights=np.repeat(weight, tree.size), minlength=2 * tree.nodes).reshape(-1, 2)
    turned[0] = weight[~opening].sum(), weight[opening].sum()
    alone = np.log(turned[:, 1]) - np.log(turned[:, 0])
    inner = np.unique(tree.ways(np.flatnonzero(~opening))[0] >> 1)
    inner = inner[np.argsort(-turned[inner].sum(axis=1), kind="stable")][: frequent - 1]
    column = np.full(tree.nodes, -1, np.int32)
    column[0], column[inner] = 0, np.arange(1, len(inner) + 1)
    # Ids that differ only beyond those columns count as one: at most as many groups as columns and one more.
    known = [tuple(t for t in tree.turns[a : a + n].tolist() if column[t >> 1] >= 0) for a, n in zip(tree.start.tolist(), tree.size.tolist(), strict=True)]
    groups = {way: k for k, way in enumerate(dict.fromkeys(w for w, o in zip(known, opening.tolist(), strict=True) if not o))}
    group = [-1 if o else groups[w] for w, o in zip(known, opening.tolist(), strict=True)]
    maps = spark.createDataFrame([(k, int(place[k]), group[k]) for k in range(size)], "id int, place int, grp int")
    near_by = pairs.where("before >= 0").join(F.broadcast(maps.select(F.col("id").alias("before"), "place")), "before").join(F.broadcast(maps.select(F.col("id").alias("after"), "grp")), "after", "left")
    # At most (frequent + 1) * (frequent + 1) rows, whatever the corpus.
    counts = near_by.groupBy("place", F.coalesce("grp", F.lit(-1)).alias("grp")).agg(F.sum("n").alias("n")).toArrow()
    sides = np.zeros((frequent + 1, len(inner) + 1, 2))
    rows, which, n = (counts[c].to_numpy() for c in ("place", "grp", "n"))
    np.add.at(sides, (rows, 0, (which < 0).astype(int)), n)
    for way, k in groups.items():
        own = which == k
        if own.any():
            for t in way:
                np.add.at(sides, (rows[own], column[t >> 1], t & 1), n[own])
    # BACKOFF successions as the corpus has them at large, dealt out over the ways; node 0 has its own.
    prior = turned[np.concatenate(([0], inner))]
    prior[0] /= prior[0].sum()
    prior[1:] /= weight[~opening].sum()
    odds = np.log((sides[..., 1] + BACKOFF * prior[:, 1]) / (sides[..., 0] + BACKOFF * prior[:, 0]))
    heavy = 1 + np.argsort(-turned[1:].sum(axis=1), kind="stable")[: DENSE - 1]
    return Statistics(tree, place, column, odds.astype(np.float32), alone.astype(np.float32), np.concatenate(([0], heavy))), flat.astype(np.float32)


class Ways:
    """Ways to ids, dealt into turns at heavy nodes, as a matrix, and other turns, in a row; and the corpus's odds likewise."""

    def __init__(self, s: Statistics, opened: bool):
        """opened: the turn at node 0, whether a word begins, belongs to each way."""
        tree = s.tree
        self.place, self.nodes = s.place, s.heavy
        rank = np.full(tree.nodes, -1, np.int32)
        rank[s.heavy] = np.arange(len(s.heavy))
        owner, rank = np.repeat(np.arange(len(tree.size)), tree.size), rank[tree.turns >> 1]
        far, side = rank < 0, (2 * (tree.turns & 1) - 1).astype(np.int8)
        #: id, heavy node -> 1 or -1 for the sides taken, 0 off the way.
        self.sign = np.zeros((len(tree.size), len(s.heavy)), np.int8)
        self.sign[owner[~far], rank[~far]] = side[~far]
        if opened:
            self.sign[:, 0] = np.where(tree.opening, 1, -1)
        self.off = np.float32(math.log(2)) * (self.sign == 0).sum(axis=1).astype(np.float32)
        self.turns, self.size = tree.turns[far], np.bincount(owner[far], minlength=len(tree.size)).astype(np.int32)
        self.start = (np.cumsum(self.size) - self.size).astype(np.int32)
        rows, width = s.after.shape
        self.table = np.concatenate((s.after.ravel(), s.alone))
        self.at = np.where(s.column >= 0, s.column, rows * width + np.arange(tree.nodes)).astype(np.int32)
        self.step = np.where(s.column >= 0, width, 0).astype(np.int32)
        self.near = self.odds(s.heavy, np.arange(rows, dtype=np.int32)[:, None])

    def odds(self, node: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.table.take(self.at.take(node) + self.step.take(node) * row, mode="clip")

    def others(self, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """The places by how many other turns they take; all first turns, then all second ones and so on, as nodes, signs and odds; and from where to where each layer lies, and its size."""
        n = self.size.take(ids)
        held = np.bincount(n)
        most = (len(ids) - np.cumsum(held)[:-1]).tolist()
        order = np.argsort((len(held) - n).astype(np.uint16), kind="stable")
        first, row = self.start.take(ids.take(order)), row.take(order)
        stops = list(itertools.accumulate(most, initial=0))
        turns = self.turns.take(deep(first, most, range(len(most))))
        node = turns >> 1
        return order, node, (2 * (turns & 1) - 1).astype(np.float32), self.odds(node, deep(row, most, itertools.repeat(0))), list(zip(stops, stops[1:], most, strict=False))


def deep(x: np.ndarray, most: list[int], plus: Iterable[int]) -> np.ndarray:
    """The first values of ``x``, so many for each layer, and so much more."""
    layers = [x[:m] + k for m, k in zip(most, plus, strict=False)]
    return np.concatenate(layers) if layers else x[:0]


# ---------------------------------------------------------------- the network


_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_ONES = np.ones((WINDOW, 1), np.float32)
_DENSE = ("p", "q", "k", "v")


class Network:
    """w: e (vector of each id as input), n (of each node of the tree), p (of each place), q, k, v."""

    def __init__(self, vectors: np.ndarray, nodes: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        n, d = vectors.shape

        def some(*shape):
            return (rng.standard_normal(shape) / math.sqrt(shape[-1])).astype(np.float32)

        self.w = {"e": vectors + 0.1 * some(n, d), "n": np.zeros((nodes, d), np.float32), "p": 0.1 * some(WINDOW, d), "q": some(d, d), "k": some(d, d), "v": some(d, d)}

    @classmethod
    def copy(cls, other: Network) -> Network:
        own = cls.__new__(cls)
        own.w = {name: x.copy() for name, x in other.w.items()}
        return own

    def attend(self, ids: np.ndarray):
        """Hidden states of windows of ids, by masked attention."""
        w = self.w
        x = w["e"].take(ids, axis=0) + w["p"]
        flat = x.reshape(-1, WIDTH) @ np.hstack((w["q"] * np.float32(1 / math.sqrt(WIDTH)), w["k"], w["v"]))
        q, k, v = (flat[:, a : a + WIDTH].reshape(x.shape) for a in (0, WIDTH, 2 * WIDTH))
        a = np.matmul(q, np.ascontiguousarray(k.transpose(0, 2, 1)))  # BLAS takes no transposed stack on that side
        np.exp(np.minimum(a, 30, out=a), out=a)
        a *= _MASK
        a /= (a.reshape(-1, WINDOW) @ _ONES + np.float32(1e-30)).reshape(*a.shape[:2], 1)
        return x, q, k, v, a, x + np.matmul(a, v)

    def step(self, ids: np.ndarray, turns: np.ndarray, first: np.ndarray, which: np.ndarray, odds: np.ndarray, real: np.ndarray | None = None) -> tuple[float, dict]:
        """Mean loss of a batch of windows over the turns of what follows each place, and its gradients.

        turns: of all places in a row, ``first``: where each place's begin, ``which``: the place of each, ``odds``: the corpus's,
        ``real``: places that count (all).
        Gradients of e and n are (rows, values) of the rows met.
        """
        w, held = self.w, self.attend(ids)
        h = held[-1]
        flat, node, side = h.reshape(-1, WIDTH), turns >> 1, (turns & 1).astype(np.float32)
        vectors, states = w["n"].take(node, axis=0), flat.take(which, axis=0)
        z = odds + np.einsum("ij,ij->i", vectors, states)
        np.clip(z, -30, 30, out=z)
        e = np.exp(-z)
        p = 1 / (1 + e)
        each, n = np.log1p(e) + (1 - side) * z, np.float32(ids.size)
        d_z = (p - side)[:, None]
        if real is not None:
            n = np.float32(max(1, real.sum()))
            each, d_z = each * real[which], d_z * real[which][:, None]
        loss, d_z = each.sum() / n, d_z / n
        vectors *= d_z
        states *= d_z
        d_h = np.add.reduceat(vectors, first, axis=0).reshape(h.shape)
        return float(loss), {"n": _by_row(node, states)} | self.back(ids, held, d_h)

    def back(self, ids: np.ndarray, held, d_h: np.ndarray) -> dict:
        """Gradients of all but n from those of the states; ``held``: what attention gave."""
        w, (x, q, k, v, a, _) = self.w, held
        d_a, d_v = np.matmul(d_h, np.ascontiguousarray(v.transpose(0, 2, 1))), np.matmul(a.transpose(0, 2, 1), d_h)
        d_a -= np.einsum("bij,bij->bi", d_a, a)[..., None]
        d_a *= a
        x, d_x, grads = x.reshape(-1, WIDTH), d_h.reshape(-1, WIDTH), {}
        # q is held scaled, so the scale of the products is left to that of its own gradient.
        for name, d, scale in (("q", np.matmul(d_a, k), np.float32(1 / math.sqrt(WIDTH))), ("k", np.matmul(d_a.transpose(0, 2, 1), q), np.float32(1)), ("v", d_v, np.float32(1))):
            flat = d.reshape(-1, WIDTH)
            grads[name] = x.T @ flat * scale
            d_x = d_x + flat @ (w[name].T * scale)
        return grads | {"p": d_x.reshape(len(ids), -1).sum(axis=0).reshape(WINDOW, WIDTH), "e": _by_row(ids.ravel(), d_x)}

    def turn(self, ways: Ways, h: np.ndarray, ids: np.ndarray, before: np.ndarray) -> tuple[float, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """What ``step`` makes of states, as loss, gradients of the states, and rows and gradients of n met, for the whole ways to ``ids``."""
        n, row, heavy, count = self.w["n"], ways.place.take(before), self.w["n"].take(ways.nodes, axis=0), np.float32(max(1, len(ids)))
        # By how much the side taken is likelier; then the odds of the other side.
        sign = ways.sign.take(ids, axis=0)
        met, sign = np.bitwise_or.reduce(sign, axis=0) != 0, sign.astype(np.float32)
        z = h @ heavy.T
        z += ways.near.take(row, axis=0)
        z *= sign
        _odds_against(z)
        loss = np.log1p(z).sum(dtype=np.float64) - ways.off.take(ids).sum(dtype=np.float64)
        z /= 1 + z
        z *= sign
        z *= -1 / count
        d_h, d_heavy = z @ heavy, z.T @ h

        order, node, sign, d_z, layers = ways.others(ids, row)
        sorted_h, vectors, dots = h.take(order, axis=0), n.take(node, axis=0), np.empty(len(node), np.float32)
        for a, b, m in layers:
            np.einsum("ij,ij->i", vectors[a:b], sorted_h[:m], out=dots[a:b])
        d_z += dots
        d_z *= sign
        _odds_against(d_z)
        loss += np.log1p(d_z).sum(dtype=np.float64)
        d_z /= 1 + d_z
        d_z *= sign
        d_z *= -1 / count
        vectors *= d_z[:, None]
        d_far, states = np.zeros_like(h), np.empty_like(vectors)
        for a, b, m in layers:
            d_far[:m] += vectors[a:b]
            np.multiply(sorted_h[:m], d_z[a:b, None], out=states[a:b])
        d_h[order] += d_far
        rows, values = _by_row(node, states)
        return float(loss / count), d_h, (np.concatenate((ways.nodes[met], rows)), np.concatenate((d_heavy[met], values)))

    def fit(self, s: Statistics, before: np.ndarray, ids: np.ndarray, rate: float = RATE, batch: int = BATCH) -> tuple[list[float], dict[str, np.ndarray]]:
        """One pass over windows of ids with those before them; the losses, and how often each row of e and n was met."""
        losses, met, _ = self.fit_all(s, [(before, ids)], rate, batch)
        return losses, met

    def fit_all(self, s: Statistics, held: Iterable[tuple[np.ndarray, np.ndarray]], rate: float = RATE, batch: int = BATCH) -> tuple[list[float], dict[str, np.ndarray], int]:
        """One pass over all that ``held`` yields, by Adagrad with one scale a row; the losses, how often each row of e and n was met, and the number of windows."""
        rng, losses, n = np.random.default_rng(5), [], 0
        scale = {name: np.full((len(x), 1) if name in "en" else x.shape, 1e-8, np.float32) for name, x in self.w.items()}
        met, ways = {name: np.zeros(len(self.w[name])) for name in "en"}, Ways(s, opened=True)
        for before, ids in _regrouped(held, SHUFFLED):
            order, n = rng.permutation(len(ids)), n + len(ids)
            for a in range(0, len(order), batch):
                own = order[a : a + batch]
                losses.append(self._learn(ways, before.take(own, axis=0), ids.take(own, axis=0), rate, scale, met))
        return losses, met, n

    def _learn(self, ways: Ways, before, ids, rate, scale, met) -> float:
        held = self.attend(before)
        # What stands in front of a text is seen but not predicted.
        real = np.flatnonzero(counting(before, ids, len(ways.size) - 1))
        loss, d_real, rows = self.turn(ways, held[-1].reshape(-1, WIDTH).take(real, axis=0), ids.ravel().take(real), before.ravel().take(real))
        d_h = np.zeros_like(held[-1])
        d_h.reshape(-1, WIDTH)[real] = d_real
        grads = {"n": rows} | self.back(before, held, d_h)
        for name, gr in grads.items():
            if name in "en":
                rows, values = gr
                sums = scale[name].take(rows, axis=0) + np.einsum("ij,ij->i", values, values)[:, None] / np.float32(WIDTH)
                scale[name][rows] = sums
                values *= np.float32(-rate) / np.sqrt(sums)
                values += self.w[name].take(rows, axis=0)
                self.w[name][rows] = values
                met[name][rows] += 1
            else:
                scale[name] += np.square(gr)
                self.w[name] -= np.float32(0.2 * rate) * gr / np.sqrt(scale[name])
        return loss


def _odds_against(z: np.ndarray) -> None:
    """Odds against, from log odds for, in place."""
    np.clip(z, -30, 30, out=z)
    np.exp(np.negative(z, out=z), out=z)


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    if int(rows.max(initial=0)) < 1 << 16:
        rows = rows.astype(np.uint16)  # sorted by radix
    order = np.argsort(rows, kind="stable")
    held = rows[order]
    first = np.flatnonzero(np.diff(held.astype(np.int64), prepend=-1))
    return held[first].astype(np.int64), np.add.reduceat(values.take(order, axis=0), first, axis=0)


def counting(before: np.ndarray, ids: np.ndarray, end: int) -> np.ndarray:
    """Whether each place of windows holds an id of a text, not what stands in front of its start, where ends follow ends."""
    fill = np.logical_and.accumulate((ids == end) & (before == end), axis=1)
    fill[:, -1] = False  # the end of an empty text
    return ~fill.ravel()


def _regrouped(held: Iterable[tuple[np.ndarray, np.ndarray]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same windows, ``most`` at a time."""
    waiting, n = [], 0
    for before, ids in held:
        for a in range(0, len(ids), most):
            waiting.append((before[a : a + most], ids[a : a + most]))
            n += len(waiting[-1][1])
            if n >= most:
                x, y = (np.concatenate(p) for p in zip(*waiting, strict=True))
                yield x[:most], y[:most]
                waiting, n = [(x[most:], y[most:])], n - most
    if n:
        yield tuple(np.concatenate(p) for p in zip(*waiting, strict=True))


@dataclass
class Coded:
    """A batch of texts: their words by number, and their ids in a row, each text closed by the end id."""

    words: list[bytes]  # by number
    numbers: np.ndarray  # of all words of all texts
    per: np.ndarray  # words of each text
    out: np.ndarray  # ids
    begins: np.ndarray  # whether an id begins a word, ends among them
    ends: np.ndarray  # where each text's ids end


def coded(texts: pa.Array, ids: Ids) -> Coded:
    words, numbers, per = split_words(texts)
    parts = ids.many(words)
    each = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    pool, origin = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(each) - each
    sizes = each[numbers]
    at = np.cumsum(sizes) - sizes
    lengths = np.diff(np.concatenate((at, [sizes.sum()]))[np.concatenate(([0], np.cumsum(per)))]) + 1
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    keep = np.ones(n, bool)
    keep[ends - 1] = False
    out, begins = np.full(n, ids.end, np.int64), np.ones(n, bool)
    out[keep] = pool[np.arange(len(keep) - len(ends)) + np.repeat(origin[numbers] - at, sizes)]
    inner = np.zeros(len(keep) - len(ends), bool)
    inner[at] = True
    begins[keep] = inner
    return Coded(words, numbers, per, out, begins, ends)


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every window in its text, and the text of each; the first window starts OVERLAP places early."""
    step = WINDOW - OVERLAP
    n = -(-lengths // step)
    text = np.repeat(np.arange(len(lengths)), n)
    return (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * step - OVERLAP, text


def inputs(out: np.ndarray, ends: np.ndarray, end: int) -> np.ndarray:
    """The id before each, the end id before the first of a text."""
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[np.concatenate(([0], ends[:-1]))] = end
    return before


def repeats(c: Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word how often it stands earlier in its text; then text, number and count of the distinct words of each text."""
    n = len(c.words) + 1
    key = np.repeat(np.arange(len(c.per)), c.per) * n + c.numbers
    order = np.argsort(key, kind="stable")
    opened = np.flatnonzero(np.diff(key[order], prepend=-1))
    counts = np.diff(opened, append=len(key))
    rank = np.empty(len(key))
    rank[order] = np.arange(len(key)) - np.repeat(opened, counts)
    distinct = key[order][opened]
    return rank, distinct // n, distinct % n, counts


class Scorer:
    def __init__(self, stats: Statistics, network: Network, ids: Ids):
        self.stats, self.network, self.ids = stats, network, ids
        self.ways = Ways(stats, opened=False)

    def each(self, out: np.ndarray, ends: np.ndarray, windows: int = 192) -> tuple[np.ndarray, np.ndarray]:
        """For each id: its log probability given whether a word begins there, and the odds against that one does."""
        s, before = self.stats, inputs(out, ends, self.ids.end)
        lengths = np.diff(np.concatenate(([0], ends)))
        first, text = layout(lengths)
        ways, n = self.ways, self.network.w["n"]
        heavy, places, ones = n.take(ways.nodes, axis=0).T, s.place[before], np.ones((len(ways.nodes), 1), np.float32)
        prob, shut = np.empty(len(out), np.float32), np.empty(len(out), np.float32)
        done = 0
        stops = np.minimum(first + WINDOW, lengths[text]) + (ends - lengths)[text]
        for block in range(0, len(first), windows):
            f, t = first[block : block + windows], text[block : block + windows]
            where = ((ends - lengths)[t] + f)[:, None] + np.arange(WINDOW)
            seen = before.take(where, mode="clip")
            seen[f < 0, :OVERLAP] = self.ids.end  # before a text there is its start only
            h = self.network.attend(seen)[-1][:, OVERLAP:].reshape(-1, WIDTH)
            # The ids that windows are to score follow one another; only a text's last window scores fewer.
            end = int(stops[min(block + windows, len(first)) - 1])
            inside = (where[:, OVERLAP:] < ends[t][:, None]).ravel()
            if not inside.all():
                h = h[inside]
            own = slice(done, end)
            row, ids, done = places[own], out[own], end
            z = h @ heavy
            z += ways.near.take(row, axis=0)
            shut[own] = -z[:, 0]
            z *= ways.sign.take(ids, axis=0)
            np.log1p(np.exp(np.negative(np.clip(z, -60, 60, out=z), out=z), out=z), out=z)
            sums = (z @ ones)[:, 0] - ways.off.take(ids)
            order, node, sign, z, layers = ways.others(ids, row)
            vectors, sorted_h, dots = n.take(node, axis=0), h.take(order, axis=0), np.empty(len(node), np.float32)
            for a, b, m in layers:
                np.einsum("ij,ij->i", vectors[a:b], sorted_h[:m], out=dots[a:b])
            z += dots
            z *= sign
            np.log1p(np.exp(np.negative(np.clip(z, -60, 60, out=z), out=z), out=z), out=z)
            rest = np.zeros(len(ids), np.float32)
            for a, b, m in layers:
                rest[:m] += z[a:b]
            sums[order] += rest
            prob[own] = -sums
        return prob.astype(np.float64), np.exp(np.clip(shut.astype(np.float64), -60, 60))

    def score(self, c: Coded, earlier: np.ndarray) -> np.ndarray:
        """log10 probability of each text; ``earlier``: how often each word stands earlier in its text."""
        if not len(c.ends):
            return np.empty(0)
        spelt, shut = self.each(c.out, c.ends)
        first = np.flatnonzero(c.begins)
        closing = c.out[first] == self.ids.end
        # A word begins given that one does; within it none begins, and where the next begins it ends.
        more = np.log1p(shut)  # minus the log probability that a word begins
        inner = spelt - np.where(c.begins, 0, more - np.log(shut))
        word = np.add.reduceat(inner, first)
        word[~closing] -= more[first[np.flatnonzero(~closing) + 1]]
        at, met = np.empty(len(first)), np.zeros(len(first))
        met[~closing] = earlier
        at[~closing] = np.arange(len(c.numbers)) - np.repeat(np.cumsum(c.per) - c.per, c.per)
        at[closing] = c.per
        again = RECENT * at / (at + RECENT_FROM)
        word += np.log1p(-again)
        hit = np.flatnonzero(met)
        word[hit] = np.logaddexp(np.log(again[hit] * met[hit] / at[hit]), word[hit])
        return np.add.reduceat(word, np.concatenate(([0], np.flatnonzero(closing)[:-1] + 1))) / math.log(10)


# ---------------------------------------------------------------- training and scoring tables


def _pieces(texts: pa.Array, at: list[int], step: int):
    """(whether it opens the text, bytes): ``SLICE`` bytes out of every ``step`` of each text, from its own place on; texts are not copied."""
    if texts.buffers()[2] is None:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    raw = memoryview(texts.buffers()[2])
    for a, e, first in zip(ends, ends[1:], at, strict=False):
        for start in range(a + first, e, step):
            yield start == a, bytes(raw[start : min(start + SLICE, e)])


def whole_windows(out: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the ids before, and of the ids, of whole texts: every id once; in front of a text's first window stand ends."""
    lengths = np.diff(np.concatenate(([0], ends)))
    fill = -lengths % WINDOW
    at = np.arange(len(out)) + np.repeat(np.cumsum(fill), lengths)
    before, ids = (np.full(len(out) + int(fill.sum()), end, np.int64) for _ in range(2))
    before[at], ids[at] = inputs(out, ends, end), out
    return before.reshape(-1, WINDOW), ids.reshape(-1, WINDOW)


def _held(it, tokenizer: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of batches of texts, or of those that a table of windows holds, coded together or one a row."""
    for b in batches(it, PIECE):
        if "text" in b.schema.names:
            ids = ids_for(tokenizer)
            c = coded(b.column("text"), ids)
            yield whole_windows(c.out, c.ends, ids.end)
        elif "coded" in b.schema.names:
            kind = id_kind(ids_for(tokenizer).end)
            rows = [np.frombuffer(x, kind) for x in b.column("coded").to_pylist()]
            yield tuple(np.concatenate([r[own] for r in rows]).reshape(-1, WINDOW).astype(np.int64) for own in (slice(None, -1), slice(1, None)))
        else:
            yield tuple(np.frombuffer(b"".join(b.column(k).to_pylist()), "<u4").reshape(-1, WINDOW).astype(np.int64) for k in ("before", "ids"))


def _windows(tokenizer: str, step: int):
    """Windows of ids, and of those before them, of the whole words of text slices; the last is filled up with what went before."""

    def run(it):
        ids, row = ids_for(tokenizer), TaskContext.get().partitionId() << 33
        for b in batches(it):
            rows = []
            for opens, piece in _pieces(b.column("text").cast(pa.large_binary()), b.column("at").to_pylist(), step):
                words = piece.lower().split()
                if not opens and piece[:1] not in b" \t\n\x0b\x0c\r":
                    words = words[1:]
                if len(piece) == SLICE and piece[-1:] not in b" \t\n\x0b\x0c\r":
                    words = words[:-1]
                if not words:
                    continue
                run_ids = np.frombuffer(b"".join(ids.many(words)), "<u4")
                whole = np.concatenate((np.full(WINDOW if opens else 1, ids.end, np.uint32), run_ids))
                if len(piece) < SLICE:
                    whole = np.concatenate((whole, np.array([ids.end], np.uint32)))
                for stop in range(len(whole), WINDOW, -WINDOW):
                    rows.append((whole[stop - WINDOW - 1 : stop - 1].tobytes(), whole[stop - WINDOW : stop].tobytes()))
            yield _window_rows(row, [x for x, _ in rows], [y for _, y in rows])
            row += len(rows)

    return run


def _window_rows(row: int, before: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.arange(row, row + len(ids)), pa.int64()), pa.array(before, pa.binary()), pa.array(ids, pa.binary())], names=["row", "before", "ids"])


def _all_windows(tokenizer: str):
    def run(it):
        row = TaskContext.get().partitionId() << 33
        for held in _held(it, tokenizer):
            for a in range(0, len(held[1]), ROWS):
                x, y = ([w.tobytes() for w in part[a : a + ROWS].astype("<u4")] for part in held)
                yield _window_rows(row, x, y)
                row += len(y)

    return run


def windows_of(lessons: DataFrame, tokenizer: str, step: int | None = None) -> DataFrame:
    """row (a number of its own), before, ids: windows of every id of each text; with ``step``, of ``SLICE`` bytes out of so many, from a place that depends on the id."""
    schema = "row long, before binary, ids binary"
    if step is None:
        return materialize(lessons.select("text").mapInArrow(_all_windows(tokenizer), schema), "windows")
    placed = lessons.select(F.pmod(F.xxhash64("doc_id"), F.lit(step)).cast("int").alias("at"), "text")
    return materialize(placed.mapInArrow(_windows(tokenizer, step), schema), "windows")


_COLUMNS = [f"x{k}" for k in range(WIDTH)]


def _trainer(shared, rate: float, tokenizer: str):
    """Rows of the weights that the windows of one part have changed: name, row, how often met, and the row times that."""

    def run(it):
        stats, network = shared.value
        network = Network.copy(network)
        _, met, count = network.fit_all(stats, _held(it, tokenizer), rate)
        if not count:
            return
        for name, w in network.w.items():
            rows = np.flatnonzero(met[name]) if name in "en" else np.arange(len(w))
            n = met[name][rows] if name in "en" else np.full(len(rows), float(count))
            values = w[rows] * n[:, None].astype(np.float32)
            for a in range(0, len(rows), 8 * ROWS):
                own = slice(a, a + 8 * ROWS)
                yield pa.record_batch([pa.array([name] * len(rows[own]), pa.string()), pa.array(rows[own], pa.int32()), pa.array(n[own], pa.float64()), *[pa.array(values[own, k], pa.float32()) for k in range(WIDTH)]], names=["name", "row", "n", *_COLUMNS])

    return run


def fit_together(windows: DataFrame, stats: Statistics, network: Network, rounds: int = ROUNDS, most: int | None = None, tokenizer: str = "") -> Network:
    """The network after ``rounds`` passes over all windows, each the average of independent trainers.

    windows: the windows themselves (``coded`` together with ``tokenizer``), or the texts they are cut from (``text``, likewise).  Each part of the table is one
    trainer's; with ``most`` the windows are dealt by their numbers to trainers of about so many.
    """
    spark = windows.sparkSession
    dealt = windows if most is None else windows.repartition(max(1, -(-windows.count() // most)), "row")
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((stats, network))
        done = dealt.mapInArrow(_trainer(shared, RATE / (1 + k), tokenizer), "name string, row int, n double, " + ", ".join(f"{c} float" for c in _COLUMNS))
        # At most one row for each row of the weights.
        mean = done.groupBy("name", "row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _COLUMNS]).toArrow()
        network = Network.copy(network)
        names, n = mean["name"].to_numpy(), mean["n"].to_numpy()
        values = np.stack([mean[c].to_numpy() for c in _COLUMNS], axis=1) / n[:, None]
        for name, w in network.w.items():
            own = names == name
            w[mean["row"].to_numpy()[own]] = values[own]
    return network


def train(docs: DataFrame, tokenizer: str) -> tuple[DataFrame, Statistics, Network]:
    """docs: doc_id, text.  The table of word counts, the corpus statistics and the trained network."""
    tune(docs.sparkSession)
    lessons = docs.where(F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", "text")
    counted, windows = read_once(lessons, tokenizer)
    stats, vectors = statistics(counted, windows, tokenizer)
    return counted, stats, fit_together(windows, stats, Network(vectors, stats.tree.nodes), tokenizer=tokenizer)


def score_documents(docs: DataFrame, counted: DataFrame, stats: Statistics, network: Network, tokenizer: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    tune(spark)
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # Fewer than HEAVY words can have over a HEAVY-th of all tokens.
    total_n = int(total.n)
    often = counted.where(F.col("n") > total.n / HEAVY).select("word", "n").toArrow()
    heavy = dict(zip(often["word"].to_pylist(), often["n"].to_pylist(), strict=True))
    shared = spark.sparkContext.broadcast((heavy, stats, network))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(it):
        heavy, stats, network = shared.value
        logs = {w: math.log10(n + 1) for w, n in heavy.items()}
        ids = ids_for(tokenizer)
        scorer = Scorer(stats, network, ids)
        end_log = logs.get(END, 0.0)
        row = TaskContext.get().partitionId() << 33
        for b in batches(it, 1 << 20):
            c = coded(b.column("text"), ids)
            earlier, text, number, n = repeats(c)
            scores = scorer.score(c, earlier)
            log = np.fromiter(map(logs.get, c.words, itertools.repeat(-1.0)), np.float64, len(c.words))[number]
            known = log >= 0
            tokens = c.per + 1
            have = np.bincount(text[known], weights=n[known], minlength=len(c.per)).astype(np.int64) + (END in logs)
            sums = np.bincount(text[known], weights=n[known] * log[known], minlength=len(c.per)) + end_log
            words = list(map(c.words.__getitem__, number[~known].tolist()))
            stops = np.concatenate(([0], np.cumsum(np.bincount(text[~known], minlength=len(c.per)))))
            ns = n[~known]
            light = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(ns, pa.int32())], names=["word", "n"]))
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(np.arange(row, row + len(tokens)), pa.int64()), pa.array(tokens, pa.int64()), pa.array(have, pa.int64()), pa.array(sums, pa.float64()), pa.array(scores, pa.float64()), light], names=["doc_id", "held_out", "row", "tokens", "known", "sum", "score", "light"])
            row += len(tokens)

    rows = docs.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    read = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, row long, tokens long, known long, sum double, score double, light array<struct<word: binary, n: int>>")
    read = materialize(read, "scored")  # rows are named once, and texts read once
    every = read.select("row", F.inline("light"))
    lightly = counted.where(F.col("n") <= total.n / HEAVY).select("word", F.col("n").alias("c"))
    met = every.join(lightly, "word").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("sum2"), F.sum("n").alias("known2"))
    base = F.col("sum") + F.coalesce("sum2", F.lit(0.0)) - F.col("tokens") * F.lit(math.log10(total.n + total.v + 1))
    return read.drop("light").join(met, "row", "left").select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(total_n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
