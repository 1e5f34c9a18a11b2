"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as sequences of lower-cased words.  An item of n words may lie in a document
with up to k = n * BUDGET // 100 word edits.  Cut into k + 1 pieces, at least one piece of it is
then found unchanged; an Aho-Corasick automaton finds all pieces of all items in one pass over a
document, and Myers' bit-parallel distance verifies the stretch around each hit.

Items are taken in blocks whose words are bounded by ``BLOCK_WORDS``; a block travels with the
tasks, further blocks are further passes over the rows that the pass before has written, so any
benchmark works and the driver holds one block of it at a time.

Defined results: null texts count as empty; an item without words, with a null text or with a null
id matches nothing; item ids of any type that sorts are returned as they are; repeated items are one
item each and repeated documents share their verdict; an empty benchmark leaves every document
clean; an empty table gives no rows; other columns are ignored, or pass through where rows are kept.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm.common import batches, materialize, texts_of, tune

BUDGET = 20  # edits in a hundred words
BLOCK_WORDS = 2_000_000
_WORD = re.compile(r"\w+")

Item = tuple[object, tuple[str, ...]]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def budget_of(n: int, percent: int = BUDGET) -> int:
    return n * percent // 100


def nearest(peq: dict[str, int], n: int, words: list[str]) -> tuple[int, int]:
    """Least edits between the pattern and any stretch of words, and the first end (exclusive) with it."""
    full, high = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, end = full, 0, n, n, 0
    for j, w in enumerate(words):
        eq = peq.get(w, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        h_up = (down | ~(d | up)) & full
        h_down = up & d
        if h_up & high:
            score += 1
        elif h_down & high:
            score -= 1
        h_up, h_down = h_up << 1 & full, h_down << 1 & full
        up, down = (h_down | ~(x | h_up)) & full, h_up & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    def __init__(self, items: list[Item], percent: int = BUDGET):
        self.items, self.pieces = items, ahocorasick.Automaton()
        self.budgets = [budget_of(len(w), percent) for _, w in items]
        self.peqs: dict[int, dict[str, int]] = {}
        found: dict[str, list[tuple[int, int, int]]] = {}
        for k, ((_, words), most) in enumerate(zip(items, self.budgets, strict=True)):
            edges = [len(words) * j // (most + 1) for j in range(most + 2)]
            for a, b in zip(edges, edges[1:], strict=False):
                found.setdefault(f" {' '.join(words[a:b])} ", []).append((k, a, b - a))
        for text, of in found.items():
            self.pieces.add_word(text, (len(text), of))
        if found:
            self.pieces.make_automaton()

    def peq(self, k: int) -> dict[str, int]:
        if k not in self.peqs:
            masks: dict[str, int] = {}
            for j, w in enumerate(self.items[k][1]):
                masks[w] = masks.get(w, 0) | 1 << j
            self.peqs[k] = masks
        return self.peqs[k]

    def hits(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, least edits, end in words) of each item found in the text, by item id."""
        if not len(self.pieces):
            return []
        words = words_of(text)
        flat = f" {' '.join(words)} "
        around: dict[int, list[tuple[int, int]]] = {}
        starts = None
        for end, (size, of) in self.pieces.iter(flat):
            if starts is None:
                starts = np.cumsum([1, *(len(w) + 1 for w in words)])
            p = int(np.searchsorted(starts, end - size + 2))
            for k, at, _ in of:
                around.setdefault(k, []).append((p - at - self.budgets[k], p - at + len(self.items[k][1]) + self.budgets[k]))
        out = []
        for k, spans in around.items():
            best, where = None, 0
            n, peq, spans = len(self.items[k][1]), self.peq(k), sorted(set(spans))
            a, b = spans[0]
            for c, d in [*spans[1:], (len(words) + n + 1, 0)]:
                if c <= b:
                    b = max(b, d)
                    continue
                lo = max(0, a)
                edits, end = nearest(peq, n, words[lo : max(0, b)])
                if best is None or edits < best:
                    best, where = edits, lo + end
                a, b = c, d
            if best is not None and best <= self.budgets[k]:
                out.append((self.items[k][0], best, where))
        return sorted(out)


@functools.lru_cache(maxsize=2)
def _matcher(items: tuple[Item, ...], percent: int) -> Matcher:
    return Matcher(list(items), percent)


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_WORDS):
    """Distinct items as tuples, in blocks of about ``most`` words each."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.size(F.split("t", r"\s+")) + 1)).first()[0] or 0
    n = -(-size // most) or 1
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()
        yield tuple((r.i, w) for r in block if (w := tuple(words_of(r.t))))


def scan(rows: DataFrame, block: tuple[Item, ...], percent: int) -> DataFrame:
    """``rows`` (doc_id, text, hits), each with the block's hits appended to its own."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    names = ("item_id", "edits", "end_word")
    hit = to_arrow_type(rows.schema["hits"].dataType)

    def run(it):
        m = _matcher(shared.value, percent)
        for b in batches(it):
            found = [[*own, *(dict(zip(names, h, strict=True)) for h in m.hits(t))] for own, t in zip(b.column("hits").to_pylist(), texts_of(b.column("text")), strict=True)]
            yield pa.record_batch([b.column("doc_id"), b.column("text"), pa.array(found, hit)], names=["doc_id", "text", "hits"])

    return rows.mapInArrow(run, rows.schema)


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = BUDGET, most: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, hits: every benchmark item found in each row of ``docs``; further blocks go over the same rows."""
    tune(docs.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.array().cast(f"array<struct<item_id: {kind}, edits: int, end_word: bigint>>").alias("hits"))
    n = 0
    for block in item_blocks(items, most=most):
        rows, n = scan(materialize(rows, "scanned") if n else rows, block, percent), n + 1
    return rows.select("doc_id", (F.array_sort(F.array_distinct("hits")) if n > 1 else F.col("hits")).alias("hits"))


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", percent: int = BUDGET, most: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item is found."""
    tune(docs.sparkSession)
    for n, block in enumerate(item_blocks(items, most=most)):
        docs = materialize(docs, "scanned") if n else docs
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(it, shared=shared):
            m = _matcher(shared.value, percent)
            for b in batches(it):
                texts = b.column(b.schema.get_field_index(text_col))
                yield b.filter(pa.array([not m.hits(t) for t in texts_of(texts)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
