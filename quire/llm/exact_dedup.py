"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of the last 32 bytes says so; each chunk has a 128-bit
identifier, and a text is the ordered list of its chunk identifiers (its recipe).  The chunks
are deduplicated first, each with its SHA-256, to verify that an identifier stands for one chunk
only; then recipes of 16 bytes a chunk are compared, so texts, long or short, are never moved.

Defined results: null text counts as empty, an empty text is a recipe of no chunks, a null id
sorts below all others and is kept only if its group has no other, repeated rows share one
verdict, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, lower_bytes, materialize, salt, salted_groups, tune

WINDOW = 32  # bytes that a cut depends on: the width of the rolling hash
SMALLEST, MEAN_BITS, LARGEST = 512, 11, 16384
#: Identifiers that stand for several chunks are told to every task up to so many; beyond, every chunk goes by its SHA-256.
MOST_AMBIGUOUS = 10_000


def _gear(seed: int = 0x9E3779B9) -> np.ndarray:
    """256 pseudo-random words, from a multiplicative generator."""
    out, x = np.empty(256, np.uint32), seed
    for k in range(256):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out[k] = x >> 32
    return out


GEAR = _gear()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i-j]] << j for j < 32, by doubling the window five times."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, width * 2
    return h


def cut(lengths_from: np.ndarray, marks: np.ndarray, k: int) -> list[int]:
    """Chunk ends of document k, given document offsets and positions that ask for a cut."""
    start, end = int(lengths_from[k]), int(lengths_from[k + 1])
    if end == start:
        return []
    out, last = [], start
    for m in marks[np.searchsorted(marks, start + SMALLEST) : np.searchsorted(marks, end)].tolist():
        while m + 1 - last > LARGEST:
            last += LARGEST
            out.append(last)
        if m + 1 - last >= SMALLEST and m + 1 < end:
            last = m + 1
            out.append(last)
    while end - last > LARGEST:
        last += LARGEST
        out.append(last)
    out.append(end)
    return out


def chunked(texts: pa.Array) -> Iterator[list[bytes]]:
    """For each text, its chunks (A-Z lowered)."""
    low = lower_bytes(texts)
    raw = b"".join(low)
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))))
    mask = np.uint32(((1 << MEAN_BITS) - 1) << (32 - MEAN_BITS))
    marks = np.flatnonzero((rolling_hash(np.frombuffer(raw, np.uint8)) & mask) == 0) if len(raw) > WINDOW else np.empty(0, np.int64)
    for k in range(len(low)):
        at, out = int(offsets[k]), []
        for e in cut(offsets, marks, k):
            out.append(raw[at:e])
            at = e
        yield out


def _chunk_rows(it):
    for b in batches(it):
        data = list({c for chunks in chunked(b.column("text")) for c in chunks})
        yield pa.record_batch([pa.array([xxhash.xxh3_128_digest(c) for c in data], pa.binary()), pa.array([hashlib.sha256(c).digest() for c in data], pa.binary())], names=["fp", "proof"])


def _recipe_rows(ambiguous: frozenset[bytes] | None):
    """``ambiguous``: identifiers that stand for several chunks; None: any may."""

    def run(it):
        for b in batches(it):
            recipes, shas = [], []
            for chunks in chunked(b.column("text")):
                sha, ids = hashlib.sha256(), []
                for c in chunks:
                    sha.update(c)
                    fp = xxhash.xxh3_128_digest(c)
                    ids.append(hashlib.sha256(c).digest() if ambiguous is None or fp in ambiguous else fp)
                shas.append(sha.hexdigest())
                recipes.append(b"".join(ids))
            yield pa.record_batch([b.column("doc_id"), pa.array(shas, pa.string()), pa.array(recipes, pa.binary())], names=["doc_id", "text_sha256", "recipe"])

    return run


def ambiguous_chunks(docs: DataFrame, most: int = MOST_AMBIGUOUS) -> frozenset[bytes] | None:
    """Identifiers that stand for more than one chunk: none, unless 128 bits collide; None if over ``most`` do."""
    distinct = docs.select("text").mapInArrow(_chunk_rows, "fp binary, proof binary").distinct()
    found = distinct.groupBy("fp").count().where("count > 1").select("fp").limit(most + 1).collect()
    return None if len(found) > most else frozenset(bytes(r.fp) for r in found)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``."""
    tune(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    recipes = materialize(docs.mapInArrow(_recipe_rows(ambiguous_chunks(docs)), f"doc_id {kind}, text_sha256 string, recipe binary"), "recipes")
    # Equal recipes are equal texts once identifiers are verified, so the recipe alone is the key; copies of one text are dealt out by id.
    dealt = recipes.withColumn("s", salt("doc_id"))
    groups = salted_groups(dealt, ["recipe"], "s", [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")], [F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")])
    return dealt.join(groups, ["recipe", "s"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
