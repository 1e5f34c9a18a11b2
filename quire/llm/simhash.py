"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the XXH64 values of the text's word shingles.
For radius r each of the 64 bit positions gets a nonzero vector of r+1 bits; table v (of
2^(r+1)-1) keeps the positions whose vector has an odd product with v.  Up to r differing
positions span too little to meet every v, so some table keeps none of them: every pair within
the radius shares a bucket in some table, with no chance involved.

Equal fingerprints are merged first.  A bucket of more than ``MOST_PAIRED`` fingerprints is split
by the same construction over the positions its table did not keep, and that again, after which a
bucket can't hold more fingerprints than its few free positions allow; so no bucket's pairs grow
with a group of copies, and no link is lost.

Defined results: a text without words, empty or null, has fingerprint zero, linked like any
other; rows with a null id take part in no component and come back with component null; repeated
rows share their verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, lower_bytes, materialize, salt, salted_groups, tune
from quire.llm.components import connected_components

SEED, WIDTH, RADIUS = 42, 3, 3
MOST_PAIRED = 64


def fingerprint(body: bytes, width: int = WIDTH) -> int:
    """Unsigned 64-bit fingerprint of a text whose case is already folded."""
    words = body.split()  # bytes: splits at \\x20 and \\x09-\\x0D only
    if not words:
        return 0
    if len(words) <= width:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digests = b"".join([xxhash.xxh64_digest(flat[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)])
    n = len(digests) // 8
    total = np.zeros(64, np.int64)
    raw = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        total += np.unpackbits(raw[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(width: int):
    def run(it):
        for b in batches(it):
            fps = np.array([fingerprint(x, width) for x in lower_bytes(b.column("text"))], np.uint64).view(np.int64)
            yield pa.record_batch([b.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return run


@functools.lru_cache
def covering(positions: tuple[int, ...], radius: int) -> tuple[int, ...]:
    """2^(radius+1)-1 masks over the given positions; any ``radius`` positions are free in one of them."""
    m = (1 << (radius + 1)) - 1
    vectors = [1 + k % m for k in range(len(positions))]
    return tuple(sum(1 << p for p, x in zip(positions, vectors, strict=True) if (x & v).bit_count() % 2) for v in range(1, m + 1))


def tables(radius: int, level: int, kept: int = 0) -> list[int]:
    """Masks of every table after ``level`` splits, in the order of their numbers."""
    free = tuple(p for p in range(64) if not kept >> p & 1)
    masks = [kept | x for x in covering(free, radius)]
    return masks if level == 0 else [x for y in masks for x in tables(radius, level - 1, y)]


def _longs(values: list[int]):
    return F.array(*[F.lit(signed(x)).cast("long") for x in values])


def links(fps: DataFrame, radius: int = RADIUS, most: int = MOST_PAIRED, levels: int = 3) -> DataFrame:
    """a < b: pairs of distinct fingerprints that differ in at most ``radius`` bits.  fps: fp (distinct)."""
    per = (1 << (radius + 1)) - 1
    rows = fps.select("fp", F.posexplode(F.transform(_longs(tables(radius, 0)), lambda m: F.col("fp").bitwiseAND(m))).alias("v", "key"))
    out = None
    for level in range(levels):
        sizes = materialize(rows.groupBy("v", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        last = level == levels - 1
        paired = rows.join(sizes if last else sizes.where(F.col("size") <= most), ["v", "key"]).select("v", "key", "fp")
        near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius)
        same = (F.col("x.v") == F.col("y.v")) & (F.col("x.key") == F.col("y.key"))
        found = paired.alias("x").join(paired.alias("y"), same & near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
        out = found if out is None else out.union(found)
        if last or sizes.where(F.col("size") > most).isEmpty():
            break
        hot = rows.join(sizes.where(F.col("size") > most), ["v", "key"]).select("v", "fp")
        # Table v of one level splits into tables v*per .. v*per+per-1 of the next.
        masks = _longs(tables(radius, level + 1))
        finer = F.transform(F.sequence(F.lit(0), F.lit(per - 1)), lambda w: F.struct((F.col("v") * per + w).alias("v"), F.col("fp").bitwiseAND(F.element_at(masks, F.col("v") * per + w + 1)).alias("key")))
        rows = materialize(hot.select("fp", F.inline(finer)).distinct(), "hot")
    return out.distinct()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints(width), f"doc_id {kind}, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least id reachable over links)."""
    marked = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    # The least id stands for all documents of a fingerprint.
    dealt = marked.withColumn("s", salt("doc_id"))
    merged = materialize(salted_groups(dealt.where("doc_id IS NOT NULL"), ["fp"], "s", [F.min("doc_id").alias("rep")], [F.min("rep").alias("rep")]), "merged")
    reps = merged.select("fp", "rep").distinct()
    pairs = links(reps.select("fp"), radius)
    by_rep = pairs.join(reps.withColumnsRenamed({"fp": "a", "rep": "ra"}), "a").join(reps.withColumnsRenamed({"fp": "b", "rep": "rb"}), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    parts = connected_components(by_rep)
    # Every part of a fingerprint's documents meets its own row, so copies are not one task's work.
    named = merged.join(parts, merged.rep == parts.node, "left").select("fp", "s", F.coalesce("component", "rep").alias("component_id"))
    return dealt.join(named, ["fp", "s"], "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
