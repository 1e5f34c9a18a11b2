"""Near copies by SimHash with covering hashing, verified by and completed to the exact Jaccard similarity of word shingles.

Every set of shingles has a SimHash fingerprint.  Sets of one fingerprint meet the least of them, and
covering hashing finds all fingerprints within ``RADIUS`` bits, each of which meets the least that it is
near to; the pairs are verified on the whole sets.  Similar sets further apart than that, which are most
of those that are not copies, are then found by an exact join with prefix filtering.

The shingles of every text are ordered alike everywhere, rare ones first.  Two sets of similarity
``percent`` or more then share a shingle among the first n - ceil(n * percent / 100) + 1 of each,
so pairs are looked for under those shingles only and none is missed; the place of the shared
shingle bounds what the rest can still share.  The pairs that remain are verified on the whole
sets, but for those of sets that verified pairs connect already.  Which shingles are rare is learned from a sample; it decides the cost, never the result.

Equal sets are merged first.  After the fingerprints, each set is compared with the least of those that it shares
much of its prefix with, at most five of them; what this links is one part, and from there on only
sets of different parts meet, so the pairs of a group of near copies grow with its size, not with
its square.  Under shingles of at most ``MOST_PAIRED`` sets the shared ones are counted before two
sets are compared; under more crowded ones two sets meet once.

Defined results: A-Z count as a-z, a text of at most ``width`` words is one shingle, texts without
words, empty or null, are copies of each other; rows with a null id take part in no component and
come back with component null; repeated rows share their verdict; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import simhash
from quire.llm.common import batches, discard, lower_bytes, materialize, salt, salted_groups, tune
from quire.llm.components import connected_components

SEED, WIDTH, PERCENT, RADIUS = 42, 5, 80, 3
MOST_PAIRED = 64
#: The sample that tells which shingles are frequent: texts, and shingles remembered from them.
SAMPLE, FREQUENT = 5_000, 100_000


def shingles(body: bytes, width: int = WIDTH) -> np.ndarray:
    """Distinct XXH64 values of the shingles of a text whose case is already folded, in ascending order."""
    words = body.split()  # bytes: splits at \\x20 and \\x09-\\x0D only
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    found = [digest(flat[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
    return np.unique(np.array(found, np.uint64))


def key_of(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def fingerprint(found: np.ndarray) -> int:
    """Signed 64-bit SimHash of a set of shingles: bits that over half of them have; zero for none."""
    total = np.zeros(64, np.int64)
    raw = found.astype(">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), 4096):
        total += np.unpackbits(raw[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(found)).tobytes(), "big", signed=True)


def prefix(found: np.ndarray, values: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles that a similar set must share one of; ``values`` (ascending) are the frequent ones, with their counts."""
    most = len(found) + (-percent * len(found)) // 100 + 1
    if not len(values) or not len(found):
        return found[:most]
    at = np.minimum(np.searchsorted(values, found), len(values) - 1)
    return found[np.lexsort((found, np.where(values[at] == found, counts[at], 0)))[:most]]


def _among(found: np.ndarray, values: np.ndarray) -> int:
    """How many of the shingles are among ``values`` (ascending)."""
    return int((values[np.minimum(np.searchsorted(values, found), len(values) - 1)] == found).sum()) if len(values) else 0


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets (ascending) share ``percent`` of their union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sampled(width: int):
    def run(it):
        for b in batches(it):
            found = [shingles(x, width) for x in lower_bytes(b.column("text"))]
            yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64), pa.int64())], names=["t"])

    return run


def frequent_shingles(docs: DataFrame, width: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than one sampled text holds, ascending, and in how many; copies count once."""
    chosen = docs.where("text IS NOT NULL").groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).orderBy("h").limit(sample)
    # At most ``sample`` ids are broadcast.
    texts = docs.join(F.broadcast(chosen.where("doc_id IS NOT NULL").select("doc_id").distinct()), "doc_id", "left_semi").select("text").distinct()
    rows = texts.mapInArrow(_sampled(width), "t long").groupBy("t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "t").limit(FREQUENT).collect()
    values, counts = np.array([r.t for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(values)
    return values[order], counts[order]


def _marks(width: int, percent: int, shared):
    def run(it):
        values, counts = shared.value
        for b in batches(it):
            found = [shingles(x, width) for x in lower_bytes(b.column("text"))]
            first = [prefix(x, values, counts, percent).view(np.int64) for x in found]
            often = [_among(x.view(np.uint64), values) for x in first]
            stops = np.concatenate(([0], np.cumsum([len(x) for x in first])))
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.concatenate(first), pa.int64()))
            yield pa.record_batch([b.column("doc_id"), pa.array([key_of(x) for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int64()), lists, pa.array(often, pa.int32()), pa.array([fingerprint(x) for x in found], pa.int64())], names=["doc_id", "key", "n", "prefix", "often", "fp"])

    return run


def _sets(width: int):
    def run(it):
        for b in batches(it):
            rows = [(i, x) for i, k, t in zip(b.column("sid").to_pylist(), b.column("key").to_pylist(), lower_bytes(b.column("text")), strict=True) if key_of(x := shingles(t, width)) == k]  # a repeated id may have other texts
            yield pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([x.tobytes() for _, x in rows], pa.binary())], names=["sid", "set"])

    return run


def _verified(percent: int):
    def run(it):
        for b in batches(it):
            x, y = b.column("sa").to_pylist(), b.column("sb").to_pylist()
            good = [similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y, strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def verify(pairs: DataFrame, docs: DataFrame, merged: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the distinct pairs a, b whose sets are similar; ``pairs`` is a written table, which goes."""
    keys = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct().join(merged.select("sid", "key", "rep"), "sid")
    sets = materialize(docs.join(keys, docs["doc_id"] == keys["rep"]).select("sid", "key", "text").mapInArrow(_sets(width), "sid long, set binary").dropDuplicates(["sid"]), "sets")
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("sid").alias("b"), F.col("set").alias("sb")), "b")
    found = materialize(both.mapInArrow(_verified(percent), "a long, b long"), "similar")
    del both, keys
    discard(sets, pairs)
    return found


def _prefix_size(n: Column, percent: int) -> Column:
    return n + F.floor(-percent * n / 100) + 1


def _shared(merged: DataFrame, percent: int) -> DataFrame:
    """t, sid, n, i, size, lead: places of shingles that several prefixes hold, with their number and the least of those sets.

    A shingle that the sample met often is dealt to many tasks by set; there are at most ``FREQUENT`` of those, so their sums are broadcast.
    """
    tokens = merged.select("sid", F.col("n").cast("int").alias("n"), "often", F.size("prefix").alias("p"), F.posexplode("prefix").alias("i", "t"))
    often = F.col("i") >= F.col("p") - F.col("often")
    # The shingle itself is named beside the key it is dealt by only where the two differ.
    dealt = tokens.select(F.when(often, F.xxhash64("t", salt("sid"))).otherwise(F.col("t")).alias("k"), F.when(often, F.col("t")).alias("t"), "sid", "n", "i").repartition("k")
    own = [F.count(F.lit(1)).alias("size"), F.min(F.struct("sid", "n")).alias("lead")]
    few = dealt.where("t IS NULL").drop("t")
    few = few.join(few.groupBy("k").agg(*own).where("size > 1").hint("merge"), "k").withColumnRenamed("k", "t")
    many = dealt.where("t IS NOT NULL")
    sums = many.groupBy("k", "t").agg(*own).groupBy("t").agg(F.sum("size").alias("size"), F.min("lead").alias("lead")).where("size > 1")
    columns = ["t", "sid", "n", "i", "size", "lead"]
    return materialize(few.select(columns).union(many.join(F.broadcast(sums), "t").select(columns)), "shared")


def covered(merged: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """a < b: sets that SimHash finds: each with the least of its fingerprint, and those with the least that lie within ``radius`` bits.

    Pairs whose sizes rule the similarity out are left away.  merged: sid, n, fp.
    """
    dealt = merged.select("sid", "n", "fp", salt("sid").alias("s"))
    own = F.min(F.struct("sid", "n")).alias("lead")
    leads = materialize(salted_groups(dealt, ["fp"], "s", [own], [F.min("lead").alias("lead")]), "leads")
    same = dealt.join(leads, ["fp", "s"]).select("sid", "n", "lead")
    first = leads.select("fp", "lead").distinct()
    near = simhash.links(first.select("fp"), radius).groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("other"))
    met = near.join(first.withColumnRenamed("lead", "mine"), "fp").join(first.withColumnRenamed("fp", "other"), "other").select("mine.sid", "mine.n", "lead")
    alike = F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * percent
    pairs = same.union(met).where((F.col("sid") != F.col("lead.sid")) & alike)
    return pairs.select(F.least("sid", "lead.sid").alias("a"), F.greatest("sid", "lead.sid").alias("b")).distinct()


def links(docs: DataFrame, merged: DataFrame, width: int = WIDTH, percent: int = PERCENT, most: int = MOST_PAIRED) -> DataFrame:
    """a, b: numbers of similar sets, enough of them to connect all that are.  merged: sid, key, rep, n, prefix, often, fp."""
    near = verify(materialize(covered(merged, percent), "covered"), docs, merged, width, percent)
    shared = _shared(merged, percent)
    alike = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    # Sets that share a quarter of their prefixes with the leader of those shingles: at most five a set, and most near copies.
    led = shared.where("sid <> lead.sid").groupBy("sid", "n", "lead").agg(F.count(F.lit(1)).alias("o")).where(F.col("o") * 4 >= _prefix_size(F.least("n", "lead.n"), percent))
    unmet = led.select(F.col("lead.sid").alias("a"), F.col("sid").alias("b")).join(near, ["a", "b"], "left_anti")
    star = verify(materialize(unmet, "star"), docs, merged, width, percent).union(near)
    parts = materialize(connected_components(star), "parts")
    # From here on only sets of different parts meet.
    placed = materialize(shared.select("t", "sid", "n", "i", "size").join(parts.withColumnRenamed("node", "sid"), "sid", "left").withColumn("part", F.coalesce("component", "sid")).drop("component"), "placed")
    discard(shared, parts)
    cold, hot = placed.where(F.col("size") <= most), placed.where(F.col("size") > most)
    meet = (F.col("x.t") == F.col("y.t")) & (F.col("x.sid") < F.col("y.sid")) & (F.col("x.part") != F.col("y.part"))
    crowded = materialize(hot.groupBy("sid").agg(F.count(F.lit(1)).alias("hot"), F.array_sort(F.collect_list("t")).alias("every")), "crowded")
    met = cold.alias("x").join(cold.alias("y"), meet & alike).groupBy(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
    met = met.agg(F.count(F.lit(1)).alias("o"), F.least(F.first("x.n") - F.min("x.i"), F.first("y.n") - F.min("y.i")).alias("rest"))
    for n in "ab":
        met = met.join(crowded.select(F.col("sid").alias(n), F.col("hot").alias(f"h{n}")), n, "left")
    # Of two sets, all that one's prefix shares is in the other's prefix too: the rest of that one bounds what more they share.
    beyond = F.ceil(F.greatest("na", "nb") * percent / 100) - 1
    most_shared = F.least(F.col("rest"), F.col("o") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) + beyond)
    pairs = met.where(most_shared * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b")
    if not crowded.isEmpty():
        # Two sets meet under the first crowded shingle that they share only; those that share others too have met above.
        hot = hot.join(crowded.select("sid", "every"), "sid")
        common, larger = F.array_intersect("x.every", "y.every"), F.greatest("x.n", "y.n")
        enough = (F.size(common) + F.ceil(larger * percent / 100) - 1) * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
        once = (F.array_min(common) == F.col("x.t")) & enough
        pairs = pairs.union(hot.alias("x").join(hot.alias("y"), meet & alike & once).select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))).distinct()
    candidates = materialize(pairs, "candidates")
    del met, pairs
    discard(placed, crowded)
    return star.union(verify(candidates, docs, merged, width, percent))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, most: int = MOST_PAIRED) -> DataFrame:
    """doc_id, component_id (the least id reachable over pairs of similarity ``percent`` or more)."""
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, width))
    marked = materialize(docs.mapInArrow(_marks(width, percent, shared), f"doc_id {kind}, key binary, n long, prefix array<long>, often int, fp long"), "marked")
    merged = materialize(marked.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("often").alias("often"), F.first("fp").alias("fp")).withColumn("sid", F.monotonically_increasing_id()), "merged")
    pairs = links(docs, merged, width, percent, most)
    reps = merged.select("sid", "key", "rep")
    by_rep = pairs.join(reps.select(F.col("sid").alias("a"), F.col("rep").alias("ra")), "a").join(reps.select(F.col("sid").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    parts = connected_components(by_rep)
    named = reps.join(parts, reps.rep == parts.node, "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    # Every part of a set's documents meets its own row, so copies are not one task's work.
    dealt = marked.select("doc_id", "key", salt("doc_id").alias("s"))
    parted = dealt.groupBy("key", "s").agg(F.count(F.lit(1)).alias("n")).join(named, "key").drop("n")
    return dealt.join(parted, ["key", "s"], "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
