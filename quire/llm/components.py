"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is an aggregation and a join on keys; nothing but a round's two checksums reaches the
driver.  The links of one node are dealt to many tasks by the node at their other end, so a node
with a share of all links is no one task's work.  Rounds go on until nothing changes, which takes
about the square of the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, materialize, salt, salted_groups


def _with_least(pairs: DataFrame) -> DataFrame:
    """a, b, m: the least b of each a beside every pair."""
    dealt = pairs.select("a", "b", salt("b").alias("s"))
    least = salted_groups(dealt, ["a"], "s", [F.min("b").alias("m")], [F.min("m").alias("m")])
    return dealt.join(least, ["a", "s"]).select("a", "b", "m")


def _large(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b")


def _small(links: DataFrame) -> DataFrame:
    down = _with_least(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    # The least neighbour itself meets the node, every other neighbour the least one.
    return down.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """links: a, b (comparable, not null).  Returns node, component: the least node reachable; nodes without links are left out."""
    now = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or mark.n == 0:
            break
        before, last = mark, now
        now = materialize(_small(_large(last)), "links")
        discard(last)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
