"""Ordered fingerprints of pages, snapshots and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u001f"


def sha_of(tokens: Column) -> Column:
    """First 16 hex digits of SHA-256 over tokens that each end in a unit separator."""
    return F.substring(F.sha2(F.when(F.size(tokens) == 0, "").otherwise(F.concat(F.array_join(tokens, MARK, ""), F.lit(MARK))), 256), 1, 16)


def in_order(position: list[str], value: str) -> Column:
    """Values of a group in the order of their positions."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*position, F.coalesce(F.col(value), F.lit("")).alias("__v")))), lambda x: x["__v"])


def fingerprints(words: DataFrame, position: list[str], token: str = "t", key: str = "src", shape: str | None = None) -> DataFrame:
    """src, words, shape, n: one row a page; ``shape`` names what stands for a word's place in the layout."""
    cols = [sha_of(in_order(position, token)).alias("words"), F.count(F.lit(1)).cast("int").alias("n")]
    if shape:
        cols.append(sha_of(in_order(position, shape)).alias("shape"))
    return words.groupBy(key).agg(*cols)


def snapshot_diff(was: DataFrame, now: DataFrame, fields: list[str], key: str = "src") -> DataFrame:
    """key, status (gone, fresh, moved), fields that moved; unchanged pages are left out."""
    a, b = (d.select(F.col(key).alias(f"__{s}"), *[F.col(f).alias(f"__{s}_{f}") for f in fields]) for d, s in ((was, "a"), (now, "b")))
    both = a.join(b, F.col("__a") == F.col("__b"), "full")
    moved = F.concat_ws(",", *[F.when(~F.col(f"__a_{f}").eqNullSafe(F.col(f"__b_{f}")), f) for f in fields])
    status = F.when(F.col("__b").isNull(), "gone").when(F.col("__a").isNull(), "fresh").when(moved != "", "moved")
    return both.select(F.coalesce("__a", "__b").alias(key), status.alias("status"), F.when(status == "moved", moved).otherwise("").alias("moved")).where("status IS NOT NULL")


def block_faults(blocks: DataFrame) -> DataFrame:
    """blocks: src, bi, text, words (array).  The first block of each page whose words are not those of its text."""
    split = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return blocks.where(~split.eqNullSafe(F.col("words"))).groupBy("src").agg(F.min("bi").alias("bi"))


def sheet_stamp(pages: DataFrame, label: Column, key: list[str]) -> DataFrame:
    """key, stamp: first 12 hex digits of SHA-256 over the sorted labels of a sheet's pages."""
    return pages.groupBy(*key).agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(label)), ""), 256), 1, 12).alias("stamp"))


def page_fingerprints(words: DataFrame, markup: DataFrame, position: list[str]) -> DataFrame:
    """src, words, shape, n, markup: a page's fingerprints with that of its markup (src, text), null where none was made."""
    own = words.withColumn("shape", F.concat_ws(",", *[F.col(c).cast("string") for c in ("x", "y", "w", "h")]))
    made = markup.select("src", F.substring(F.sha2("text", 256), 1, 16).alias("markup"))
    return fingerprints(own, position, shape="shape").join(made, "src", "left")


def page_faults(blocks: DataFrame, prints: DataFrame) -> DataFrame:
    """src, fault: pages whose words and texts differ, by their first block, and pages without markup (prints: src, markup)."""
    split = block_faults(blocks).select("src", F.concat(F.lit("block "), F.col("bi").cast("string")).alias("fault"))
    return split.unionByName(prints.where("markup IS NULL").select("src", F.lit("no markup").alias("fault")))
