"""Self-witness: words that the corpus itself contradicts in the same context.

A page's words lie in one row, so contexts are shifted slices of its array, laid side by side; what
is shuffled is a 128-bit hash of the context and the word in its midst.  The few words that these
counts contradict are then found on their pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import markish, norm

REACH, SUPPORT = 3, 2


def pages_of(words: DataFrame) -> DataFrame:
    """src, words: array<struct<bi, wi, t, conf>> in reading order, one row a page."""
    return words.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("bi", "wi", "t", "conf"))).alias("words"))


def contexts(pages: DataFrame, reach: int = REACH) -> DataFrame:
    """src, bi, wi, t, conf, k, h1, h2 (a hash of the keys on either side): each word with a key and whole context; pages do not run into one another."""
    real = F.filter("words", lambda w: ~markish(w["t"]))
    keyed = pages.select("src", F.transform(real, lambda w: F.struct(w["bi"].alias("bi"), w["wi"].alias("wi"), w["t"].alias("t"), w["conf"].alias("conf"), norm(w["t"]).alias("k"))).alias("w"))
    most = F.greatest(F.size("w") - 2 * reach, F.lit(0))
    sides = [s for s in range(2 * reach + 1) if s != reach]
    cut = keyed.select("src", F.slice("w", reach + 1, most).alias("own"), *[F.slice(F.col("w.k"), s + 1, most).alias(f"c{s}") for s in sides])
    # An outer explosion: the plain one has Spark work the arrays out twice, once to see whether they are empty.
    laid = cut.select("src", F.inline_outer(F.arrays_zip("own", *[f"c{s}" for s in sides]))).where("own IS NOT NULL")
    around = [F.col(f"c{s}") for s in sides]
    # Words without a key are context for others but never a centre.
    return laid.where("own.k <> ''").select("src", "own.*", F.xxhash64(*around).alias("h1"), F.xxhash64(F.lit(reach), *around).alias("h2"))


def self_witness_pages(pages: DataFrame, reach: int = REACH, support: int = SUPPORT) -> DataFrame:
    """src, bi, wi, is, book, seen, conf: centres seen once where another is seen ``support`` times; ties go to the lesser word.

    pages: src, words (array<struct<bi, wi, t, conf>>).
    """
    around = contexts(pages, reach)
    key = ["h1", "h2"]
    # Dealt out by context, both counts and their comparison stay where they are.
    counted = around.select(*key, "k").repartition(*key).groupBy(*key, "k").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("n") >= support, F.struct((-F.col("n")).alias("n"), F.col("k").alias("k"))))
    said = counted.groupBy(*key).agg(best.alias("best"), F.collect_list(F.when(F.col("n") == 1, F.col("k"))).alias("once"))
    hits = said.where("best IS NOT NULL").select(*key, F.explode("once").alias("k"), F.col("best.k").alias("book"), (-F.col("best.n")).alias("seen")).where("k <> book")
    return around.join(hits, [*key, "k"]).select("src", "bi", "wi", F.col("t").alias("is"), "book", "seen", F.bround("conf").cast("long").alias("conf"))


def self_witness(words: DataFrame, reach: int = REACH, support: int = SUPPORT) -> DataFrame:
    """The same for a table of words: src, bi, wi, t, conf."""
    return self_witness_pages(pages_of(words), reach, support)
