"""Counts and outliers by page and by part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import markish, token_class

THIN, NOISY, NOISY_FLOOR, REDS_FROM = 0.45, 2.0, 0.25, 8
LOW = 60
LOPSIDED, TIGHT = 0.15, 0.012
STRETCHES = 64


def class_counts(words: DataFrame) -> DataFrame:
    return words.groupBy(token_class(F.col("t"), F.col("conf")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def page_audit(words: DataFrame) -> DataFrame:
    """src, part, black, red, low, words, rate: words that are no marks, by layer, and the share of doubtful ones."""
    real = words.where(~markish(F.col("t")))
    out = real.groupBy("src", "part").agg(F.count_if(F.col("layer") == "black").alias("black"), F.count_if(F.col("layer") == "red").alias("red"), F.count_if(F.col("conf") < LOW).alias("low"), F.count(F.lit(1)).alias("words"))
    return out.withColumn("rate", F.coalesce(F.try_divide(F.col("low"), F.col("words")), F.lit(0.0)))


def part_medians(pages: DataFrame) -> DataFrame:
    return pages.groupBy("part").agg(F.count(F.lit(1)).alias("pages"), F.median("words").alias("med_words"), F.median("rate").alias("med_rate"), F.median("red").alias("med_red"))


def page_outliers(pages: DataFrame) -> DataFrame:
    """Pages that stand out from their part, with the reasons."""
    p = pages.join(part_medians(pages), "part")
    thin = (F.col("med_words") > 0) & (F.col("words") < F.col("med_words") * THIN)
    noisy = (F.col("med_rate") > 0) & (F.col("rate") > F.greatest(F.col("med_rate") * NOISY, F.lit(NOISY_FLOOR)))
    reds = (F.col("med_red") >= REDS_FROM) & (F.col("red") == 0)
    why = F.concat_ws("; ", F.when(thin, "few words"), F.when(noisy, "many doubtful words"), F.when(reds, "no red words"))
    return p.select("src", "part", "words", "red", "rate", why.alias("why")).where("why <> ''")


def uncovered_outliers(pages: DataFrame) -> DataFrame:
    """pages: src, part, frac (null: not measurable).  Pages whose uncovered share stands out, the worst first."""
    known = pages.where("frac IS NOT NULL")
    meds = known.groupBy("part").agg(F.median("frac").alias("med"), F.max("frac").alias("most"))
    return known.join(meds, "part").where((F.col("med") > 0) & (F.col("frac") > F.greatest(F.col("med") * 2.5, F.col("med") + 0.05))).withColumn("ratio", F.col("frac") / F.col("med")).orderBy(F.desc("ratio"), "src")


def geometry_by_part(pages: DataFrame) -> DataFrame:
    """pages: src, part, cols, left, right, empty.  Histogram of columns, margins and empty pages of each part."""
    return pages.groupBy("part").agg(F.count_if(F.col("cols") == 1).alias("one"), F.count_if(F.col("cols") >= 3).alias("many"), F.count_if(F.least("left", "right") < TIGHT).alias("tight"), F.count_if("empty").alias("empty"), F.median("left").alias("med_left"), F.median("right").alias("med_right"))


def lopsided(pages: DataFrame) -> DataFrame:
    """pages: src, part, shape.  Pages whose shape is off their part's median."""
    meds = pages.groupBy("part").agg(F.median("shape").alias("med"))
    return pages.join(meds, "part").withColumn("off", F.try_divide(F.abs(F.col("shape") - F.col("med")), F.col("med"))).where(F.col("off") > LOPSIDED).orderBy(F.desc("off"), "src")


def totals(pages: DataFrame) -> DataFrame:
    """Sums of each part and of everything (part null)."""
    return pages.rollup("part").agg(F.sum("words").alias("words"), F.sum("low").alias("low"), F.max("words").alias("most"))


def upper_median(values: Column) -> Column:
    """The middle value, the upper of two; of none null, and one for zero."""
    v = F.sort_array(F.collect_list(values))
    at = F.try_element_at(v, (F.floor(F.size(v) / 2) + 1).cast("int"))
    return F.when(at == 0, 1).otherwise(at)


def sample_every(df: DataFrame, n: int, key: str = "src") -> DataFrame:
    """Every n-th row in key order.

    The key's range is cut at some of its own values, chosen by hash, so a row's stretch depends on the row alone; rows are
    numbered within stretches, and no task sorts everything.
    """
    rows = df.count()
    cuts = df.select(key).where(F.pmod(F.xxhash64(key), F.lit(max(1, rows // STRETCHES))) == 0).distinct().orderBy(key).limit(8 * STRETCHES).collect()
    at = F.lit(0)
    if cuts:
        held = F.array(*[F.lit(r[0]) for r in cuts])
        at = F.size(F.filter(held, lambda c: c <= F.col(key)))
    cut = df.withColumn("__at", at)
    # At most one row a stretch.
    sizes = {r["__at"]: r["n"] for r in cut.groupBy("__at").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for k in range(len(cuts) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    place = F.row_number().over(Window.partitionBy("__at").orderBy(key)) - 1 + F.element_at(F.array(*[F.lit(x) for x in before]), F.col("__at") + 1)
    return cut.withColumn("__place", place).where(F.col("__place") % n == 0).select(df.columns)


def proof_metrics(words: DataFrame, fixes: DataFrame) -> DataFrame:
    """One row: words looked at, wrong ones, stray ones gone, precision of the marks and the true error rate."""
    w = words.withColumn("class", token_class(F.col("t"), F.col("conf"))).join(fixes.select("src", "bi", "wi", "now").withColumn("fixed", F.lit(True)), ["src", "bi", "wi"], "left")
    fixed, marked = F.coalesce("fixed", F.lit(False)), F.col("class").isin("bad", "check")
    real = F.col("class") != "stray"
    out = w.agg(F.count_if(real).alias("words"), F.count_if(real & fixed).alias("wrong"), F.count_if(~real & fixed).alias("stray_gone"), F.count_if(marked).alias("marked"), F.count_if(marked & fixed).alias("marked_wrong"))
    return out.withColumn("precision", F.try_divide(F.col("marked_wrong"), F.col("marked"))).withColumn("error_rate", F.try_divide(F.col("wrong"), F.col("words")))


def tag_counts(markup: DataFrame) -> DataFrame:
    """tag, n, pages of markup blocks (src, tag)."""
    per = markup.groupBy("src", "tag").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("tag").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))


def block_confidence(words: DataFrame) -> DataFrame:
    """src, bi, mean: the mean confidence of each block's words, to a tenth."""
    return words.groupBy("src", "bi").agg(F.bround(F.avg("conf"), 1).alias("mean"))


def parts_by_size(pages: DataFrame, most: int | None = None) -> DataFrame:
    """part, pages: parts by their number of pages, the smallest first, ties by name."""
    out = pages.groupBy("part").agg(F.count(F.lit(1)).alias("pages")).orderBy("pages", "part")
    return out if most is None else out.limit(most)


def by_deviation(rows: DataFrame, value: str, most: int, key: str = "src") -> tuple[DataFrame, int]:
    """The ``most`` rows with the greatest value, ties by key, and how many more there are."""
    return rows.orderBy(F.desc(value), key).limit(most), max(0, rows.count() - most)


def first_addresses(hits: DataFrame, most: int = 12) -> DataFrame:
    """The first ``most`` hits of a report in the order of their addresses as text (src, then "block.word")."""
    address = F.concat_ws(".", F.col("bi").cast("string"), F.col("wi").cast("string"))
    return hits.withColumn("address", address).orderBy("src", "address").limit(most)


def top_tags(tags: DataFrame, most: int = 9) -> DataFrame:
    """tag, n: the most frequent tags, ties by name."""
    return tags.orderBy(F.desc("n"), "tag").limit(most)
