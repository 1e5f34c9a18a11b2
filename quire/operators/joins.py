"""Lookups, range joins and set differences between page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import glob_regex

#: A side list is broadcast up to so many rows; longer ones are joined as the planner sees fit.
SMALL, SMALL_BYTES = 10_000, 8 << 20
#: Characters of a pattern's beginning that it is looked up by, and stretches that a long list of bands is cut into.
PREFIX, STRETCHES = 4, 4096


def small(df: DataFrame, most: int = SMALL, most_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast ``df`` if it is proven small, in rows and in bytes, by reading no more than its first rows."""
    seen = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return F.broadcast(df) if seen.n <= most and (seen.bytes or 0) <= most_bytes else df


def _literal_prefix(pattern: Column) -> Column:
    """What a file-name pattern asks for before its first wildcard, at most ``PREFIX`` characters of it."""
    return F.substring(F.regexp_extract(pattern, r"^([^*?\[]*)", 1), 1, PREFIX)


def matching_any(pages: DataFrame, name: Column, patterns: DataFrame, most: int = SMALL) -> DataFrame:
    """Pages whose name fits any file-name pattern (patterns: pattern).

    Up to ``most`` patterns are one regular expression in the filter; more meet the names in an equi-join on their literal beginnings.
    """
    distinct = patterns.where("pattern IS NOT NULL").select("pattern").distinct()
    held = distinct.select(glob_regex(F.col("pattern")).alias("rx")).limit(most + 1).collect()
    if len(held) <= most:
        return pages.where(name.rlike("|".join(f"(?:{r.rx})" for r in held)) if held else F.lit(False))
    names = pages.select(name.alias("name")).distinct()
    begun = names.select("name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(PREFIX)), lambda n: F.substring(F.col("name"), F.lit(1), n)))).alias("begin"))
    asked = distinct.select(_literal_prefix(F.col("pattern")).alias("begin"), glob_regex(F.col("pattern")).alias("rx"))
    fit = begun.join(asked, "begin").where(F.rlike("name", F.col("rx"))).select(F.col("name").alias("__name")).distinct()
    return pages.join(fit, name == F.col("__name"), "left_semi")


def extra_turn(pages: DataFrame, turns: DataFrame, key: str = "src") -> DataFrame:
    """pages with deg, 0 where no turn is listed."""
    return pages.join(small(turns.select(key, "deg")), key, "left").withColumn("deg", F.coalesce("deg", F.lit(0.0)))


def first_band(lines: DataFrame, bands: DataFrame, mid: str, lo: str, hi: str, index: str, keys: list[str] | None = None, most: int = SMALL) -> DataFrame:
    """lines with the least index of the bands that hold their centre, null without one.

    Bands of one page meet its lines by ``keys``; without keys up to ``most`` bands stand in the expression itself, more are
    met by the stretches of equal width that they reach into.
    """
    band = F.struct(F.col(lo).cast("double").alias("lo"), F.col(hi).cast("double").alias("hi"), F.col(index).alias("ix"))

    def least(held: Column) -> Column:
        fits = F.filter(held, lambda b: (F.col(mid) >= b["lo"]) & (F.col(mid) <= b["hi"]))
        return F.array_min(F.transform(fits, lambda b: b["ix"])).alias(index)

    if keys:
        packed = bands.groupBy(*keys).agg(F.collect_list(band).alias("__bands"))
        return lines.join(packed, keys, "left").select(*lines.columns, least(F.col("__bands")))
    kind = bands.schema[index].dataType.simpleString()
    held = bands.select(band.alias("b")).select("b.*").limit(most + 1).collect()
    if len(held) <= most:
        listed = [F.struct(F.lit(b.lo).cast("double").alias("lo"), F.lit(b.hi).cast("double").alias("hi"), F.lit(b.ix).cast(kind).alias("ix")) for b in held]
        return lines.select(*lines.columns, least(F.array(*listed)) if listed else F.lit(None).cast(kind).alias(index))
    ends = bands.agg(F.min(lo).alias("a"), F.max(hi).alias("b")).first()
    step = max((ends.b - ends.a) / STRETCHES, 1e-9)
    at = lambda v: F.floor((v - ends.a) / step).cast("int")
    spread = bands.select(band.alias("b"), F.explode(F.sequence(at(F.col(lo)), at(F.col(hi)))).alias("__at")).groupBy("__at").agg(F.collect_list("b").alias("__bands"))
    return lines.withColumn("__at", at(F.col(mid))).join(spread, "__at", "left").select(*lines.columns, least(F.col("__bands")))


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no finished result."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, place: whether it is in the first table only, the second only or both."""
    x, y = a.select(key).distinct().withColumn("__a", F.lit(True)), b.select(key).distinct().withColumn("__b", F.lit(True))
    return x.join(y, key, "full").select(key, F.when(F.col("__b").isNull(), "first").when(F.col("__a").isNull(), "second").otherwise("both").alias("place"))


def assemble(editions: DataFrame, pages: DataFrame) -> DataFrame:
    """edition, volume, vpos, block, bpos, ppos, src: pages of each edition in order; parts may repeat across volumes."""
    part = F.regexp_replace("src", r"-[^-]*$", "")
    named = pages.select("src", part.alias("prefix"))
    return named.join(small(editions), "prefix").select("edition", "volume", "vpos", "block", "bpos", "ppos", "src")


def parts_of(pages: DataFrame) -> DataFrame:
    """Distinct part names of page names."""
    return pages.select(F.regexp_replace("src", r"-[0-9]{4}[ab]$", "").alias("part")).distinct()


def uncovered(boxes: DataFrame, words: DataFrame, pad: int = 2) -> DataFrame:
    """Ink boxes that no padded word box of the same page meets."""
    b, w = boxes.alias("b"), words.alias("w")
    meets = (F.col("b.src") == F.col("w.src")) & (F.col("b.x") < F.col("w.x") + F.col("w.w") + pad) & (F.col("w.x") - pad < F.col("b.x") + F.col("b.w")) & (F.col("b.y") < F.col("w.y") + F.col("w.h") + pad) & (F.col("w.y") - pad < F.col("b.y") + F.col("b.h"))
    return b.join(w, meets, "left_anti")


def next_flagged(words: DataFrame, flagged: Column) -> DataFrame:
    """src, bi, wi, nbi, nwi: the next flagged word of the page after each word, from its start again at the end."""
    here = F.when(flagged, F.struct("bi", "wi"))
    page = Window.partitionBy("src")
    # Read from the end of the page, the next one is the last met so far: one pass, whatever the page's length.
    back = page.orderBy(F.desc("bi"), F.desc("wi")).rowsBetween(Window.unboundedPreceding, -1)
    after = F.coalesce(F.last(here, ignorenulls=True).over(back), F.min(here).over(page))
    return words.select("src", "bi", "wi", after.alias("n")).select("src", "bi", "wi", F.col("n.bi").alias("nbi"), F.col("n.wi").alias("nwi"))


def word_witness(words: DataFrame, witness: DataFrame) -> DataFrame:
    """words with what the corpus says instead (``book``, ``seen``), null where it says nothing; witness: src, bi, wi, book, seen."""
    return words.join(witness.select("src", "bi", "wi", "book", "seen"), ["src", "bi", "wi"], "left")


def image_drafts(images: DataFrame, drafts: DataFrame, key: str = "src") -> tuple[DataFrame, DataFrame]:
    """Images with their drafts, and images that have none."""
    return images.join(drafts, key), images.join(drafts.select(key), key, "left_anti")


def within_parts(pages: DataFrame, prefix: str = "", without: str = "", part: str = "part") -> DataFrame:
    """Pages of the parts that begin with ``prefix`` and don't match ``without``; on a table laid out by part only those are read."""
    kept = pages.where(F.col(part).startswith(prefix)) if prefix else pages
    return kept.where(~F.col(part).rlike(without)) if without else kept


def newer(a: DataFrame, b: DataFrame, key: str, at: str) -> DataFrame:
    """Rows of ``a`` that are newer than their partner in ``b``, or have none."""
    return a.join(b.select(key, F.col(at).alias("__at")), key, "left").where(F.col("__at").isNull() | (F.col(at) > F.col("__at"))).select(a.columns)
