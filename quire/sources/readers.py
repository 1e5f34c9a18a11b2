"""Readers of page drafts, word tables, markup, corrections and side lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.schemas import CORRECTIONS, DRAFT, TABLE_FIX, TSV


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """A table of fewer splits than the cluster has cores, dealt to all of them; others stay as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def stem(path: Column) -> Column:
    """File name without folders and its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_drafts(spark: SparkSession, path: str) -> DataFrame:
    """One nested row a page; a malformed page comes back with nulls and its name."""
    return spark.read.schema(DRAFT).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("src", F.coalesce("src", stem(F.input_file_name())))


def draft_words(drafts: DataFrame) -> DataFrame:
    """src, part, bi, wi, column, region, layer, t, conf, x, y, w, h: one row a word."""
    blocks = drafts.select("src", F.posexplode("blocks").alias("bi", "b"))
    words = blocks.select("src", "bi", "b.column", "b.region", "b.layer", F.posexplode("b.words").alias("wi", "w"))
    return words.select("src", part_of(F.col("src")).alias("part"), "bi", "wi", "column", "region", "layer", "w.*")


def regions_of(raw: Column) -> Column:
    """A region list [[y0, y1, [[x0, x1], ...]], ...] as structs; its mixed arrays can't be read by a schema."""
    rows = F.from_json(raw, "array<array<string>>")
    cols = F.transform(F.from_json(F.lit("[]"), "array<array<int>>"), lambda c: F.struct(c[0].alias("x0"), c[1].alias("x1")))
    return F.transform(rows, lambda r: F.struct(r[0].cast("int").alias("y0"), r[1].cast("int").alias("y1"), F.coalesce(F.transform(F.from_json(r[2], "array<array<int>>"), lambda c: F.struct(c[0].alias("x0"), c[1].alias("x1"))), cols).alias("cols")))


def part_of(src: Column) -> Column:
    """Leading digits of a source name, or ??."""
    found = F.regexp_extract(src, r"^(\d+)-", 1)
    return F.when(found == "", "??").otherwise(found)


def read_tsv(spark: SparkSession, path: str, scale: int = 1, pad: int = 0) -> DataFrame:
    """Recognised words of tab-separated output, in page pixels; blank texts and unreadable confidences go."""
    rows = spark.read.schema(TSV).option("sep", "\t").option("header", True).option("quote", "").option("mode", "DROPMALFORMED").csv(path)
    at = {c: (F.floor(F.col(c) / scale) - pad).cast("int") for c in ("left", "top")}
    size = {c: F.floor(F.col(c) / scale).cast("int") for c in ("width", "height")}
    rows = rows.withColumn("conf", F.expr("try_cast(conf AS DOUBLE)")).where(F.col("conf").isNotNull() & (F.trim("text") != ""))
    return rows.select("page", "block", "par", "line", "word", F.trim("text").alias("t"), "conf", at["left"].alias("x"), at["top"].alias("y"), size["width"].alias("w"), size["height"].alias("h"))


def tsv_lines(words: DataFrame) -> DataFrame:
    """page, block, par, line, text, y, top, bot: words gathered in reading order."""
    ordered = F.array_sort(F.collect_list(F.struct("word", "t")))
    return words.groupBy("page", "block", "par", "line").agg(F.array_join(F.transform(ordered, lambda w: w["t"]), " ").alias("text"), F.min("y").alias("top"), F.max(F.col("y") + F.col("h")).alias("bot")).withColumn("y", F.col("top"))


def read_markup(spark: SparkSession, path: str) -> DataFrame:
    """src, line_no, line of every markup page."""
    pages = spark.read.text(path, wholetext=True).select(stem(F.input_file_name()).alias("src"), F.col("value"))
    return pages.select("src", F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n")).alias("line_no", "line"))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """sheet, who, src and the page record; files are small, pages many."""
    files = spark.read.schema(CORRECTIONS).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return files.select("sheet", "who", F.explode("pages").alias("src", "rec")).select("sheet", "who", "src", "rec.*")


def fixes_of(pages: DataFrame) -> DataFrame:
    """sheet, who, src, bi, wi, was, now, after: word corrections by numeric address."""
    rows = pages.select("sheet", "who", "src", F.explode("fix").alias("addr", "f"))
    return rows.select("sheet", "who", "src", F.split_part("addr", F.lit("."), F.lit(1)).cast("int").alias("bi"), F.split_part("addr", F.lit("."), F.lit(2)).cast("int").alias("wi"), "f.was", "f.now", "f.after")


def read_table_fixes(spark: SparkSession, path: str) -> DataFrame:
    """src, ops, cols, lean; a corrupt record counts as none, missing and empty guides stay apart."""
    return spark.read.schema(TABLE_FIX).option("multiLine", True).option("mode", "PERMISSIVE").json(path).select(stem(F.input_file_name()).alias("src"), "ops", "cols", "lean")


def side_list(spark: SparkSession, path: str) -> DataFrame:
    """fields of each line that is not blank or a comment."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    return lines.select(F.split("line", r"\s+").alias("fields"))


def pattern_list(spark: SparkSession, path: str) -> DataFrame:
    return side_list(spark, path).select(F.col("fields")[0].alias("pattern"))


def turn_list(spark: SparkSession, path: str) -> DataFrame:
    """src, deg: lines of exactly two fields whose second is a number."""
    rows = side_list(spark, path).where(F.size("fields") == 2)
    return rows.select(F.col("fields")[0].alias("src"), F.expr("try_cast(fields[1] AS DOUBLE)").alias("deg")).where("deg IS NOT NULL")


# ------------------------------------------------ tables derived from documents


def document_blocks(docs: DataFrame) -> DataFrame:
    """src, part, bi, layer, text: the lines of each document as blocks."""
    lines = docs.select(F.col("doc_id").alias("src"), F.col("source").alias("part"), F.posexplode(F.split("text", "\n")).alias("bi", "text"))
    return lines.select("src", "part", "bi", F.when(F.col("bi") % 4 == 3, "red").otherwise("black").alias("layer"), "text")


def document_pages(docs: DataFrame) -> DataFrame:
    """src, words: array<struct<bi, wi, t, conf>>: the words of ``document_words`` with each page in one row."""
    toks = lambda line: F.filter(F.split(line, r"\s+"), lambda t: t != "")

    def word(bi: Column):
        return lambda t, wi: F.struct(bi.alias("bi"), wi.alias("wi"), t.alias("t"), ((F.col("src") * 31 + bi * 17 + wi * 13) % 101).cast("double").alias("conf"))

    named = docs.select(F.col("doc_id").alias("src"), "text")
    return named.select("src", F.flatten(F.transform(F.split("text", "\n"), lambda line, bi: F.transform(toks(line), word(bi)))).alias("words"))


def document_words(docs: DataFrame) -> DataFrame:
    """src, part, bi, wi, layer, t, conf, x, y, w, h: tokens with made-up confidences and boxes."""
    tokens = F.filter(F.split("text", r"\s+"), lambda t: t != "")
    words = document_blocks(docs).select("src", "part", "bi", "layer", F.posexplode(tokens).alias("wi", "t"))
    n = F.length("t")
    return words.select("src", "part", "bi", "wi", "layer", "t", ((F.col("src") * 31 + F.col("bi") * 17 + F.col("wi") * 13) % 101).cast("double").alias("conf"), (F.col("wi") * 40).alias("x"), (F.col("bi") * 12 + (F.col("wi") * 5 + F.col("src")) % 4).cast("int").alias("y"), (n * 6).alias("w"), (n % 5 + 8).alias("h"))
