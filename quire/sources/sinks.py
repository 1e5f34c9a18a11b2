"""Writers: results laid out by part, written whole, and only what is not there yet.

A batch's files appear at once or not at all, as Spark commits them; a part's folder is replaced by its new contents, so a run
that is repeated changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parts(df: DataFrame, path: str, part: str = "part") -> None:
    """Parquet, one folder a part; parts that ``df`` does not hold stay as they are."""
    df.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def read_parts(spark: SparkSession, path: str, prefix: str = "", without: str = "", part: str = "part") -> DataFrame:
    """Only the folders of the parts that begin with ``prefix`` and don't match ``without`` are listed and read."""
    rows = spark.read.parquet(path).withColumn(part, F.col(part).cast("string"))
    rows = rows.where(F.col(part).startswith(prefix)) if prefix else rows
    return rows.where(~F.col(part).rlike(without)) if without else rows


def append_new(df: DataFrame, path: str, key: str, failed: str | None = None) -> int:
    """Append the rows whose key is not there yet; rows with an ``error`` go to ``failed`` instead, to be tried again.  How many were appended."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(key)
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        done = df.select(key).limit(0)
    fresh = df.join(done.distinct(), key, "left_anti")
    good = fresh.where("error IS NULL").drop("error") if "error" in df.columns else fresh
    if failed and "error" in df.columns:
        fresh.where("error IS NOT NULL").select(key, "error").write.mode("overwrite").parquet(failed)
    before = done.count()
    good.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def write_pages(pages: DataFrame, path: str, text: str = "text") -> None:
    """Markup or TeX: a row a page with its name, one folder a part, as JSON lines that any tool reads."""
    pages.select("src", "part", text).repartition("part").sortWithinPartitions("src").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").json(path)


def write_reports(rows: DataFrame, path: str) -> None:
    """Witness and check results as JSON, one file, in the order of the table; reports are as small as their list of findings."""
    rows.coalesce(1).write.mode("overwrite").json(path)
