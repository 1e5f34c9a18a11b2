"""Correction files as a stream: delivered at least once, applied once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.merge import latest
from quire.sources.readers import fixes_of
from quire.sources.schemas import CORRECTIONS


def correction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """sheet, who, src, bi, wi, was, now, after of every file that arrives."""
    files = spark.readStream.schema(CORRECTIONS).option("multiLine", True).json(folder)
    pages = files.select("sheet", "who", F.explode("pages").alias("src", "rec")).select("sheet", "who", "src", "rec.*")
    return fixes_of(pages)


def store_fixes(stream: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Append each batch under its number; a batch that is run again overwrites itself."""

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("arrival", F.lit(number)).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_fixes(spark: SparkSession, store: str) -> DataFrame:
    """The newest correction of each word, whoever sent it and however often."""
    rows = spark.read.parquet(store).select("src", "bi", "wi", "was", "now", "after", "arrival")
    return latest(rows, ["src", "bi", "wi"], [F.col("arrival"), F.col("was"), F.col("now")]).drop("arrival")


def same_sheet(batch: DataFrame, stamps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows made on the sheet as it is now, and rows of an older one (sheet, stamp)."""
    now = stamps.select("sheet", "stamp")
    return batch.join(now, ["sheet", "stamp"], "left_semi"), batch.join(now, ["sheet", "stamp"], "left_anti")
