"""Helpers shared by the training-data operators.

Everything that must outlive one stage goes to the folder named in ``spark.checkpoint.dir``
(shared by driver and executors), so a lost executor never takes results with it.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Bound on what one Arrow batch hands to Python; long documents make small batches.
BATCH_ROWS, BATCH_BYTES = 1000, "4m"
#: Parts that the rows of one group are dealt to at most.
SALTS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes, whatever the length of single documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode, where nothing else is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more, and let go of the shuffles of finished steps."""
    for t in tables:
        at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_to)
        at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def new_name(name: str, taken: list[str]) -> str:
    """The name, with underscores after it until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def salt(*by: str) -> Column:
    """A number below ``SALTS`` that deals the rows of a group by other columns; the same in every attempt of a task."""
    return F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")


def salted_groups(rows: DataFrame, keys: list[str], salt_name: str, first: list[Column], then: list[Column]) -> DataFrame:
    """keys, ``salt_name`` and the aggregates ``then`` of ``first``: one row for each part of a group that ``rows`` holds.

    A group is summed up by parts and joined back by parts, so no task gets all rows of one group,
    and small groups cost one row.
    """
    whole = rows.groupBy(*keys, salt_name).agg(*first).groupBy(*keys).agg(*then, F.collect_list(salt_name).alias(salt_name))
    return whole.withColumn(salt_name, F.explode(salt_name))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(n)


def crc_mod_py(value: int | None, n: int) -> int | None:
    return None if value is None else zlib.crc32(str(value).encode()) % n


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; a null stays null."""
    return F.translate(column, UPPER, LOWER)


def lower_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as bytes with A-Z lowered; null counts as empty."""
    return [b"" if x is None else x.lower() for x in column.cast(pa.binary()).to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def batches(it: Iterable[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes, or one row; Spark may cut its batches by rows alone."""
    for b in it:
        if b.num_rows == 0:
            continue
        step = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)
