import pathlib
import re

import pytest

from quire import llm

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def low(t):
    return (t or "").translate(UPPER)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", low(t))


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{k % 997}" for k in range(60_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Same text here", "en", "s", 1), (4, "same TEXT here", "fr", "s", 1), (4, "same TEXT here", "fr", "s", 1), (5, long, "en", "t", 9), (None, "no id at all", "de", "t", 3), (7, " \t\n ", "es", "t", 3), (8, "日本 é x <|endoftext|>", None, None, 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing(odd):
    """Extra columns named like those that operators use within: every short or underscored name in quotes in their code."""
    from pyspark.sql import functions as F

    here = pathlib.Path(llm.__file__).parent
    inner = {m for p in here.glob("*.py") for m in re.findall(r'"(__[a-z_]+|[a-z][a-z_0-9]{0,12})"', p.read_text())}
    return odd.select("*", *[F.lit(1).alias(c) for c in sorted(inner - {c.lower() for c in odd.columns})])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
