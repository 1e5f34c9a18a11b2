"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of documents; the last returns each document's encoding.

Defined results, for every stage: a null text counts as empty; rows with a null id pass unless their
own text rules them out, and are nobody's copies; equal rows fare alike, and in near-dedup rows that
repeat an id stand or fall together; an empty table gives no rows; further columns pass, whatever
their names, but for the last stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import discard, materialize, read_table
from quire.llm.decontam import clean_documents
from quire.llm.jaccard import near_copies
from quire.llm.line_dedup import dedup_lines
from quire.llm.pieces import encode_documents
from quire.llm.toxicity import drop_toxic, train

SHINGLE_WORDS, SIMILAR = 5, 80  # per cent
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more go; labels teach the score.  Empty texts score what a text without hits does, and stay."""
    return drop_toxic(docs, train(docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows leave the texts, and n_chars follows; an emptied document stays, with empty text."""
    cut = dedup_lines(docs, report=True)
    removed = cut.columns[-1]  # the report's last column, whatever its name
    return cut.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies, found by covering SimHash and completed to the exact Jaccard similarity of shingles, stays; all texts without words are one group."""
    grouped = near_copies(docs, width=SHINGLE_WORDS, percent=SIMILAR)
    gone = grouped.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; an empty text holds none."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation, the scores of the N best, and whether decoding gives the text back."""
    return encode_documents(docs, MODEL)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: Learned scores and lattice search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, done = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*done)  # what the stage before wrote
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
