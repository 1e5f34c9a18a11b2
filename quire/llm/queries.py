"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm.common import read_table
from quire.llm.sharding import SHARDS, SLOTS


def op8_sentencepiece(spark, sf_dir):
    import public_tokenizers

    from quire.llm.pieces import encode_documents

    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op9_language_id(spark, sf_dir):
    from quire.llm.lang_id import identify, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), train(docs))


def op10_exact_dedup(spark, sf_dir):
    from quire.llm.exact_dedup import exact_duplicates

    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op1_lm_scoring(spark, sf_dir):
    import public_tokenizers

    from quire.llm.lm_scoring import score_documents, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return score_documents(docs, *train(docs, tokenizer), tokenizer)


def op2_toxicity(spark, sf_dir):
    from quire.llm.toxicity import score_documents, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, train(docs, read_table(spark, sf_dir, "labels")))


def op3_token_store(spark, sf_dir):
    import public_tokenizers

    from quire.llm.token_store import read_store, write_store

    return read_store(write_store(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


def op4_simhash_dedup(spark, sf_dir):
    from quire.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    from quire.llm.line_dedup import dedup_lines

    return dedup_lines(read_table(spark, sf_dir, "documents"), report=True).select("doc_id", "text", "n_lines", "n_removed")


def op6_sharding(spark, sf_dir):
    from quire.llm.sharding import assign_shards

    return assign_shards(read_table(spark, sf_dir, "documents").select("doc_id"))


def op7_decontamination(spark, sf_dir):
    from quire.llm.decontam import find_contamination

    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    best = F.array_min(F.transform("hits", lambda h: F.struct(h["edits"], h["item_id"])))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").alias("n_items"), best["item_id"].alias("best_item"), best["edits"].alias("best_edits"), F.transform("hits", lambda h: h["item_id"]).alias("items"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL_10 = f"""
WITH t AS (SELECT doc_id, {_LOWERED} AS body FROM documents),
     g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""

SQL_5 = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     p AS (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM l WHERE len(lines) >= 3),
     w AS (SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS body FROM p
           WHERE trim(lines[pos + 1]) <> '' OR trim(lines[pos + 2]) <> '' OR trim(lines[pos + 3]) <> ''),
     f AS (SELECT body, min(row(doc_id, pos)) AS first FROM w GROUP BY body HAVING count(*) > 1),
     r AS (SELECT w.doc_id, w.pos FROM w JOIN f ON w.body = f.body
           WHERE NOT (w.doc_id = f.first[1] AND w.pos < f.first[2] + 3)),
     c AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r CROSS JOIN (SELECT unnest([0, 1, 2]) AS k)),
     g AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN gone IS NULL THEN text ELSE coalesce(list_aggregate(list_transform(list_filter(range(len(l.lines)), lambda i: NOT list_contains(gone, i)), lambda i: l.lines[i + 1]), 'string_agg', chr(10)), '') END AS text,
       CAST(len(l.lines) AS INTEGER) AS n_lines, CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed
FROM documents d JOIN l ON l.doc_id = d.doc_id LEFT JOIN g ON g.doc_id = d.doc_id
"""

#: Shards claim slots one after another: step k is the turn of shard k mod SHARDS.
SQL_6 = f"""
WITH RECURSIVE prefs AS (
  SELECT s, CAST('0x' || substr(md5('offset-' || s), 1, 15) AS BIGINT) % {SLOTS} AS off,
         CAST('0x' || substr(md5('skip-' || s), 1, 15) AS BIGINT) % {SLOTS - 1} + 1 AS skip
  FROM (SELECT unnest(range({SHARDS})) AS s)),
claims AS (
  SELECT 0 AS step, off AS slot, list_transform(range({SLOTS}), lambda i: i = off) AS taken FROM prefs WHERE s = 0
  UNION ALL
  SELECT step + 1, pick, list_transform(taken, lambda x, i: x OR i = pick + 1)
  FROM (SELECT c.step, c.taken, list_filter(list_transform(range({SLOTS}), lambda j: (p.off + j * p.skip) % {SLOTS}), lambda x: NOT c.taken[x + 1])[1] AS pick
        FROM claims c JOIN prefs p ON p.s = (c.step + 1) % {SHARDS} WHERE c.step + 1 < {SLOTS}))
SELECT d.doc_id, CAST(t.slot AS INTEGER) AS slot, CAST(t.step % {SHARDS} AS INTEGER) AS shard
FROM documents d JOIN claims t ON t.slot = CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS}
"""

QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_toxicity, op3_token_store, op4_simhash_dedup, op5_line_dedup, op6_sharding, op7_decontamination, op8_sentencepiece, op9_language_id, op10_exact_dedup)}
ORACLES = {"op5_line_dedup": SQL_5, "op6_sharding": SQL_6, "op10_exact_dedup": SQL_10}
