"""Columns of lines to markup, sinks and reports."""

import json

from pyspark.sql import functions as F

from quire.operators import audit, cluster, fingerprint, joins, roundtrip, structure
from quire.sources import sinks

LINES = "src string, column int, n int, layer string, text string, conf double, y int, x0 int, x1 int"
MARKS = "src string, column int, kind string, y int, ink string, letter string"


def page(spark, lines, marks=()):
    rows = [("p", 1, k, *r) for k, r in enumerate(lines)]
    out = structure.structured(spark.createDataFrame(rows, LINES), spark.createDataFrame([("p", 1, *m) for m in marks], MARKS), 10.0)
    return out.first().text


def line(text, y, layer="black", conf=90.0, x0=0, x1=100):
    return (layer, text, conf, y, x0, x1)


def test_lines_to_markup(spark):
    got = page(spark, [
        line("Psalm 94", 0, "red", x0=30, x1=70), line("Come let us sing to the Lord,", 12), line("to the rock of our salvation.", 24),
        line("RR", 36, "red", 20.0, 0, 10), line("And with you.", 48), line("Ant. 3 Sing aloud", 60, "red"), line("black goes on", 72), line("then red", 74, "red"),
        line(".troyed words here", 86), line("℣ O Lord, open", 98),
    ])
    assert got == "#src p\n\n.psalm 94\n.text\nCome let us sing to the Lord,\nto the rock of our salvation.\n<R> And with you.\n.ant 3\nSing aloud\n.text\nblack goes on {then red}\n .troyed words here\n<V> O Lord, open\n"


def test_rules_and_capitals(spark):
    lines = [line("first line of it", 0), line("ing to the Lord a new song", 20), line("for he is good", 32)]
    assert page(spark, lines, [("rule", 10, "black", None), ("capital", 18, "red", "S")]) == "#src p\n\n.text\nfirst line of it\n.rule black\n.open red\nSing to the Lord a new song\n.text\nfor he is good\n"
    assert page(spark, lines, [("capital", 18, "black", None), ("rule", 90, "red", None)]) == "#src p\n\n.text\nfirst line of it\n.open\ning to the Lord a new song\n.text\nfor he is good\n"


def test_parts_are_written_and_pruned(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    rows = spark.createDataFrame([("03-a", "03", 1), ("13-b", "13", 2), ("14-c", "14", 3)], "src string, part string, n int")
    at = str(tmp_path / "parts")
    sinks.write_parts(rows, at)
    sinks.write_parts(spark.createDataFrame([("13-b", "13", 9)], rows.schema), at)
    assert sorted((r.src, r.n) for r in sinks.read_parts(spark, at).collect()) == [("03-a", 1), ("13-b", 9), ("14-c", 3)]
    one = sinks.read_parts(spark, at, prefix="1", without="4$")
    assert [r.src for r in one.collect()] == ["13-b"] and "PartitionFilters: [isnotnull(part" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.src for r in joins.within_parts(rows, "1", "^14").collect()) == ["13-b"]
    spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")


def test_only_new_rows_are_appended(spark, tmp_path):
    at, bad = str(tmp_path / "done"), str(tmp_path / "bad")
    rows = spark.createDataFrame([("a", 1, None), ("b", None, "torn")], "src string, n int, error string")
    assert sinks.append_new(rows, at, "src", bad) == 1 and sinks.append_new(rows, at, "src", bad) == 0
    assert [r.src for r in spark.read.parquet(bad).collect()] == ["b"]
    assert sinks.append_new(spark.createDataFrame([("b", 2), ("a", 5)], "src string, n int"), at, "src") == 1
    assert sorted((r.src, r.n) for r in spark.read.parquet(at).collect()) == [("a", 1), ("b", 2)]
    sinks.write_pages(spark.createDataFrame([("p", "03", "x")], "src string, part string, text string"), str(tmp_path / "md"))
    assert spark.read.json(str(tmp_path / "md")).first().text == "x"
    sinks.write_reports(spark.createDataFrame([("p", 1)], "src string, n int"), str(tmp_path / "r"))
    (made,) = (tmp_path / "r").glob("*.json")
    assert json.loads(made.read_text()) == {"src": "p", "n": 1}


def test_reports(spark):
    parts = spark.createDataFrame([("a", 6, 0), ("b", 2, 0), ("c", None, 1)], "part string, run int, moved int")
    bad = roundtrip.part_report(parts)
    assert sorted(r.part for r in bad.where("bad").collect()) == ["a", "c"]
    assert (roundtrip.verdict(bad), roundtrip.verdict(bad.where("part = 'b'")), roundtrip.verdict(bad.limit(0))) == (1, 0, 2)
    heads = spark.createDataFrame([(["a", "b"],), (["and"],), (["psalm"],), ([],)], "words array<string>")
    assert [r.words for r in roundtrip.real_headings(heads).collect()] == [["a", "b"], ["psalm"]]
    top, rest = audit.by_deviation(spark.createDataFrame([("p", 1.0), ("q", 3.0), ("r", 3.0)], "src string, off double"), "off", 2)
    assert [r.src for r in top.collect()] == ["q", "r"] and rest == 1
    pages = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "part string")
    assert [(r.part, r.pages) for r in audit.parts_by_size(pages).collect()] == [("a", 1), ("c", 1), ("b", 2)]


def test_lookups(spark):
    words = spark.createDataFrame([("p", 0, 0, "ts"), ("p", 0, 1, "so")], "src string, bi int, wi int, t string")
    said = spark.createDataFrame([("p", 0, 0, "is", 2)], "src string, bi int, wi int, book string, seen int")
    assert sorted((r.t, r.book) for r in joins.word_witness(words, said).collect()) == [("so", None), ("ts", "is")]
    images, drafts = spark.createDataFrame([("p", 3), ("q", 9)], "src string, at int"), spark.createDataFrame([("p", 5)], "src string, at int")
    with_draft, without = joins.image_drafts(images, drafts.select("src"))
    assert [r.src for r in with_draft.collect()] == ["p"] and [r.src for r in without.collect()] == ["q"]
    assert [r.src for r in joins.newer(images, drafts, "src", "at").collect()] == ["q"]


def test_long_lists_meet_by_joins(spark):
    names = spark.createDataFrame([(f"{k:02d}-part-{k % 3}",) for k in range(40)] + [(None,), ("",)], "src string")
    patterns = spark.createDataFrame([("03-*",), ("1?-part-0",), ("*-2",), ("[!0-3]*",), ("39-part-0",), (None,)], "pattern string")
    short, long = (sorted(r.src for r in joins.matching_any(names, F.col("src"), patterns, most=most).collect()) for most in (100, 2))
    assert short == long and len(short) > 10
    assert joins.matching_any(names, F.col("src"), patterns.limit(0)).count() == 0
    bands = spark.createDataFrame([(k, float(k * 3), float(k * 3 + 4 + k % 5)) for k in range(30)], "ix int, lo double, hi double")
    lines = spark.createDataFrame([(float(k) / 2,) for k in range(250)] + [(None,)], "mid double")
    few, many = (sorted(map(repr, (tuple(r) for r in joins.first_band(lines, bands, "mid", "lo", "hi", "ix", most=most).collect()))) for most in (100, 3))
    assert few == many and len(few) == 251
    plan = joins.first_band(lines, bands, "mid", "lo", "hi", "ix")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    paged = joins.first_band(lines.withColumn("src", F.lit("p")), bands.withColumn("src", F.lit("p")), "mid", "lo", "hi", "ix", ["src"])
    assert sorted(repr((r.mid, r.ix)) for r in paged.collect()) == few


def test_columns_and_crops(spark):
    df = spark.createDataFrame([("p", 1, 400), ("p", 0, 300), ("p", 1, 80)], "src string, region int, x0 int")
    assert [(r.region, r.x0, r.n) for r in cluster.reading_order(df).orderBy("n").collect()] == [(0, 300, 1), (1, 80, 2), (1, 400, 3)]
    kinds = spark.createDataFrame([(92, 900), (700, 1000), (300, 1000), (300, 0)], "w int, h int").select(cluster.crop_class(F.col("w"), F.col("h")))
    assert [r[0] for r in kinds.collect()] == ["thin", "page", "column", "column"]


def test_fingerprints_of_markup(spark):
    words = spark.createDataFrame([("p", 0, 0, "a", 1, 2, 3, 4), ("q", 0, 0, "a", 1, 2, 3, 5)], "src string, bi int, wi int, t string, x int, y int, w int, h int")
    prints = fingerprint.page_fingerprints(words, spark.createDataFrame([("p", ".text\na\n")], "src string, text string"), ["bi", "wi"])
    got = {r.src: r for r in prints.collect()}
    assert got["p"].words == got["q"].words and got["p"]["shape"] != got["q"]["shape"] and got["p"].markup and got["q"].markup is None
    blocks = spark.createDataFrame([("p", 0, "a", ["a"]), ("p", 1, "a  b", ["a"]), ("p", 2, "c", [])], "src string, bi int, text string, words array<string>")
    assert sorted(map(tuple, fingerprint.page_faults(blocks, prints).collect())) == [("p", "block 1"), ("q", "no markup")]
