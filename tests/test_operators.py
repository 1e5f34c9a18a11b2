import random

from pyspark.sql import functions as F

from quire.functions import text as fn
from quire.operators import audit, cluster, fingerprint, joins, markup, merge, roundtrip
from quire.operators.witness import self_witness


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def words_of(spark, text, src=1):
    rows = [(src, 0, 0, k, "black", t, 90.0, 10 * k, 0, 6, 10) for k, t in enumerate(text.split())]
    return spark.createDataFrame(rows, "src int, part int, bi int, wi int, layer string, t string, conf double, x int, y int, w int, h int")


def test_token_classes(spark):
    got = values(spark, [(".",), ("|",), ("©",), ("é",), ("R7",), ("----",)], "t string", fn.markish(F.col("t")))
    assert [x for (x,) in got] == [True, True, True, True, False, False]
    got = values(spark, [("|",), ("}~",), ("*",), ("||||",)], "t string", fn.stray(F.col("t")))
    assert [x for (x,) in got] == [True, True, False, False]
    got = values(spark, [("«été»",), ("don't,",), ("--",), ("__",)], "t string", fn.norm(F.col("t")))
    assert [x for (x,) in got] == ["été", "don't", "", "__"]


def test_edits_and_marks(spark):
    assert values(spark, [("kitten", "sitting"), ("Psalm", "psaln")], "a string, b string", fn.edits(F.col("a"), F.col("b"))) == [(3,), (1,)]
    rows = [("RR", 18.0), ("by", 95.0), ("©", 40.0), ("A", 9.0), ("℟", None)]
    assert [x for (x,) in values(spark, rows, "t string, c double", fn.as_mark(F.col("t"), F.col("c")))] == ["<R>", None, "<V>", None, "<R>"]
    assert [x for (x,) in values(spark, [("R/",), ("R/.",), ("R./",), ("R.",)], "t string", fn.glyphs(F.col("t")))] == ["℟", "℟", "℟", "R."]


def test_line_classes(spark):
    line = lambda t, layer="black", clearing=1.0: fn.classify_line(F.lit(t), F.lit(layer), F.lit(10), F.lit(50), F.lit(0), F.lit(60), F.lit(clearing))
    got = spark.range(1).select(line("Psalm 94").alias("a"), line("Lesson iv.").alias("b"), line("First Nocturn").alias("c"), line("Ant. 7 sing", "red").alias("d"), line("MATlNS").alias("e"), line("a short head", "red", 1.5).alias("f"), line("a short head").alias("g")).first()
    assert [x and tuple(x) for x in got] == [("psalm", "94"), ("lesson", "iv"), ("bheading", "First Nocturn"), ("ant", "7"), ("hour", "MATINS"), ("heading", "a short head"), None]


def test_reflow_dehyphenate_words(spark):
    assert values(spark, [("com-\npanions",), ("Mary-\nAnn",), ("a\nb",)], "t string", fn.reflow(F.col("t"))) == [("companions",), ("Mary- Ann",), ("a b",)]
    assert values(spark, [("com-\npared",), ("well-known",)], "t string", fn.dehyphenate(F.col("t"))) == [("compared",), ("well-known",)]
    assert values(spark, [("l'âme—well-known 7",)], "t string", fn.text_words(F.col("t"))) == [(["l'âme", "well-known"],)]
    assert values(spark, [("ﬁé “x” — Æ",)], "t string", fn.plain_letters(F.col("t"))) == [('fie "x" - ae',)]


def test_split_boxes(spark):
    got = spark.range(1).select(fn.split_boxes(F.lit(0), F.lit(100), F.array(F.lit("a"), F.lit("bb"))).alias("b")).first().b
    assert [(b.t, b.x, b.w) for b in got] == [("a", 0, 25), ("bb", 50, 50)]


def test_glob(spark):
    pages = spark.createDataFrame([("03-x",), ("13-x",)], "src string")
    assert [r.src for r in joins.matching_any(pages, F.col("src"), spark.createDataFrame([("03-*",)], "pattern string")).collect()] == ["03-x"]


def test_self_witness(spark):
    text = ["a1 b1 c1 is d1 e1 f1"] * 2 + ["a1 b1 c1 ts d1 e1 f1"]
    words = words_of(spark, text[0], 1).union(words_of(spark, text[1], 2)).union(words_of(spark, text[2], 3))
    assert [tuple(r) for r in self_witness(words).collect()] == [(3, 0, 3, "ts", "is", 2, 90)]
    halves = words_of(spark, "a1 b1 c1 ts", 3).union(words_of(spark, "d1 e1 f1", 4))
    assert self_witness(words.where("src < 3").union(halves)).count() == 0


def test_upper_median(spark):
    assert values(spark, [(1,), (2,), (3,), (10,)], "h int", audit.upper_median(F.col("h"))) == [(3,)]
    assert values(spark, [(0,)], "h int", audit.upper_median(F.col("h"))) == [(1,)]


def test_outlier_guard(spark):
    pages = spark.createDataFrame([(k, "p", 10, 0 if k == 0 else 7, 0, 100, 0.0) for k in range(5)], "src int, part string, black int, red int, low int, words int, rate double")
    assert audit.page_outliers(pages).count() == 0
    assert audit.page_outliers(pages.withColumn("red", F.when(F.col("src") == 0, 0).otherwise(8))).count() == 1


def test_fingerprint(spark):
    assert values(spark, [(["a", "b"],), ([],)], "t array<string>", fingerprint.sha_of(F.col("t"))) == [("023b8059a924f728",), ("e3b0c44298fc1c14",)]
    was = spark.createDataFrame([("p", "1"), ("q", "1")], "src string, words string")
    now = spark.createDataFrame([("q", "2"), ("r", "1")], "src string, words string")
    assert sorted(map(tuple, fingerprint.snapshot_diff(was, now, ["words"]).collect())) == [("p", "gone", ""), ("q", "moved", "words"), ("r", "fresh", "")]


def test_order_changes_a_fingerprint(spark):
    a = fingerprint.fingerprints(words_of(spark, "x1 y1 z1"), ["bi", "wi"]).first().words
    b = fingerprint.fingerprints(words_of(spark, "z1 y1 x1"), ["bi", "wi"]).first().words
    assert a != b


def test_bags(spark):
    a, b = spark.createDataFrame([("a",), ("a",), ("b",)], "w string"), spark.createDataFrame([("a",), ("c",)], "w string")
    assert sorted(map(tuple, roundtrip.bag_difference(a, b, ["w"]).collect())) == [("a", 1), ("b", 1)]
    assert sorted(map(tuple, roundtrip.bag_difference(b, a, ["w"]).collect())) == [("c", 1)]


def test_absent_run(spark):
    source = spark.createDataFrame([(1, k, w) for k, w in enumerate("x y z w".split())], "src int, pos int, word string")
    there = spark.createDataFrame([(1, "x"), (1, "w")], "src int, word string")
    assert [tuple(r) for r in roundtrip.absent_run(source, there).collect()] == [(1, 2, "y z")]


def test_moved_headings(spark):
    heads = spark.createDataFrame([(1, 0, ["a"]), (1, 1, ["b"]), (1, 2, ["c"]), (1, 3, ["gone", "now"])], "src int, head int, words array<string>")
    stream = spark.createDataFrame([(1, k, w) for k, w in enumerate("a c b".split())], "src int, pos int, word string")
    assert sorted(r["head"] for r in roundtrip.moved_headings(heads, stream).collect()) == [2, 3]


def test_drift(spark):
    pairs = spark.createDataFrame([(1, list("abcdef"), list("abf"))], "src int, a array<string>, b array<string>")
    assert tuple(roundtrip.drift_run(pairs).first()) == (1, 3, "c d e")


def loop_groups(ys, tol):
    out = []
    for y in sorted(ys):
        if out and abs(y - out[-1][0]) <= tol:
            out[-1].append(y)
        else:
            out.append([y])
    return out


def test_anchored_groups_equal_a_loop(spark):
    rng = random.Random(4)
    rows = [([rng.randint(0, 60) for _ in range(rng.randint(0, 12))],) for _ in range(40)] + [([0, 5, 10, 15],)]
    df = spark.createDataFrame(rows, "ys array<int>")
    got = df.select(cluster.anchored(F.array_sort(F.transform("ys", lambda y: F.struct(y.alias("y")))), lambda m: m["y"], F.lit(6))).collect()
    assert [[[m.y for m in g] for g in r[0]] for r in got] == [loop_groups(ys, 6) for (ys,) in rows]


def test_layers_merge(spark):
    lines = spark.createDataFrame([(1, "black", 100, 50, 20, "b"), (1, "red", 104, 10, 20, "r")], "src int, layer string, y int, x int, h int, text string")
    assert [tuple(r) for r in cluster.merge_layers(lines).orderBy("bi").collect()] == [(1, 0, "red", "r"), (1, 1, "black", "b")]


def test_cluster_values_and_rules(spark):
    df = spark.createDataFrame([([1, 2, 3, 20, 23],)], "v array<int>")
    assert df.select(cluster.cluster_values(F.col("v"), F.lit(5)), cluster.merged_rules(F.col("v"))).first()[:] == ([2, 21], [1, 20])


def lay(spark, boxes, cuts, lean=0.0):
    words = spark.createDataFrame([("p", t, x, y, 0) for t, x, y in boxes], "src string, t string, x int, y int, w int")
    rows = cluster.table_rows(words, spark.createDataFrame([("p", cuts, lean)], "src string, cols array<double>, lean double"), 10, 100).orderBy("row").collect()
    return [r.cells for r in rows], [round(x, 6) for x in rows[0].widths]


def test_table(spark):
    assert lay(spark, [("1", 5, 0), ("feast", 60, 0), ("more", 30, 20)], [0.25, 0.5]) == ([["1", "", "feast"], ["", "more", ""]], [0.25, 0.25, 0.5])
    assert lay(spark, [("1", 5, 0), ("feast", 30, 0), ("on", 40, 20), ("|", 95, 0), ("|", 95, 40)], [0.2, 0.9]) == ([["1", "feast on"], ["", ""]], [0.2, 0.8])
    # Guides that lean: the top of the page moves one way, its foot the other.
    boxes = [("a", 52, 0), ("b", 48, 100)]
    assert lay(spark, boxes, [0.5])[0] == [["b", "a"]] and lay(spark, boxes, [0.5], 5.0)[0] == [["a", ""], ["", "b"]]


FIX = "src int, bi int, wi int, was string, now string, after string"


def verdicts(spark, text, fixes):
    return sorted((r.wi, r.verdict) for r in merge.fix_verdicts(words_of(spark, text), spark.createDataFrame(fixes, FIX)).collect())


def applied(spark, text, fixes):
    out = merge.apply_fixes(words_of(spark, text), spark.createDataFrame(fixes, FIX))
    return " ".join(r.t for r in out.orderBy("bi", "wi").collect())


def test_fixes(spark):
    assert verdicts(spark, "foo x", [(1, 0, 0, "bar", "baz", None)]) == [(0, merge.CHANGED)]
    assert verdicts(spark, "foo x", [(1, 0, 9, "bar", "baz", None), (1, 3, 0, "a", "b", None)]) == [(0, merge.NO_WORD), (9, merge.NO_WORD)]
    both = [(1, 0, 0, "a", "", "b"), (1, 0, 1, "b", "", "c")]
    assert applied(spark, "a b c", both) == "c"
    assert verdicts(spark, "a b c", [(1, 0, 0, "a", "", "z")]) == [(0, merge.NEIGHBOUR)]
    assert applied(spark, "a bc d", [(1, 0, 1, "bc", "b c", None)]) == "a b c d"
    assert verdicts(spark, "a b c d", [(1, 0, 1, "bc", "b c", None)]) == [(1, merge.AGAIN)]
    assert verdicts(spark, "b c", [(1, 0, 0, "a", "", "b")]) == [(0, merge.CHANGED)]
    assert verdicts(spark, "a b", [(1, 0, 0, "a", "c", None), (1, 0, 1, "b", "", None)]) == [(0, merge.DONE), (1, merge.DONE)]
    got = merge.apply_fixes(words_of(spark, "abc d"), spark.createDataFrame([(1, 0, 0, "abc", "a bc", None)], FIX)).orderBy("wi").collect()
    assert [(r.wi, r.t, r.x, r.w, r.conf) for r in got] == [(0, "a", 0, 2, 100.0), (1, "bc", 4, 3, 100.0), (2, "d", 10, 6, 90.0)]


def slow_fixes(words, fixes):
    """One page's words and its fixes, last address first, in plain lists."""
    here, then, said = list(words), list(words), []
    for wi, was, now, after in sorted(fixes, reverse=True, key=lambda f: f[0]):
        parts = (now or "").split()
        if wi >= len(here):
            said.append((wi, merge.NO_WORD))
        elif parts and here[wi : wi + len(parts)] == parts:
            said.append((wi, merge.AGAIN))
        elif here[wi] != was:
            said.append((wi, merge.CHANGED))
        elif not parts and after is not None and (then[wi + 1] if wi + 1 < len(then) else None) != after:
            said.append((wi, merge.NEIGHBOUR))
        else:
            said.append((wi, merge.DONE))
            here[wi : wi + 1] = parts
    return here, sorted(said)


def test_fixes_equal_a_loop(spark):
    rng = random.Random(6)
    pages, fixes = {}, {}
    for src in range(60):
        pages[src] = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        fixes[src] = [(wi, rng.choice("abc"), rng.choice(["", "a", "b c", "a b c", None, "c"]), rng.choice([None, "a", "b"])) for wi in rng.sample(range(9), rng.randint(0, 5))]
    rows = [(s, 0, 0, k, "black", t, 90.0, 10 * k, 0, 6, 10) for s, p in pages.items() for k, t in enumerate(p)]
    words = spark.createDataFrame(rows, "src int, part int, bi int, wi int, layer string, t string, conf double, x int, y int, w int, h int")
    df = spark.createDataFrame([(s, 0, *f) for s, fs in fixes.items() for f in fs], FIX)
    texts = {r.src: r.text for r in merge.fixed_texts(words, df).collect()}
    told = {}
    for r in merge.fix_verdicts(words, df).collect():
        told.setdefault(r.src, []).append((r.wi, r.verdict))
    for s in pages:
        here, said = slow_fixes(pages[s], fixes[s])
        assert texts[s] == " ".join(here) and sorted(told.get(s, [])) == said
    assert len({v for x in told.values() for _, v in x}) == 5


def test_correction_records(spark):
    kind = "src string, full boolean, note string, cols array<double>, lean double, fix map<string,string>, str map<string,struct<do:string,was:string>>"
    records = spark.createDataFrame([("p", True, "", [0.2], None, None, {"1": {"do": "up", "was": "x"}}), ("q", None, "see", None, 1.0, None, None), ("r", False, None, [], None, {}, {})], kind)
    assert sorted(r.src for r in merge.worth_keeping(records).collect()) == ["p", "q"]
    kept = spark.createDataFrame([("p", {"1": {"do": "down", "was": "y"}, "2": {"do": "open", "was": "z"}}, None, 2.0), ("r", {}, [0.5], 1.5)], "src string, ops map<string,struct<do:string,was:string>>, cols array<double>, lean double")
    got = {r.src: ({k: v.do for k, v in r.ops.items()}, r.cols, r.lean) for r in merge.persist_structure(kept, records).collect()}
    assert got == {"p": ({"1": "up", "2": "open"}, [0.2], 0.0), "r": ({}, [0.5], 1.5)}
    drafts = spark.createDataFrame([("p", None, "old"), ("q", True, "old"), ("s", False, None)], "src string, proofed boolean, note string")
    assert sorted(map(tuple, merge.page_fields(drafts, records).collect())) == [("p", True, "old"), ("q", True, "see"), ("s", False, None)]
    said = spark.createDataFrame([(merge.DONE, 1), (merge.DONE, 3), (merge.DONE, 0), (merge.AGAIN, 1), (merge.CHANGED, 1)], "verdict string, parts int")
    assert merge.correction_report(said, records).first().asDict() == {"changed": 2, "cut": 1, "added": 2, "again": 1, "refused": 1, "notes": 1, "blocks": 1, "tables": 1}


def test_setwise_deletion_agrees_with_the_fold(spark):
    words = words_of(spark, "a | b ~ || c")
    d = merge.stray_deletions(words)
    assert [r.text for r in merge.delete_words(words, d).collect()] == [" ".join(r.t for r in merge.apply_fixes(words, d).orderBy("wi").collect())] == ["a b c"]


def test_merge_keeps_human_fields(spark):
    new = spark.createDataFrame([("p", None, 1), ("q", None, 2)], "src string, note string, n int")
    old = spark.createDataFrame([("p", "seen", 0)], "src string, note string, n int")
    assert sorted(map(tuple, merge.keep_fields(new, old, "src", ["note"]).collect())) == [("p", "seen", 1), ("q", None, 2)]
    empty = spark.createDataFrame([("p", "", 0)], "src string, note string, n int")
    assert sorted(map(tuple, merge.keep_fields(new.fillna("x"), empty, "src", ["note", "n"]).collect())) == [("p", "x", 1), ("q", "x", 2)]
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "key string, at int, v string")
    assert [tuple(r) for r in merge.latest(rows, ["key"], [F.col("at")]).collect()] == [("k", 2, "b")]


PAGE = "#src p\n\n.text\na\nb\n.rubric\nc\n.text d\n"


def replay(spark, text, ops):
    pages = spark.createDataFrame([("p", text)], "src string, text string")
    held = spark.createDataFrame([("p", ops)], "src string, ops map<string,struct<do:string,was:string>>")
    return tuple(markup.replay_pages(pages, held).select("text", "done", "refused").first())


def test_replay(spark):
    assert replay(spark, PAGE, {})[0] == PAGE
    text, done, refused = replay(spark, PAGE, {"1": {"do": "join", "was": "c"}, "0": {"do": "up", "was": "a\nb"}, "9": {"do": "down", "was": "d"}})
    assert (done, refused) == (1, 2) and text == "#src p\n\n.text\na\nb\nc\n.text d\n"
    assert replay(spark, PAGE, {"1": {"do": "open", "was": "c"}, "7": {"do": "open", "was": "c"}})[1:] == (1, 0)
    assert ".open red" in replay(spark, PAGE, {"1": {"do": "open", "was": "c"}})[0]
    assert replay(spark, PAGE, {"0": {"do": "down", "was": "a\nb"}})[0] == "#src p\n\n.rubric\nc\n.text\na\nb\n.text d\n"
    assert replay(spark, PAGE, {"2": {"do": "join", "was": "d"}})[0] == "#src p\n\n.text\na\nb\n.rubric\nc\nd\n"
    # Numbers that are none, unknown actions, pages that are null.
    assert replay(spark, PAGE, {"x": {"do": "up", "was": "c"}})[1:] == (1, 0)
    assert replay(spark, PAGE, {"1": {"do": "spin", "was": "c"}})[1:] == (0, 1)
    assert replay(spark, None, {"1": {"do": "up", "was": "c"}}) == (None, 0, 1)


def test_lines_that_open_blocks(spark):
    """A bare dot and a # after the first tag open blocks; blank lines go; an inline of blanks is none."""
    text = "x\n#src p\n.text  \n\na\n.\nb\n#note c\nd\n"
    pages = spark.createDataFrame([("p", text)], "src string, text string")
    got = [(r.bi, r.tag, r.inline, r.lines) for r in markup.blocks_of(pages).orderBy("bi").collect()]
    assert got == [(0, "text", None, ["a"]), (1, "", None, ["b"]), (2, "#note", "c", ["d"])]
    assert replay(spark, text, {"2": {"do": "up", "was": "c\nd"}})[0] == "#src p\n\n.text\na\n#note c\nd\n.\nb\n"


def test_blocks(spark):
    lines = spark.createDataFrame([("p", k, x) for k, x in enumerate(PAGE.splitlines())], "src string, line_no int, line string")
    got = [(r.bi, r.tag, r.inline, r.lines) for r in markup.blocks_from_lines(lines).orderBy("bi").collect()]
    assert got == [(0, "text", None, ["a", "b"]), (1, "rubric", None, ["c"]), (2, "text", "d", [])]


def typeset(spark, text):
    r = markup.typeset_pages(spark.createDataFrame([("p", text)], "src string, text string")).first()
    return r.tex.split("\n"), r.unknown


def test_typeset(spark):
    out, unknown = typeset(spark, ".text\ncom-\npanions {red} a * b ** c\n.ant 7\nx\n.open\nSing to\n.nosuch\n")
    assert out == [r"\begin{brevbody}", r"companions \rubric{red} a \med{} b ** c", "", r"\ant{7}%", "x", "", r"\opening[black]{S}{ing} to", "", r"\end{brevbody}"]
    assert unknown == ["nosuch"]
    out, _ = typeset(spark, ".table 0.25 0.75\na | b & c\n.title\nOne\nTwo\n")
    assert out[1] == r"a & b \& c \\" and out[-1] == r"\displaytitle{One \\ Two}"
    out, _ = typeset(spark, "#office A & B\n#hour Lauds\n.rubric\nOn {Sunday}, * {*}\n.widerubric\nAll\n.table x\na|b\n.heading {x} y\n.rule black\n")
    assert out == [r"\office{A \& B}", "% hour: Lauds", r"\begin{brevbody}", r"\begin{rubricpar}", r"On \textcolor{black}{Sunday}, \med{} \textcolor{black}{\med{}}", "", r"\end{rubricpar}", r"\end{brevbody}", r"\begin{rubricpar}", "All", "", r"\end{rubricpar}", r"\begin{brevtable}{p{\dimexpr 1.0000\linewidth-2\tabcolsep\relax}}", r"a \\", r"\end{brevtable}", r"\begin{brevbody}", r"\heading{\textcolor{black}{x} y}", r"\blackrule", r"\end{brevbody}"]
    assert typeset(spark, None) == ([""], [])


def test_tag_safe(spark):
    assert values(spark, [(".troyed",), (".text",), ("x",)], "t string", fn.tag_safe(F.col("t"), ["text"])) == [(" .troyed",), (".text",), ("x",)]


def test_markup_words(spark):
    lines = spark.createDataFrame([(1, 0, ".psalm 94"), (1, 1, "{a} <R>b"), (1, 2, ".rule")], "src int, line_no int, line string")
    assert markup.markup_words(lines).first().text.split() == ["psalm", "94", "a", "b"]


def test_band_and_boxes(spark):
    bands = spark.createDataFrame([(0, 0.0, 10.0), (1, 10.0, 20.0)], "ix int, lo double, hi double")
    lines = spark.createDataFrame([(10.0,), (10.0,), (30.0,)], "mid double")
    assert sorted(((r.mid, r.ix) for r in joins.first_band(lines, bands, "mid", "lo", "hi", "ix").collect()), key=str) == [(10.0, 0), (10.0, 0), (30.0, None)]
    box = "src int, x int, y int, w int, h int"
    assert joins.uncovered(spark.createDataFrame([(1, 0, 0, 5, 5), (1, 50, 0, 5, 5)], box), spark.createDataFrame([(1, 3, 3, 9, 9)], box)).first().x == 50


def test_sample_every(spark):
    assert sorted(r.src for r in audit.sample_every(spark.range(50).selectExpr("id AS src"), 20).collect()) == [0, 20, 40]


def test_kept_in_order():
    import itertools

    import pandas as pd

    rng = random.Random(8)
    assert roundtrip.kept_in_order(pd.DataFrame({"pos": [], "head": []})) == []
    for _ in range(60):
        pairs = [(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(rng.randint(1, 8))]
        got = roundtrip.kept_in_order(pd.DataFrame(pairs, columns=["pos", "head"]))
        order = [h for _, h in sorted(set(pairs))]
        longest = max(len(c) for n in range(len(order) + 1) for c in itertools.combinations(order, n) if all(a < b for a, b in zip(c, c[1:])))
        it = iter(order)
        assert len(got) == longest and all(h in it for h in got) and got == sorted(set(got))
