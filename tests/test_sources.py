import json

from quire.sources import readers
from quire.streaming import corrections


def test_drafts_and_corrections(spark, tmp_path):
    page = {"src": "03-x-0001a", "regions": [[0, 9, [[1, 2], [3, 4]]]], "blocks": [{"column": 0, "region": 0, "layer": "black", "text": "a b", "words": [{"t": "a", "conf": 90.0, "x": 1, "y": 2, "w": 3, "h": 4}, {"t": "b", "conf": 9.5, "x": 5, "y": 2, "w": 3, "h": 4}]}]}
    (tmp_path / "d").mkdir()
    (tmp_path / "d/03-x-0001a.json").write_text(json.dumps(page))
    (tmp_path / "d/bad.json").write_text("{")
    drafts = readers.read_drafts(spark, str(tmp_path / "d"))
    assert [(r.src, r.part, r.bi, r.wi, r.t, r.conf) for r in readers.draft_words(drafts).orderBy("wi").collect()] == [("03-x-0001a", "03", 0, 0, "a", 90.0), ("03-x-0001a", "03", 0, 1, "b", 9.5)]
    got = drafts.where("blocks IS NOT NULL").select(readers.regions_of(drafts.regions).alias("r")).first().r
    assert (got[0].y0, got[0].y1, [(c.x0, c.x1) for c in got[0].cols]) == (0, 9, [(1, 2), (3, 4)])


def put(folder, name, fix):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"sheet": "s", "who": "w", "pages": {"p": {"fix": fix}}}))


def test_correction_stream_applies_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"0.1": {"was": "x", "now": "y"}, "10.2": {"was": "q", "now": "", "after": "z"}})
    for _ in range(2):
        corrections.store_fixes(corrections.correction_stream(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "ckpt")).awaitTermination()
        put(tmp_path / "in", "b.json", {"0.1": {"was": "x", "now": "z"}})
    rows = corrections.stored_fixes(spark, str(tmp_path / "store")).orderBy("bi").collect()
    assert [(r.src, r.bi, r.wi, r.was, r.now, r.after) for r in rows] == [("p", 0, 1, "x", "z", None), ("p", 10, 2, "q", "", "z")]
    assert readers.fixes_of(readers.read_corrections(spark, str(tmp_path / "in"))).count() == 3


def test_side_lists(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# c\n\np-1 0.5\np-2 x\np-3 1 2\n03-* why\n")
    assert [tuple(r) for r in readers.turn_list(spark, str(tmp_path / "t.txt")).collect()] == [("p-1", 0.5)]
    assert [r.pattern for r in readers.pattern_list(spark, str(tmp_path / "t.txt")).collect()][-1] == "03-*"


def test_tsv(spark, tmp_path):
    head = "\t".join("level page block par line word left top width height conf text".split())
    rows = ["5 1 1 1 1 1 40 40 20 10 90 a", "5 1 1 1 1 2 80 42 20 10 x b", "5 1 1 1 1 3 90 44 20 10 80 c"]
    (tmp_path / "o.tsv").write_text("\n".join([head, *("\t".join(r.split()) for r in rows)]) + "\n")
    words = readers.read_tsv(spark, str(tmp_path / "o.tsv"), scale=2, pad=12)
    assert [(r.t, r.x, r.y) for r in words.orderBy("word").collect()] == [("a", 8, 8), ("c", 33, 10)]
    assert readers.tsv_lines(words).first().text == "a c"


def test_markup(spark, tmp_path):
    (tmp_path / "p.md").write_text(".text\nx\n")
    assert [tuple(r) for r in readers.read_markup(spark, str(tmp_path / "p.md")).orderBy("line_no").collect()] == [("p", 0, ".text"), ("p", 1, "x")]
