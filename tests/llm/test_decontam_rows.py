"""Rows stay apart however many blocks the benchmark takes."""

from quire.llm import decontam


def test_blocks_keep_every_row(spark):
    items = [(k, " ".join(f"item{k}word{j}" for j in range(8))) for k in range(6)]
    rows = [(None, items[0][1]), (None, "clean text"), (None, items[3][1]), (1, items[1][1]), (1, "clean too"), (2, "x " + items[2][1] + " y " + items[5][1]), (2, None)]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def found(most):
        return sorted(((r.doc_id, [h.item_id for h in r.hits]) for r in decontam.find_contamination(df, bench, most=most).collect()), key=repr)

    wanted = sorted([(None, [0]), (None, []), (None, [3]), (1, [1]), (1, []), (2, [2, 5]), (2, [])], key=repr)
    assert found(decontam.BLOCK_WORDS) == found(10) == wanted


def test_item_ids_of_other_types(spark):
    df = spark.createDataFrame([(1, "one two three four five"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("b/7", "two three four"), (None, "one two"), ("b/2", "four five")], "item_id string, text string")
    for most in (decontam.BLOCK_WORDS, 3):
        got = {r.doc_id: [(h.item_id, h.edits, h.end_word) for h in r.hits] for r in decontam.find_contamination(df, bench, most=most).collect()}
        assert got == {1: [("b/2", 0, 5), ("b/7", 0, 4)], 2: []}
