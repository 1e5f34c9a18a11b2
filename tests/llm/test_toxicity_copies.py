"""Copies of one toxic text leave the lexicon as it is."""

import random

from quire.llm import toxicity


def test_copies_do_not_empty_the_lexicon(spark):
    rng = random.Random(3)
    fill = [f"w{k}" for k in range(60)]

    def text(term):
        w = [rng.choice(fill) for _ in range(30)]
        return " ".join([*w[:15], term, *w[15:]])

    rows = [(k, text("blorgface" if k % 2 else "kindly"), k % 2) for k in range(80)]
    copied = text("blorgface")
    more = [(1000 + k, copied, 1) for k in range(400)]
    learned = []
    for own in (rows, rows + more):
        docs = spark.createDataFrame([(i, t) for i, t, _ in own], "doc_id long, text string")
        learned.append(toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in own], "doc_id long, toxic int")))
    assert all("blorgface" in lexicon for lexicon, _, _ in learned)
    assert set(learned[0][0]) == set(learned[1][0])
    assert toxicity.Scorer(*learned[1]).scores([copied, "w1 w2 w3"]).round().tolist() == [1, 0]
