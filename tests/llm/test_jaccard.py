"""Near copies by exact five-word Jaccard similarity."""

import itertools
import random

from quire.llm import jaccard

from .conftest import words
from .test_dedup import components, rows


def slow_set(text, width=5):
    w = words(text)
    return {" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def near(pairs):
    ids = {(i, t) for i, t in pairs if i is not None}
    sets = {x: slow_set(x[1]) for x in ids}
    part = components({i for i, _ in ids}, [(a[0], b[0]) for a, b in itertools.combinations(ids, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])
    return sorted(((i, part.get(i)) for i, _ in pairs), key=repr)


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def made(seed=4):
    """Groups of near copies around the threshold, one large, and texts that share a passage only."""
    rng = random.Random(seed)
    out = []
    for group in range(12):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice([4, 6, 30, 120]))]
        out += [edited(rng, base, rng.randrange(1 + len(base) // 20)) for _ in range(60 if group == 0 else 6)]
    passage = "all of these texts hold this one passage of many words"
    return list(enumerate(out + [f"{passage} " + " ".join(f"r{rng.randrange(999)}" for _ in range(rng.randrange(4, 40))) for _ in range(40)]))


def test_near_copies_equal_brute_force(spark, docs, odd, none, clashing):
    for df in (docs, odd, clashing):
        assert rows(jaccard.near_copies(df), "doc_id", "component_id") == near([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    texts = made()
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for most in (64, 3):
        assert rows(jaccard.near_copies(df, most=most), "doc_id", "component_id") == near(texts)
    assert jaccard.near_copies(none).count() == 0


def test_pipeline_drops_near_copies(spark):
    import corpus_pipeline as p

    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    other = base[:50] + ["new"] + base[51:]  # 91 of 101 shingles in common
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other)), (3, edited(rng, base, 60))], "doc_id long, text string")
    assert sorted(r.doc_id for r in p.near_dedup(spark, df, "").collect()) == [1, 3]
