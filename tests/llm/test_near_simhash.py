"""The near-dedup stage finds copies by covering SimHash, and what that misses by the exact join."""

from quire.llm import jaccard, simhash


def test_covering_simhash_gives_links(spark):
    base = [f"w{k}" for k in range(300)]
    texts = [base, [*base[:299], "x"], [*base[:298], "y", "z"], [f"v{k}" for k in range(300)], [*base, "more"]]
    sets = [jaccard.shingles(" ".join(t).encode()) for t in texts]
    rows = [(k, len(x), jaccard.fingerprint(x)) for k, x in enumerate(sets)]
    found = {(r.a, r.b) for r in jaccard.covered(spark.createDataFrame(rows, "sid long, n long, fp long")).collect()}
    bits = lambda a, b: ((rows[a][2] ^ rows[b][2]) & (1 << 64) - 1).bit_count()
    near = {(a, b) for a in range(5) for b in range(a) if bits(a, b) <= jaccard.RADIUS}
    assert near and found and all(tuple(sorted(p, reverse=True)) in near for p in found)
    assert {x for p in near for x in p} == {x for p in found for x in p}
    assert 3 not in {x for p in found for x in p}


def test_stage_runs_the_covering_step(spark, monkeypatch):
    called, real = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a, **k: called.append(1) or real(*a, **k))
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(60 + k))) for k in range(6)] + [(9, None)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(docs).collect()}
    assert called and got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 9: 9}
