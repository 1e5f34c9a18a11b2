"""Exact, near and line dedup, sharding."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import duckdb
import xxhash

from quire.llm import exact_dedup, line_dedup, queries, sharding, simhash
from quire.llm.components import connected_components
from tests.llm.conftest import SF, low, words


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def against_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = db.execute(queries.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert rows(queries.QUERIES[name](spark, SF), *cols) == sorted(map(tuple, cur.fetchall()), key=repr)


def test_queries_with_sql(spark):
    for name in ("op5_line_dedup", "op6_sharding", "op10_exact_dedup"):
        against_sql(spark, name)


def exact(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[low(t)].append(i)
    out = []
    for i, t in pairs:
        ids = [x for x in groups[low(t)] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[low(t)]), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup_odd_rows(odd, none, clashing):
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(exact_dedup.exact_duplicates(odd), *COLS) == exact(pairs)
    assert rows(exact_dedup.exact_duplicates(clashing), *COLS) == exact(pairs)
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_chunks_are_the_text_and_follow_content():
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcdefg ") for _ in range(200_000))
    import pyarrow as pa

    a, b, c = exact_dedup.chunked(pa.array([text.decode(), "xyz" + text.decode(), None]))
    assert b"".join(a) == text and b"".join(b) == b"xyz" + text and c == []
    assert len(set(a) & set(b)) > 0.9 * len(a) > 20
    assert all(exact_dedup.SMALLEST <= len(x) <= exact_dedup.LARGEST for x in a[:-1])


def test_all_identifiers_ambiguous(monkeypatch, odd):
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    monkeypatch.setattr(exact_dedup, "ambiguous_chunks", lambda docs: None)
    assert rows(exact_dedup.exact_duplicates(odd), *COLS) == exact(pairs)


def test_recipes_stand_for_texts(docs):
    recipes = docs.select("doc_id", "text").mapInArrow(exact_dedup._recipe_rows(frozenset()), "doc_id long, text_sha256 string, recipe binary")
    both = {(r.text_sha256, bytes(r.recipe)) for r in recipes.collect()}
    assert len({a for a, _ in both}) == len({b for _, b in both}) == len(both) > 1


def test_ambiguous_identifiers_fall_back(monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1, 2]), pa.array(["aa", "bb"])], names=["doc_id", "text"])
    fp = xxhash.xxh3_128_digest(b"aa")
    plain = next(exact_dedup._recipe_rows(frozenset())([batch]))["recipe"].to_pylist()
    other = next(exact_dedup._recipe_rows(frozenset([fp]))([batch]))["recipe"].to_pylist()
    assert plain[0] == fp and other[0] == hashlib.sha256(b"aa").digest() and plain[1] == other[1]


def slow_fingerprint(t, width):
    w = words(t)
    shingles = [" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    part = {n: n for n in nodes}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in linked:
        p, q = root(a), root(b)
        part[max(p, q)] = min(p, q)
    return {n: root(n) for n in nodes}


def near(pairs, width=3, radius=3):
    fps = {(i, t): slow_fingerprint(t, width) for i, t in pairs}
    ids = {(i, t) for i, t in pairs if i is not None}
    linked = [(a[0], b[0]) for a, b in itertools.combinations(ids, 2) if (fps[a] ^ fps[b]).bit_count() <= radius]
    part = components({i for i, _ in ids}, linked)
    return sorted(((i, f"{fps[i, t]:016x}", part.get(i)) for i, t in pairs), key=repr)


def test_near_dedup(docs, odd, none, clashing):
    for df in (docs, odd, clashing):
        pairs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert rows(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == near(pairs)
    assert simhash.near_duplicates(none).count() == 0


def test_covering_masks_cover():
    for radius in (1, 2, 3):
        masks = simhash.tables(radius, 0)
        assert len(masks) == 2 ** (radius + 1) - 1
        assert all(any(all(not m >> p & 1 for p in bits) for m in masks) for bits in itertools.combinations(range(64), radius))
    assert max(64 - m.bit_count() for m in simhash.tables(3, 2)) <= 8


def test_hot_buckets_lose_no_link(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(500)} | {rng.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    wanted = {tuple(sorted((simhash.signed(a), simhash.signed(b)))) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3}
    assert {(r.a, r.b) for r in simhash.links(df, most=8).collect()} == wanted


def test_components(spark):
    rng = random.Random(3)
    linked = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(linked, "a long, b long")).collect()}
    nodes = {x for ab in linked for x in ab if ab[0] != ab[1]}
    assert got == {k: v for k, v in components(nodes, linked).items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_lines(pairs, window=3):
    found = defaultdict(list)
    for i, t in dict.fromkeys((i, t) for i, t in pairs if i is not None):
        lines = (t or "").split("\n")
        for p in range(len(lines) - window + 1):
            if any(x.strip(" ") for x in lines[p : p + window]):
                found[tuple(lines[p : p + window])].append((i, p))
    gone = defaultdict(set)
    for places in found.values():
        first = min(places)
        for i, p in places:
            if not (i == first[0] and p < first[1] + window):
                gone[i].update(range(p, p + window))
    return {i: (t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])) for i, t in pairs if i is not None}


def test_line_dedup(spark, odd, none, clashing):
    a, b = "one\ntwo\nthree\nfour", "x\none\ntwo\nthree\nfour\ny"
    rows_ = [(1, a), (2, b), (3, "r\nr\nr\nr\nr"), (4, "r\nr\nr\nr\nr\nr"), (5, "\n\n\n\n"), (6, "\n\n\n\n"), (7, "one\ntwo"), (8, a), (9, None)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == slow_lines(rows_)
    for d in (odd, clashing):
        out = line_dedup.dedup_lines(d)
        assert out.columns == d.columns and Counter(map(repr, out.collect())) == Counter(map(repr, d.collect()))
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.dedup_lines(clashing, report=True).columns == [*clashing.columns, "n_lines_", "n_removed_"]


def test_line_dedup_heavy_windows(spark, monkeypatch):
    """Windows looked up apart give the same result as all others."""
    rng = random.Random(12)
    rows_ = [(k, "\n".join(rng.choice("abcdef") for _ in range(rng.randint(0, 12)))) for k in range(60)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    for share in (10_000, 40, 0.5):
        monkeypatch.setattr(line_dedup, "HEAVY", share)
        assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == slow_lines(rows_)


def test_line_dedup_is_native(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding(odd, none, clashing):
    table = sharding.lookup_table(7, 101)
    assert sorted(Counter(table).values()) == [14] * 4 + [15] * 3
    moved = sum(a != b for a, b in zip(table, sharding.lookup_table(8, 101), strict=True))
    assert moved < 101 * 0.35
    out = sharding.assign_shards(odd)
    assert out.columns == [*odd.columns, "slot", "shard"] and out.count() == odd.count()
    assert len({(r.slot, r.shard) for r in out.where("doc_id = 4").collect()}) == 1
    clash = sharding.assign_shards(clashing)
    assert clash.columns == [*clashing.columns, "slot_", "shard_"] and clash.count() == odd.count() and sharding.assign_shards(none).count() == 0
    assert rows(clash, "doc_id", "slot_", "shard_") == rows(out, "doc_id", "slot", "shard")
