"""Language-model scoring, toxicity, language identification, the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers

from quire.llm import lang_id, lm_scoring, queries, toxicity
from tests.llm.conftest import SF, words

BPE = public_tokenizers.path("byte_bpe_50k.json")


def fold(i, n):
    return None if i is None else zlib.crc32(str(i).encode()) % n


def scored(df):
    d = df.select("doc_id", "text")
    return lm_scoring.score_documents(d, *lm_scoring.train(d, BPE), BPE).collect()


def check_base(rows, got):
    held = {i: [*words(t), " "] for i, t in rows}
    counts = Counter()
    for i, t in rows:
        if i is not None and fold(i, 7) != 2:
            counts.update([*words(t), " "])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        w = held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(counts[x] > 0 for x in w), n, fold(r.doc_id, 7) == 2)
        assert abs(r.base_score - sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w)
        assert r.score < 0 and math.isfinite(r.score)


def test_words_are_split_as_promised():
    rng = random.Random(4)
    texts = [None, "", "  ", "A b"] + ["".join(rng.choice("aBéÉ \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u2003\u3000日") for _ in range(rng.randint(0, 12))) for _ in range(800)]
    for part in (pa.array(texts), pa.array(texts).slice(5, 300), pa.array(texts * 200).slice(60_001, 70_000)):
        distinct, numbers, per = lm_scoring.split_words(part)
        at = np.cumsum(per)
        assert [[distinct[k].decode() for k in numbers[e - n : e]] for e, n in zip(at.tolist(), per.tolist(), strict=True)] == [words(t) for t in part.to_pylist()]
        assert len(set(distinct)) == len(distinct)


def test_lm_scores(docs):
    got = scored(docs)
    check_base([(r.doc_id, r.text) for r in docs.collect()], got)
    # A word costs less than spelling it letter by letter would, on texts not learned from.
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) / sum(r.n_tokens for r in held) > -6


def test_lm_odd_rows(odd, none, clashing):
    for df in (odd, clashing):
        check_base([(r.doc_id, r.text) for r in df.collect()], scored(df))
    assert scored(none) == []


def trained(docs):
    _, stats, net = lm_scoring.train(docs.select("doc_id", "text"), BPE)
    return stats, net, lm_scoring.ids_for(BPE)


def slow_score(stats, net, ids, text):
    """log10 probability of a text, one subword, one node and one pair of places at a time."""
    w, end, tree = {k: v.astype(float) for k, v in net.w.items()}, ids.end, stats.tree
    spelt = [np.frombuffer(x, "<u4").astype(int).tolist() for x in ids.many([x.encode() for x in words(text)])]
    out = [k for x in spelt for k in x] + [end]
    before = [end, *out[:-1]]

    def state(p):
        # The window that scores place p: twelve at a time, with four before them.
        first = p // 12 * 12 - 4
        seen = [before[q] if q >= 0 else end for q in range(first, p + 1)]
        x = [w["e"][k] + w["p"][n] for n, k in enumerate(seen)]
        q = x[-1] @ w["q"] / 4
        a = [math.exp(min(30, q @ (y @ w["k"]))) for y in x]
        return x[-1] + sum(b * (y @ w["v"]) for b, y in zip(a, x, strict=True)) / sum(a)

    def turn(p, h, node, side):
        at = stats.column[node]
        odds = float(stats.after[stats.place[before[p]], at] if at >= 0 else stats.alone[node]) + h @ w["n"][node]
        return 1 / (1 + math.exp(-odds if side else odds))

    def way(k):
        return [(t >> 1, t & 1) for t in tree.turns[tree.start[k] : tree.start[k] + tree.size[k]].tolist()]

    total, place, met = 0.0, 0, Counter()
    for n, parts in enumerate([*spelt, [end]]):
        p = 1.0
        for m, k in enumerate(parts):
            h = state(place)
            if m:
                p *= turn(place, h, 0, 0)
            for node, side in way(k):
                p *= turn(place, h, node, side)
            place += 1
        again = lm_scoring.RECENT * n / (n + lm_scoring.RECENT_FROM)
        if n < len(spelt):
            p *= turn(place, state(place), 0, 1)
            p = (1 - again) * p + (again * met[tuple(parts)] / n if n else 0)
            met[tuple(parts)] += 1
        else:
            p *= 1 - again
        total += math.log10(p)
    return total


def test_lm_equals_brute_force(spark, docs):
    stats, net, ids = trained(docs.where("doc_id < 40"))
    assert np.abs(net.w["n"]).max() > 0
    rng = random.Random(3)
    known = [x for r in docs.limit(5).collect() for x in words(r.text)[:40]]
    texts = ["", "a", "the the the", *(" ".join(rng.choice([*known, "xq", "日本", "don't", "12"]) for _ in range(rng.randint(1, 30))) for _ in range(12))]
    c = lm_scoring.coded(pa.array(texts), ids)
    got = lm_scoring.Scorer(stats, net, ids).score(c, lm_scoring.repeats(c)[0])
    assert np.allclose(got, [slow_score(stats, net, ids, t) for t in texts], rtol=2e-4)


def test_lm_is_normalised(docs):
    """Continuations of a context add up to one, over ids inside a word and over ids that begin one; every id has a way of its own."""
    stats, net, ids = trained(docs.where("doc_id < 40"))
    tree = stats.tree
    ways = {(bool(o), tree.turns[a : a + n].tobytes()) for o, a, n in zip(tree.opening, tree.start, tree.size, strict=True)}
    assert len(ways) == ids.end + 1 > 50_000
    stem = lm_scoring.coded(pa.array(["the and attion"]), ids).out[:-1]
    s = lm_scoring.Scorer(stats, net, ids)
    for opens in (True, False):
        every = np.flatnonzero(tree.opening == opens)
        out = np.hstack((np.tile(stem, (len(every), 1)), every[:, None])).ravel()
        ends = np.arange(1, len(every) + 1) * (len(stem) + 1)
        total = np.exp(s.each(out, ends)[0][ends - 1]).sum()
        assert abs(total - 1) < 1e-3


def test_training_windows_follow_the_texts(spark, docs):
    ids = lm_scoring.ids_for(BPE)
    for step in (256, 4096):
        rows = lm_scoring.windows_of(docs.select("doc_id", "text"), BPE, step).collect()
        before, own = (np.frombuffer(b"".join(bytes(r[c]) for r in rows), "<u4").reshape(-1, lm_scoring.WINDOW) for c in ("before", "ids"))
        assert (before[:, 1:] == own[:, :-1]).all()
        every = lm_scoring.coded(pa.array([r.text for r in docs.collect()]), ids).out
        share = own.size / len(every) * step / lm_scoring.SLICE
        assert 0.5 < share < 1.1
        flat = every.astype("<u4").tobytes()
        assert np.mean([flat.find(bytes(r.ids)[8:]) >= 0 for r in rows]) > 0.95


def test_trainers_average_to_one(spark, docs):
    """One trainer gives its own weights; several give the mean of theirs, row by row."""
    windows = lm_scoring.windows_of(docs.select("doc_id", "text"), BPE)
    stats, vectors = lm_scoring.statistics(lm_scoring.count_words(docs), windows, BPE)
    start = lm_scoring.Network(vectors, stats.tree.nodes)
    for most in (10**6, 60):
        got = lm_scoring.fit_together(windows, stats, start, rounds=1, most=most)
        n = max(1, -(-windows.count() // most))
        sums, seen = {k: np.zeros_like(v, float) for k, v in start.w.items()}, {k: np.zeros(len(v)) for k, v in start.w.items()}
        for part in windows.repartition(n, "row").withColumn("p", lm_scoring.F.spark_partition_id()).groupBy("p").agg(lm_scoring.F.collect_list("before").alias("b"), lm_scoring.F.collect_list("ids").alias("i")).collect():
            x, y = (np.frombuffer(b"".join(map(bytes, c)), "<u4").reshape(-1, lm_scoring.WINDOW).astype(np.int64) for c in (part.b, part.i))
            own = lm_scoring.Network.copy(start)
            _, met = own.fit(stats, x, y)
            for k, v in own.w.items():
                weight = met[k] if k in met else np.full(len(v), float(len(x)))
                sums[k] += v * weight[:, None]
                seen[k] += weight
        for k, v in start.w.items():
            wanted = np.where(seen[k][:, None] > 0, sums[k] / np.maximum(seen[k], 1)[:, None], v)
            assert np.allclose(got.w[k], wanted, atol=0.05 if most > 1000 else 0.2) and np.abs(got.w[k] - wanted).mean() < 2e-3


def test_attention_is_causal_and_its_gradient_right():
    rng = np.random.default_rng(0)
    net = lm_scoring.Network(rng.standard_normal((30, lm_scoring.WIDTH)).astype(np.float32), 20)
    x = rng.integers(0, 30, (2, lm_scoring.WINDOW))
    y = x.copy()
    y[:, 9:] = 1
    assert np.allclose(net.attend(x)[-1][:, :9], net.attend(y)[-1][:, :9], atol=1e-5)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.w["n"] = rng.standard_normal(net.w["n"].shape)
    size = rng.integers(1, 5, x.size)
    turns, which, first = rng.integers(0, 40, size.sum()), np.repeat(np.arange(x.size), size), np.cumsum(size) - size
    odds = rng.standard_normal(len(turns))
    _, grads = net.step(x, turns, first, which, odds)
    for name in net.w:
        at = tuple(rng.integers(0, n) for n in net.w[name].shape) if name not in "en" else (int(x[0, 0]) if name == "e" else int(turns[0] >> 1), 3)
        keep = net.w[name][at]
        sides = []
        for e in (1e-5, -1e-5):
            net.w[name][at] = keep + e
            sides.append(net.step(x, turns, first, which, odds)[0])
        net.w[name][at] = keep
        got = dict(zip(grads[name][0].tolist(), grads[name][1], strict=True))[at[0]][at[1]] if name in "en" else grads[name][at]
        assert abs((sides[0] - sides[1]) / 2e-5 - got) < 1e-4


def test_windows_score_each_id_once():
    first, text = lm_scoring.layout(np.array([1, 12, 13, 40]))
    seen = Counter()
    for f, t in zip(first.tolist(), text.tolist(), strict=True):
        for p in range(f + lm_scoring.OVERLAP, f + lm_scoring.WINDOW):
            if p < [1, 12, 13, 40][t]:
                seen[t, p] += 1
    assert set(seen.values()) == {1} and len(seen) == 66


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 10))) for _ in range(50)})
    a = toxicity.Automaton(terms)
    for _ in range(800):
        w = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 11)))
        assert a.match(w) == min(((distance(w, t), k) for k, t in enumerate(terms) if distance(w, t) <= toxicity.edits_for(t)), default=None)


def test_context_tells_quotation_from_abuse():
    s = toxicity.Scorer({"moronic": 1.0, "trash": 1.0}, frozenset(["thrash"]), toxicity.PRIOR)
    assert s.rows(["you moronic", 'he called it "moronic" again', "you morronic", "they said morronic things", "thrash", ""]) == [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [0, 0, 0, 0], [0, 0, 0, 0]]
    p = s.scores(["you moronic trash", 'he said "moronic"', ""])
    assert p[0] > 0.5 > p[1] > p[2] > 0


def test_toxicity_scores_equal_brute_force(docs, spark):
    """Features and score of every text by distances to every term, word by word."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lexicon, exempt, w = toxicity.train(docs.select("doc_id", "text"), labels)
    lexicon = {**lexicon, "scoundrel": 1.5, "rat": 0.5}
    terms = sorted(lexicon)
    rng = random.Random(7)
    fill = ["said", "the", "a", '"', "“", "”", "scoundrel", "scoundel", "rat", "rats", "İİİ", *terms[:6], *[t[1:] for t in terms[:6]]]
    texts = [" ".join(rng.choice(fill) for _ in range(rng.randint(0, 30))) for _ in range(150)] + ["İ" * 8 + ' "scoundrel" x', "scoundrel " * 500, ""]

    def slow(text):
        text, out = text.lower(), [0.0] * 4
        found = [(m.group(), m.start(), m.end()) for m in toxicity._WORD.finditer(text)]
        for k, (word, start, end) in enumerate(found):
            near = min(((distance(word, t), n) for n, t in enumerate(terms) if distance(word, t) <= toxicity.edits_for(t)), default=None)
            if near is None or word in exempt:
                continue
            around = found[max(0, k - toxicity.NEAR) : k + toxicity.NEAR + 1]
            marks = [sum(c in '"“”„«»' for c in part) for part in (text[around[0][1] : start], text[end : around[-1][2] + 1])]
            quoted = (marks[0] % 2 == 1 and marks[1] > 0) or any(x in toxicity.REPORTING for x, _, _ in around)
            out[2 * (near[0] > 0) + quoted] += lexicon[terms[near[1]]]
        return out

    s = toxicity.Scorer(lexicon, exempt, w)
    got, wanted = np.array(s.rows(texts)), np.array([slow(t) for t in texts])
    assert np.allclose(got, wanted)
    odds = [math.exp(w[0] + sum(a * math.log2(1 + x) for a, x in zip(w[1:], row, strict=True))) for row in wanted.tolist()]
    assert np.allclose(s.scores(texts), [o / (1 + o) if math.isfinite(o) else 1 for o in odds])


def test_toxicity_learns(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        w = [rng.choice(plain) for _ in range(30)]
        bad = k % 5 == 0
        if bad:
            for t in ("scoundrel", "villain"):
                w[rng.randrange(30)] = t if k % 15 else t[:3] + "x" + t[4:]
        rows.append((k, " ".join(w)))
        labels.append((k, 1 if bad else 0))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, toxicity.train(docs, known)).collect()}
    held = [k for k, _ in labels if fold(k, 5) == 0]
    assert all(got[k].held_out == (fold(k, 5) == 0) for k in got)
    assert np.mean([got[k].predicted == dict(labels)[k] for k in held]) > 0.97


def test_toxicity_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(2, 1), (3, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    for df in (odd, clashing):
        model = toxicity.train(df, labels)
        out = toxicity.score_documents(df.select("doc_id", "text"), model).collect()
        assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
        assert toxicity.drop_toxic(df, model).columns == df.columns
    model = toxicity.train(none, labels.where("false"))
    assert toxicity.score_documents(none.select("doc_id", "text"), model).count() == 0


def slow_languages(rows):
    """doc_id -> (language, score) by counting everything in memory."""
    letters, grams, known = Counter(), {}, {}
    for i, t, lang in rows:
        if i is None or lang is None or t is None or fold(i, 4) == 2:
            continue
        for w in lang_id.words_of(t):
            known.setdefault(w, Counter())[lang] += 1
            for n in range(1, 6):
                for g in lang_id.grams_of(w, n):
                    grams.setdefault(g, Counter())[lang] += 1
                    letters[lang] += n == 1
    langs = sorted({x for c in known.values() for x in c})
    total = {x: sum(c[x] for c in known.values()) for x in langs}

    def word(w, x):
        if w in known:
            return math.log((known[w][x] + 0.5) / (total[x] + 0.5 * (len(known) + 1)))
        framed, got = f"<{w}>", []
        for end in range(1, len(framed) + 1):
            for n in range(min(5, end), 0, -1):
                if framed[end - n : end] in grams:
                    got.append(grams[framed[end - n : end]][x])
                    break
        return sum(math.log((c + 0.5) / (letters[x] + 0.5 * (len(grams) + 1))) for c in got or [0]) / 5

    out = []
    for i, t, _ in rows:
        w = lang_id.words_of(t or "")
        if not w or not langs:
            out.append((i, fold(i, 4) == 2, "und", 0.0))
            continue
        sums = [sum(word(y, x) for y in w) for x in langs]
        best = max(sums)
        out.append((i, fold(i, 4) == 2, langs[sums.index(best)], round(1 / sum(math.exp(x - best) for x in sums), 6)))
    return sorted(out, key=repr)


def told(df, heavy=lang_id.HEAVY, grams=lang_id.GRAMS_TOLD):
    d = df.select("doc_id", "text", "lang")
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 6)) for r in lang_id.identify(d, lang_id.train(d), heavy, grams).collect()), key=repr)


def test_language_equals_brute_force(spark, docs, odd, none, clashing):
    rng = random.Random(2)
    made = [(k, "".join(rng.choice("abcé ²7") for _ in range(rng.randint(0, 25))) + f" the{k % 7}", rng.choice(["xx", "yy", "zz", None])) for k in range(300)]
    made = spark.createDataFrame(made, "doc_id long, text string, lang string")
    for df in (made, odd, clashing, none):
        assert told(df) == slow_languages([(r.doc_id, r.text, r.lang) for r in df.select("doc_id", "text", "lang").collect()])
    assert told(made, 30) == told(made, 5, 0) == told(made, grams=0) == told(made)
    some = docs.where("doc_id < 60")
    assert told(some) == told(some, 100, 0) == slow_languages([(r.doc_id, r.text, r.lang) for r in some.collect()])


def test_language_held_out(docs):
    d = docs.select("doc_id", "text", "lang")
    both = lang_id.identify(d, lang_id.train(d)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert both and np.mean([r.lang == r.lang_pred for r in both]) > 0.97


def test_language_odd_rows(spark, odd, none):
    out = {r.doc_id: r for r in lang_id.identify(odd, lang_id.train(odd)).collect()}
    assert out[1].lang_pred == out[2].lang_pred == out[7].lang_pred == "und" and not out[None].held_out
    assert all(r.lang_pred in ("und", "en", "fr", "es") and 0 <= r.score <= 1 for r in out.values())
    signs = spark.createDataFrame([(1, "²³ 12 _ !", "en"), (2, "x", "en"), (3, "y²", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in lang_id.identify(signs, lang_id.train(signs)).collect()} == {1: "und", 2: "en", 3: "en"}
    assert {r.lang_pred for r in lang_id.identify(odd, lang_id.train(none)).collect()} == {"und"}


def test_pipeline(spark, docs):
    import corpus_pipeline as p

    now, kept = docs, docs.count()
    for name, stage in p.STAGES[:-1]:
        now = p.materialize(stage(spark, now, SF), name)
        assert now.columns == docs.columns and 0 < now.count() <= kept
        kept = now.count()
    out = p.STAGES[-1][1](spark, now, SF)
    assert out.count() == kept and out.where("NOT round_trip").count() == 0
    assert sorted(r.doc_id for r in p.run(spark, SF).collect()) == sorted(r.doc_id for r in now.collect())


def test_pipeline_stages_on_odd_rows(spark, odd, none, clashing):
    import corpus_pipeline as p

    kept = {"toxicity": None, "line_dedup": None, "near_dedup": {1, 3, 5, 8, None}, "decontamination": None, "sentencepiece": None}
    for name, stage in p.STAGES:
        for df in (odd, clashing):
            out = stage(spark, df, SF)
            rows = out.collect()
            if name != "sentencepiece":
                assert out.columns == df.columns
            wanted = sorted((r.doc_id for r in df.collect() if kept[name] is None or r.doc_id in kept[name]), key=repr)
            assert sorted((r.doc_id for r in rows), key=repr) == wanted
        assert stage(spark, none, SF).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))
