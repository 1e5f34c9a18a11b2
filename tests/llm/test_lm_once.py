"""Training reads its texts once, and its fast steps are the plain ones."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from quire.llm import lm_scoring

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_one_reading_gives_counts_and_windows(spark, odd, none, monkeypatch):
    """The same words, and the same windows with what stands before each place, as separate readings of the texts give."""
    for texts in (odd, none):
        counted, coded = lm_scoring.read_once(texts, BPE)
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, lm_scoring.count_words(texts).collect()))
        rows = [sorted(np.hstack(p).tolist() for held in lm_scoring._held(iter(df.toArrow().to_batches()), BPE) for p in zip(*held, strict=True)) for df in (coded, texts.select("text"))]
        assert rows[0] == rows[1] and (len(rows[0]) > 5000) == (texts is odd)


def test_training_reads_the_texts_once(spark, docs, monkeypatch):
    """Neither statistics nor trainers get texts."""
    seen = []
    for name in ("statistics", "fit_together"):
        whole = getattr(lm_scoring, name)
        monkeypatch.setattr(lm_scoring, name, lambda a, b, *c, whole=whole, name=name, **d: seen.append((a if name == "fit_together" else b).columns) or whole(a, b, *c, **d))
    lm_scoring.train(docs.select("doc_id", "text").limit(30), BPE)
    assert seen == [["coded"], ["coded"]]


def test_neighbours_equal_brute_force():
    rng = np.random.default_rng(2)
    ids, context = rng.integers(0, 40, (300, lm_scoring.WINDOW)), np.array([3, 7, 8])
    held = pa.record_batch([pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())] * 2, names=["before", "ids"])
    got = {(i, c): n for b in lm_scoring._neighbours(40, context, "")(iter([held])) for i, c, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)}
    wanted = {}
    for window in ids.tolist():
        for i in window:
            for c, k in enumerate(context.tolist()):
                if k in window:
                    wanted[i, c] = wanted.get((i, c), 0) + 1
    assert got == wanted


def test_fast_steps_are_plain_steps(spark, docs):
    """Loss and gradients with heavy nodes as a matrix equal those of ``step``, turn by turn; so do those of any choice of heavy nodes."""
    texts = docs.select("doc_id", "text").where("doc_id < 40")
    _, stats, net = lm_scoring.train(texts, BPE)
    c = lm_scoring.coded(pa.array([r.text for r in texts.collect()] + ["", None]), lm_scoring.ids_for(BPE))
    end = lm_scoring.ids_for(BPE).end
    x, y = (w[-200:] for w in lm_scoring.whole_windows(c.out, c.ends, end))
    ways = [(stats.tree.turns[a : a + n]) for a, n in zip(stats.tree.start[y.ravel()], stats.tree.size[y.ravel()], strict=True)]
    turns = np.concatenate([np.concatenate(([int(o)], w)) for o, w in zip(stats.tree.opening[y.ravel()], ways, strict=True)])
    size = np.array([1 + len(w) for w in ways])
    which, real = np.repeat(np.arange(y.size), size), lm_scoring.counting(x, y, end)
    assert not real.all()
    loss, wanted = net.step(x, turns, np.cumsum(size) - size, which, stats.odds(x.ravel()[which], turns >> 1), real)
    for heavy in (stats.heavy, np.array([0]), np.array([0, 5, 900])):
        stats.heavy = heavy
        held, at = net.attend(x), np.flatnonzero(real)
        got_loss, d_real, rows = net.turn(lm_scoring.Ways(stats, opened=True), held[-1].reshape(-1, lm_scoring.WIDTH)[at], y.ravel()[at], x.ravel()[at])
        d_h = np.zeros_like(held[-1])
        d_h.reshape(-1, lm_scoring.WIDTH)[at] = d_real
        got = {"n": rows} | net.back(x, held, d_h)
        assert abs(loss - got_loss) < 1e-4 and got.keys() == wanted.keys()
        for name, g in wanted.items():
            a, b = np.zeros((2, *net.w[name].shape))
            if name in "en":
                a[g[0]], b[got[name][0]] = g[1], got[name][1]
            else:
                a, b = g, got[name]
            assert np.allclose(a, b, atol=1e-6)
