"""Every subword of every training text is trained on."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from quire.llm import lm_scoring

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_windows_hold_every_id_once(spark, odd):
    """By default no text and no place of one is left out; what stands in front of a text does not count."""
    ids, texts = lm_scoring.ids_for(BPE), [r.text for r in odd.collect()]
    c = lm_scoring.coded(pa.array(texts), ids)
    before, own = lm_scoring.whole_windows(c.out, c.ends, ids.end)
    real = lm_scoring.counting(before, own, ids.end)
    assert (own.ravel()[real] == c.out).all() and (before.ravel()[real] == lm_scoring.inputs(c.out, c.ends, ids.end)).all()
    rows = lm_scoring.windows_of(odd, BPE).collect()
    x, y = (np.frombuffer(b"".join(bytes(r[k]) for r in rows), "<u4").reshape(-1, lm_scoring.WINDOW).astype(np.int64) for k in ("before", "ids"))
    held = y.ravel()[lm_scoring.counting(x, y, ids.end)]
    assert np.bincount(held).tolist() == np.bincount(c.out).tolist()
    assert len({r.row for r in rows}) == len(rows)


def test_training_counts_every_window(spark, docs, monkeypatch):
    """The trainers together meet each real place of all windows, whether these are cut on the way or lie in a table."""
    texts = docs.select("doc_id", "text").limit(40)
    windows = lm_scoring.windows_of(texts, BPE)
    stats, vectors = lm_scoring.statistics(lm_scoring.count_words(texts), texts.select("text"), BPE)
    start = lm_scoring.Network(vectors, stats.tree.nodes)
    held = list(lm_scoring._held(iter(texts.select("text").toArrow().to_batches()), BPE))
    x, y = (np.concatenate(p) for p in zip(*held, strict=True))
    assert len(y) == windows.count()
    net = lm_scoring.Network.copy(start)
    _, met, n = net.fit_all(stats, held)
    assert n == len(y) and set(np.flatnonzero(met["e"])) == set(np.unique(x).tolist())
    one = lm_scoring.fit_together(texts.select("text").coalesce(1), stats, start, tokenizer=BPE)
    assert all(np.allclose(one.w[k], net.w[k], atol=1e-3) for k in net.w)
