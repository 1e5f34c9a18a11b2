"""Token store, SentencePiece coding, decontamination."""

import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from quire.llm import decontam, pieces, queries, token_store
from quire.llm.subwords import encoder
from tests.llm.conftest import SF

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, most in ((1, 1), (700, 3), (3000, 50257), (2000, 90000)):
        x = (rng.zipf(1.3, n) % most).astype(np.uint32)
        docs, ends, w = token_store.unpack(token_store.pack([-(1 << 63), None], np.array([0, n]), x))
        assert docs == [-(1 << 63), None] and not w.planes.open and ends.tolist() == [0, n] and (w.decode() == x).all()
        assert [w.access(i) for i in range(0, n, 97)] == x[::97].tolist()
        for t in {*x[:3].tolist(), most + 3}:
            at = np.flatnonzero(x == t)
            assert w.count(t) == len(at) and w.count(t, n // 2) == int((x[: n // 2] == t).sum())
            assert [w.find(t, k) for k in range(0, len(at), 31)] == at[::31].tolist()


def test_ids_are_the_librarys():
    library, own = Tokenizer.from_file(BPE), encoder(BPE)
    rng = random.Random(2)
    texts = ["a  b\t\n c's I'll 12½ x—y “q”  z <|endoftext|> hi", "", "  ", "日本 語", "a\x1cb", "ſ İı ŉ", "é̀", "a b", "don't  \n\n", "'S 's"]
    texts += ["".join(rng.choice("abé' .,\n\t1½²ſ—“-_'s’日\x85\xa0") for _ in range(30)) for _ in range(400)]
    texts += [" ".join("".join(rng.choice("abcé12½.,;:!?'’_-\n") for _ in range(rng.randint(1, 5))) for _ in range(8)) for _ in range(600)] + ["a b ", " a b", "a\n b", "a \n", "x.\ny z. 's 'll"]
    assert [list(array("I", x)) for x in own.ids(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for w in ("the", "l'âme", "x,y", "日本", "½", "a_b"):
        assert list(array("I", own.word(w))) == library.encode(f" {w}", add_special_tokens=False).ids


def stored(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_store(token_store.write_store(df, BPE, 2, shard_tokens=500)).collect()), key=repr)


def slow_store(rows):
    library, at, out = Tokenizer.from_file(BPE), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def test_token_store(spark, docs, odd, none, clashing):
    for df in (docs, odd, clashing):
        assert stored(df) == slow_store([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert stored(none) == []
    assert queries.op3_token_store(spark, SF).count() == docs.count()


def every_path(v, s):
    edges, _, _ = v.lattice(s)

    def go(i):
        if i == len(s):
            yield 0.0, ()
        for a, b, score, k in edges:
            if a == i:
                for rest, ids in go(b):
                    yield score + rest, (((k,) if k >= 0 else v.spell(s[i])) + ids)

    return sorted(go(0), reverse=True)


def test_nbest_is_exact():
    v, sp = pieces.Vocabulary(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    c, rng = pieces.Coder(v), random.Random(6)
    for _ in range(120):
        t = "".join(rng.choice("there in\n日𝄞é.,") for _ in range(rng.randint(1, 9)))
        assert v.decode(c.nbest(t)[0][1]) == t
        paths, got = every_path(v, pieces.MARK + t.replace(" ", pieces.MARK)), c.nbest(t)
        assert [s for s, _ in got] == [s for s, _ in paths[: pieces.BEST]]
        assert all(p in paths for p in got)
        assert all(sp.decode(list(ids)) == v.decode(ids) for _, ids in got)


def test_sentencepiece_rows(docs, odd, none, clashing):
    for df in (docs, odd, clashing):
        out = pieces.encode_documents(df, MODEL)
        texts = {repr((r.doc_id, r.text or "")) for r in df.select("doc_id", "text").collect()}
        back = pieces.decode_documents(out, MODEL).collect()
        assert {repr((r.doc_id, r.text)) for r in back} == texts
        got = out.collect()
        assert all(r.round_trip and r.scores == sorted(r.scores, reverse=True) and r.scores[0] == r.score and len(r.ids) == 4 * r.n_tokens for r in got)
        for r in got:
            assert r.nbest[0] == r.ids and len(r.nbest) == len(set(map(bytes, r.nbest))) == len(r.scores)
            assert [zlib.crc32(x) for x in r.nbest] == r.nbest_crc32
    assert pieces.encode_documents(none, MODEL).count() == 0


def slow_nearest(item, words):
    best, col = len(item), list(range(len(item) + 1))
    for w in words:
        new = [0]
        for j, x in enumerate(item):
            new.append(min(col[j + 1] + 1, new[j] + 1, col[j] + (x != w)))
        col = new
        best = min(best, col[-1])
    return best


def test_decontamination_equals_brute_force(spark, docs, odd, none, clashing):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 40)))) for k in range(30)] + [(90, None), (91, " ,; "), (92, "Same, text!"), (92, "Same, text!")]
    made = []
    for k in range(120):
        w = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 80))]
        if k % 2:
            own = (items[k % 30][1]).split()
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = rng.choice("abxyz")
            w[rng.randint(0, len(w)) : 0] = own
        made.append((k, " ".join(w)))
    df, bench = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    known = {i: decontam.words_of(t) for i, t in items if t and decontam.words_of(t)}
    wanted = {d: sorted((i, slow_nearest(w, decontam.words_of(t))) for i, w in known.items() if slow_nearest(w, decontam.words_of(t)) <= decontam.budget_of(len(w))) for d, t in made}
    for most in (decontam.BLOCK_WORDS, 100):
        got = {r.doc_id: [(h.item_id, h.edits) for h in r.hits] for r in decontam.find_contamination(df, bench, most=most).collect()}
        assert got == wanted
    assert {r.doc_id for r in decontam.clean_documents(df, bench, most=100).collect()} == {d for d, h in wanted.items() if not h}
    kept = decontam.clean_documents(clashing, bench)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {1, 2, 5, None, 7, 8}
    assert decontam.find_contamination(none, bench).count() == 0
    assert all(not r.hits for r in decontam.find_contamination(odd, bench.where("false")).collect())


def test_planted_items_are_found(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [decontam.words_of(r.text) for r in bench.collect()]
    holds = {r.doc_id for r in docs.collect() if any(f" {' '.join(w)} " in f" {' '.join(decontam.words_of(r.text))} " for w in texts)}
    found = {r.doc_id for r in queries.op7_decontamination(spark, SF).collect() if r.contaminated}
    assert holds and holds <= found
