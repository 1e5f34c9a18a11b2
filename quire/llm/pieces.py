"""SentencePiece encoding and decoding with N-best segmentations.

A text becomes a lattice of vocabulary pieces.  A forward Viterbi pass gives, for every place, the
exact best score of reaching it; a backward A-star search from the end uses these as heuristics,
so complete segmentations come out in order of score.  Where no piece reaches across (before
spaces, signs after letters, line ends) the lattice falls apart: each stretch between is solved
once and remembered, and a text's N best combine the best of its stretches with the few that cost
least to change.  A vocabulary with other pieces is searched text by text.

A path's score is the sum of its pieces' scores in the model file; a character outside the
vocabulary is spelt as byte pieces for 10 less than the least score of a piece.  Equal
scores prefer the longer last piece.  For a merge-trained model these sums are ranks rather than
log-probabilities, and its library offers no N-best at all; the single best path may then differ
from the merge order's, but decodes to the same text.

Defined results: null text counts as empty, an empty text has no pieces, score 0 and no other
segmentation; a space mark in the text itself decodes as a space and fails the round trip; fewer
than N scores are returned where fewer segmentations exist; repeated rows are coded alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, texts_of, tune

MARK = "▁"
BEST = 4
REMEMBERED = 250_000
UNKNOWN_COST = 10.0
#: Signs that pieces of common vocabularies only have beside other signs or a space mark.
_SIGNS = "!-/:-@\\[-`{-~»’“”…–—²"
#: Stretches of a text, if no piece has a sign after another character, a space mark after anything
#: else, or a line end beside anything.
_STRETCH = re.compile(f"{MARK}*[{_SIGNS}]*[^{MARK}\n{_SIGNS}]+|{MARK}*[{_SIGNS}]+|{MARK}+|\n")
_CROSSING = re.compile(f"[^{MARK}\n{_SIGNS}][{_SIGNS}]|[^{MARK}]{MARK}|\n.|.\n", re.DOTALL)
_WHOLE = re.compile(".+", re.DOTALL)

_NEVER = -1e300

Path = tuple[float, tuple[int, ...]]


class Vocabulary:
    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        #: Piece, or prefix of one -> (id, score); id -1 if it is a prefix only.
        self.table: dict[str, tuple[int, float]] = {}
        self.spelt: dict[int, int] = {}
        self.raw: list[bytes] = [b""] * sp.get_piece_size()
        for k in range(sp.get_piece_size()):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                byte = int(piece[3:-1], 16)
                self.spelt[byte], self.raw[k] = k, bytes([byte])
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                self.table[piece], self.raw[k] = (k, sp.get_score(k)), piece.replace(MARK, " ").encode()
        self.parts = _WHOLE if any(map(_CROSSING.search, self.table)) else _STRETCH
        scores = [s for _, s in self.table.values() if s > -1e8]
        self.unknown = min(scores) - UNKNOWN_COST
        self.unk_id = sp.unk_id()
        self.matches = ahocorasick.Automaton()
        for piece, (k, score) in self.table.items():
            self.matches.add_word(piece, (len(piece), score, k))
        self.matches.make_automaton()
        self.singles = {p for p in self.table if len(p) == 1}
        for piece in list(self.table):
            for n in range(1, len(piece)):
                self.table.setdefault(piece[:n], (-1, 0.0))

    def stretches(self, text: str) -> list[str]:
        """Parts of the marked text that no piece reaches across."""
        return self.parts.findall(MARK + text.replace(" ", MARK)) if text else []

    def spell(self, c: str) -> tuple[int, ...]:
        return tuple(self.spelt.get(b, self.unk_id) for b in c.encode("utf-8", "replace"))

    def lattice(self, s: str) -> tuple[list[tuple[int, int, float, int]], list[float], list[int]]:
        """Edges (from, to, score, id; id -1: spelt), the best score of reaching each place, and the edge it comes by."""
        n, get = len(s), self.table.get
        reach, by, edges = [0.0] + [_NEVER] * n, [-1] * (n + 1), []
        for i in range(n):
            here, single = reach[i], False
            for j in range(i + 1, n + 1):
                found = get(s[i:j])
                if found is None:
                    break
                k, score = found
                if k >= 0:
                    single |= j == i + 1
                    if here + score > reach[j]:
                        reach[j], by[j] = here + score, len(edges)
                    edges.append((i, j, score, k))
            if not single:
                if here + self.unknown > reach[i + 1]:
                    reach[i + 1], by[i + 1] = here + self.unknown, len(edges)
                edges.append((i, i + 1, self.unknown, -1))
        return edges, reach, by

    def ids_of(self, s: str, path: list[tuple[int, int, float, int]]) -> tuple[int, ...]:
        return tuple(itertools.chain.from_iterable((e[3],) if e[3] >= 0 else self.spell(s[e[0]]) for e in path))

    def solve(self, s: str) -> tuple[float, tuple[int, ...], float]:
        """Best score, its ids, and what the second best costs more (infinite if there is none)."""
        n = len(s)
        first, second, by = [0.0] + [_NEVER] * n, [_NEVER] * (n + 1), [(0, 0)] * (n + 1)
        if self.singles.issuperset(s):
            edges = ((end + 1 - size, end + 1, score, k) for end, (size, score, k) in self.matches.iter(s))
        else:
            edges = sorted(self.lattice(s)[0], key=lambda e: (e[1], e[0]))
        # Edges come by their end, the longest first.
        for i, j, score, k in edges:
            now, best = first[i] + score, first[j]
            if now > best:
                first[j], by[j] = now, (i, k)
                second[j] = max(best, second[i] + score)
            elif now > second[j]:
                second[j] = now
        path, at = [], n
        while at:
            i, k = by[at]
            path.append((i, at, 0.0, k))
            at = i
        return first[n], self.ids_of(s, path[::-1]), first[n] - second[n] if second[n] > _NEVER / 2 else float("inf")

    def best(self, s: str, n: int) -> list[Path]:
        """The n best segmentations of a stretch by backward A-star search."""
        edges, reach, _ = self.lattice(s)
        into: list[list[int]] = [[] for _ in range(len(s) + 1)]
        for k, e in enumerate(edges):
            into[e[1]].append(k)
        count = itertools.count()
        heap, out = [(-reach[-1], next(count), len(s), 0.0, ())], []
        while heap and len(out) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                chosen = []
                while path:
                    k, path = path
                    chosen.append(edges[k])
                out.append((behind, self.ids_of(s, chosen)))
                continue
            for k in into[at]:
                i, _, score, _ = edges[k]
                heapq.heappush(heap, (-(reach[i] + score + behind), next(count), i, behind + score, (k, path)))
        return out

    def decode(self, ids) -> str:
        """Text of ids, without the space put before the first word."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class Stretches(dict):
    """Best score, ids and gap to the second best of stretches, solved when first asked for."""

    def __init__(self, vocabulary: Vocabulary, older: dict[str, tuple[float, bytes, float]]):
        self.vocabulary, self.older = vocabulary, older

    def __missing__(self, s: str) -> tuple[float, bytes, float]:
        found = self.older.get(s)
        if found is None:
            score, ids, gap = self.vocabulary.solve(s)
            found = (score, array("I", ids).tobytes(), gap)
        self[s] = found
        return found


class Coder:
    """Encodes texts; remembers the stretches it has solved lately."""

    def __init__(self, vocabulary: Vocabulary, best: int = BEST):
        self.vocabulary, self.best = vocabulary, best
        self.solved = Stretches(vocabulary, {})
        self.ranked: dict[str, list[Path]] = {}

    def alternatives(self, s: str) -> list[Path]:
        if s not in self.ranked:
            if len(self.ranked) > REMEMBERED:
                self.ranked = {}
            self.ranked[s] = self.vocabulary.best(s, self.best)
        return self.ranked[s]

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """Score and ids (little-endian 32-bit numbers) of the N best segmentations, the best first."""
        if len(self.solved) > REMEMBERED:
            self.solved = Stretches(self.vocabulary, dict(self.solved))
        parts = self.vocabulary.stretches(text)
        found = list(map(self.solved.__getitem__, parts))
        own, out = [x[1] for x in found], []
        for score, took in self._combined(parts, found, sum(x[0] for x in found)):
            ids = list(own)
            for k, j in took.items():
                ids[k] = array("I", self.alternatives(parts[k])[j][1]).tobytes()
            out.append((score, b"".join(ids)))
        return out

    def _combined(self, parts, found, total) -> list[tuple[float, dict[int, int]]]:
        """Scores of the N best and which stretch takes which alternative."""
        # A combination among the N best changes only stretches whose own gap is among the N-1 least.
        gaps = np.array([x[2] for x in found])
        cheap = np.argsort(gaps)[: self.best - 1] if len(gaps) <= self.best else np.argpartition(gaps, self.best - 1)[: self.best - 1]
        out: list[tuple[float, dict[int, int]]] = [(total, {})]
        for k in (k for k in cheap.tolist() if gaps[k] != float("inf")):
            ranked = self.alternatives(parts[k])
            top = ranked[0][0]
            out = heapq.nlargest(self.best, ((t + p[0] - top, {**took, k: j} if j else took) for t, took in out for j, p in enumerate(ranked)), key=lambda x: x[0])
        return out

    def nbest(self, text: str) -> list[Path]:
        """The N best segmentations of a whole text: score and ids."""
        return [(score, tuple(array("I", ids))) for score, ids in self.encode(text)]


@functools.lru_cache(maxsize=2)
def coder(path: str, best: int) -> Coder:
    """One coder for each model in a worker process."""
    return Coder(Vocabulary(path), best)


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", best: int = BEST, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, score, scores and nbest_crc32 (of the N best), ids_crc32, round_trip (decoding the best gives the text back).

    ``with_ids`` adds ids (the best, as little-endian 32-bit numbers) and nbest (the ids of each of the N best, the best first).
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it):
        c = coder(model, best)
        for b in batches(it):
            texts = texts_of(b.column("text"))
            coded = [c.encode(t) for t in texts]
            best_ids = [n[0][1] for n in coded]
            back = [c.vocabulary.decode(array("I", ids)) == t for t, ids in zip(texts, best_ids, strict=True)]
            sums = [[zlib.crc32(ids) for _, ids in n] for n in coded]
            columns = {
                "doc_id": b.column("doc_id"),
                "n_tokens": pa.array([len(ids) // 4 for ids in best_ids], pa.int64()),
                "score": pa.array([n[0][0] for n in coded], pa.float64()),
                "scores": pa.array([[s for s, _ in n] for n in coded], pa.list_(pa.float64())),
                "ids_crc32": pa.array([x[0] for x in sums], pa.int64()),
                "nbest_crc32": pa.array(sums, pa.list_(pa.int64())),
                "round_trip": pa.array(back, pa.bool_()),
            }
            if with_ids:
                columns["ids"] = pa.array(best_ids, pa.binary())
                columns["nbest"] = pa.array([[ids for _, ids in n] for n in coded], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, n_tokens long, score double, scores array<double>, ids_crc32 long, nbest_crc32 array<long>, round_trip boolean" + ", ids binary, nbest array<binary>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode_documents(coded: DataFrame, model: str, best: int = BEST) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    tune(coded.sparkSession)
    kind = coded.schema["doc_id"].dataType.simpleString()

    def run(it):
        v = coder(model, best).vocabulary
        for b in batches(it):
            yield pa.record_batch([b.column("doc_id"), pa.array([v.decode(np.frombuffer(x or b"", "<u4")) for x in b.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
