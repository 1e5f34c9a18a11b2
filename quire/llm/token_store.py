"""Token ids of a corpus in binary shards, each a wavelet matrix in one compressed file.

A shard holds the ids of consecutive documents.  Its ids are kept as bit planes, highest bit
first, each plane's elements ordered by the planes above (zeros before ones, stably); with counts
of ones every 512 bits, a token can be read, counted and found without expanding the shard.

File: magic, then a compressed header (ids, bits, documents, plane sizes and zero counts,
document ids and ends) and one zstd frame a plane, so a lookup opens only what it reads.  Spark
writes the files (one row each, as a binary column), so a lost executor leaves no half file.

Defined results: null text counts as empty and an empty text is its end id alone; ids are 64-bit
numbers, those of other types are cast and null where that fails; rows with a null id come first;
repeated rows are all written, rows of one id in the order of their texts; an empty table gives a
store without shards; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, materialize, texts_of, tune
from quire.llm.subwords import encoder

MAGIC = b"QWMX0002"
SHARD_TOKENS = 1 << 18
BLOCK = 512  # bits between stored ranks


class WaveletMatrix:
    """planes[l]: bits of level l packed in bytes; zeros[l]: how many are zero."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._ranks: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << b)) != 0
            planes.append(np.packbits(one))
            low = now.compress(~one)
            zeros.append(len(low))
            now = np.concatenate((low, now.compress(one)))
        return cls(len(ids), planes, zeros)

    def ranks(self, level: int) -> np.ndarray:
        """Ones before each block of a plane."""
        if level not in self._ranks:
            ones = np.bitwise_count(self.planes[level]).astype(np.int64)
            per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
            self._ranks[level] = np.concatenate(([0], np.cumsum(per)))
        return self._ranks[level]

    def bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8 : i >> 3]
        rest = int(self.planes[level][i >> 3]) >> (8 - (i & 7)) if i & 7 else 0
        return int(self.ranks(level)[block]) + int(np.bitwise_count(part).sum()) + rest.bit_count()

    def select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        ranks = self.ranks(level) if bit else np.minimum(np.arange(len(self.ranks(level))) * BLOCK, self.n) - self.ranks(level)
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        flags = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8])[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(flags == bit)[k - int(ranks[block])])

    def access(self, i: int) -> int:
        value = 0
        for level, z in enumerate(self.zeros):
            one = self.bit(level, i)
            value = value << 1 | one
            before = self.rank1(level, i)
            i = z + before if one else i - before
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's copies among the first i elements stand at the bottom."""
        lo, hi, bits = 0, i, len(self.zeros)
        if token < 0 or token >> bits:
            return 0, 0
        for level, z in enumerate(self.zeros):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (z + a, z + b) if token >> (bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, upto: int | None = None) -> int:
        lo, hi = self._range(token, self.n if upto is None else upto)
        return hi - lo

    def find(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of the token."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError("no such occurrence")
        at, bits = lo + k, len(self.zeros)
        for level in range(bits - 1, -1, -1):
            one = token >> (bits - 1 - level) & 1
            at = self.select(level, one, at - self.zeros[level] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, by undoing the levels from the last."""
        bits = len(self.zeros)
        now = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            before = np.empty_like(now)
            now[self.zeros[level] :] |= now.dtype.type(1 << (bits - 1 - level))
            before[np.concatenate((np.flatnonzero(~one), np.flatnonzero(one)))] = now
            now = before
        return now.astype(np.uint32)


def pack(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    w, z = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1)
    frames = [z.compress(p.tobytes()) for p in w.planes]
    named, absent = np.array([x or 0 for x in doc_ids], "<i8"), np.packbits([x is None for x in doc_ids])
    head = z.compress(struct.pack("<QIQ", w.n, len(frames), len(named)) + np.array([len(f) for f in frames] + w.zeros, "<u8").tobytes() + named.tobytes() + np.asarray(ends, "<u8").tobytes() + absent.tobytes())
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *frames])


class Planes(Sequence):
    """The planes of a shard, each opened when it is first read."""

    def __init__(self, blob: bytes, at: int, sizes: list[int]):
        self.blob, self.ends, self.sizes = blob, (at + np.cumsum(sizes)).tolist(), sizes
        self.open: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, level: int) -> np.ndarray:
        if level not in self.open:
            end = self.ends[level]
            self.open[level] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.blob[end - self.sizes[level] : end]), np.uint8)
        return self.open[level]


def unpack(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    if blob[:8] != MAGIC:
        raise ValueError("not a token shard")
    (size,) = struct.unpack_from("<I", blob, 8)
    z = zstandard.ZstdDecompressor()
    head = z.decompress(blob[12 : 12 + size])
    n, bits, docs = struct.unpack_from("<QIQ", head)
    body = np.frombuffer(head, "<u8", count=2 * (bits + docs), offset=20)
    absent = np.unpackbits(np.frombuffer(head, np.uint8, offset=20 + body.nbytes), count=docs).view(bool)
    sizes, zeros = body[:bits].tolist(), body[bits : 2 * bits].tolist()
    named = body[2 * bits : 2 * bits + docs].view("<i8").astype(object)
    named[absent] = None
    return named.tolist(), body[2 * bits + docs :], WaveletMatrix(n, Planes(blob, 12 + size, sizes), zeros)


def _writer(tokenizer: str, end_id: int, most: int):
    end = int(end_id).to_bytes(4, "little")

    def run(it):
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids, docs, sizes, held, before = [], [], [], 0, 0

        def shard():
            data = np.frombuffer(b"".join(ids), "<u4")
            blob = pack(docs, np.cumsum(sizes), data)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([blob], pa.binary())], names=["part", "before", "n_docs", "n_tokens", "blob"])

        for b in batches(it):
            for doc, own in zip(b.column("doc_id").to_pylist(), enc.ids(texts_of(b.column("text"))), strict=True):
                ids.append(own + end)
                docs.append(doc)
                sizes.append(len(own) // 4 + 1)
                held += sizes[-1]
                if held >= most:
                    yield shard()
                    before += held
                    ids, docs, sizes, held = [], [], [], 0
        if docs:
            yield shard()

    return run


def write_store(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards in id order; the table of them: part, before (ids earlier in the part), n_docs, n_tokens, blob."""
    tune(docs.sparkSession)
    rows = docs.select(F.expr(f"try_cast(`{id_col}` AS BIGINT)").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(_writer(tokenizer, end_id, shard_tokens), "part int, before long, n_docs long, n_tokens long, blob binary"), "tokens")


def _read(it):
    encoder.cache_clear()  # a worker that wrote shards before needs its pre-tokens no more
    for b in batches(it):
        for start, blob in zip(b.column("start").to_pylist(), b.column("blob").to_pylist(), strict=True):
            docs, ends, w = unpack(blob)
            raw = memoryview(w.decode().astype("<u4").tobytes())
            first = np.concatenate(([0], ends[:-1])).astype(np.int64).tolist()
            crcs = [zlib.crc32(raw[4 * a : 4 * e]) for a, e in zip(first, ends.tolist(), strict=True)]
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array([start + a for a in first], pa.int64()), pa.array([e - a for a, e in zip(first, ends.tolist(), strict=True)], pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_store(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the shards alone."""
    # One row a task of the writing job, so the driver and the broadcast hold no more than that.
    totals = store.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts, at = [], 0
    for r in totals:
        starts.append((r.part, at))
        at += r.n
    offsets = store.sparkSession.createDataFrame(starts, "part int, offset long")
    placed = store.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("before")).alias("start"), "blob")
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
