"""Byte-level BPE encoding and decoding with two tiers of lookup.

A minimal perfect hash over the vocabulary resolves whole pre-tokens that are tokens themselves (buckets of keys are
displaced until every key has its own slot; the slot's key is then compared, so strangers never pass). The others are
merged from their bytes: a doubly linked list of spans and a heap of (rank, place) for the adjacent pairs. Decoding
gathers the tokens' bytes from one pool.

Defined results. Null text: as empty; no ids, empty bytes. Repeated rows: a row each. Empty table: empty result. Other
columns of the input are ignored. Decoded bytes of an id outside the vocabulary: an error, as in the library.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import PieceCache, Words, spans, text_batches


class PerfectHash:
    """Slots 0..n-1 for n distinct byte strings."""

    def __init__(self, keys: list[bytes]):
        self.n, self.r = len(keys), max(1, len(keys) // 4)
        bucket, mixed = self._parts(keys)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.r)
        start = np.cumsum(size) - size
        taken = np.zeros(self.n, dtype=bool)
        self.shift = np.zeros(self.r, dtype=np.int64)  # below 0: the slot itself, of a bucket with one key
        self.slot_key: list[bytes] = [b""] * self.n
        for k in np.argsort(-size, kind="stable").tolist():
            own = order[start[k] : start[k] + size[k]]
            if size[k] < 2:
                break
            for low in range(0, 1 << 22, 64):
                at = self._slot(mixed[own, None], np.arange(low, low + 64))
                ok = ~taken[at].any(axis=0)
                for t in np.flatnonzero(ok).tolist():
                    if len({*at[:, t].tolist()}) == len(own):
                        break
                else:
                    continue
                break
            else:
                raise ValueError("no displacement found")
            self.shift[k] = low + t
            taken[at[:, t]] = True
            for i, s in zip(own.tolist(), at[:, t].tolist()):
                self.slot_key[s] = keys[i]
        free = np.flatnonzero(~taken).tolist()
        for k, s in zip(np.flatnonzero(size == 1).tolist(), free):
            self.shift[k] = -s - 1
            self.slot_key[s] = keys[order[start[k]]]

    def _parts(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))
        return (h % np.uint64(self.r)).astype(np.int64), (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)

    def _slot(self, mixed: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = mixed * (2 * d + 1).astype(np.uint64)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot of each key, -1 for strings that aren't among the n."""
        bucket, mixed = self._parts(keys)
        d = self.shift[bucket]
        at = np.where(d < 0, -d - 1, self._slot(mixed, d))
        held = self.slot_key
        same = np.fromiter((held[s] == k for s, k in zip(at.tolist(), keys)), dtype=bool, count=len(keys))
        return np.where(same, at, -1)


def merge_bytes(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of one pre-token, by a heap of the adjacent pairs over linked spans."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # spans begin at i and end where the next begins
    get, heap = ranks.get, []
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if j < 0 or j >= n or after[j] != end:  # one of the two spans has changed since
            continue
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            stop = after[end]
            if stop - i <= longest:
                r = get(piece[i:stop])
                if r is not None:
                    heapq.heappush(heap, (r, i, stop))
        p = before[i]
        if p >= 0 and end - p <= longest:
            r = get(piece[p:end])
            if r is not None:
                heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class ByteBpe:
    """A rank file (base64 token, rank) and the pattern that cuts texts into pre-tokens.

    Texts are cut into pieces before the pattern sees them only if it is one of SAFE, which always begin a new match there.
    """

    def __init__(self, raw: bytes, pattern: str):
        self.whole = pattern not in SAFE
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines()) if t}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, self.ranks))
        self.hash = PerfectHash(list(self.ranks))
        self.slot_id = np.array([self.ranks[k] for k in self.hash.slot_key], dtype=np.int32)
        top = max(self.ranks.values()) + 1
        by_id = [b""] * top
        for t, r in self.ranks.items():
            by_id[r] = t
        self.byte_len = np.array([len(t) for t in by_id], dtype=np.int64)
        self.byte_start = np.cumsum(self.byte_len) - self.byte_len
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)
        self.cache = PieceCache(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        index: dict[str, int] = {}
        which, sizes = [], []
        for p in pieces:
            found = self.pattern.findall(p)
            which += [index.setdefault(w, len(index)) for w in found]
            sizes.append(len(found))
        tokens = [w.encode("utf-8", "surrogatepass") for w in index]
        slot = self.hash.slots(tokens)
        length = np.ones(len(tokens), dtype=np.int64)
        miss = np.flatnonzero(slot < 0).tolist()
        merged = [merge_bytes(tokens[i], self.ranks, self.longest) for i in miss]
        length[miss] = [len(m) for m in merged]
        start = np.cumsum(length) - length
        pool = np.empty(int(length.sum()), dtype=np.int32)
        hit = slot >= 0
        pool[start[hit]] = self.slot_id[slot[hit]]
        if miss:
            pool[spans(start[miss], length[miss])] = np.concatenate([np.array(m, dtype=np.int32) for m in merged])
        w = np.array(which, dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(length[w])])[offsets]
        return pool[spans(start[w], length[w])], np.diff(total)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and each text's bounds in them."""
        words = Words(texts, whole=self.whole)
        starts, lengths = self.cache.look_up(words)
        n = lengths[words.which]
        total = np.concatenate([[0], np.cumsum(n)])[words.offsets]
        return self.cache.pool[spans(starts[words.which], n)], total

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids and each text's bounds in them."""
        n = self.byte_len[ids]
        if len(ids) and not n.all():
            raise KeyError("an id outside the vocabulary")
        total = np.concatenate([[0], np.cumsum(n)])[bounds]
        return self.bytes[spans(self.byte_start[ids], n)], total


# Patterns of byte-level tokenizers, as published, that never match across shared.Words' cuts.
SAFE = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}


@functools.lru_cache(2)
def _loaded(raw: bytes, pattern: str) -> ByteBpe:
    return ByteBpe(raw, pattern)


def _shipped(docs: DataFrame, ranks: str):
    with open(ranks, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size


def encode_texts(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (array<int>) of every row. ranks: path of the rank file on the driver."""
    raw = _shipped(docs, ranks)

    def run(batches):
        bpe = _loaded(raw.value, pattern)
        for b in text_batches(batches, 1024, text=1, most=2 << 20):
            ids, bounds = bpe.encode(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))], ["doc_id", "n_tokens", "ids"])
        bpe.cache.clear()  # the worker's next task may be of another stage

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and decoded (binary) of every row; null ids count as none."""
    raw = _shipped(encoded, ranks)

    def run(batches):
        bpe = _loaded(raw.value, pattern)
        for b in text_batches(batches):
            lists = b.column(1)
            n = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], dtype=np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            out, bounds = bpe.decode(ids, np.concatenate([[0], np.cumsum(n)]))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, _binary(out, bounds)], ["doc_id", "ids", "decoded"])

    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of every text's ids and of the bytes that they decode to; columns to keep.

    Both ways in one pass over a batch, so that ids and bytes don't travel between worker processes.
    """
    raw = _shipped(docs, ranks)

    def run(batches):
        bpe = _loaded(raw.value, pattern)
        for b in text_batches(batches, 1024, text=1, most=2 << 20):
            ids, bounds = bpe.encode(b.column(1))
            out, ends = bpe.decode(ids, bounds)
            wide = ids.astype("<u4")
            one = [hashlib.sha256(wide[i:j]).hexdigest() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            two = [hashlib.sha256(out[i:j]).hexdigest() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(bounds)), pa.array(one, pa.string()), pa.array(two, pa.string()), *b.columns[2:]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *keep])
        bpe.cache.clear()  # the worker's next task may be of another stage

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col), *keep)
    kept = "".join(f", `{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + kept)


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents, encoded by byte_bpe_multi_50k.tiktoken and decoded again."""
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
