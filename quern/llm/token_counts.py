"""Token counts of a BPE with word ends, by rank-synchronous merging of arrays.

The distinct pieces of a batch become ragged arrays of symbols. In each round, every sequence finds its lowest-rank
adjacent pair (one minimum.reduceat over all sequences) and merges all its places, left to right; the sequences that
have no pair left are counted and leave the arrays. A merged symbol only takes part in pairs of higher rank, which is
checked when the vocabulary is read, so this gives the library's result.

Defined results. Null text: as empty, 0 bytes and 0 tokens. Repeated rows: a row each. Empty table: empty result. Other
columns are ignored. Texts are never cut short; the strings of special tokens inside a text count as one token each.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import TAILS, PieceCache, Words, group_sums, text_batches

NONE = np.int32(2**31 - 1)


class PairTable:
    """From pairs of symbols to rank and merged symbol: open addressing over two arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(left), 1) * 4))))
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.rank = np.full(1 << self.bits, NONE)
        self.merged = merged.astype(np.int32)
        todo, step, home = np.arange(len(keys)), 0, self._home(keys)
        while len(todo):
            slot = (home[todo] + step) & ((1 << self.bits) - 1)
            free = self.keys[slot] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.rank[slot[put]] = keys[todo[put]], todo[put]
            todo, step = np.delete(todo, put), step + 1
        self.steps = step

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._home(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rank[slot], NONE)
        todo = np.flatnonzero((held != keys) & (held != np.uint64(2**64 - 1)))
        for step in range(1, self.steps):
            if not len(todo):
                break
            s = (slot[todo] + step) & ((1 << self.bits) - 1)
            held = self.keys[s]
            hit = held == keys[todo]
            out[todo[hit]] = self.rank[s[hit]]
            todo = todo[~hit & (held != np.uint64(2**64 - 1))]
        return out


def surviving(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> np.ndarray:
    """How many symbols each sequence keeps after all merges. symbols: the sequences one after another."""
    out = lengths.astype(np.int64).copy()
    ids = np.flatnonzero(lengths > 1)
    keep = np.repeat(lengths > 1, lengths)
    sym, length = symbols[keep].astype(np.int64), lengths[ids].astype(np.int64)
    rank = np.full(len(sym), NONE)
    if len(sym):
        rank[:-1] = pairs.ranks(sym[:-1], sym[1:])
    while len(ids):
        start = np.cumsum(length) - length
        rank[start + length - 1] = NONE  # no pair reaches over a sequence's end
        best = np.minimum.reduceat(rank, start)
        alive = best != NONE
        out[ids[~alive]] = length[~alive]
        if not alive.all():
            keep = np.repeat(alive, length)
            sym, rank, ids, length, best = sym[keep], rank[keep], ids[alive], length[alive], best[alive]
            if not len(ids):
                break
        at = np.flatnonzero(rank == np.repeat(best, length))
        # a run of neighbouring places is a run of one symbol: every other place of it merges
        run = np.r_[True, np.diff(at) != 1]
        first = at[np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))]
        at = at[(at - first) % 2 == 0]
        sym[at] = pairs.merged[rank[at]]
        gone = np.zeros(len(sym), dtype=bool)
        gone[at + 1] = True
        fresh = np.zeros(len(sym), dtype=bool)
        fresh[at] = True
        lost = np.add.reduceat(gone, np.cumsum(length) - length, dtype=np.int64)
        sym, rank, fresh = sym[~gone], rank[~gone], fresh[~gone]
        length = length - lost
        redo = np.flatnonzero(fresh)
        redo = np.unique(np.concatenate([redo, redo[redo > 0] - 1]))
        redo = redo[redo < len(sym) - 1]
        rank[redo] = pairs.ranks(sym[redo], sym[redo + 1])
        if fresh[-1]:
            rank[-1] = NONE
    return out


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class WordBpe:
    """A vocabulary file of the kind word_bpe_49k.json: NFC, lower case, words with an end mark, byte letters."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        if any(c.isspace() for s in special for c in s):
            raise ValueError("special tokens with white space aren't supported")
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.specials = {*special}
        self.tails = "".join(c for c in TAILS if not any(c in s for s in special))
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int32)
        self.last = np.array([vocab[x + end] for x in letters], dtype=np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[f(m)] for m in merges], dtype=np.int64) for f in (lambda m: m[0], lambda m: m[1], lambda m: m[0] + m[1]))
        rank_of = np.full(max(vocab.values()) + 1, -1)
        rank_of[made] = np.arange(len(made))
        if (rank_of[left] >= np.arange(len(made))).any() or (rank_of[right] >= np.arange(len(made))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        self.pairs = PairTable(left, right, made)
        self.cache = PieceCache(self.count)

    def words(self, piece: str) -> tuple[list[str], int]:
        """The pre-tokens of a piece, and how many special tokens it holds."""
        if self.special and "<" in piece:
            parts = self.special.split(piece)
            found = sum(p in self.specials for p in parts)
            if found:
                return [w for p in parts if p not in self.specials for w in self.words(p)[0]], found
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return self.word.findall(piece.lower()), 0

    def count(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One number for each piece."""
        index: dict[str, int] = {}
        which, sizes, extra = [], [], []
        for p in pieces:
            words, more = self.words(p)
            which += [index.setdefault(w, len(index)) for w in words]
            sizes.append(len(words))
            extra.append(more)
        raw = [w.encode() for w in index]
        length = np.array([len(w) for w in raw], dtype=np.int64)
        text = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.inner[text]
        if len(length):
            ends = np.cumsum(length) - 1
            symbols[ends] = self.last[text[ends]]
        n = surviving(symbols, length, self.pairs)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = group_sums(n[np.array(which, dtype=np.int64)], offsets) + np.array(extra, dtype=np.int64)
        return total, np.ones(len(pieces), dtype=np.int64)


@functools.lru_cache(2)
def _loaded(raw: bytes) -> WordBpe:
    return WordBpe(raw)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. tokenizer: path of the vocabulary file on the driver."""
    with open(tokenizer, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size

    def count(batches):
        bpe = _loaded(shipped.value)
        for b in text_batches(batches, 4096, text=1):
            words = Words(b.column(1), bpe.tails)
            starts, _ = bpe.cache.look_up(words)
            n = group_sums(bpe.cache.pool[starts].astype(np.int64)[words.which], words.offsets)
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        bpe.cache.clear()  # the worker's next task may be of another stage

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents by word_bpe_49k.json."""
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
