"""Token ids in files, compressed by Re-Pair grammars.

Documents are encoded by the tokenizers library, each ends with an end id, and they are dealt to range buckets in ascending
id order. A bucket's ids are cut into shards of some SHARD_IDS ids, never inside a document. Per shard, the most frequent
pairs of neighbouring ids become nonterminals, round after round, until no pair occurs MIN_COUNT times; in one round all
chosen pairs are replaced together, chosen by count so that no two of them can overlap. A pair never spans two documents.
Files and their rows follow the ids' order.

File format: Parquet; a row is a shard, with columns bucket, seq (its place in the bucket), n_ids, base (first nonterminal),
doc_ids, doc_starts (in ids, within the shard), rules (pairs of symbols as little-endian u4; rule i is symbol base + i),
lengths (expanded length of each rule, u4) and symbols (the remaining sequence, u2 or u4 by `wide`). From the lengths, the
ids at any place are found without expanding what stands before (ids_between).

Defined results. Null and empty texts: the end id only. Repeated ids: each row is a document, in any order among
themselves; null ids come first. Empty table: files without rows, an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import TAILS, PieceCache, Words, bucket_of, in_order, partitions, range_bounds, shared_path, spans, text_batches

SHARD_IDS = 1 << 20
MIN_COUNT = 6
#: Pieces that a worker keeps while it encodes, about; it drops them before it makes grammars.
PIECES = 1_800_000
#: More marks that are cut off the end of a piece, where the library's pattern is known.
MORE_TAILS = "*#%$&"
#: Buckets at most; they bound the driver's sample, and the tasks that write.
MOST_BUCKETS = 16_384

SHARD = "bucket int, seq int, n_ids long, base int, doc_ids array<long>, doc_starts array<long>, rules binary, lengths binary, wide boolean, symbols binary"


# --- grammar ---------------------------------------------------------------------------------------------------------


def _grouped(at: np.ndarray, seq: np.ndarray, after: np.ndarray, symbols: int) -> tuple[np.ndarray, ...]:
    """The frequent pairs that begin at places: their places, ascending, the pair's number at each of them, and the pairs' left and
    right symbols and counts."""
    bits, wide = symbols.bit_length(), len(seq).bit_length()
    pair = seq.take(at).astype(np.int64)
    pair <<= bits
    pair |= seq.take(after.take(at))
    if 2 * bits + wide <= 63:  # pair and place in one number, so that sorting moves nothing else
        pair <<= wide
        pair |= at
        pair.sort()
        at = pair & ((1 << wide) - 1)
        pair >>= wide
    else:
        order = np.lexsort((at, pair))
        at, pair = at[order], pair[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(at) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.r_[first, len(at)])
    good = n >= MIN_COUNT
    kind = pair[first[good]]
    at, own = at[np.repeat(good, n)], np.repeat(np.arange(len(kind)), n[good])
    if 16 * len(at) > len(seq):
        there = np.full(len(seq), -1)
        there[at] = own
        at = np.flatnonzero(there >= 0)
        own = there.take(at)
    else:
        order = np.argsort(at)
        at, own = at[order], own[order]
    return at, own, kind >> bits, kind & ((1 << bits) - 1), n[good]


def _apart(left: np.ndarray, right: np.ndarray, symbols: int) -> np.ndarray:
    """The numbers of pairs, best first, of which no two can overlap: each one that no better one taken before overlaps.

    Pairs that overlap no better one that is still open are taken together, until none is open.
    """
    n = len(left)
    taken, todo = np.zeros(n, dtype=bool), np.arange(n)
    best_left, best_right = np.full(symbols, n), np.full(symbols, n)
    is_left, is_right = np.zeros(symbols, dtype=bool), np.zeros(symbols, dtype=bool)
    while len(todo):
        a, b = left[todo], right[todo]
        best_left[a[::-1]] = best_right[b[::-1]] = todo[::-1]  # of several, the last one written stays: the best
        win = (todo <= best_right[a]) & (todo <= best_left[b])
        best_left[a] = best_right[b] = n
        taken[todo[win]] = is_left[a[win]] = is_right[b[win]] = True
        todo = todo[~(win | is_right[a] | is_left[b])]
    return np.flatnonzero(taken)


def compress(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rules (n, 2), their expanded lengths and the remaining symbols. starts: where documents begin, ascending.

    Symbols stay at their places and know their neighbours' places within their document. A new pair always holds a new
    symbol, so that a pair's count only falls: the places of pairs that aren't frequent are let go, and a round looks at
    places of frequent pairs and at what it has replaced. It ends when no pair has MIN_COUNT places in documents.
    """
    none = len(ids)  # the place before a document's first symbol and after its last
    kind = np.int32 if none < 1 << 30 else np.int64  # short numbers: places are looked up in no order
    seq, after, before = np.append(ids, 0).astype(kind), np.arange(1, none + 2, dtype=kind), np.arange(-1, none, dtype=kind)
    if none:
        after[np.r_[starts[1:], none] - 1] = before[starts] = none
    alive = np.ones(none, dtype=bool)
    rules, lengths, size = [], [], np.ones(base, dtype=np.int64)
    at, own, left, right, count = _grouped(np.flatnonzero(after[:none] != none), seq, after, base)
    while len(count):
        order = np.lexsort((right, left, -count))
        chosen = order[_apart(left[order], right[order], len(size))]
        rule = np.full(len(count), -1)
        rule[chosen] = np.arange(len(chosen))
        mine = rule.take(own)
        hit = np.flatnonzero(mine >= 0)
        place, mine = at.take(hit), mine.take(hit)
        on = np.flatnonzero((place[1:] == after.take(place[:-1])) & (mine[1:] == mine[:-1])) + 1
        if len(on):  # only a pair of one symbol twice overlaps itself: every other place of a run
            k = np.arange(len(place))
            first = k.copy()
            first[on] = 0
            odd = (k - np.maximum.accumulate(first)) % 2 == 0
            place, mine = place[odd], mine[odd]
        gone = after.take(place).astype(np.int64)
        seq[place] = len(size) + mine
        after[place] = after.take(gone)
        before[after.take(place)] = place
        alive[gone] = False
        new = np.zeros(none + 1, dtype=bool)
        new[place] = new[none] = True
        prior = before.take(place).astype(np.int64)
        near = np.concatenate([place, prior[~new.take(prior)]])
        new[near] = new[gone] = True
        pair = np.stack([left[chosen], right[chosen]], axis=1)
        rules.append(pair)
        lengths.append(size[pair].sum(axis=1))
        size = np.concatenate([size, lengths[-1]])
        keep = np.flatnonzero(~new.take(at))
        at, own = at.take(keep), own.take(keep)
        count = np.bincount(own, minlength=len(count))
        good = count >= MIN_COUNT
        keep = np.flatnonzero(good.take(own))
        at, own = at.take(keep), (np.cumsum(good) - 1).take(own.take(keep))
        more = _grouped(near[after.take(near) != none], seq, after, len(size))
        at, own = np.concatenate([at, more[0]]), np.concatenate([own, more[1] + int(good.sum())])
        left, right, count = (np.concatenate([x[good], y]) for x, y in zip((left, right, count), more[2:]))
    empty = np.zeros((0, 2), dtype=np.int64)
    return np.concatenate([empty, *rules]), np.concatenate([empty[:, 0], *lengths]), seq[:none][alive].astype(np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for. Rules are expanded once, those of other rules' symbols first."""
    symbols = symbols.astype(np.int64)
    n = len(rules)
    if not n:
        return symbols
    inner = rules >= base
    depth = np.zeros(n, dtype=np.int64)
    while True:
        new = np.where(inner, depth[np.where(inner, rules - base, 0)] + 1, 0).max(axis=1)
        if (new == depth).all():
            break
        depth = new
    start = np.cumsum(lengths) - lengths
    pool = np.empty(int(lengths.sum()), dtype=np.int64)
    for d in range(int(depth.max()) + 1):
        for side in (0, 1):
            at = np.flatnonzero(depth == d)
            part, deep = rules[at, side], inner[at, side]
            size = np.where(deep, lengths[np.where(deep, part - base, 0)], 1)
            to = start[at] + (lengths[at] - size if side else 0)
            pool[to[~deep]] = part[~deep]
            pool[spans(to[deep], size[deep])] = pool[spans(start[part[deep] - base], size[deep])]
    deep = np.flatnonzero(symbols >= base)
    which = symbols[deep] - base
    size, source = np.ones(len(symbols), dtype=np.int64), np.arange(len(pool), len(pool) + len(symbols))
    size[deep], source[deep] = lengths[which], start[which]
    ends = np.cumsum(size)
    place = np.repeat(source - ends + size, size)
    place += np.arange(len(place))
    return np.concatenate([pool, symbols]).take(place)


def ids_between(shard: dict, start: int, stop: int) -> np.ndarray:
    """The ids start .. stop - 1 of a shard (a dict of its columns), expanding only the symbols over them."""
    base, rules, lengths, symbols = _arrays(shard)
    n = np.where(symbols >= base, np.concatenate([lengths, [1]])[np.maximum(symbols - base, -1)], 1)
    ends = np.cumsum(n)
    i, j = np.searchsorted(ends, [start, stop - 1], side="right")
    skip = start - int(ends[i] - n[i])
    return expand(symbols[i : j + 1], rules, base, lengths)[skip : skip + stop - start]


def _arrays(shard: dict) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    rules = np.frombuffer(shard["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
    return shard["base"], rules, np.frombuffer(shard["lengths"], dtype="<u4").astype(np.int64), np.frombuffer(shard["symbols"], dtype="<u4" if shard["wide"] else "<u2").astype(np.int64)


# --- writing ---------------------------------------------------------------------------------------------------------


def _byte_widths(spec: dict, size: int) -> np.ndarray | None:
    """The bytes that each id stands for, if the vocabulary file is a byte-level one whose pattern begins a match at a space before
    a letter, without other steps; else None."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    odd = spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
    if odd or model.get("type") != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return None
    out = np.zeros(size, dtype=np.int64)
    for token, i in model["vocab"].items():
        out[i] = len(token)  # a character stands for each byte
    return out


class Library:
    """A vocabulary file under the tokenizers library; distinct pieces of a batch are encoded once."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.cache = PieceCache(self.encode_pieces, PIECES)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for t in added.values()]
        self.widths = _byte_widths(json.loads(raw), self.size)
        self.tails = "".join(c for c in TAILS + (MORE_TAILS if self.widths is not None else "") if not any(c in t for t in self.specials))
        plain = [(i, t) for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark_id, self.mark = (plain[0][0], plain[0][1].content) if plain else (-1, "")

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces and their numbers. Pieces go to the library in groups: one call and one result for many of them.

        Those that begin with a space and a letter or digit are put together as they are, and told apart by their bytes; others
        are joined by a special token, or go alone if they hold one.
        """
        everything = "".join(pieces)
        there = [t for t in self.specials if t in everything]
        alone = {i for i, p in enumerate(pieces) if not self.mark or any(t in p for t in there)} if there or not self.mark else set()
        led = [i for i, p in enumerate(pieces) if p[:1] == " " and p[1:2].isalnum() and i not in alone] if self.widths is not None else []
        values, lengths, done = [], np.zeros(len(pieces), dtype=np.int64), np.zeros(0, dtype=np.int64)
        for k in range(0, len(led), 16384):  # some groups a call: the library's results take far more memory than the ids
            some = led[k : k + 16384]
            texts = [pieces[i] for i in some]
            ids = self._ids("".join(texts[j : j + 64]) for j in range(0, len(texts), 64))
            ends, bounds = np.cumsum(self.widths[ids]), np.cumsum(np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts)))
            last = np.searchsorted(ends, bounds)
            if len(ends) and ends[-1] == bounds[-1] and (ends[last] == bounds).all():
                lengths[some] = np.diff(last, prepend=-1)
                values.append(ids)
                done = np.concatenate([done, some])
        left = np.ones(len(pieces), dtype=bool)
        left[done] = left[np.array(sorted(alone), dtype=np.int64)] = False
        rest = np.flatnonzero(left).tolist()
        for k in range(0, len(rest), 16384):
            some = rest[k : k + 16384]
            ids = self._ids(self.mark.join([pieces[i] for i in some[j : j + 64]]) + self.mark for j in range(0, len(some), 64))
            lengths[some] = np.diff(np.flatnonzero(ids == self.mark_id), prepend=-1) - 1
            values.append(ids[ids != self.mark_id])
        for i in sorted(alone):
            ids = self._ids([pieces[i]])
            lengths[i] = len(ids)
            values.append(ids)
        order = np.array([*done, *rest, *sorted(alone)], dtype=np.int64)
        flat, start = np.concatenate([np.zeros(0, np.int32), *values]), np.zeros(len(pieces), dtype=np.int64)
        start[order] = np.cumsum(lengths[order]) - lengths[order]
        return flat[spans(start, lengths)], lengths

    def _ids(self, texts) -> np.ndarray:
        """The library's ids of texts, one after the other."""
        out = array("i")
        for e in self.tokenizer.encode_batch_fast([*texts], add_special_tokens=False):
            out.fromlist(e.ids)
        return np.array(out, dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts, self.tails, lines=self.widths is not None)
        starts, lengths = self.cache.look_up(words)
        n = lengths[words.which]
        return self.cache.pool[spans(starts[words.which], n)], np.concatenate([[0], np.cumsum(n)])[words.offsets]


@functools.lru_cache(2)
def _loaded(raw: bytes) -> Library:
    return Library(raw)


def _encoded(batches, raw: bytes, end: int):
    library = _loaded(raw)
    kind = "<u2" if library.size <= 65536 else "<u4"
    for b in text_batches(batches, 4096, text=3):
        ids, bounds = library.encode(b.column(3))
        ids = ids.astype(kind)
        tail = np.array([end], dtype=kind).tobytes()
        blobs = [ids[i:j].tobytes() + tail for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blobs, pa.binary())], ["bucket", "doc_id", "ord", "ids"])


def _shards(batches, base: int):
    """Rows bucket, doc_id, ids in order; a row for each shard."""
    kind = "<u2" if base <= 65536 else "<u4"
    bucket, seq, held, size = None, 0, [], 0
    _loaded.cache_clear()  # a worker that has encoded before needs the memory of its pieces now

    def done():
        ids = np.frombuffer(b"".join(x for _, x in held), dtype=kind)
        n = np.array([len(x) for _, x in held], dtype=np.int64) // np.dtype(kind).itemsize
        starts = np.cumsum(n) - n
        rules, lengths, symbols = compress(ids, starts, base)
        wide = base + len(rules) > 65536
        row = [bucket, seq, len(ids), base, [d for d, _ in held], starts.tolist(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), wide, symbols.astype("<u4" if wide else "<u2").tobytes()]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.bool_(), pa.binary()]
        names = [x.split()[0] for x in SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    for b in batches:
        for bk, doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if held and (bk != bucket or size >= SHARD_IDS):
                yield done()
                held, size, seq = [], 0, seq + 1 if bk == bucket else 0
            elif bk != bucket:
                seq = 0
            bucket = bk
            held.append((doc, ids))
            size += len(ids) // np.dtype(kind).itemsize
    if held:
        yield done()


def token_shards(docs: DataFrame, tokenizer: str, end: int = 0, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 4000) -> DataFrame:
    """The shards of all documents, in SHARD's columns. tokenizer: path of the vocabulary file on the driver."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size
    base = Library(raw.value).size
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    n = ids.count()
    bounds = range_bounds(ids, "doc_id", max(1, min(MOST_BUCKETS, max(partitions(spark), n // per_bucket))), n)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("ord"), F.col(text_col).alias("text"))
    rows = rows.select(bucket_of(F.col("doc_id"), bounds, F.col("ord")).alias("bucket"), "doc_id", "ord", "text")
    encoded = rows.mapInArrow(lambda it: _encoded(it, raw.value, end), "bucket int, doc_id long, ord long, ids binary")
    dealt = in_order(encoded, "bucket", len(bounds) + 1).sortWithinPartitions("bucket", "doc_id", "ord")
    return dealt.select("bucket", "doc_id", "ids").mapInArrow(lambda it: _shards(it, base), SHARD)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = 0, **how) -> None:
    token_shards(docs, tokenizer, end, **how).write.parquet(path)


# --- reading ---------------------------------------------------------------------------------------------------------


def read_tokens(spark, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids of every document."""
    shards = spark.read.schema(SHARD).parquet(path)
    # the ids before each shard: buckets (MOST_BUCKETS at most) are summed up in one small window, shards within their bucket
    sizes = shards.select("bucket", "seq", "n_ids")
    per = sizes.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    per = per.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("low"))
    before = sizes.withColumn("own", F.sum("n_ids").over(Window.partitionBy("bucket").orderBy("seq")) - F.col("n_ids")).join(per, "bucket").select("bucket", "seq", (F.col("low") + F.col("own")).alias("before"))
    names = ["bucket", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]

    def run(batches):
        for b in batches:
            for shard in b.to_pylist():
                base, rules, lengths, symbols = _arrays(shard)
                ids = expand(symbols, rules, base, lengths).astype("<u4")
                starts = np.array(shard["doc_starts"], dtype=np.int64)
                ends = np.r_[starts[1:], len(ids)]
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(starts.tolist(), ends.tolist())]
                n = len(starts)
                cols = [pa.array([shard["bucket"]] * n, pa.int32()), pa.array([shard["seq"]] * n, pa.int32()), pa.array(shard["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(ids)], pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names + ["ids"] * with_ids)

    out = shards.mapInArrow(run, "bucket int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return out.join(before, ["bucket", "seq"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents as files of byte_bpe_50k.json's ids, read back."""
    import public_tokenizers

    path = shared_path(spark, "token-files")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path, with_ids=False)
