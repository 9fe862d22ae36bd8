"""What several operators use: the shared folder, range buckets, filters of fixed size, whole-word batches."""

from __future__ import annotations

import ctypes
import functools
import json
import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- shared folder ---------------------------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Local runs without it get a new temp folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the session's JVM ends, or by remove()."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, path)
    fs.mkdirs(at.getParent())
    fs.deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage, survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of shared_path() once nothing reads it any more."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


#: What keeps rows in their places from one reading to the next: scans of files and of local rows, columns and conditions.
_IN_PLACE = {"LogicalRelation", "LocalRelation", "Range", "Project", "Filter", "SubqueryAlias", "View"}


def repeatable(df: DataFrame) -> bool:
    """Whether df gives the same rows at the same places whenever it is read: only scans, columns and conditions, all deterministic.

    Whatever else stands in the plan (joins, shuffles, limits, samples, Python functions, random numbers) counts as not.
    """
    plan = df._jdf.queryExecution().analyzed()

    def fine(node) -> bool:
        below = node.children()
        kind = node.getClass().getSimpleName()
        return kind in _IN_PLACE and all(fine(below.apply(i)) for i in range(below.size()))

    return plan.deterministic() and fine(plan)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- range buckets ---------------------------------------------------------------------------------------------------


def range_bounds(df: DataFrame, key: str, buckets: int, rows: int, per_bucket: int = 40) -> list:
    """Up to buckets-1 sorted keys (repeats kept: a hot key takes several buckets) that deal df's rows out evenly.

    They come from a sample of about buckets * per_bucket keys and only steer the dealing; no row depends on it for
    its result. Nulls are not sampled.
    """
    share = min(1.0, buckets * per_bucket / max(rows, 1))
    keys = df.select(key).where(F.col(key).isNotNull())
    if share < 1:
        keys = keys.sample(share, seed=11)
    found = sorted(r[0] for r in keys.collect())
    return [found[len(found) * i // buckets] for i in range(1, buckets)] if found else []


def bounds_below(bounds: list, test) -> Column:
    """How many of the sorted bounds meet test, which holds for a prefix of them; two short scans, whatever their number."""
    step = math.isqrt(len(bounds)) + 1
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    kind = "string" if isinstance(bounds[0], str) else "bigint"
    known = F.from_json(F.lit(json.dumps(chunks)), f"array<array<{kind}>>")
    last = F.from_json(F.lit(json.dumps([c[-1] for c in chunks])), f"array<{kind}>")
    whole = F.size(F.filter(last, test))
    return F.when(whole < len(chunks), whole * step + F.size(F.filter(F.get(known, whole), test))).otherwise(len(bounds))


def bucket_of(key: Column, bounds: list, tie: Column) -> Column:
    """The bucket of a key; buckets follow the keys' order. A key that is a bound several times is dealt out by tie.

    Null keys go to bucket 0.
    """
    if not bounds:
        return F.lit(0)
    below = bounds_below(bounds, lambda b: b < key)
    upto = bounds_below(bounds, lambda b: b <= key)
    return F.when(key.isNull(), 0).otherwise(F.when(upto - below <= 1, upto).otherwise(below + 1 + F.pmod(tie, upto - below)).cast("int"))


def in_order(df: DataFrame, bucket: str, buckets: int, most: int = 4) -> DataFrame:
    """df in partitions that follow the order of a bucket column (0 .. buckets - 1), each of whole buckets, at most so many of them."""
    parts = min(buckets, max(partitions(df.sparkSession), -(-buckets // most)))
    return df.repartitionById(parts, F.expr(f"cast({bucket} * {parts}L div {buckets} as int)"))


# --- filters of fixed size -------------------------------------------------------------------------------------------

BLOOM_BITS = 1 << 27


def _bloom_slots(ids: np.ndarray) -> list[np.ndarray]:
    x = ids.astype(np.int64).view(np.uint64)
    out = []
    for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93):
        y = (x + np.uint64(k)) * np.uint64(0xFF51AFD7ED558CCD)
        y ^= y >> np.uint64(33)
        y *= np.uint64(k)
        out.append(y >> np.uint64(37))
    return out


def bloom(ids: DataFrame) -> bytes:
    """A Bloom filter of at most 16 MB over a frame of one long column; smaller when there are few rows.

    Tasks build filters of the same size that are merged bit by bit; no list of ids reaches the driver. Past some ten
    million ids it passes more rows than it must; results don't change, as an exact join follows wherever it is used.
    """
    name = ids.columns[0]
    rows = ids.count()
    shift = 27
    while shift > 12 and (1 << (shift - 1)) >= 12 * max(rows, 1):
        shift -= 1

    def build(batches):
        bits = np.zeros(1 << (shift - 3), dtype=np.uint8)
        for b in batches:
            for slot in _bloom_slots(b.column(0).drop_null().to_numpy(zero_copy_only=False)):
                s = slot >> np.uint64(27 - shift)
                np.bitwise_or.at(bits, (s >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (s & np.uint64(7)).astype(np.uint8)))
        yield pa.RecordBatch.from_pydict({"bits": pa.array([bits.tobytes()], pa.binary())})

    def merge(batches):
        bits = np.zeros(1 << (shift - 3), dtype=np.uint8)
        for b in batches:
            for x in b.column(0):
                bits |= np.frombuffer(x.as_py(), dtype=np.uint8)
        yield pa.RecordBatch.from_pydict({"bits": pa.array([bits.tobytes()], pa.binary())})

    part = ids.where(F.col(name).isNotNull()).coalesce(16).mapInArrow(build, "bits binary")
    out = part.coalesce(1).mapInArrow(merge, "bits binary").collect()
    return bytes(out[0][0]) if out else bytes(1 << (shift - 3))


def may_hold(bits: bytes, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in bloom()'s filter; never False for one that is."""
    shift = (len(bits) * 8).bit_length() - 1
    table = np.frombuffer(bits, dtype=np.uint8)
    ok = np.ones(len(ids), dtype=bool)
    for slot in _bloom_slots(ids):
        s = slot >> np.uint64(27 - shift)
        ok &= (table[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


# --- ragged arrays ---------------------------------------------------------------------------------------------------


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1 of every i, in order."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep].astype(np.int64), lengths[keep]
    step = np.ones(total, dtype=np.int64)
    ends = np.cumsum(lengths)
    step[0] = starts[0]
    step[ends[:-1]] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(step)


def group_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of values[offsets[i]:offsets[i+1]] of every i."""
    c = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


# --- whole texts as words --------------------------------------------------------------------------------------------

#: White space as patterns and normalizers see it, and the end of a text: no cut is safe before a space that precedes it.
WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LOOSE = rf"^(?:[{WHITE}]|$)"
#: Marks that are cut off the end of a piece behind a letter or a digit.
TAILS = ".,!?;:"
#: The letters and digits meant: Latin, Greek and Cyrillic ones that neither lower case nor a normal form ends in a mark.
STEM = r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}\x{388}-\x{3f5}\x{3f7}-\x{481}\x{48a}-\x{52f}]$"
#: A word whose first line end stands alone between a character other than white space and a letter or digit of STEM.
LINE = rf"^[^\n]*[^{WHITE}]\n" + STEM[:-1]


def _in_two(words: pa.Array, head: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words (large strings without offset) cut behind so many bytes, 0 for no cut: the parts over the same bytes, and how many each word has."""
    _, bounds, data = words.buffers()
    k = np.flatnonzero(head)
    if not len(k):
        return words, np.ones(len(words), dtype=np.int64)
    off = np.frombuffer(bounds, np.int64)[: len(words) + 1]
    parts = pa.Array.from_buffers(words.type, len(words) + len(k), [None, pa.py_buffer(np.insert(off, k + 1, off[k] + head[k])), data])
    return parts, 1 + (head > 0)


class Words:
    """The texts of a batch, cut into pieces at spaces and before marks at the end of a word.

    A cut is made only before a space that a character other than white space follows, and between a letter or digit of STEM
    and marks of TAILS that a space or the end follows; there, patterns of the usual byte-level tokenizers always begin a new
    match, so that pieces can be tokenized one by one. which: the distinct piece at each place; offsets: the texts' bounds
    in which. Null texts count as empty.
    """

    def __init__(self, texts: pa.Array, tails: str = TAILS, whole: bool = False, lines: bool = False):
        """whole: texts aren't cut, for patterns that may match across the places named above.

        lines: cut behind a single line end between a character other than white space and a letter or digit of STEM, too, and
        before line ends behind such a letter; for patterns that take white space for itself or as one space before a letter.
        """
        texts = pc.fill_null(level(texts).cast(pa.large_string()), "")
        parts = pa.LargeListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int64()), texts) if whole else pc.split_pattern(texts, " ")
        off, tails = parts.offsets.to_numpy().astype(np.int64), "" if whole else tails
        codes = parts.flatten().dictionary_encode()
        words, at = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        spaced = np.ones(len(at), dtype=bool)
        spaced[off[:-1]] = False
        loose = pc.match_substring_regex(words, LOOSE).to_numpy(zero_copy_only=False)
        glued = loose[at] & spaced
        if glued.any():
            start = np.flatnonzero(~glued)
            n = np.diff(np.r_[start, len(at)])
            many = np.flatnonzero(n > 1)
            part, end = words.take(pa.array(at[spans(start[many], n[many])])).to_pylist(), np.cumsum(n[many]).tolist()
            index: dict[str, int] = {}
            own = [index.setdefault(" " * int(lead) + " ".join(part[i:j]), len(index)) for lead, i, j in zip(spaced[start[many]].tolist(), [0, *end], end)]
            off = np.concatenate([[0], np.cumsum(~glued)])[off]
            at, spaced = at[start], spaced[start]
            at[many], spaced[many] = len(words) + np.array(own), False
            words = pa.concat_arrays([words, pa.array([*index], pa.large_string())])
        count = None  # of the parts of each word
        if lines and not whole:
            ends = pc.if_else(pc.match_substring_regex(words, LINE), pc.add(pc.find_substring(words, "\n"), 1), 0)
            words, count = _in_two(words, ends.to_numpy(zero_copy_only=False))
            tails = tails and tails + "\n"
        if tails:
            stems = pc.ascii_rtrim(words, characters=tails)
            cut = pc.and_(pc.less(pc.binary_length(stems), pc.binary_length(words)), pc.match_substring_regex(stems, STEM))
            words, more = _in_two(words, pc.if_else(cut, pc.binary_length(stems), 0).to_numpy(zero_copy_only=False))
            count = more if count is None else group_sums(more, np.concatenate([[0], np.cumsum(count)]))
        if count is not None and len(words) > len(count):
            codes = words.dictionary_encode()
            words, flat = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            n = count[at]
            to = np.cumsum(n) - n
            off = np.concatenate([to, [int(n.sum())]])[off]
            lead = np.zeros(off[-1], dtype=bool)
            lead[to] = spaced
            at, spaced = flat[spans((np.cumsum(count) - count)[at], n)], lead
        self.words, n = words, len(words)
        which = at + n * spaced
        seen = np.zeros(2 * n, dtype=bool)
        seen[which] = True
        self.used = np.flatnonzero(seen)  # the words' places; n more where a space goes before
        self.which, self.offsets = (np.cumsum(seen) - 1)[which], off

    @functools.cached_property
    def _bytes(self) -> tuple[bytes, list[int]]:
        """All words' bytes and their bounds."""
        _, off, data = self.words.buffers()
        return (data.to_pybytes() if data else b""), (np.frombuffer(off, np.int64)[: len(self.words) + 1].tolist() if off else [0])

    def strings(self, at: np.ndarray) -> list[str]:
        """The distinct pieces of these numbers."""
        n, (data, off) = len(self.words), self._bytes
        return [" " + data[off[c - n] : off[c - n + 1]].decode() if c >= n else data[off[c] : off[c + 1]].decode() for c in self.used[at].tolist()]

    @functools.cached_property
    def distinct(self) -> list[str]:
        return self.strings(np.arange(len(self.used)))

    def keys(self) -> np.ndarray:
        """128 bits of xxh3 for every distinct piece."""
        n, (data, off), digest = len(self.words), self._bytes, xxhash.xxh3_128_digest
        h = np.frombuffer(b"".join([digest(data[i:j]) for i, j in zip(off, off[1:])]), dtype=np.uint64).reshape(-1, 2)
        out = h[self.used % n] if n else np.zeros((0, 2), np.uint64)
        out[:, 1] ^= np.where(self.used >= n, np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
        return out


class _Held:
    """Keys of 128 bits and a run of numbers for each: open addressing over arrays, which grow."""

    def __init__(self):
        self.n, self.values = 0, 0
        self.table = np.full(1 << 12, -1, np.int32)
        self.key = np.zeros((1 << 11, 2), np.uint64)
        self.start, self.length = np.zeros(1 << 11, np.int64), np.zeros(1 << 11, np.int32)
        self.pool = np.zeros(1 << 12, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those that aren't held."""
        out, mask = np.full(len(keys), -1), len(self.table) - 1
        todo, slot = np.arange(len(keys)), (keys[:, 0] & np.uint64(mask)).astype(np.int64)
        while len(todo):
            held = self.table[slot]
            same = (held >= 0) & (self.key[held] == keys[todo]).all(axis=1)
            out[todo[same]] = held[same]
            on = (held >= 0) & ~same
            todo, slot = todo[on], (slot[on] + 1) & mask
        return out

    def _put(self, first: int) -> None:
        mask = len(self.table) - 1
        todo = np.arange(first, self.n)
        slot = (self.key[todo, 0] & np.uint64(mask)).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.table[slot] < 0)
            self.table[slot[free]] = todo[free]  # of keys for one slot, one stays
            on = self.table[slot] != todo
            todo, slot = todo[on], (slot[on] + 1) & mask

    def add(self, keys: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> None:
        """Adds distinct keys that aren't held."""
        n, size = self.n, self.values
        self.n, self.values = n + len(keys), size + len(values)
        if self.n > len(self.key):
            more = max(self.n, 2 * len(self.key)) - len(self.key)
            self.key = np.concatenate([self.key, np.zeros((more, 2), np.uint64)])
            self.start, self.length = np.concatenate([self.start, np.zeros(more, np.int64)]), np.concatenate([self.length, np.zeros(more, np.int32)])
        if self.values > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(self.values, 3 * len(self.pool) // 2) - len(self.pool), np.int32)])
        self.key[n : self.n], self.length[n : self.n], self.pool[size : self.values] = keys, lengths, values
        self.start[n : self.n] = size + np.cumsum(lengths) - lengths
        grow = len(self.table)
        while grow < 2 * self.n:
            grow *= 2
        if grow > len(self.table):
            self.table = np.full(grow, -1, np.int32)
            n = 0
        self._put(n)


class PieceCache:
    """Maps distinct pieces to runs of numbers; a Python worker keeps it between batches, and between tasks unless it is cleared.

    Pieces are told apart by 128 bits of their xxh3 hash (two of ten million pieces agree by chance once in 10 ** 24
    times). Two generations hold at most about `most` pieces and `most_values` numbers: when the young one has half of
    them, it becomes the old one, and what is met again moves up, so that frequent pieces stay.
    """

    def __init__(self, compute, most: int = 600_000, most_values: int = 16_000_000):
        """compute: list of new pieces -> (int array of all their values, int array of their lengths)."""
        self.compute, self.most, self.most_values = compute, most, most_values
        self.clear()

    def clear(self) -> None:
        """Lets go of everything, also of what Arrow keeps for its next arrays."""
        self.young, self.old = _Held(), _Held()
        give_back()

    @property
    def pool(self) -> np.ndarray:
        return self.young.pool

    def look_up(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths in self.pool of words' distinct pieces, valid until the next call."""
        if self.young.n > self.most // 2 or self.young.values > self.most_values // 2:
            self.young, self.old = _Held(), self.young
        keys = words.keys()
        at = self.young.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            before = self.old.find(keys[new])
            known = before >= 0
            if known.any():
                k = before[known]
                at[new[known]] = self.young.n + np.arange(len(k))
                self.young.add(keys[new[known]], self.old.pool[spans(self.old.start[k], self.old.length[k])], self.old.length[k])
            rest = new[~known]
            if len(rest):
                values, lengths = self.compute(words.strings(rest))
                at[rest] = self.young.n + np.arange(len(rest))
                self.young.add(keys[rest], values, lengths)
        return self.young.start[at], self.young.length[at].astype(np.int64)


@functools.lru_cache(1)
def _trim():
    """The C library's call that gives freed memory back to the system, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns to the system what this worker has freed; idle workers of earlier stages then hold little."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def frugal(run):
    """The function of batches run, which gives memory back when its task is done."""

    @functools.wraps(run)
    def task(batches, *args):
        yield from run(batches, *args)
        give_back()

    return task


def level(array: pa.Array) -> pa.Array:
    """The array, copied if it is a slice of a longer one: kernels misread texts that were cast from a slice with an offset
    (pyarrow 23: ascii_lower of a large_string cast from such a string array)."""
    return pa.concat_arrays([array]) if array.offset else array


def text_batches(batches, rows: int = 1024, text: int | None = None, most: int = 8 << 20):
    """Batches of at most so many rows each, none of them a view with an offset; long texts are whole in one batch.

    text: the column whose texts should fill at most so many bytes of a batch, but for a longer one, which is alone.
    """
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if text is not None else None
        i = 0
        while i < b.num_rows:
            j = min(i + rows, b.num_rows)
            if size is not None:
                j = max(i + 1, min(j, int(np.searchsorted(size, most + (size[i - 1] if i else 0), side="right"))))
            part = b.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([level(c) for c in part.columns], schema=part.schema)
            i = j
