"""JSON envelopes of any size, cut into records in parallel.

An envelope is one JSON object whose list of records is `results`, else `files`. Spark reads it in byte ranges, as lines that end
in "}": a range then begins outside of any escape, and no key of the two lists is cut. What a range does to a tokenizer
depends on one bit, whether it begins inside a string; so each range is read once for both, and gives for each what it ends in, how
deep it leads and the keys that it passes. These are put together along each file, a few numbers a range. Then every
range knows its state, and cuts the records in it; records that lie across ranges come in pieces, which are joined.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sinks import once

NO_LIST = "no list of records under results or files"
KEY = re.compile(rb'"(results|files)"\s*:\s*(\S)')
#: Byte ranges up to which their states are broadcast (some 100 bytes each); more are joined by sorting.
MOST_BROADCAST = 100_000
TRIES = 3
_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_STRUCTURE = _STEP != 0
_STRUCTURE[ord(",")] = True


class Tokens(NamedTuple):
    """Real quotes of a text that begins outside of an escape, and its brackets and commas with the quotes before each."""

    quotes: np.ndarray
    places: np.ndarray
    before: np.ndarray


def tokens(b: np.ndarray) -> Tokens:
    quotes, slashes = np.flatnonzero(b == 34), np.flatnonzero(b == 92)
    if len(slashes) and len(quotes):
        first = np.r_[True, np.diff(slashes) > 1]
        run = np.arange(len(slashes)) - np.flatnonzero(first)[np.cumsum(first) - 1] + 1
        at = np.searchsorted(slashes, quotes - 1)
        at[at == len(slashes)] = 0
        quotes = quotes[(slashes[at] != quotes - 1) | (run[at] % 2 == 0)]
    places = np.flatnonzero(_STRUCTURE[b])
    return Tokens(quotes, places, np.searchsorted(quotes, places))


def _texts(batches, extra: int):
    """path, block and length, the columns behind, and the text, of the runs of rows of one range, a batch at a time."""
    for batch in batches:
        path, block, value = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(), batch.column(3)
        new = np.flatnonzero(np.r_[True, (np.diff(path.indices.to_numpy()) != 0) | (np.diff(block) != 0)]) if len(block) else []
        for i, j in zip(new, [*new[1:], len(block)]):
            i, j = int(i), int(j)
            lines = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), value.slice(i, j - i).cast(pa.binary()))
            yield tuple(batch.column(k)[i].as_py() for k in range(3)), [batch.column(4 + k)[i].as_py() for k in range(extra)], pc.binary_join(lines, b"}")[0].as_py() + b"}"


class _Reading:
    """One range read as if it began outside (0) or inside (1) a string."""

    def __init__(self, inside: int):
        self.inside = self.now = inside
        self.depth = self.low = 0
        self.keys: dict[tuple[str, int], dict] = {}

    def add(self, b: np.ndarray, t: Tokens, at: int, found: list) -> None:
        own = t.before % 2 == self.now
        depth = self.depth + np.cumsum(_STEP[b[t.places[own]]])
        low = int(depth.min(initial=self.depth))
        for held in self.keys.values():
            held["closed"] = held["closed"] or low <= held["depth"]
        if found:
            places, after = t.places[own], np.minimum.accumulate(depth[::-1])[::-1] if len(depth) else depth
            for key, start, value, char in found:
                if np.searchsorted(t.quotes, start) % 2 != self.now:
                    continue
                k = int(np.searchsorted(places, start))
                level = int(depth[k - 1]) if k else self.depth
                k = int(np.searchsorted(places, value, side="right"))
                self.keys[key, level] = {"key": key, "depth": level, "at": at + value + 1, "char": char, "closed": k < len(depth) and int(after[k]) <= level}
        self.low = min(self.low, low)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        self.now = (self.now + len(t.quotes)) % 2


_KEYS = "array<struct<key: string, depth: bigint, at: bigint, char: string, closed: boolean>>"
_SUMMARY = f"path string, block long, length long, inside int, ends int, depth long, low long, first string, first_at long, keys {_KEYS}"


def _summaries(batches):
    now, readings, at, first = None, [], 0, (None, 0)
    type_ = pa.list_(pa.struct([("key", pa.string()), ("depth", pa.int64()), ("at", pa.int64()), ("char", pa.string()), ("closed", pa.bool_())]))

    def told():
        rows = [(*now, r.inside, r.now, r.depth, r.low, *first, [*r.keys.values()]) for r in readings]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), type_]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in _SUMMARY.split(", ", 9)])

    for place, _, text in _texts(batches, 0):
        if place != now:
            if now:
                yield told()
            now, readings, at, first = place, [_Reading(0), _Reading(1)], 0, (None, 0)
        if first[0] is None and (m := re.search(rb"\S", text)):
            first = (chr(m[0][0]), at + m.start())
        b = np.frombuffer(text, np.uint8)
        t, found = tokens(b), [(m[1].decode(), m.start(), m.start(2), chr(m[2][0])) for m in KEY.finditer(text)]
        for r in readings:
            r.add(b, t, at, found)
        at += len(text)
    if now:
        yield told()


_PLAN = "path string, block long, length long, inside int, depth long, start long, level long"


def _along(table: pa.Table, lenient: bool) -> pa.Table:
    """The state in which each range of one file that holds records begins; an error where there is no list of records."""
    rows = {(r["block"], r["inside"]): r for r in table.to_pylist()}
    inside, depth, first, keys, states = 0, 0, None, {}, []
    for block in sorted({b for b, _ in rows}):
        r = rows[block, inside]
        states.append((block, r["length"], inside, depth, depth + r["low"]))
        if first is None and r["first"]:
            first = (r["first"], block, r["first_at"])
        for k in r["keys"]:
            if depth + k["depth"] == 1:
                keys[k["key"]] = (block, k)
        inside, depth = r["ends"], depth + r["depth"]
    path = table.column("path")[0].as_py()
    if inside or depth not in (0, -1):  # the last line gets a "}" that it may not have
        raise ValueError(f"{path}: the JSON document isn't whole")
    if first and first[0] == "[" and lenient:
        start, level, closed = (first[1], first[2] + 1), 1, None
    else:
        block, k = keys.get("results") or keys.get("files") or (None, None)
        if not first or first[0] != "{" or k is None or k["char"] != "[":
            raise ValueError(f"{path}: {NO_LIST}")
        start, level, closed = (block, k["at"]), 2, k["closed"]
    out = []
    for block, length, inside, depth, low in states:
        if block == start[0]:
            out.append((path, block, length, inside, depth, start[1], level))
            if closed or (closed is None and low < level - 1):
                break
        elif block > start[0]:
            out.append((path, block, length, inside, depth, -1, level))
            if low < level:
                break
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in _PLAN.split(", ")])


#: What a piece of text is: the rest (or the middle) of a record that began in an earlier range, the beginning of one, a whole one;
#: or no text, a range's mark that it was read.
REST, BEGUN, WHOLE, READ = 0, 1, 2, 3


class _Cutting:
    def __init__(self, inside: int, depth: int, start: int, level: int):
        self.now, self.depth, self.start, self.level = inside, depth, start, level
        self.open, self.own, self.done, self.held = start < 0, False, False, []  # own: the text held began in this range

    def add(self, text: bytes, at: int) -> list[tuple[int, bytes]]:
        b = np.frombuffer(text, np.uint8)
        t = tokens(b)
        own = t.before % 2 == self.now
        places = t.places[own]
        depth = self.depth + np.cumsum(_STEP[b[places]])
        self.now, self.depth = (self.now + len(t.quotes)) % 2, int(depth[-1]) if len(depth) else self.depth
        if self.done:
            return []
        low = 0
        if not self.open:
            if self.start >= at + len(text):
                return []
            self.open, self.own, low = True, True, self.start - at
        behind = places >= low
        ends = np.flatnonzero(behind & (depth < self.level))
        cuts = places[behind & (depth == self.level) & (b[places] == ord(","))].tolist()
        if len(ends):
            self.done = True
            cuts = [c for c in cuts if c < places[ends[0]]] + [int(places[ends[0]])]
        out = []
        for c in cuts:
            out.append((WHOLE if self.own else REST, b"".join([*self.held, text[low:c]])))
            self.held, self.own, low = [], True, c + 1
        if not self.done:
            self.held.append(text[low:])
        return out

    def rest(self) -> list[tuple[int, bytes]]:
        return [(BEGUN if self.own else REST, b"".join(self.held))] if self.open and not self.done else []


def _cut(batches):
    now, cutting, at, count = None, None, 0, 0

    def made(found):
        n = len(found)
        return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array(range(count, count + n), pa.int64()), pa.array([k for k, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary()).cast(pa.string())], ["path", "block", "place", "kind", "record"])

    for place, state, text in _texts(batches, 4):
        if place != now:
            if now:
                yield made([*cutting.rest(), (READ, b"")])
            now, cutting, at, count = place, _Cutting(*state), 0, 0
        found = cutting.add(text, at)
        yield made(found)
        at, count = at + len(text), count + len(found)
    if now:
        yield made([*cutting.rest(), (READ, b"")])


def read_envelopes(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """record: the JSON text of every element of the envelopes' lists. A bare list of records only where lenient.

    What has no list of records, or isn't a whole document, is an error. Files of no bytes have no records. Of repeated keys,
    the last counts. The records' texts are written once to the shared folder; only the pieces of records that lie across byte
    ranges are shuffled, and only a file's pieces and ranges come together. Files are read twice, in the same ranges; where Spark
    has cut them otherwise the second time (as a cluster's size may change it), they are read anew, and after TRIES it is an error.
    """
    for _ in range(TRIES):
        cut, whole = _read(spark, path, lenient)
        if whole:
            break
    else:
        raise ValueError(f"{path}: files were cut in other ranges at each reading; set spark.sql.files.minPartitionNum")
    w = Window.partitionBy("path").orderBy("block", "place")  # two rows a range at most
    pieces = cut.where(F.col("kind").isin(REST, BEGUN)).withColumn("group", F.sum((F.col("kind") == BEGUN).cast("long")).over(w))
    joined = pieces.groupBy("path", "group").agg(F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("p")).select(F.array_join(F.transform("p", lambda x: x["record"]), "").alias("record"))
    found = cut.where(F.col("kind") == WHOLE).select("record").unionAll(joined)
    return found.select(F.trim(F.col("record"), F.lit(" \t\r\n")).alias("record")).where("record <> ''")


def _read(spark: SparkSession, path: str, lenient: bool) -> tuple[DataFrame, bool]:
    """The pieces of all records, and whether every range with records was read as it was in the pass before."""
    lines = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("length"), "value")
    states = lines.mapInArrow(_summaries, _SUMMARY).groupBy("path").applyInArrow(lambda t: _along(t, lenient), _PLAN)
    keys = ["path", "block", "length"]
    states, columns = once(states, "envelope-ranges"), [*keys, "value", "inside", "depth", "start", "level"]
    ranges = states.count()
    if ranges <= MOST_BROADCAST:
        known = lines.join(F.broadcast(states), keys).select(*columns)  # lines stay in their order
    else:
        known = lines.withColumn("place", F.monotonically_increasing_id()).join(states.hint("merge"), keys).sortWithinPartitions("path", "block", "place").select(*columns)
    cut = once(known.mapInArrow(_cut, "path string, block long, place long, kind int, record string"), "envelope-records")
    return cut, cut.where(F.col("kind") == READ).count() == ranges
