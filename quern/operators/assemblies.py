"""Contig lengths and coordinates against a table of reference assemblies of any size.

functions.reference holds the same tests as expressions over three assemblies. Here references are a frame: assembly, contig, length,
rank (the order in which equally near assemblies are preferred). Contigs compare without a leading `chr`.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions.reference import BED_TOLERANCE, TOLERANCE, bare
from quern.sources.sinks import once

from .skew import join_per_key

#: Assemblies that are ruled out together, as one bitmap of 32 bytes; and contig lengths that a pass over the files takes, about (some
#: 100 MB of a worker).
SET, BUNDLE = 256, 2_000_000
#: Files that go through the assemblies together, about: many, since each node that they meet costs some calls.
FILES = 100_000


def nearest(contigs: DataFrame, references: DataFrame, tolerance: int = TOLERANCE, contig_col: str = "contig", length_col: str = "length") -> DataFrame:
    """contigs plus assembly: the one whose length of the contig is nearest, within the tolerance; the lowest rank of equals. Or null.

    Each distinct contig and length is looked up once. Lengths are cut into bands as wide as the tolerance; references stand in
    their own band and both beside it, so the nearest below and above are the neighbours in a band's order: a band holds at
    most `tolerance` lengths to look up and three times as many distinct reference lengths, however many assemblies there are.
    """
    width = max(1, tolerance)
    asked = contigs.select(bare(F.col(contig_col)).alias("c"), F.col(length_col).cast("long").alias("n")).groupBy("c", "n").agg(F.count("*").alias("rows"))
    held = references.select(bare(F.col("contig")).alias("c"), F.col("length").cast("long").alias("n"), F.struct(F.col("rank").cast("long").alias("rank"), "assembly").alias("r")).where("c is not null and n is not null")
    held = held.groupBy("c", "n").agg(F.min("r").alias("r"))
    band = F.expr(f"cast(floor(n / {width}) as bigint)")
    beside = held.withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
    both = asked.where("c is not null and n is not null").withColumn("band", band).withColumn("r", F.lit(None).cast(held.schema["r"].dataType)).unionByName(beside, allowMissingColumns=True)
    # both frames grow from their start: one that shrinks to its end would be gone through again for every row
    rising, falling = (Window.partitionBy("c", "band").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc("n"), F.desc("n")))
    gap = lambda found: F.when(found.isNotNull(), F.struct(F.abs(found["n"] - F.col("n")).alias("gap"), found["r"]["rank"].alias("rank"), found["r"]["assembly"].alias("assembly")))
    known = F.when(F.col("r").isNotNull(), F.struct("n", "r"))
    below, above = F.last(known, True).over(rising), F.last(known, True).over(falling)
    swept = both.withColumns({"below": below, "above": above}).where("rows is not null")
    best = F.array_min(F.array_compact(F.array(gap(F.col("below")), gap(F.col("above")))))
    answers = swept.select("c", "n", "rows", best.alias("b")).select("c", "n", "rows", F.when(F.col("b.gap") <= tolerance, F.col("b.assembly")).alias("assembly"))
    answers = answers.unionByName(asked.where("c is null or n is null").withColumn("assembly", F.lit(None).cast("string")))
    keyed = contigs.drop("assembly").withColumns({"_c": bare(F.col(contig_col)), "_n": F.col(length_col).cast("long")})
    found = once(answers.select(F.col("c").alias("_c"), F.col("n").alias("_n"), "rows", "assembly"), "nearest-assemblies")
    return join_per_key(keyed, found, ["_c", "_n"], "rows").drop("_c", "_n")


def vote(votes: DataFrame, key: str) -> DataFrame:
    """key, assembly and matches of the most frequent assembly of every key; null and 0 if several share the top, or none was voted for."""
    counts = votes.groupBy(key, "assembly").agg(F.count("assembly").alias("n"))
    known = F.col("assembly").isNotNull()
    top = counts.groupBy(key).agg(F.max(F.when(known, F.struct("n", "assembly"))).alias("high"), F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "assembly"))).alias("low"))
    clear = F.col("high.assembly") == F.col("low.assembly")
    return top.select(key, F.when(clear, F.col("high.assembly")).alias("assembly"), F.coalesce(F.when(clear, F.col("high.n")), F.lit(0)).cast("long").alias("matches"))


class _Set:
    """Up to SET assemblies: for each contig, their lengths in ascending order, and a bitmap of the first so many of them."""

    def __init__(self, assemblies: np.ndarray, code: np.ndarray, place: np.ndarray, length: np.ndarray):
        """assemblies: their numbers. place: an assembly's place among them."""
        self.assemblies, self.sorted, self.bits = assemblies, {}, {}
        order = np.lexsort((length, code))
        code, place, length = code[order], place[order], length[order]
        edge = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
            marks = np.zeros((j - i + 1, SET), dtype=bool)
            marks[np.arange(1, j - i + 1), place[i:j]] = True
            self.sorted[int(code[i])], self.bits[int(code[i])] = length[i:j], np.packbits(np.logical_or.accumulate(marks, axis=0), axis=1)


class _Node:
    """Assemblies of like lengths: the codes of their contigs, the least and the largest length on each (no bound, where one of them
    lacks the contig), and two nodes of half of them each, or a set."""

    def __init__(self, assemblies: np.ndarray, code: np.ndarray, place: np.ndarray, length: np.ndarray):
        """Rows are sorted by code."""
        self.size = len(assemblies)
        edge = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])
        n = np.diff(edge)
        self.codes, self.low, most = code[edge[:-1]], np.minimum.reduceat(length, edge[:-1]), np.maximum.reduceat(length, edge[:-1])
        self.high = np.where(n == self.size, most, np.iinfo(np.int64).max)
        self.parts, self.set = (), None
        if self.size <= SET:
            self.set = _Set(assemblies, code, place, length)
            return
        # halves by the contig that most of them have, and of these by the one whose lengths differ most
        k = np.lexsort((most - self.low, n))[-1]
        known = np.full(self.size, np.iinfo(np.int64).max)
        known[place[edge[k] : edge[k + 1]]] = length[edge[k] : edge[k + 1]]
        order = np.argsort(known, kind="stable")
        for half in (order[: self.size // 2], order[self.size // 2 :]):
            new = np.full(self.size, -1)
            new[half] = np.arange(len(half))
            own = new[place] >= 0
            self.parts += (_Node(assemblies[half], code[own], new[place[own]], length[own]),)

    def count(self, files: np.ndarray, own: np.ndarray, code: np.ndarray, reach: np.ndarray, left: np.ndarray, sole: np.ndarray) -> None:
        """Adds to left how many assemblies each of files keeps here, and sets sole where it is one. own, code and reach: the
        positions of files (by place in files), less the tolerance."""
        if len(own):
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            touch = np.flatnonzero((self.codes[at] == code) & (reach > self.low[at]))  # others rule out nothing here, nor in a part
            own, code, reach, at = own[touch], code[touch], reach[touch], at[touch]
        touched, gone = np.zeros(len(files), dtype=bool), np.zeros(len(files), dtype=bool)
        touched[own] = True
        if len(own):
            gone[own[reach > self.high[at]]] = True
        left[files[~touched]] += self.size
        if self.size == 1:
            sole[files[~touched]] = self.set.assemblies[0]
        some = touched & ~gone
        stay = some[own]
        files, own, code, reach = files[some], (np.cumsum(some) - 1)[own[stay]], code[stay], reach[stay]
        if not len(files):
            return
        if self.set is None:
            for part in self.parts:
                part.count(files, own, code, reach, left, sole)
            return
        bits = np.zeros((len(files), SET // 8), dtype=np.uint8)
        for c in np.unique(code).tolist():
            mine = np.flatnonzero(code == c)  # a file has a contig once
            bits[own[mine]] |= self.set.bits[c][np.searchsorted(self.set.sorted[c], reach[mine], side="left")]
        n = self.size - np.bitwise_count(bits.view(np.uint64)).sum(axis=1, dtype=np.int64)
        left[files] += n
        one = np.flatnonzero(n == 1)
        sole[files[one]] = self.set.assemblies[np.unpackbits(bits[one], axis=1)[:, : self.size].argmin(axis=1)]


#: What this process prepared last, by its bundle's name: the root, the codes of contigs and the assemblies' names.
_PREPARED: dict[str, tuple[_Node | None, dict[str, int], pa.Array]] = {}


def _prepared(name: str, held: pa.Table) -> tuple[_Node | None, dict[str, int], pa.Array]:
    """held: contig, assembly and length."""
    if name not in _PREPARED:
        _PREPARED.clear()
        contig, assembly = (held.column(i).combine_chunks().dictionary_encode() for i in (0, 1))
        code, place, length = contig.indices.to_numpy().astype(np.int64), assembly.indices.to_numpy().astype(np.int64), held.column(2).to_numpy()
        order = np.argsort(code, kind="stable")
        root = _Node(np.arange(len(assembly.dictionary)), code[order], place[order], length[order]) if len(code) else None
        _PREPARED[name] = root, {c: i for i, c in enumerate(contig.dictionary.to_pylist())}, assembly.dictionary
    return _PREPARED[name]


def _gathered(batches, rows: int):
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _ruled_out(batches, name: str, held: pa.Table, tolerance: int):
    root, codes, names = _prepared(name, held)
    for b in _gathered(batches, FILES):
        places = b.column(1)
        flat, size = places.flatten(), pc.list_value_length(places).to_numpy()
        kinds, at = flat.field("c").dictionary_encode(), flat.field("n").to_numpy(zero_copy_only=False)
        row, which = np.repeat(np.arange(b.num_rows), size), kinds.indices.to_numpy(zero_copy_only=False)
        left, sole = np.zeros(b.num_rows, np.int64), np.full(b.num_rows, -1)
        if root:
            code = np.array([codes.get(c, -1) for c in kinds.dictionary.to_pylist()], dtype=np.int64)[which]
            root.count(np.arange(b.num_rows), row, code, at - tolerance, left, sole)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(left), names.take(pa.array(sole, mask=(sole < 0) | (left != 1))), b.column(2)], ["_key", "n_left", "sole", "evidence"])


def rule_out(positions: DataFrame, references: DataFrame, tolerance: int = BED_TOLERANCE, key: str = "k", contig_col: str = "contig", position_col: str = "position") -> DataFrame:
    """key, n_left (assemblies that no position exceeds by more than the tolerance), assembly (that one, if it is the only one), and
    evidence (contigs on which a position rules out an assembly).

    Assemblies stand in a tree that halves them by lengths down to sets of SET. A file goes into a node only if its positions rule out
    some of the node's assemblies and may keep others; the rest are counted whole, by the least and the largest length on each
    contig. In a set, a contig's lengths are sorted; a position rules out those that come before its place among them, which is one
    bitmap, and a file's bitmaps are put together. So no file meets an assembly row by row, and few sets. References go to the tasks
    in bundles of about BUNDLE rows, whole assemblies each; the files are passed once for each bundle, and its counts added up. Only
    the largest position of each file and known contig is shuffled.
    """
    spark = positions.sparkSession
    held = references.select(bare(F.col("contig")).alias("c"), F.col("length").cast("long").alias("n"), "assembly").where("c is not null and n is not null and assembly is not null")
    held = once(held.groupBy("c", "assembly").agg(F.max("n").alias("n")), "references")
    bundles = max(1, -(-held.count() // BUNDLE))
    shortest = held.groupBy("c").agg(F.min("n").alias("shortest"))
    at = positions.select(F.col(f"`{key}`").alias("_key"), bare(F.col(contig_col)).alias("c"), F.col(position_col).cast("long").alias("n")).groupBy("_key", "c").agg(F.max("n").alias("n"))
    known = F.col("shortest").isNotNull() & F.col("n").isNotNull()
    files = at.join(shortest, "c", "left").groupBy("_key").agg(F.array_compact(F.collect_list(F.when(known, F.struct("c", "n")))).alias("places"), F.count_if(F.col("n") - tolerance > F.col("shortest")).alias("evidence"))
    files, kind, found = once(files, "file-positions"), at.schema["_key"].dataType.simpleString(), []
    for i in range(bundles):
        own = held.where(F.pmod(F.xxhash64("assembly"), F.lit(bundles)) == i).select("c", "assembly", "n").toArrow()
        name, own = uuid.uuid4().hex, spark.sparkContext.broadcast(own)
        found.append(files.mapInArrow(lambda it, name=name, own=own: _ruled_out(it, name, own.value, tolerance), f"_key {kind}, n_left long, sole string, evidence long"))
    out = functools.reduce(DataFrame.unionAll, found)
    if bundles > 1:
        out = out.groupBy("_key").agg(F.sum("n_left").alias("n_left"), F.max("sole").alias("sole"), F.max("evidence").alias("evidence"))
    return out.select(F.col("_key").alias(key), "n_left", F.when(F.col("n_left") == 1, F.col("sole")).alias("assembly"), "evidence")
