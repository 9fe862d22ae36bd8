"""Heads of files: the few lines at a file's start that say what it holds.

Spark lists the files (`binaryFile` without its content); a task opens each one as a stream, on any store that pyarrow's file
systems or a given opener can reach, unpacks gzip as it goes, up to a cap, and stops as soon as it has what it needs: a file's
size doesn't matter. What can't be read gives an error text, never a failed task.
"""

from __future__ import annotations

import re
import struct
import tarfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.names import CATEGORIES, FORMATS, WRAPPERS
from quern.operators.classify import STORE_FILES, VARIANT_ARRAYS

#: Bytes of unpacked head that are looked at, by kind of file; members and lines that are kept.
CAPS = {"bam": 64 << 20, "vcf": 8 << 20, "fastq": 1 << 20, "fasta": 4 << 20, "gfa": 4 << 20, "bed": 16 << 20, "tar": 1600 << 20}
MEMBERS, VARIANTS, READS = 200, 100, 10
#: Bytes of the file after which an archive's members so far are looked at (if they tell what it holds, no more is read), and at most.
ARCHIVE = 100 << 20
STAGES = (256 << 10, 1 << 20, 10 << 20)
STEP = 128 << 10


class Head:
    """A stream's first cap bytes, unpacked if they are gzip (of several members, too), read a step at a time.

    taken: bytes unpacked so far; served: bytes of the file read so far, of which there are most at most.
    """

    def __init__(self, stream, cap: int, most: int | None = None):
        self.stream, self.cap, self.most, self.taken, self.served, self.whole = stream, cap, most, 0, 0, False
        self.held, self.parts = b"", self._parts()

    def _step(self) -> bytes:
        raw = self.stream.read(STEP) if self.most is None or self.served < self.most else b""
        self.served += len(raw)
        return raw

    def _parts(self) -> Iterator[bytes]:
        raw = self._step()
        if raw[:2] != b"\x1f\x8b":
            while raw and self.taken < self.cap:
                out = raw[: self.cap - self.taken]
                self.taken += len(out)
                yield out
                raw = raw[len(out) :] or self._step()
            self.whole = not raw
            return
        while raw[:2] == b"\x1f\x8b":
            unpack = zlib.decompressobj(31)
            while not unpack.eof and raw:
                out = unpack.decompress(raw, self.cap - self.taken)
                self.taken += len(out)
                if out:
                    yield out
                if self.taken >= self.cap:
                    return
                raw = unpack.unconsumed_tail or (b"" if unpack.eof else self._step())
            if not unpack.eof:
                return
            raw = unpack.unused_data
            raw = raw if len(raw) > 1 else raw + self._step()
        self.whole = not raw

    def read(self, n: int) -> bytes:
        """The next n bytes; fewer at the end of the head."""
        out = [self.held]
        size = len(self.held)
        while size < n:
            part = next(self.parts, None)
            if part is None:
                break
            out.append(part)
            size += len(part)
        data = b"".join(out)
        self.held = data[n:]
        return data[:n]


def lines(stream, cap: int) -> Iterator[str]:
    """Whole lines of a head; a last line without an end only counts if nothing was left out. A line is UTF-8, else Latin-1."""
    head, rest = Head(stream, cap), b""
    text = lambda x: x.decode("utf-8" if _is_utf8(x) else "latin-1")
    for part in head.parts:
        *found, rest = (rest + part).split(b"\n")
        yield from map(text, found)
    if rest and head.whole:
        yield text(rest)


def _is_utf8(x: bytes) -> bool:
    try:
        x.decode()
    except UnicodeDecodeError:
        return False
    return True


def bam(stream) -> list[str]:
    """The text header's lines."""
    head = Head(stream, CAPS["bam"])
    if head.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    size = struct.unpack("<i", head.read(4))[0]
    text = head.read(max(0, min(size, CAPS["bam"]))).rstrip(b"\0").decode("utf-8", "replace")
    if not text.strip():
        raise ValueError("no header lines")
    return [x for x in text.split("\n") if x]


def vcf(stream) -> list[str]:
    out, variants = [], 0
    for x in lines(stream, CAPS["vcf"]):
        if x.startswith("#"):
            out.append(x)
        elif variants < VARIANTS:
            variants += 1
            out.append(x)
        else:
            break
    if not any(x.startswith("#") for x in out):
        raise ValueError("no header lines")
    return out


def fastq(stream) -> list[str]:
    out, skip = [], 0
    for x in lines(stream, CAPS["fastq"]):
        if skip:
            skip -= 1
        elif x.startswith("@"):
            out.append(x)
            skip = 3
            if len(out) == READS:
                break
    if not out:
        raise ValueError("no reads")
    return out


def fasta(stream) -> list[str]:
    return [x[1:].split()[0] for x in lines(stream, CAPS["fasta"]) if x.startswith(">") and x[1:].split()]


def gfa(stream) -> list[str]:
    """sn and sr of every segment line, joined by a tab."""
    out = []
    for x in lines(stream, CAPS["gfa"]):
        if x.startswith("S\t"):
            tags = dict((t[:5], t[5:]) for t in x.split("\t")[3:])
            if {"SN:Z:", "SR:i:"} & {*tags}:
                out.append(tags.get("SN:Z:", "") + "\t" + tags.get("SR:i:", ""))
    return out


def bed(stream) -> list[str]:
    """chromosome, largest end and number of data lines of every chromosome, joined by tabs."""
    found: dict[str, list[int]] = {}
    for x in lines(stream, CAPS["bed"]):
        parts = x.split("\t") if "\t" in x else x.split()
        if x.strip() and not x.startswith(("#", "track", "browser")) and len(parts) >= 3 and parts[2].isdecimal():
            own = found.setdefault(parts[0], [0, 0])
            own[0], own[1] = max(own[0], int(parts[2])), own[1] + 1
    return [f"{c}\t{most}\t{n}" for c, (most, n) in found.items()]


_KNOWN = re.compile("(?:" + "|".join(re.escape(e) for e in {*FORMATS, *CATEGORIES}) + r")(?:\.(?:" + "|".join(WRAPPERS) + r"))*\Z")


def telling(names: list[str]) -> bool:
    """Whether members' names say what an archive holds: a part of a path is of a variant store, or a name has a known extension.

    What counts is what classify.is_variant_store() and names.extension_of() count.
    """
    parts = (p for n in names for p in n.strip("/").split("/"))
    store = any(p in STORE_FILES or (p.endswith(".tdb") and p[:-4].removesuffix("_var").lower() in VARIANT_ARRAYS) for p in parts)
    return store or any(_KNOWN.search(n.rsplit("/", 1)[-1].lower()) for n in names)


def tar(stream, tells: Callable[[list[str]], bool] = telling) -> list[str]:
    head, out, stages = Head(stream, CAPS["tar"], ARCHIVE), [], [*STAGES]
    try:
        with tarfile.open(fileobj=head, mode="r|", bufsize=10240) as t:
            for m in t:
                out.append(m.name)
                late = bool(stages) and head.served >= stages[0]
                while stages and head.served >= stages[0]:
                    stages.pop(0)
                if len(out) == MEMBERS or (late and tells(out)):
                    break
    except (tarfile.TarError, zlib.error):
        pass  # a cut or foreign head: what was read counts
    return out


READERS = {"bam": bam, "vcf": vcf, "fastq": fastq, "fasta": fasta, "gfa": gfa, "bed": bed, "tar": tar}


def open_stream(path: str):
    """A stream of a file on any of pyarrow's file systems. Spark gives paths without percent encoding."""
    store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", quote(path, safe=":/@=+,;!$&'()*~")))
    return store.open_input_stream(at, compression=None, buffer_size=STEP)


def read_heads(spark: SparkSession, path: str, kind: str | Callable, opener: Callable = open_stream) -> DataFrame:
    """path, lines (array<string>, null if unreadable) and error of every file below a path. Files of no bytes have no row.

    kind: one of READERS, or a function from a stream to lines. opener: a function from a path to a stream with read(n) and close(), for stores that pyarrow doesn't know.
    """
    reader = kind if callable(kind) else READERS[kind]

    def run(batches):
        for b in batches:
            found = []
            for x in b.column(0).to_pylist():
                try:
                    with opener(x) as stream:
                        found.append((reader(stream), None))
                except Exception as e:  # one bad file must not end the job; its reason is kept
                    found.append((None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f for f, _ in found], pa.list_(pa.string())), pa.array([e for _, e in found], pa.string())], ["path", "lines", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path")
    return files.mapInArrow(run, "path string, lines array<string>, error string")


def bed_signals(heads: DataFrame) -> DataFrame:
    """path and bed (chromosomes, has_chr_prefix, max_coordinates, line_count) of read_heads(..., 'bed')'s readable rows."""
    each = F.transform("lines", lambda x: F.split(x, "\t"))
    name, most, n = F.transform("x", lambda x: x[0]), F.transform("x", lambda x: x[1]), F.transform("x", lambda x: x[2])
    signals = F.struct(
        F.array_sort(name).alias("chromosomes"), F.exists(name, lambda c: F.lower(c).startswith("chr")).alias("has_chr_prefix"),
        F.map_from_arrays(name, most.cast("array<bigint>")).alias("max_coordinates"), F.aggregate(n.cast("array<int>"), F.lit(0), lambda a, b: a + b).alias("line_count"),
    )
    return heads.where("lines is not null").select("path", each.alias("x")).select("path", signals.alias("bed"))
