"""Kinds of files whose content is looked at, and how a user adds one.

A kind has the extensions that it is routed by, the reader of a file's head (a function from a stream to lines), what turns the heads'
lines into payload columns, and the classifier of files with those columns. Nothing is registered globally: a table of kinds is
passed to whoever routes, reads or classifies.

    own = with_kind("bcf", Kind((".bcf",), classify_mine, reader=read_mine, payload=lambda heads: heads.select("path", ...)))
    run = classify_catalog(files, payloads, kinds=own)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.classify import CLASSIFIERS, ROUTES
from quern.sources import heads as H


@dataclass(frozen=True)
class Kind:
    """extensions: with a leading dot, compared with case. classifier: files with payload columns -> files with classifications.

    reader: stream -> list of lines. payload: read_heads()'s readable rows -> path and the payload's columns.
    """

    extensions: tuple[str, ...]
    classifier: Callable[[DataFrame], DataFrame]
    reader: Callable | None = None
    payload: Callable[[DataFrame], DataFrame] | None = None


def _lines(name: str, column: Column) -> Callable[[DataFrame], DataFrame]:
    return lambda heads: heads.where("lines is not null").select("path", column.alias(name))


def archives(tells: Callable[[list[str]], bool]) -> Callable:
    """A reader of archives' members that stops at a stage as soon as tells(members so far) holds."""
    return lambda stream: H.tar(stream, tells)


def built_in() -> dict[str, Kind]:
    """The kinds that come with the package, by name."""
    text, own = F.array_join("lines", "\n"), F.col("lines")
    tags = F.transform("lines", lambda x: F.struct(F.split(x, "\t")[0].alias("sn"), F.split(x, "\t")[1].alias("sr")))
    payloads = {
        "bam": _lines("header_text", text), "vcf": _lines("header_text", text), "fastq": _lines("read_names", own), "fasta": _lines("contig_names", own),
        "gfa": _lines("gfa_segment_tags", tags), "tar": _lines("member_names", own), "bed": H.bed_signals,
    }
    return {k: Kind(ROUTES[k], CLASSIFIERS[k], H.READERS[k], payloads[k]) for k in ROUTES}


def with_kind(name: str, kind: Kind, kinds: dict[str, Kind] | None = None) -> dict[str, Kind]:
    """kinds (the built-in ones) and one more, or another one in the place of its namesake; an error says what is wrong with it."""
    kinds = built_in() if kinds is None else kinds
    if not name.isidentifier() or name.startswith("_"):
        raise ValueError(f"{name!r}: a kind's name must be an identifier without a leading underscore")
    if not kind.extensions or isinstance(kind.extensions, str) or not all(isinstance(e, str) and len(e) > 1 and e[0] == "." for e in kind.extensions):
        raise ValueError(f"{name}: extensions must be a list of texts that begin with a dot")
    for part in ("classifier", "reader", "payload"):
        if not callable(getattr(kind, part)) and (part == "classifier" or getattr(kind, part) is not None):
            raise ValueError(f"{name}: {part} must be a function")
    taken = {e: k for k, other in kinds.items() if k != name for e in other.extensions}
    if clash := [e for e in kind.extensions if e in taken]:
        raise ValueError(f"{name}: {clash[0]} belongs to {taken[clash[0]]}")
    return {**kinds, name: kind}


def routes(kinds: dict[str, Kind]) -> dict[str, tuple[str, ...]]:
    return {k: v.extensions for k, v in kinds.items()}


def read_payloads(spark: SparkSession, path: str, name: str, kinds: dict[str, Kind] | None = None, **how) -> DataFrame:
    """path and the payload's columns of every readable file of a kind below a path."""
    kind = (built_in() if kinds is None else kinds)[name]
    if kind.reader is None or kind.payload is None:
        raise ValueError(f"{name}: has no reader and payload")
    return kind.payload(H.read_heads(spark, path, kind.reader, **how).where("lines is not null"))
