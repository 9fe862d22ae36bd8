"""A whole run: routed files by their payloads, images and auxiliary files by name, indexes from parents, the rest by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.names import is_auxiliary, is_image
from quern.operators import classify as C
from quern.operators import propagate
from quern.operators.classify import route
from quern.plans.kinds import Kind, built_in, routes
from quern.sources.sinks import once


#: Phases that pick their files by name and format, beside the payloads'.
BY_NAME = {"image": is_image, "auxiliary": is_auxiliary}


def whole_run(files: DataFrame, payloads: dict[str, DataFrame]) -> DataFrame:
    """classify_catalog() with every phase: payloads, images, auxiliary files, indexes, the rest."""
    return classify_catalog(files, payloads, tuple(BY_NAME))


def classify_catalog(files: DataFrame, payloads: dict[str, DataFrame] | None = None, by_name: tuple[str, ...] = (), kinds: dict[str, Kind] | None = None) -> DataFrame:
    """files (entry_id, file_name, ..., file_md5sum) plus classifications and phase.

    payloads: for each kind of ROUTES, a frame with file_md5sum and the payload column. Routed files without a payload are
    unreadable. A file that routes to two kinds has two rows, as in each kind's own output; so has one that is routed and
    an image or auxiliary. The first phases are worked out and written once; indexes and the rest read them from there.
    Without any, all files are classified by name, and indexes take their parents' labels. by_name: which of BY_NAME's
    phases to run; without them, their files are among the rest. kinds: others than the built-in ones, see plans.kinds.
    """
    cols = files.columns
    if not payloads and not by_name:
        base = once(C.classify(files).withColumn("phase", F.lit("name")), "classified")
        indexes = _indexes(files, base)
        return base.join(indexes.select("entry_id"), "entry_id", "left_anti").unionByName(indexes)
    kinds, parts = built_in() if kinds is None else kinds, []
    if payloads:
        given = with_payloads(files, payloads, kinds)
        for kind in payloads:
            got = kinds[kind].classifier(given.where((F.col("_kind") == kind) & F.col("_read")).select(*[F.col(f"`{c}`") for c in cols], f"_{kind}.*"))
            parts.append(got.select(*cols, "classifications", F.lit(kind).alias("phase")))
        lost = given.where(~F.col("_read"))
        parts.append(C.unreadable(lost, F.lit("content could not be read")).select(*cols, "classifications", F.col("_kind").alias("phase")))
    if by_name:
        phases = F.array_compact(F.array(*[F.when(BY_NAME[p](F.col("file_name"), F.col("file_format")), F.lit(p)) for p in by_name]))
        parts.append(C.classify(files.withColumn("phase", F.explode(phases))).select(*cols, "classifications", "phase"))
    base = once(reduce(DataFrame.unionByName, parts), "classified")
    known = base.unionByName(_indexes(files, base))
    rest = C.classify(propagate.remaining(files, known)).withColumn("phase", F.lit("remaining"))
    return known.unionByName(rest.select(known.columns))


def with_payloads(files: DataFrame, payloads: dict[str, DataFrame], kinds: dict[str, Kind]) -> DataFrame:
    """Routed files with _kind, _read (whether there is a payload), and for each kind a struct `_<kind>` of its payload's columns.

    Files are routed once, and all kinds' payloads are one side of one join on md5 and kind, which is written once.
    """
    told = [p.select(F.col("file_md5sum").alias("_md5"), F.lit(k).alias("_of"), F.struct(*[F.col(f"`{c}`") for c in p.columns if c != "file_md5sum"]).alias(f"_{k}")) for k, p in payloads.items()]
    told = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), told)
    routed = route(files, routes(kinds)).withColumnRenamed("kind", "_kind").where(F.col("_kind").isin(*payloads))
    joined = routed.join(told, (F.col("file_md5sum") == F.col("_md5")) & (F.col("_kind") == F.col("_of")), "left")
    return once(joined.withColumn("_read", F.col("_md5").isNotNull()).drop("_md5", "_of"), "payloads")


def _indexes(files: DataFrame, base: DataFrame) -> DataFrame:
    found = propagate.inherited(propagate.matched_indexes(files), base)
    return found.select(*files.columns, "classifications", F.lit("index").alias("phase"))
