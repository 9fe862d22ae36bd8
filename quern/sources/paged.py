"""A paged API as a Spark data source: the keys by which its pages are sorted are cut into ranges, and each range is a task's.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").option("fetch", "package.module:function").option("ranges", 64).load()

`fetch(after, size, start)` returns {"hits": [...], "next": token or None}: the page behind the token `after`, or, without one, the first
page of hits whose key is at least `start` (None: from the beginning). Requests are its own business. A task follows its range's pages
until a key lies beyond, so pages never pass the driver. download() keeps what was read, and goes on where it was stopped.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, DELAY_S, RANGES = 1000, 0.5, 64


def named(place: str) -> Callable:
    """The function that a text `package.module:name` names."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def file_id(hit: dict) -> str:
    """The key by which hits are sorted: the first file's id."""
    return ((hit.get("files") or [{}])[0] or {}).get("file_id") or ""


def hex_bounds(ranges: int) -> list[str]:
    """Keys that cut ids which begin with hex digits into about equal ranges: one fewer than ranges."""
    return [f"{(i << 32) // ranges:08x}" for i in range(1, ranges)]


class Range(InputPartition):
    """Keys from low (None: the first) up to high (excluded; None: to the last), as part number `part`."""

    def __init__(self, part: int, low: str | None, high: str | None):
        self.part, self.low, self.high = part, low, high


class PagedSource(DataSource):
    """Options: fetch, key (`package.module:function`, file_id by default), ranges or bounds (a JSON list), parts (a JSON list of
    the parts to read; all by default), size (hits a page), delay (seconds between a task's requests)."""

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return "part int, record string"

    def reader(self, schema):
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.fetch, self.key = options["fetch"], options.get("key", f"{__name__}:file_id")
        self.size, self.delay = int(options.get("size", PAGE)), float(options.get("delay", DELAY_S))
        self.bounds = json.loads(options["bounds"]) if "bounds" in options else hex_bounds(int(options.get("ranges", RANGES)))
        self.parts = set(json.loads(options["parts"])) if "parts" in options else None

    def partitions(self):
        ends = [None, *self.bounds, None]
        return [Range(i, a, b) for i, (a, b) in enumerate(zip(ends, ends[1:])) if self.parts is None or i in self.parts]

    def read(self, partition):
        fetch, key, after, first = named(self.fetch), named(self.key), None, True
        while first or after is not None:
            if not first:
                time.sleep(self.delay)
            page = fetch(after, self.size, partition.low if first else None)
            for hit in page["hits"]:
                if partition.high is not None and key(hit) >= partition.high:
                    return
                yield partition.part, json.dumps(hit)
            if not page["hits"]:
                return
            first, after = False, page.get("next")


def download(spark: SparkSession, path: str, fetch: str, at_once: int = 16, **options) -> DataFrame:
    """All hits (record, JSON texts), kept below path; ranges that an earlier call finished aren't asked for again.

    at_once: ranges of one job, and so the requests at a time. A job's ranges are written together and then marked; a job that
    was stopped between the two is done over, and its ranges replace what it wrote.
    """
    spark.dataSource.register(PagedSource)
    told = {k: json.dumps(v) if isinstance(v, list) else str(v) for k, v in options.items()}
    every = len(PagedReader({"fetch": fetch, **told}).partitions())
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{path}/done")
    there = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marks)
    done = {r.part for r in spark.read.schema("part int").parquet(f"{path}/done").collect()} if there else set()  # a number for each range
    left = [i for i in range(every) if i not in done]
    for i in range(0, len(left), at_once):
        now = left[i : i + at_once]
        rows = spark.read.format("paged").options(fetch=fetch, **told, parts=json.dumps(now)).load()
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{path}/records")
        spark.createDataFrame([(p,) for p in now], "part int").coalesce(1).write.mode("append").parquet(f"{path}/done")
    return spark.read.schema("record string, part int").parquet(f"{path}/records").select(F.col("record"))
