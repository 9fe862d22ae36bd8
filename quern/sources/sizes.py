"""Sizes of files that a catalog gives none for."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_sizes(files: DataFrame, size_of: Callable[[str], int], at_once: int = 8) -> DataFrame:
    """files with file_size filled in by size_of(url) where it is null and there is a url; it stays null where that fails.

    size_of asks a store for a file's length (of a HEAD request, say); how it does so is its own business. Each distinct
    url is asked for once.
    """

    def ask(batches):
        def one(url):
            try:
                n = size_of(url)
            except Exception:  # an unknown size is no error of the job
                return None
            return n if isinstance(n, int) and n >= 0 else None

        with ThreadPoolExecutor(at_once) as pool:
            for b in batches:
                urls = b.column(0)
                yield pa.RecordBatch.from_arrays([urls, pa.array([*pool.map(one, urls.to_pylist())], pa.int64())], ["_url", "_size"])

    lacking = files.where("file_size is null and url is not null").select(F.col("url").alias("_url")).distinct()
    found = lacking.mapInArrow(ask, "_url string, _size long")
    return files.join(found, F.col("file_size").isNull() & (F.col("url") == F.col("_url")), "left").withColumn("file_size", F.coalesce("file_size", "_size")).drop("_url", "_size")
