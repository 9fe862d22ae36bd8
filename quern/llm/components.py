"""Connected components of a frame of edges, by alternating large and small stars; nothing passes the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import remove, shared_path


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges a-b, and for each the smallest node that it is connected to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _shrunk(batches):
    for b in batches:
        nodes, roots = local_roots(*(b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        far = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (two long columns) that isn't a root itself; root: the component's smallest.

    Each round is written to the shared folder and the one before it deleted. A node with very many neighbours is a
    join key against one row, so that adaptive execution can split it; minima are summed up before the shuffle.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    now = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).mapInArrow(_shrunk, "u long, v long").distinct()
    path, seen = None, None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).distinct()
        new = shared_path(spark, "components")
        small.write.parquet(new)
        now = spark.read.schema("u long, v long").parquet(new)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(30,0)"))).first())
        if path:
            remove(spark, path)
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        path, seen = new, state
