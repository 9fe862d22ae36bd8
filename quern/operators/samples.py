"""Counts and a few examples of every group, added up in tasks before anything is shuffled."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that a task holds at once; when there are more, what it has is passed on and it begins anew.
HELD = 50_000
#: Parts in which tasks' samples of one group meet first.
PARTS = 64


def first_of_groups(rows: DataFrame, keys: list[str], order: str, most: int) -> DataFrame:
    """keys (as text), n and first (the `most` smallest distinct values of order, as text, without nulls) of every group.

    A task keeps a group's count and smallest values only, so a group of any size is one row of a task; neither it nor its
    values are sorted or shuffled.
    """
    k = len(keys)
    names = [f"k{i}" for i in range(k)]
    schema = ", ".join(f"{c} string" for c in names) + ", n long, first array<string>"

    def passed_on(held):
        columns = [pa.array([key[i] for key in held], pa.string()) for i in range(k)]
        counts, values = pa.array([v[0] for v in held.values()], pa.int64()), pa.array([sorted(v[1])[:most] for v in held.values()], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([*columns, counts, values], [*names, "n", "first"])

    def add(batches):
        held: dict[tuple, list] = {}
        for b in batches:
            each = pa.Table.from_batches([b]).group_by([*names, "v"]).aggregate([([], "count_all")])
            *key_columns, values, counts = (each.column(c).to_pylist() for c in [*names, "v", "count_all"])
            for key, value, n in zip(zip(*key_columns), values, counts):
                own = held.setdefault(key, [0, set()])
                own[0] += n
                if value is not None:
                    own[1].add(value)
                    if len(own[1]) > 8 * most:
                        own[1] = {*sorted(own[1])[:most]}
            if len(held) > HELD:
                yield passed_on(held)
                held = {}
        if held:
            yield passed_on(held)

    slim = rows.select(*[F.col(c).cast("string").alias(n) for c, n in zip(keys, names)], F.col(order).cast("string").alias("v"))
    partial = slim.mapInArrow(add, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    for by in ([*names, "part"], names):
        partial = partial.groupBy(*by).agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("first")))), 1, most).alias("first"))
    return partial.select(*[F.col(n).alias(c) for c, n in zip(keys, names)], "n", "first")
