"""Joins with a table of one row a key, for keys that may hold any share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_per_key(rows: DataFrame, table: DataFrame, keys: list[str], count_col: str) -> DataFrame:
    """rows with table's other columns, matched null-safely on keys; rows whose key isn't in table are left out.

    table: one row a key, with count_col, how many of rows have it (dropped). A key with more than half a shuffle
    partition's fair share of the rows is broadcast (there are at most two such keys a partition, whatever the table's size), so that
    its rows stay where they are; the others are joined by shuffling. table is read three times: write it first.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = table.agg(F.sum(count_col)).first()[0] or 0
    most = total // (2 * parts)
    named = table.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], F.col(count_col).alias("_rows"), F.struct(*[F.col(f"`{c}`") for c in table.columns if c not in (*keys, count_col)]).alias("_found"))

    def same(a: DataFrame, b: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_key{i}"]) for i, k in enumerate(keys)])

    drop = [f"_key{i}" for i in range(len(keys))]
    large = named.where(F.col("_rows") > most).drop("_rows")
    marked = rows.join(F.broadcast(large), same(rows, large), "left").drop(*drop)
    own, rest = marked.where("_found is not null"), marked.where("_found is null").drop("_found")
    small = named.where(F.col("_rows") <= most).drop("_rows")
    return own.unionByName(rest.join(small, same(rest, small)).drop(*drop)).select(*rows.columns, "_found.*")
