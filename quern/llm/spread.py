"""Distinct hash keys for rows, so that no id, however often it repeats, is one hash key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_text(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def with_key(rows: DataFrame, id_col: str) -> DataFrame:
    """rows plus key: 15 hex digits of md5 of the id; of the id and the row's ordinal where the id repeats.

    rows should be slim (ids and sizes), as repeated ids are found by a count of ids and a join.
    """
    rows = rows.withColumn("ord", F.monotonically_increasing_id()).withColumn("own", id_text(id_col))
    twice = rows.groupBy("own").count().where("count > 1").select("own", F.lit(True).alias("twice"))
    text = F.when(F.col("twice"), F.concat("own", F.lit(":"), F.col("ord").cast("string"))).otherwise(F.col("own"))
    return rows.join(twice, "own", "left").withColumn("key", F.substring(F.md5(text), 1, 15)).drop("own", "ord", "twice")
