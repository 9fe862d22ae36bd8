"""Sharding by extendible hashing.

A document's key is 60 bits of a hash. A shard is a prefix of bits; the directory maps every prefix of the current depth
to its shard. Only shards over the byte limit are split on one more bit, so a shard's depth is the least at which the
documents below its prefix fit. The bytes below all prefixes come from one small histogram of prefixes, built by partial
sums before any shuffle; texts aren't shuffled to find the shards. The directory's own depth grows only below prefixes
that are still too large. The directory grows with the input, so it is joined by sorting, never broadcast.

Defined results. A document larger than the limit is alone in its shard, which then is over the limit (nothing is cut).
Null text: 0 bytes. Null ids: as the empty id. Repeated ids: their rows get keys of their own, so that they can be split.
Empty table: empty result. Other columns are ignored by plan_shards and kept by write_shards, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, written
from .spread import with_key

#: Bytes of text a shard holds at most, in the query.
SHARD_BYTES = 8 << 20
BITS = 60


def plan_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, shard (its prefix of bits), depth, shard_docs, shard_bytes of every document, and columns to keep."""
    slim = docs.select(*keep, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"))
    rows = written(with_key(slim, "doc_id").select(*keep, "doc_id", "n_bytes", F.lpad(F.conv("key", 16, 2), BITS, "0").alias("bits")), "shard-keys")
    total = rows.agg(F.sum("n_bytes")).first()[0]
    if total is None:
        return rows.select(*keep, "doc_id", "n_bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard_docs"), F.lit(0).cast("long").alias("shard_bytes"))
    depth, low, levels, left = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 4), 0, [], rows
    while True:
        prefix = F.substring("bits", 1, depth) if depth else F.lit("")
        leaves = written(left.groupBy(prefix.alias("leaf")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "shard-leaves")
        each = leaves.select("leaf", "b", "n", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth")).withColumn("shard", F.expr("substring(leaf, 1, depth)"))
        fits = each.groupBy("shard", "depth").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")).where(f"shard_bytes <= {int(limit)} or shard_docs = 1")
        best = each.select("leaf", "shard").join(fits.hint("merge"), "shard").groupBy("leaf").agg(F.min(F.struct("depth", "shard", "shard_docs", "shard_bytes")).alias("s"))
        known = written(best, "shard-directory")
        levels.append((depth, known))
        over = leaves.join(known.hint("merge"), "leaf", "left_anti").select("leaf")
        if depth >= BITS or over.isEmpty():
            break
        left = left.withColumn("leaf", prefix).join(over.hint("merge"), "leaf", "left_semi").drop("leaf")
        low, depth = depth + 1, min(BITS, depth + 8)
    out = rows
    for i, (d, known) in enumerate(levels):
        out = out.withColumn("leaf", F.substring("bits", 1, d) if d else F.lit("")).join(known.withColumnRenamed("s", f"s{i}").hint("merge"), "leaf", "left").drop("leaf")
    s = reduce(lambda a, b: F.coalesce(a, b), [F.col(f"s{i}") for i in range(len(levels))])
    return out.select(*keep, "doc_id", "n_bytes", s.alias("s")).select(*keep, "doc_id", "n_bytes", "s.shard", "s.depth", "s.shard_docs", "s.shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes every row of docs once, with all its columns, as one folder `<name>=s<bits>` for each shard; returns the name.

    The name is `shard`, with as many `_` behind it as it takes to differ from docs' columns. Rows get numbers in a table that is written
    first, and are joined with the plan by them, so ids can repeat and be null.
    """
    rows = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("place", F.monotonically_increasing_id()), "shard-rows")
    slim = rows.select("place", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").alias("text"))
    plan = plan_shards(slim, limit, keep=("place",)).select("place", F.concat(F.lit("s"), "shard").alias("shard"))
    name, taken = "shard", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    dealt = rows.join(plan, "place").select("row", "shard").repartition(partitions(docs.sparkSession), "shard")
    dealt.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.col("shard").alias(name)).write.partitionBy(name).parquet(path)
    return name


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """The shard of every document at SHARD_BYTES a shard."""
    return plan_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         array_to_string(list_transform(string_split(substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15), ''), lambda h: lpad(bin(strpos('0123456789abcdef', h) - 1), 4, '0')), '') AS bits
  FROM documents),
prefixes AS (SELECT doc_id, n_bytes, d.d AS depth, substr(bits, 1, d.d) AS shard FROM keyed, (SELECT unnest(range(0, 33)) AS d) d),
sized AS (SELECT shard, depth::INTEGER AS depth, count(*) AS shard_docs, sum(n_bytes)::BIGINT AS shard_bytes FROM prefixes GROUP BY ALL),
fit AS (
  SELECT p.doc_id, p.n_bytes, p.shard, s.depth, s.shard_docs, s.shard_bytes, row_number() OVER (PARTITION BY p.doc_id ORDER BY s.depth) AS k
  FROM prefixes p JOIN sized s ON p.shard = s.shard AND p.depth = s.depth WHERE s.shard_bytes <= {SHARD_BYTES} OR s.shard_docs = 1)
SELECT doc_id, n_bytes, shard, depth, shard_docs, shard_bytes FROM fit WHERE k = 1
"""
