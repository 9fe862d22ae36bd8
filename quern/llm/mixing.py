"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Weights are whole units that sum to a period. A source of u units has u blocks a period; its i-th block (from 0) is released
at floor(i * period / u) and due at ceil((i + 1) * period / u). One slot after the other, the released block with the earliest
deadline runs. As the weights fill the period, every block meets its deadline, so in every prefix of the schedule each source
is less than one block away from its target share. The schedule repeats after a period, so one period is computed, and every
other block's slot follows by arithmetic: no list of blocks passes one task. A period of at most FOLDED slots is one folded
expression; a longer one, as very many sources make it, is the same schedule run by a heap in one task, whose time and
memory grow with the sources and their units, not with the documents.

Documents stand in a source in the order of a hash of their ids. Their numbers come from counts of hash buckets and
row numbers in each bucket, so a hot source is many small windows.

Defined results. Every document gets a slot, none is dropped or repeated; once a source has run out, its slots stay empty
and the others go on at their weights. A null source is a source of its own. A source without a weight gets no slot
(null), as its target share is none; weights of null or below one unit, likewise. Null and repeated ids: a row each.
Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import partitions, written
from .spread import with_key

#: Documents in a block.
BLOCK = 16
#: Units that tempered_units() deals out, about; and the slots of the longest period that is folded, not run by a heap.
UNITS, FOLDED = 1000, 20_000
#: Parts that a source's documents are dealt to when there are too many sources for a broadcast.
SALTS = 32


def tempered_units(docs: DataFrame, source_col: str = "source", power: float = 0.5, units: int = UNITS) -> DataFrame:
    """source, units: shares in proportion to the sources' counts to a power; every source gets one unit at least."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    share = F.pow(F.col("n").cast("double"), F.lit(float(power)))
    whole = counts.agg(F.sum(F.floor(share * 1000))).first()[0] or 1
    return counts.select("source", F.greatest(F.lit(1), F.floor(F.lit(units) * F.floor(share * 1000) / F.lit(whole) + 0.5)).cast("int").alias("units"))


def _heaped(batches, period: int, rows: int = 50_000):
    """schedule()'s rows, from source and units in the order of the sources."""
    table = pa.Table.from_batches(list(batches)).combine_chunks()
    if not table.num_rows:
        return
    u = table.column(1).to_pylist()
    done, waiting, ready, out = [0] * len(u), [(0, n) for n in range(len(u))], [], []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            n = heappop(waiting)[1]
            heappush(ready, (-(-(done[n] + 1) * period // u[n]), n))
        due, n = heappop(ready)
        out.append((n, done[n], done[n] * period // u[n], due, t))
        done[n] += 1
        if done[n] < u[n]:
            heappush(waiting, (done[n] * period // u[n], n))
        if len(out) == rows or t == period - 1:
            n, i, release, due, slot = (pa.array(c, pa.int32()) for c in zip(*out))
            taken = table.take(n)
            source = taken.column(0).combine_chunks()
            source = source if isinstance(source, pa.Array) else pa.concat_arrays(source.chunks)
            yield pa.RecordBatch.from_arrays([source, taken.column(1).combine_chunks(), pa.array([period] * len(n), pa.int32()), i, release, due, slot], ["source", "units", "period", "i", "release", "deadline", "slot"])
            out = []


def schedule(weights: DataFrame, folded: int = FOLDED) -> DataFrame:
    """source, units, period, i, release, deadline, slot: one period of earliest-deadline-first over released blocks."""
    good = weights.where("units >= 1").select("source", F.col("units").cast("int").alias("units"))
    period = good.agg(F.sum("units")).first()[0] or 0
    if period > folded:
        one = good.withColumn("named", F.col("source").isNotNull()).repartition(1).sortWithinPartitions("named", "source").select("source", "units")
        kind = good.schema["source"].dataType.simpleString()
        return one.mapInArrow(lambda it: _heaped(it, period), f"source {kind}, units int, period int, i int, release int, deadline int, slot int")
    # one row of at most FOLDED sources: sorted by name, the null source first
    one = good.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNotNull().alias("named"), "source", "units"))).alias("s"))
    p = F.lit(int(period))

    def run(t, state):
        def block(x, n):
            k = state["k"][n]
            due = F.floor(((k + 1) * p + x["units"] - 1) / x["units"]).cast("int")
            ready = (k < x["units"]) & (F.floor(k * p / x["units"]) <= t)
            return F.when(ready, F.struct(due.alias("due"), n.alias("n")))

        pick = F.array_min(F.transform(F.col("s"), block))["n"]
        return F.struct(F.transform(state["k"], lambda k, n: F.when(n == pick, k + 1).otherwise(k)).alias("k"), pick.alias("pick"), t.alias("t"))

    slots = one
    # the fold keeps the picks so far; a struct of counters and picks
    start = F.struct(F.transform(F.col("s"), lambda x: F.lit(0)).alias("k"), F.array().cast("array<int>").alias("picks"))

    def step(state, t):
        done = run(t, state)
        return F.struct(done["k"].alias("k"), F.concat(state["picks"], F.array(done["pick"])).alias("picks"))

    picks = F.aggregate(F.sequence(F.lit(0), F.lit(int(period) - 1)), start, step)["picks"] if period else F.array().cast("array<int>")
    slots = one.select("s", F.posexplode(picks).alias("slot", "n")).select("slot", F.col("s")[F.col("n")].alias("x")).select("slot", "x.source", "x.units", "x.named")
    i = F.row_number().over(Window.partitionBy("named", "source").orderBy("slot")) - 1
    return slots.withColumn("i", i).select("source", "units", p.alias("period"), "i", F.floor(F.col("i") * p / F.col("units")).cast("int").alias("release"), F.floor(((F.col("i") + 1) * p + F.col("units") - 1) / F.col("units")).cast("int").alias("deadline"), "slot")


def numbered(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """doc_id, source, key, nth: the place (from 0) of every document in its source."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"))
    rows = written(with_key(slim, "doc_id"), "mix-keys")
    n = rows.count()
    digits = max(1, min(4, math.ceil(math.log(max(partitions(docs.sparkSession) * 4, n / 5000), 16))))
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    sizes = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("key", "doc_id")) - 1
    b = before.select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), "before")
    own = rows.withColumn("place", place)
    return own.join(b, own["source"].eqNullSafe(b["__s"]) & (own["bucket"] == b["__b"])).select("doc_id", "source", "key", (F.col("before") + F.col("place")).alias("nth"))


def mix_sources(docs: DataFrame, weights: DataFrame, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """doc_id, source, block, in_block, release, deadline, slot: the mix is docs in the order of slot, in_block.

    weights: source, units (whole numbers).
    """
    plan = written(schedule(weights), "mix-schedule")
    rows = numbered(docs, id_col, source_col).withColumn("block", F.floor(F.col("nth") / block)).withColumn("in_block", (F.col("nth") % block).cast("int"))
    units = plan.where("i = 0").select(F.col("source").alias("__u"), "units", "period")
    at = plan.select(F.col("source").alias("__s"), F.col("i").alias("__k"), "release", "deadline", "slot")
    same = F.col("source").eqNullSafe(F.col("__u"))
    if plan.count() > FOLDED:  # too many for a broadcast: a hot source's documents are dealt out
        units = units.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same &= F.pmod(F.xxhash64("key"), F.lit(SALTS)) == F.col("__part")
    else:
        units, at = F.broadcast(units), F.broadcast(at)
    rows = rows.join(units, same, "left").withColumn("__i", (F.col("block") % F.col("units")).cast("int"))
    rows = rows.join(at, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__i") == F.col("__k")), "left")
    base = F.floor(F.col("block") / F.col("units")) * F.col("period")
    return rows.select("doc_id", "source", "block", "in_block", *[(base + F.col(c)).cast("long").alias(c) for c in ("release", "deadline", "slot")])


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed to square-root tempered shares of their sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix_sources(docs, tempered_units(docs))


ORACLE = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
whole AS (SELECT sum(floor(pow(n::DOUBLE, 0.5) * 1000)) AS a FROM counts),
weights AS (SELECT source, greatest(1, floor({UNITS} * floor(pow(n::DOUBLE, 0.5) * 1000) / a + 0.5))::INTEGER AS units FROM counts, whole),
ordered AS (SELECT source, units, row_number() OVER (ORDER BY source NULLS FIRST) AS n FROM weights),
lists AS (SELECT list(units ORDER BY n) AS u, sum(units)::INTEGER AS p, count(*)::INTEGER AS c FROM ordered),
run(t, k, pick) AS (
  SELECT -1, list_transform(u, lambda x: 0), 0 FROM lists
  UNION ALL
  SELECT t + 1, list_transform(range(1, c + 1), lambda n: k[n] + (n = pick)::INTEGER), pick FROM (
    SELECT t, k, u, p, c, list_min(list_filter(list_transform(range(1, c + 1), lambda n:
      CASE WHEN k[n] < u[n] AND (k[n] * p) // u[n] <= t + 1 THEN ((k[n] + 1) * p + u[n] - 1) // u[n] * 100000 + n END), lambda x: x IS NOT NULL)) % 100000 AS pick
    FROM run, lists WHERE t + 1 < p)),
slots AS (SELECT source, units, p, t AS slot, row_number() OVER (PARTITION BY source ORDER BY t) - 1 AS i FROM run JOIN ordered ON pick = n, lists WHERE t >= 0),
nth AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15), doc_id) - 1 AS nth FROM documents),
blocks AS (SELECT doc_id, source, nth // {BLOCK} AS block, (nth % {BLOCK})::INTEGER AS in_block FROM nth)
SELECT doc_id, b.source, block, in_block,
       block // units * p + (i * p) // units AS release, block // units * p + ((i + 1) * p + units - 1) // units AS deadline, block // units * p + slot AS slot
FROM blocks b JOIN slots s ON b.source IS NOT DISTINCT FROM s.source AND block % units = i
"""
