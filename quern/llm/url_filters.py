"""URL filters as a sort-merge range join.

A url's host, its labels reversed and each ended by a dot, is its canonical key: `blog.example.org` -> `org.example.blog.`.
All hosts under a rule's host then lie in one interval of keys, from the rule's key to that key with its last dot raised
by one. Urls and rules are dealt to range buckets and sorted by key; a sweep over each bucket keeps a stack of the hosts
whose intervals hold the current key (intervals are nested or disjoint), and asks them for the longest rule whose path
begins the url's path.

Defined results. Null urls and urls without `://`: host and path empty, no rule. Repeated urls: a row each. Rules given
twice: one of them (block before allow). Two rules of one length that both fit: the one with the longer host. No pages:
an empty result; no rules: the default verdict everywhere. Other columns of the pages are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bounds_below, bucket_of, partitions, range_bounds

#: The rules of the query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: What holds for a url that no rule fits: a filter blocks only what it lists.
DEFAULT = "allow"

AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), AZ, az)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(batches, default: str):
    """Rows sorted by bucket and key, a key's rules before its urls."""
    names = ["page_id", "host", "path", "rule", "verdict"]
    bucket, stack = None, []  # of (key, {path: (rule, verdict)}, lengths of the paths, longest first)
    for b in batches:
        out = {n: [] for n in names}
        cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for bk, key, is_url, page_id, host, path, verdict in zip(*cols):
            if bk != bucket:
                bucket, stack = bk, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                held = stack[-1][1]
                if path not in held or verdict == "block":
                    held[path] = (host + path, verdict)
                    stack[-1][2][:] = sorted({*map(len, held)}, reverse=True)
                continue
            best = (None, default)
            for _, held, lengths in stack:  # from the shortest host to the longest
                for n in lengths:
                    found = held.get(path[:n]) if n <= len(path) else None
                    if found:
                        if best[0] is None or len(found[0]) >= len(best[0]):
                            best = found
                        break
            for n, v in zip(names, (page_id, host, path, *best)):
                out[n].append(v)
        yield pa.RecordBatch.from_pydict({"page_id": pa.array(out["page_id"], pa.int64())} | {n: pa.array(out[n], pa.string()) for n in names[1:]})


def judge_urls(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]], default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url", rows_per_bucket: int = 20_000) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every row of pages.

    rules: (host, path, verdict) rows or a frame of three such columns; they may be many, as they are dealt out with the
    urls. A rule goes to every bucket that its interval meets, so a rule for a whole top-level domain is repeated once a
    bucket, not once a url; a hot host takes several buckets.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")).withColumn("key", host_key(F.col("host")))
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.toDF("host", "path", "verdict").where("host is not null and path is not null and verdict is not null").withColumn("key", host_key(F.lower("host")))
    n = urls.count()
    bounds = range_bounds(urls, "key", max(1, min(16_384, max(partitions(spark), n // rows_per_bucket))), n)
    tie = F.monotonically_increasing_id()
    dealt = urls.select(bucket_of(F.col("key"), bounds, tie).alias("bucket"), "key", F.lit(True).alias("is_url"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    low = bucket_of(F.col("key"), bounds, F.lit(0))
    if bounds:
        low = bounds_below(bounds, lambda b: b < F.col("key"))
        end = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
        high = bounds_below(bounds, lambda b: b <= end)
    else:
        low = high = F.lit(0)
    spread = rules.withColumn("bucket", F.explode(F.sequence(low, high))).select("bucket", "key", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    both = dealt.unionByName(spread).repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "key", "is_url", "path")
    return both.mapInArrow(lambda it: _sweep(it, default), "page_id long, host string, path string, rule string, verdict string")


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page's url under RULES."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), RULES)


ORACLE = """
WITH rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
urls AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
fit AS (
  SELECT n, rh || rp AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM urls JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fit WHERE k = 1) f USING (n)
"""
