"""URL filters, sharding and mixing against brute force, with nulls, ties, repeats, empty tables and odd columns."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quern.llm import mixing, sharding, url_filters
from quern.llm.shared import repeatable, shared_path


def judged(url, rules):
    head, sep, rest = (url or "").partition("://")
    cut = min([len(rest), *(i for i in map(rest.find, "/?#") if i >= 0)]) if sep else 0
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:] if sep else ""
    path = tail[: min([len(tail), *(i for i in map(tail.find, "?#") if i >= 0)])]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, url_filters.DEFAULT))
    return host, path, best[2], best[3]


def test_urls_match_brute_force(spark):
    rng = random.Random(5)
    hosts = ["example.org", "a.example.org", "B.Example.ORG", "example.com", "org", "notexample.org", "x.y.com", "", "a..b", "éa.org", "com"]
    paths = ["", "/", "/es/", "/es/x?y#z", "/en/1", "/en/12", "/fr/", "/de/q", "?a=/fr/", "#://org/", "/ES/", "\n/fr/"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + [None, "", "no url", "://org/", "x" * 50_000, "http://org/" + "y" * 50_000]
    urls += ["https://example.org/es/1"] * 300  # a hot host
    rules = [*url_filters.RULES, ("example.org", "/es/x", "allow"), ("a.example.org", "/", "block")]
    for given in (url_filters.RULES, rules, []):
        df = spark.createDataFrame([(i if i % 7 else None, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
        got = url_filters.judge_urls(df, given, rows_per_bucket=50).collect()
        want = Counter((i if i % 7 else None, *judged(u, given)) for i, u in enumerate(urls))
        assert Counter(tuple(r) for r in got) == want


def test_no_pages(spark):
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_filters.RULES).count() == 0


def test_shards_fit_and_hold_everything(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 60)) for i in range(300)] + [(7, "same")] * 200 + [(None, "x"), (None, None), (1000, "y" * 5000), (1001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).withColumn("bits", F.lit(1))
    got = sharding.plan_shards(df, limit=900).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t in rows)
    size, docs = Counter(), Counter()
    for r in got:
        size[r.shard] += r.n_bytes
        docs[r.shard] += 1
    assert all(size[s] <= 900 or docs[s] == 1 for s in size)
    assert {r.shard: (r.shard_bytes, r.shard_docs, r.depth) for r in got} == {s: (size[s], docs[s], len(s)) for s in size}
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no shard lies in another


def test_a_shard_splits_only_where_it_must(spark):
    df = spark.createDataFrame([(i, "x" * 10) for i in range(64)], "doc_id long, text string")
    got = sharding.plan_shards(df, limit=100)
    total = {r.shard: r.b for r in got.groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()}
    for s in total:  # the shard that it came from did not fit
        assert not s or sum(b for t, b in total.items() if t.startswith(s[:-1])) > 100
    assert sharding.plan_shards(df.limit(0)).count() == 0


def brute_schedule(units):
    period, done, out = sum(u for _, u in units), [0] * len(units), []
    for t in range(period):
        ready = [(-(-(done[i] + 1) * period // u), i) for i, (_, u) in enumerate(units) if done[i] < u and done[i] * period // u <= t]
        _, i = min(ready)
        out.append(units[i][0])
        done[i] += 1
    return out


def test_schedule_is_pfair(spark):
    for units in ([("a", 1), ("b", 1)], [("a", 50), ("b", 10), ("c", 10), ("d", 10), ("e", 10), ("f", 10)], [(None, 3), ("", 4), ("z", 93)], [("a", 7)]):
        rows = mixing.schedule(spark.createDataFrame(units, "source string, units int")).orderBy("slot").collect()
        assert [r.source for r in rows] == brute_schedule(sorted(units, key=lambda x: (x[0] is not None, x[0] or "")))
        period, seen = sum(u for _, u in units), Counter()
        for t, r in enumerate(rows, 1):
            seen[r.source] += 1
            assert r.release <= r.slot < r.deadline
            assert all(abs(seen[s] - t * u / period) < 1 for s, u in units)


def test_mix_places_every_document_once(spark):
    rows = [(i, "hot" if i % 3 else "b") for i in range(500)] + [(5, "hot")] * 40 + [(None, "b"), (900, None), (901, "unweighted")]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("clash"))
    w = spark.createDataFrame([("hot", 3), ("b", 2), (None, 1)], "source string, units int")
    got = mixing.mix_sources(df, w, block=4).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    assert all(r.slot is None for r in got if r.source == "unweighted")
    placed = [(r.slot, r.in_block) for r in got if r.source != "unweighted"]
    assert len({*placed}) == len(placed)
    order = [r.source for r in sorted((r for r in got if r.slot is not None), key=lambda r: (r.slot, r.in_block))]
    n, seen = Counter(s for _, s in rows), Counter()
    for t, s in enumerate(order, 1):  # as long as no source has run out, each is less than one block off its share
        seen[s] += 1
        if any(seen[x] == n[x] for x in ("hot", "b", None)):
            break
        assert all(abs(seen[x] - t * u / 6) < 4 + 1e-9 for x, u in (("hot", 3), ("b", 2), (None, 1)))
    assert mixing.mix_sources(df.limit(0), w).count() == 0


def test_more_sources_than_a_folded_period(spark):
    for units in ([("a", 50), ("b", 10), ("c", 10), (None, 13), ("", 10)], [("a", 9), *((f"s{i}", 1) for i in range(40))]):
        df = spark.createDataFrame(units, "source string, units int")
        heaped, folded = (mixing.schedule(df, n).orderBy("slot").collect() for n in (1, 1000))
        assert heaped == folded
    n = 21_000
    df = spark.range(n + 6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n, F.concat(F.lit("host"), F.col("id"))).otherwise("hot").alias("source"))
    got = mixing.mix_sources(df, mixing.tempered_units(df))
    assert got.count() == n + 6000 and got.where("slot is null").count() == 0
    assert got.select("slot", "in_block").distinct().count() == n + 6000 and got.where("slot < release or slot >= deadline").count() == 0


def test_written_shards_hold_every_row_once(spark):
    rows = [(1, "a" * 10, "x", 0), (1, "b" * 900, "x", 1), (2, "c" * 40, None, 2), (None, "d" * 300, "y", 3), (None, None, "y", 4)] + [(7, f"{i}" * 30, "z", 5) for i in range(200)] + [(i, "t" * 50, "s1", 6) for i in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, place int").withColumn("Shard_", F.col("place")).repartition(3)
    path = shared_path(spark, "test-shards")
    name = sharding.write_shards(docs, path, 2000)
    assert name == "shard__"
    back = spark.read.parquet(path)
    assert sorted(map(str, (tuple(r)[:5] for r in back.select("doc_id", "text", "shard", "place", "Shard_").collect()))) == sorted(map(str, ((*r, r[3]) for r in rows)))
    for r in back.groupBy(name).agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect():
        assert (r.b or 0) <= 2000 or r.n == 1
    assert sharding.write_shards(spark.createDataFrame(rows, "doc_id long, text string, label string, n int"), shared_path(spark, "test-shards"), 500) == "shard"


def test_repeatable_inputs(spark):
    path = shared_path(spark, "test-repeatable")
    spark.range(100).selectExpr("id AS doc_id", "cast(id AS string) AS text").write.parquet(path)
    docs = spark.read.parquet(path)
    assert repeatable(docs.where("doc_id > 3").select("doc_id", F.upper("text").alias("text"))) and repeatable(spark.createDataFrame([(1, "a")], "doc_id long, text string").limit(0)) is False
    odd = F.udf(lambda x: x, "string").asNondeterministic()
    for df in (docs.limit(5), docs.repartition(3), docs.distinct(), docs.withColumn("text", odd("text")), docs.where(F.rand() < 0.5), docs.join(docs.select("doc_id"), "doc_id"), docs.sample(0.5), docs.orderBy("text")):
        assert not repeatable(df)
