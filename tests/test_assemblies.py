"""Reference tables of any size against brute force and against the expressions over three assemblies."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.functions import reference as R
from quern.operators import assemblies as A


def three(spark):
    return spark.createDataFrame([(a, c, n, i) for i, (a, v) in enumerate(R.LENGTHS.items()) for c, n in zip(R.CHROMS, v)], "assembly string, contig string, length long, rank int")


@pytest.mark.parametrize("tolerance", [1000, 0, 7])
def test_nearest_equals_brute_force(spark, tolerance):
    rng = random.Random(tolerance)
    refs = [(f"a{i}", rng.choice(["1", "chr2", "X", None]), rng.randrange(-2000, 40_000), rng.randrange(50)) for i in range(800)]
    asked = [(i, rng.choice(["chr1", "2", "X", "Y", None]), rng.choice([rng.randrange(-3000, 45_000), 500, None])) for i in range(1500)] + [(10_000 + i, "chr1", 777) for i in range(1000)]
    got = {r.i: r.assembly for r in A.nearest(spark.createDataFrame(asked, "i int, contig string, length long"), spark.createDataFrame(refs, "assembly string, contig string, length long, rank int"), tolerance).collect()}
    plain = lambda c: c and c.removeprefix("chr")
    for i, c, n in asked:
        near = min(((abs(length - n), rank, a) for a, rc, length, rank in refs if c and n is not None and plain(rc) == plain(c) and abs(length - n) <= tolerance), default=(None, None, None))
        assert got[i] == near[2], (c, n)
    assert len(got) == len({i for i, *_ in asked})


def test_three_assemblies_as_a_table(spark):
    rng = random.Random(3)
    lengths = [n for v in R.LENGTHS.values() for n in v]
    rows = [(i // 6, rng.choice(["chr", ""]) + R.CHROMS[j := rng.randrange(24)], rng.choice([v[j] for v in R.LENGTHS.values()]) + rng.choice([0, 0, 5, -900, 1000, 1001])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, contig string, length long")
    found = A.nearest(df.withColumn("plain", R.contig_vote(F.col("contig"), F.col("length"))), three(spark))
    assert found.where(~F.col("plain").eqNullSafe(F.col("assembly"))).count() == 0 and len(lengths) == 72
    voted = {r.k: (r.assembly, r.matches) for r in A.vote(found, "k").collect()}
    lists = found.groupBy("k").agg(F.collect_list(F.struct("plain")).alias("v")).select("k", R.vote_winner(F.transform("v", lambda x: x["plain"])).alias("w"))
    assert voted == {r.k: (r.w.assembly, r.w.matches) for r in lists.collect()}


@pytest.mark.parametrize("bundle", [250_000, 300])
def test_rule_out_equals_brute_force(spark, monkeypatch, bundle):
    monkeypatch.setattr(A, "BUNDLE", bundle)
    rng = random.Random(5)
    lengths = {f"a{i:04}": {c: rng.randrange(1000, 9000) for c in rng.sample(["1", "2", "3", "X"], rng.randint(1, 4))} for i in range(1500)}
    refs = spark.createDataFrame([(a, "chr" * (i % 2) + c, n, i) for i, (a, v) in enumerate(lengths.items()) for c, n in v.items()], "assembly string, contig string, length long, rank int")
    rows = [(k, "chr" + c, rng.choice([rng.randrange(500, 9900), 9400 + rng.randrange(100)])) for k in range(150) for c in rng.sample(["1", "2", "3", "X", "Y"], rng.randint(1, 5)) for _ in range(2)] + [(998, "1", None), (999, "other", 10**9)]
    got = {r.k: (r.n_left, r.assembly, r.evidence) for r in A.rule_out(spark.createDataFrame(rows, "k int, contig string, position long"), refs).collect()}
    for k in {k for k, *_ in rows}:
        most = {}
        for _, c, p in (r for r in rows if r[0] == k and r[2] is not None):
            most[c[3:]] = max(most.get(c[3:], 0), p)
        left = [a for a, v in lengths.items() if not any(c in most and most[c] > n + 500 for c, n in v.items())]
        evidence = sum(any(c in v and p > v[c] + 500 for v in lengths.values()) for c, p in most.items())
        assert got[k] == (len(left), left[0] if len(left) == 1 else None, evidence), k



def test_a_wide_band_is_gone_through_once(spark):
    """60,000 lengths and as many references in one band: a frame that shrinks to its end takes minutes for them."""
    n = 60_000
    refs = spark.range(n).selectExpr("concat('a', id) AS assembly", "'1' AS contig", "id * 2 AS length", "id AS rank")
    asked = spark.range(n).selectExpr("id AS i", "'chr1' AS contig", "id * 2 + 1 AS length")
    began = time.monotonic()
    got = A.nearest(asked, refs, tolerance=10_000_000).selectExpr("count(*) AS n", "count_if(assembly = concat('a', i)) AS low").first()
    assert got == (n, n) and time.monotonic() - began < 60


def test_a_file_meets_few_sets_of_many_assemblies(monkeypatch):
    """Work that grew with files times assemblies: with 64 times the assemblies, files look into some times the sets only."""
    looked, plain = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda bits: looked.append(len(bits)) or plain(bits))

    def run(n):
        refs = [(str(c), f"a{i}", 1_000_000 + (i * 7919 + c * 104_729) % 1_000_000) for i in range(n) for c in range(1, 8)]
        held = pa.table(dict(zip(("c", "assembly", "n"), zip(*refs))))
        rng = random.Random(1)
        files = [[{"c": str(c), "n": rng.randrange(1_000_000, 2_000_700)} for c in range(1, 1 + rng.randint(1, 7))] for _ in range(200)]
        looked.clear()
        left = next(A._ruled_out([pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(files), pa.array([0] * 200)], ["_key", "places", "evidence"])], str(n), held, 500)).column(1).to_pylist()
        for f, got in list(zip(files, left))[:5]:
            most = {p["c"]: p["n"] for p in f}
            assert got == n - len({a for c, a, x in refs if c in most and most[c] > x + 500})
        return sum(looked)

    assert 0 < run(64 * A.SET) < 16 * run(A.SET)
