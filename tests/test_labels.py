"""Labels without evidence against lists of claims, and how tables are dealt out to tasks."""

import random

from pyspark.sql import functions as F

from quern.operators import classify as C
from quern.operators import labels as L
from quern.operators.claims import last_reason, resolve
from quern.plans.compile import with_claims
from quern.plans.rules import FIELDS, RULES
from quern.sources import synthetic as S

SF = "/root/testdata/sf0.001"


def same(slim, full):
    a = slim.select("k", *[F.struct(f"classifications.{f}.value", f"classifications.{f}.status", f"classifications.{f}.why").alias(f) for f in FIELDS])
    b = full.select("k", *[F.struct(f"classifications.{f}.value", f"classifications.{f}.status", F.element_at(f"classifications.{f}.evidence", -1)["reason"].alias("why")).alias(f) for f in FIELDS])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_any_set_of_rules_is_labelled_as_its_claims_resolve(spark):
    rng = random.Random(5)
    rows = [(i, sorted(rng.sample(range(len(RULES)), rng.randrange(8))), rng.choice([".bam", ".cram", ".vcf"]), rng.choice([None, 8 * 10**9, 10**10, 3 * 10**10])) for i in range(1500)]
    matched = spark.createDataFrame(rows, "k int, matched array<int>, ext string, file_size long")
    slim = L.labelled(matched)
    own = C._inferred(with_claims(matched))
    full = own.select("k", F.struct(*[F.struct(resolve(f)["value"].alias("value"), resolve(f)["status"].alias("status"), last_reason(f, resolve(f)).alias("why")).alias(f) for f in FIELDS]).alias("classifications"))
    pick = lambda df: {r.k: r.classifications.asDict(True) for r in df.select("k", "classifications").collect()}
    a, b = pick(slim), pick(full)
    assert a == b and any(e["why"].startswith("top-tier") for r in a.values() for e in r.values())


def test_headers_and_archives_have_the_same_labels_without_evidence(spark):
    vcf = S.over(spark, SF, S.vcf_headers("spark"), "lineitem").select("k", F.concat(F.lit("s"), F.col("k"), F.lit(".vcf.gz")).alias("file_name"), "header_text")
    same(C.classify_variants(vcf, evidence=False), C.classify_variants(vcf))
    tar = S.over(spark, SF, S.member_names("spark"), "lineitem").select("k", F.concat(F.lit("a"), F.col("k"), F.lit(".tar.gz")).alias("file_name"), F.split("members", "\n").alias("member_names"))
    same(C.classify_archives(tar, evidence=False), C.classify_archives(tar))


def test_tasks_get_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert S.catalog(spark, SF).rdd.getNumPartitions() == -(-n // 100) > 4


def test_a_record_is_parsed_once(spark):
    from quern.operators import contract

    plan = spark.createDataFrame([("{}",)], "record string").select(contract.reasons(F.col("record")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert max(plan.count("parse_json("), plan.count("parsejson")) == 1
