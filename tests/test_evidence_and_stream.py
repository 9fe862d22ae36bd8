"""The bucketed table of evidence, and the stream that drops repeats."""

import json
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from quern.sources.evidence import EvidenceTable
from quern.streaming.ingest import ingest

RECORD = {"entry_id": "e", "file_id": "f", "file_name": "a.bam", "file_format": ".bam", "file_size": 1, "file_md5sum": "0" * 32, "drs_uri": "drs://x", "dataset_id": "d", "dataset_title": "t", "is_supplementary": False}


@pytest.fixture
def table(spark):
    made = []

    def make(schema, **how):
        made.append(f"ev_{uuid.uuid4().hex[:12]}")
        return EvidenceTable(spark, made[-1], schema, buckets=8, **how)

    make.made = made
    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_evidence_is_joined_where_it_lies(spark, table):
    t = table("header_text string, lines array<string>")
    at = lambda s: F.lit(f"2026-01-01 00:00:{s:02}").cast("timestamp")
    first = spark.createDataFrame([(f"m{i}", f"h{i}", ["a", None]) for i in range(100)] + [("m100", "", []), (None, "x", [])], "file_md5sum string, header_text string, lines array<string>")
    t.append(first.withColumn("fetched_at", at(1)))
    t.append(spark.createDataFrame([("m1", "newer", ["b"])], first.schema).withColumn("fetched_at", at(3)))
    t.append(spark.createDataFrame([("m1", "older", ["c"])], first.schema).withColumn("fetched_at", at(2)))
    bad = [("m2", "{"), ("m3", '{"header_text": {"x": 1}, "lines": 3}'), ("m4", '{"lines": []}'), ("m5", "[1]"), ("m6", None), ("bad", "nothing")]
    spark.createDataFrame(bad, "file_md5sum string, payload string").withColumn("fetched_at", at(9)).write.format("parquet").bucketBy(8, "file_md5sum").sortBy("file_md5sum").mode("append").saveAsTable(t.name)
    files = spark.createDataFrame([(f"m{i}", i) for i in range(120)] + [("bad", 500), (None, 501), ("m1", 502)], "file_md5sum string, n int")
    for store in (t, t.compact(t.name + "_c")):
        table.made.append(store.name)
        found, lost = store.split(files)
        got = {r.n: (r.header_text, r.lines) for r in found.collect()}
        assert got[1] == got[502] == ("newer", ["b"]) and got[2] == ("h2", ["a", None]) and len(got) == 101
        assert sorted(r.n for r in lost.collect()) == [*range(100, 120), 500, 501]
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = store.split(files)[0]._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        right = plan[plan.index("SortMergeJoin") :]
        assert right.count("Exchange") == 1 and "Bucketed: true" in right  # the files' alone
    assert spark.table(t.name + "_c").count() == 100


def test_empty_payloads(spark, table):
    for empty, hits in ((False, 1), (True, 2)):
        t = table("members array<string>", may_be_empty=empty)
        t.append(spark.createDataFrame([("a", ["x"]), ("b", [])], "file_md5sum string, members array<string>"))
        found, lost = t.split(spark.createDataFrame([("a",), ("b",)], "file_md5sum string"))
        assert found.count() == hits and lost.count() == 2 - hits


def test_stream_drops_repeats_across_batches_and_restarts(spark, tmp_path):
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    hour = 3600
    start = time.time() - 10 * hour

    def arrive(name, at, *keys):
        path = src / name
        path.write_text("\n".join(json.dumps(RECORD | {"file_md5sum": f"{k:032x}", "entry_id": f"{name}-{k}", "dataset_id": d}) for k, d in keys) + "\n")
        os.utime(path, (start + at, start + at))

    def run():
        ingest(spark, str(src), out, check, distinct="1 hour", max_files=1).awaitTermination()
        return sorted((int(r.file_md5sum, 16), r.dataset_id) for r in spark.read.parquet(out).collect())

    arrive("a", 0, (1, "d"), (1, "d"), (2, "d"), (1, "other"))
    arrive("b", 60, (2, "d"), (3, "d"))
    assert run() == [(1, "d"), (1, "other"), (2, "d"), (3, "d")]
    arrive("c", 120, (1, "d"), (3, "d"), (4, "d"))  # after a restart
    assert run() == [(1, "d"), (1, "other"), (2, "d"), (3, "d"), (4, "d")]
    arrive("d", 6 * hour, (5, "d"))
    assert run()[-1] == (5, "d")
    arrive("e", 6 * hour + 60, (1, "d"), (5, "d"))  # long after: 1 is forgotten, 5 isn't
    assert run() == [(1, "d"), (1, "d"), (1, "other"), (2, "d"), (3, "d"), (4, "d"), (5, "d")]
    arrive("f", 60, (9, "d"))  # older than the watermark
    assert (9, "d") not in run()
