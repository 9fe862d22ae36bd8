"""The paged source over ranges of keys, and downloads that go on where they stopped."""

import hashlib
import json
import os
from bisect import bisect_left, bisect_right
from pathlib import Path

import pytest

from quern.sources import paged

KEYS = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(3000)) + ["zz-odd"]
LOG = Path(os.environ.get("PAGED_LOG", "/nonexistent"))


def fetch(after, size, start):
    """A stand-in for an API: hits in the order of their keys, tokens are keys."""
    log = Path(os.environ["PAGED_LOG"])
    (log / f"{after or start or 'first'}-{os.getpid()}-{len(os.listdir(log))}").touch()
    at = bisect_right(KEYS, after[0]) if after else bisect_left(KEYS, start or "")
    if (log / "broken").exists() and KEYS[at] >= "80":
        raise OSError("the service is down")
    page = KEYS[at : at + size]
    return {"hits": [{"entryId": k, "files": [{"file_id": k}]} for k in page], "next": [page[-1]] if at + size < len(KEYS) else None}


@pytest.fixture
def log(tmp_path, spark):
    (tmp_path / "log").mkdir()
    root = str(Path(__file__).parent.parent)
    old = {k: spark.sparkContext.environment.get(k) for k in ("PAGED_LOG", "PYTHONPATH")}
    spark.sparkContext.environment["PAGED_LOG"] = os.environ["PAGED_LOG"] = str(tmp_path / "log")
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, old["PYTHONPATH"]) if x)
    yield tmp_path / "log"
    for k, v in old.items():
        spark.sparkContext.environment.pop(k) if v is None else spark.sparkContext.environment.update({k: v})


def ids(df):
    return sorted(json.loads(r.record)["entryId"] for r in df.collect())


def test_ranges_are_read_in_tasks(spark, log):
    spark.dataSource.register(paged.PagedSource)
    df = spark.read.format("paged").option("fetch", f"{__name__}:fetch").option("ranges", 8).option("size", 100).option("delay", 0).load()
    assert ids(df) == KEYS
    assert {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}.keys() == set(range(8))
    assert ids(spark.read.format("paged").option("fetch", f"{__name__}:fetch").option("bounds", '["5", "9"]').option("size", 7000).load()) == KEYS
    assert paged.hex_bounds(4) == ["40000000", "80000000", "c0000000"] and paged.hex_bounds(1) == []


def test_downloads_go_on(spark, log, tmp_path):
    how = {"fetch": f"{__name__}:fetch", "at_once": 4, "ranges": 16, "size": 50, "delay": 0}
    (log / "broken").touch()
    with pytest.raises(Exception, match="service is down"):
        paged.download(spark, str(tmp_path / "out"), **how)
    kept = ids(spark.read.parquet(str(tmp_path / "out" / "records")))
    assert kept == [k for k in KEYS if k < "80"]  # the ranges of the jobs that ended
    (log / "broken").unlink()
    for f in log.iterdir():
        f.unlink()
    assert ids(paged.download(spark, str(tmp_path / "out"), **how)) == KEYS
    assert not [f.name for f in log.iterdir() if f.name[0] in "01234567" or f.name.startswith("first")]  # nothing is asked for twice
    calls = len(list(log.iterdir()))
    assert ids(paged.download(spark, str(tmp_path / "out"), **how)) == KEYS and len(list(log.iterdir())) == calls
