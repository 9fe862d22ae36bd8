"""JSON envelopes cut in byte ranges against a plain parser."""

import json
import random

import pytest

from quern.sources import envelopes, records


def nested(rng, depth=0):
    kinds = [lambda: rng.choice(["", "a", 'q"q', "back\\slash", '\\"', "}{][,", '"files": [', "é🙂\n", "x" * rng.randrange(60), '\\\\"']), lambda: rng.randrange(-5, 10**12), lambda: rng.choice([True, False, None, 1.5])]
    if depth < 3:
        kinds += [lambda: [nested(rng, depth + 1) for _ in range(rng.randrange(4))], lambda: {rng.choice(["files", "results", "k", 'a"b', "}"]): nested(rng, depth + 1) for _ in range(rng.randrange(4))}] * 2
    return rng.choice(kinds)()


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    yield lambda n: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "0")]
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(k, old[k]) if k in old else spark.conf.unset(k)


def read(spark, path, **how):
    return sorted(json.dumps(json.loads(r.record), sort_keys=True) for r in records.read_envelope(spark, str(path), **how).collect())


def test_records_equal_a_parser_at_any_range(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    for case, (n, size, style) in enumerate([(300, 700, {}), (300, 701, {"indent": 1}), (40, 37, {"separators": (",", ":")}), (200, 5000, {"ensure_ascii": False}), (6, 64, {}), (0, 64, {}), (1, 16, {})]):
        rows = [nested(rng) for _ in range(n)] + ([{"id": 1, "text": "y" * 3000}] if case != 5 else [])
        rng.shuffle(rows)
        key = rng.choice(["files", "results"])
        body = {"meta": {"files": [1, {"results": []}], "note": '"results": [3'}, **({"files": [7]} if key == "results" and case % 2 else {}), key: rows, "after": [{"files": [2]}]}
        (tmp_path / f"e{case}.json").write_text(json.dumps(body, **style) + "\n" * (case % 2), encoding="utf-8")
        small_ranges(size)
        assert read(spark, tmp_path / f"e{case}.json") == sorted(json.dumps(r, sort_keys=True) for r in rows), case
    (tmp_path / "list.json").write_text(json.dumps(rows := [nested(rng) for _ in range(99)], indent=2))
    small_ranges(400)
    assert read(spark, tmp_path / "list.json", lenient=True) == sorted(json.dumps(r, sort_keys=True) for r in rows)


def test_other_ranges_at_the_second_reading(spark, tmp_path, small_ranges, monkeypatch):
    rows = [{"id": i} for i in range(500)]
    (tmp_path / "e.json").write_text(json.dumps({"files": rows}))
    small_ranges(700)
    real, sizes = envelopes.once, [300, 300, 300, 300]

    def shifting(df, name):  # a range's size changes after the first pass
        out = real(df, name)
        if name == "envelope-ranges" and sizes:
            small_ranges(sizes.pop())
        return out

    monkeypatch.setattr(envelopes, "once", shifting)
    assert read(spark, tmp_path / "e.json") == sorted(json.dumps(r) for r in rows)
    assert sizes == [300, 300]  # the first try was thrown away
    sizes[:] = [900, 800, 650]
    with pytest.raises(ValueError, match="other ranges"):
        read(spark, tmp_path / "e.json")


def test_many_files_and_states_joined_by_sorting(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(envelopes, "MOST_BROADCAST", 0)
    rows = [[{"id": f"{f}-{i}", "x": "}" * (i % 5)} for i in range(200)] for f in range(3)]
    (tmp_path / "in").mkdir()
    for f, own in enumerate(rows):
        (tmp_path / "in" / f"{f}.json").write_text(json.dumps({"files": own}))
    small_ranges(900)
    assert read(spark, tmp_path / "in") == sorted(json.dumps(r, sort_keys=True) for own in rows for r in own)


@pytest.mark.parametrize("body,why", [('{"files": 3}', "no list"), ('{"x": []}', "no list"), ("[1]", "no list"), ("3", "no list"), ('{"results": null, "files": []}', "no list"), ('{"files": [1, 2', "whole"), ('{"files": ["a', "whole")])
def test_faulty_envelopes_are_errors(spark, tmp_path, body, why):
    (tmp_path / "e.json").write_text(body)
    with pytest.raises(Exception, match=why):
        records.read_envelope(spark, str(tmp_path / "e.json")).collect()
