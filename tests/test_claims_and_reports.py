"""Claims in long tables, bounded samples, reports from one scan, tallies taken by the write, stored outputs, rules from a file."""

import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from quern.operators import classify as C
from quern.operators import report
from quern.operators.claims import markers, resolve, resolve_rows
from quern.operators.samples import first_of_groups
from quern.plans import documents, kinds, rules_file
from quern.plans.compile import CLAIM
from quern.plans.rules import FIELDS
from quern.plans.run import classify_catalog
from quern.sources import heads, sinks

NA, NC = "not_applicable", "not_classified"


def test_rows_resolve_as_lists_do(spark):
    rng = random.Random(4)
    cases = [[(rng.choice([1, 2, 3, 4]), rng.choice(["A", "B", "C", NA, NC, NC])) for _ in range(rng.choice([1, 1, 2, 3, 4, 7]))] for _ in range(400)] + [[(None, "A"), (None, "A")], [(None, NC), (2, "A")]]
    rows = [(i, j, t, None if d in (NA, NC) else d, d if d in (NA, NC) else None, None) for i, c in enumerate(cases) for j, (t, d) in enumerate(c)] + [(-1, 0, None, None, NC, "conflict"), (None, 0, 1, "A", None, None)]
    long = spark.createDataFrame(rows, "i int, j int, tier int, value string, status string, marker string")
    got = {r.i: (r.value, r.status, r.reason, r.competing, r.n_claims) for r in resolve_rows(long, ["i"]).collect()}
    lists = long.groupBy("i").agg(F.collect_list(F.struct(F.lit("r").alias("rule_id"), F.lit("").alias("reason"), "tier", "value", "status", "marker", F.lit(None).cast("array<string>").alias("competing_values")).cast(CLAIM)).alias("claims"))
    want = {r.i: (r.r.value, r.r.status, r.r.reason, r.r.competing, r.n) for r in lists.select("i", resolve("claims").alias("r"), F.size(F.filter("claims", lambda c: c["marker"].isNull())).alias("n")).collect()}
    assert got == want and got[-1] == (None, NC, "no_claims", None, 0)
    marked = {r.i: r.marker for r in markers(resolve_rows(long, ["i"]), ["i"]).collect()}
    assert marked == {i: "conflict" if w[2] == "conflict" else NC for i, w in want.items() if w[2] in ("conflict", "no_claims")}
    with pytest.raises(Exception, match="no tier"):
        resolve_rows(spark.createDataFrame([(1, None, "A", None), (1, 2, "B", None)], "i int, tier int, value string, status string"), ["i"]).collect()
    assert resolve_rows(long.limit(0), ["i"]).collect() == []


def test_a_hot_file_is_a_few_rows_before_the_shuffle(spark):
    n = 1_000_000
    claims = spark.range(0, n, 1, 8).select((F.col("id") % 10 < 9).cast("int").alias("hot"), (1 + F.col("id") % 3).cast("int").alias("tier"), F.element_at(F.array(*map(F.lit, "ABC")), (1 + F.col("id") % 3).cast("int")).alias("value"), F.lit(None).cast("string").alias("status"))
    found = resolve_rows(claims, ["hot"])
    assert {(r.hot, r.value, r.n_claims) for r in found.collect()} == {(1, "C", n * 9 // 10), (0, "C", n // 10)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") and "collect_list" not in plan
    before = claims.groupBy("hot", "tier", "value").count()
    assert before.count() == 6


def test_first_of_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc") if i % 50 else None, f"{rng.randrange(500):03}" if i % 7 else None) for i in range(5000)]
    got = {r.g: (r.n, r.first) for r in first_of_groups(spark.createDataFrame(rows, "g string, v string").repartition(6), ["g"], "v", 5).collect()}
    want = {g: (sum(x == g for x, _ in rows), sorted({v for x, v in rows if x == g and v is not None})[:5]) for g in {g for g, _ in rows}}
    assert got == want
    assert first_of_groups(spark.createDataFrame([], "g string, v string"), ["g"], "v", 5).collect() == []


def test_archives_are_read_until_they_tell(spark, tmp_path):
    def put(name, members):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as t:
            for n, size in members:
                info = tarfile.TarInfo(n)
                info.size = size
                t.addfile(info, io.BytesIO(random.Random(size).randbytes(size)))
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.tar").write_bytes(out.getvalue())
        return heads.read_heads(spark, str(tmp_path / name), "tar").first().lines

    late = [("w/genes.tdb", 300 << 10), ("w/__array_schema.tdb", 500 << 10), ("w/x", 900 << 10), ("w/PL_var.tdb/a", 10), ("w/y", 3 << 20), ("w/z", 1)]
    assert "w/PL_var.tdb/a" in put("late", late)
    assert "z" not in put("early", [("a.bam", 300 << 10), ("b", 400 << 10), ("c", 2 << 20), ("z", 1)])
    assert heads.telling(["w/GT.tdb"]) and heads.telling(["w/callset.json"]) and heads.telling(["d/a.BED.gz.zip"]) and heads.telling(["a.h5ad"])
    assert not heads.telling(["w/genes.tdb", "x.bam/notes", "__array_schema.tdb"]) and not heads.telling([])


def classified(spark, evidence=True):
    names = ["a_wgs.bam", "b.vcf.gz", "c.svs", "d.md5", "e", "f_rnaseq.bam", "g.hg19.GRCh38.bam", "h.fastq.gz"] * 5
    df = spark.createDataFrame([(f"e{i}", n, f"m{i}", 10**9 * i) for i, n in enumerate(names)], "entry_id string, file_name string, file_md5sum string, file_size long").withColumns({"file_format": F.lit(""), "dataset_title": F.lit("t")})
    return C.classify(df, evidence=evidence)


def test_reports_from_one_scan(spark):
    both = [classified(spark, e) for e in (True, False)]
    counts = [sorted(map(tuple, report.all_counts(c).collect()), key=str) for c in both]
    assert counts[0] == counts[1]
    rows = both[0].select("file_name", *[report.label(f).alias(f) for f in FIELDS]).collect()
    n = {}
    for r in rows:
        for f in FIELDS:
            n[f, r[f]] = n.get((f, r[f]), 0) + 1
    assert {(r[1], r[2]): r[5] for r in counts[0] if r[0] == "label"} == n
    for r in report.coverage(both[1]).collect():
        assert (r.total, r.not_classified) == (40, sum(v for (f, x), v in n.items() if f == r.field and x == NC))
        assert {x[2]: x[5] for x in counts[0] if x[0] == "coverage" and x[1] == r.field} == {k: v for k, v in (("classified", r.classified), (NC, r.not_classified)) if v}
    plan = report.all_counts(both[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_the_write_takes_the_tally(spark, tmp_path):
    rows = classified(spark).withColumns({"outcome": F.when(F.col("entry_id") == "e3", "errored").when(F.col("entry_id") == "e4", "validation_failed").otherwise("successful"), "from_cache": F.col("entry_id").isin("e1", "e2"), "content_unreadable": F.lit(None).cast("boolean")})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("tally", "")
    tally = sinks.write_observed(rows, str(tmp_path / "bam"))
    spark.sparkContext.setJobGroup("other", "")
    got = tally.first().asDict()
    assert got == report.run_tally(rows).first().asDict() and got["errored"] == 1 and got["complete"]
    assert len(tracker.getJobIdsForGroup("tally")) == 2  # the records, the tally's row
    reads = rows.withColumn("is_paired_end", F.lit(True))
    reads.select(*sinks.OUTPUT[:1], "is_paired_end", "classifications", "entry_id").write.json(str(tmp_path / "fastq" / "classifications"))
    stored = sinks.stored_outputs(spark, str(tmp_path))
    assert {(r.kind, r.n, r.p) for r in stored.groupBy("kind").agg(F.count("*").alias("n"), F.count("is_paired_end").alias("p")).collect()} == {("bam", 40, 0), ("fastq", 40, 40)}
    assert sorted(map(tuple, report.coverage(stored.where("kind = 'bam'")).collect())) == sorted(map(tuple, report.coverage(rows).collect()))


def test_rules_from_a_file(spark, tmp_path):
    rule = {"id": "mine", "tier": 2, "scope": "filename", "when": {"extensions": [".bam"], "filename_pattern": "_zz"}, "then": {"platform": "ONT", "status": {"assay_type": NA}}, "rationale": "ours"}
    (tmp_path / "rules.json").write_text(json.dumps({"rules": [rule]}))
    rules = rules_file.load_rules(spark, str(tmp_path / "rules.json"))
    files = spark.createDataFrame([("a_ZZ.bam",), ("a.bam",)], "file_name string")
    got = {r.file_name: r.classifications for r in C.classify(files, rules=rules).collect()}
    assert got["a_ZZ.bam"].platform.value == "ONT" and got["a_ZZ.bam"].assay_type.status == NA and got["a.bam"].platform.value is None
    assert {r.classifications.platform.value for r in C.classify_archives(files.withColumn("member_names", F.array(F.lit("x.vcf"))), rules=rules).collect()} == {"ONT", None}

    def bad(**change):
        with pytest.raises(ValueError) as e:
            rules_file.rules_of(json.dumps({"rules": [rule | change]}))
        return str(e.value)

    assert "tier" in bad(tier=5) and "tier" in bad(tier=True) and "scope" in bad(scope="file") and "when.filename_patern" in bad(when={"filename_patern": "x"})
    assert "when.extensions" in bad(when={"extensions": ".bam"}) and "when.extensions" in bad(when={"extensions": ["bam"]}) and "then.colour" in bad(then={"colour": "red"})
    assert "then.platform" in bad(then={"platform": "abacus"}) and "then.status.platform" in bad(then={"platform": "ONT", "status": {"platform": NC}}) and "then.status.platform" in bad(then={"status": {"platform": "conflict"}})
    assert "when.fastq_pattern" in bad(when={"fastq_pattern": "x"}) and "when.header_pattern" in bad(tier=3, scope="header", when={"header_pattern": "x"}) and "rules[0]" in bad(id="") and "extra" in bad(extra=1)
    with pytest.raises(ValueError, match="duplicate"):
        rules_file.rules_of(json.dumps({"rules": [rule, rule]}))
    for text in ("{", "[]", '{"rules": {}}'):
        with pytest.raises(ValueError, match="rules"):
            rules_file.rules_of(text)


def test_documents(spark):
    rows = classified(spark).withColumn("entry_id", F.col("entry_id"))
    one = lambda sql: spark.sql(sql)
    catalogs = {
        "sequencing": one("select concat('f_rnaseq.bam') as filename, 'PACBIO_SMRT' as platform, 'GENOMIC' as librarySource, 'WGS' as libraryStrategy union all select 'a_wgs.bam', 'ILLUMINA', 'GENOMIC', 'WGS'"),
        "alignments": one("select 'a_wgs.bam' as filename, 'CHM13' as referenceCoordinates"),
        "annotations": one("select 'x' as filename, 'CAT_genes_chm13' as annotationType"),
        "assemblies": one("select 'b.vcf.gz' as filename"),
    }
    text = documents.validation_report(rows, catalogs)
    for part in ("# Agreement by field", "# Agreement by catalog", "| assemblies | 1 |", "# Discrepancies", "| data_modality | sequencing | transcriptomic.bulk | genomic | 5 | f_rnaseq.bam |"):
        assert part in text, text
    assert "<h2>Agreement by field</h2>" in documents.validation_report(rows, catalogs, report.html)
    bent = rows.withColumn("classifications", F.col("classifications").withField("assay_type", F.struct(F.lit("RNA-seq").alias("value"), F.lit("classified").alias("status"), F.col("classifications.assay_type.evidence").alias("evidence"))))
    text = documents.consistency_report(bent)
    assert "| imaging_exclusive | assay_type | RNA-seq | 5 | c.svs |" in text and "# Rules that no record met" in text and "| assay_for_methylation |" in text
    assert "<h2>Rules</h2>" in documents.consistency_report(bent, form=report.html)


def test_a_kind_of_one_s_own(spark, tmp_path):
    def reader(stream):
        return [x for x in heads.lines(stream, 1 << 20) if x.startswith("MODEL=")]

    def classifier(files):
        return C.classify(files).withColumn("classifications", F.col("classifications").withField("platform", F.struct(F.upper("model").alias("value"), F.lit("classified").alias("status"), F.col("classifications.platform.evidence").alias("evidence"))))

    payload = lambda h: h.select("path", F.substring(h["lines"][0], 7, 20).alias("model"))
    mine = kinds.with_kind("runinfo", kinds.Kind((".runinfo",), classifier, reader, payload))
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.runinfo").write_text("x\nMODEL=ont\ny\n")
    got = kinds.read_payloads(spark, str(tmp_path / "h"), "runinfo", mine)
    files = spark.createDataFrame([("a", "a.runinfo", "m1"), ("b", "b.runinfo", "m2"), ("c", "c.bam", "m3")], "entry_id string, file_name string, file_md5sum string").withColumns({"file_format": F.lit(""), "dataset_id": F.lit("d"), "dataset_title": F.lit("t"), "file_size": F.lit(1).cast("long")})
    payloads = {"runinfo": got.select(F.lit("m1").alias("file_md5sum"), "model"), "bam": spark.createDataFrame([("m3", "@RG\tPL:PACBIO")], "file_md5sum string, header_text string")}
    out = {r.entry_id: (r.phase, r.classifications.platform.value) for r in classify_catalog(files, payloads, kinds=mine).collect()}
    assert out == {"a": ("runinfo", "ONT"), "b": ("runinfo", None), "c": ("bam", "PACBIO")}
    whole = kinds.built_in()
    for name, change in (("x y", {}), ("k", {"extensions": ("txt",)}), ("k", {"extensions": (".bam",)}), ("k", {"extensions": ".q"}), ("k", {"classifier": None}), ("k", {"reader": 3})):
        with pytest.raises(ValueError):
            kinds.with_kind(name, kinds.Kind(**({"extensions": (".q",), "classifier": classifier} | change)))
    assert whole.keys() == kinds.built_in().keys()
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for n in ("a.bam", "b", "c"):
            info = tarfile.TarInfo(n)
            info.size = 2 << 20
            t.addfile(info, io.BytesIO(bytes(info.size)))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.tar").write_bytes(out.getvalue())
    members = lambda k: kinds.read_payloads(spark, str(tmp_path / "t"), "tar", k).first().member_names
    other = kinds.with_kind("tar", kinds.Kind((".tar",), C.classify_archives, kinds.archives(lambda names: False), whole["tar"].payload))
    assert members(whole) == ["a.bam", "b"] and members(other) == ["a.bam", "b", "c"]


def test_files_are_never_broadcast_to_compare_them_with_truth(spark):
    from quern import queries as Q

    for name in ("catalog_accuracy", "truth_compare", "discrepancy_categories"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, name
