"""Decision tables, traps of the rule set, contract, propagation, lint, readers, sinks and streaming."""

import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from quern.functions import headers as H
from quern.functions.names import parse_name
from quern.operators import classify as C
from quern.operators import contract, lint, propagate, report
from quern.operators.claims import entry, resolve
from quern.plans.compile import CLAIM
from quern.plans.rules import FIELDS, RULES, Rule, checked
from quern.plans.run import classify_catalog
from quern.sources import heads, records, sinks

NA, NC = "not_applicable", "not_classified"


def claims(spark, rows):
    made = [(i, [(f"r{n}", "", t, None if d in (NA, NC) else d, d if d in (NA, NC) else None, None, None) for n, (t, d) in enumerate(c)]) for i, c in enumerate(rows)]
    return spark.createDataFrame(made, f"i int, claims array<{CLAIM}>")


def test_resolution_table(spark):
    table = [
        ([], None, NC, "no_claims", None),
        ([(2, "GRCh38")], "GRCh38", "classified", "single_claim", None),
        ([(1, "a"), (3, "a")], "a", "classified", "unanimous", None),
        ([(1, "A"), (3, "B")], "B", "classified", "higher_specificity_override", None),
        ([(2, "B"), (2, "A")], None, NC, "conflict", ["A", "B"]),
        ([(2, NA), (2, "A")], None, NA, "not_applicable_terminal", None),
        ([(1, NA), (2, "A")], "A", "classified", "higher_specificity_override", None),
        ([(1, "A"), (4, NC)], "A", "classified", "single_claim", None),
        ([(3, NC)], None, NC, "single_claim", None),
        ([(3, "A"), (4, "B")], "B", "classified", "higher_specificity_override", None),
        ([(2, NA), (1, NA)], None, NA, "unanimous", None),
    ]
    got = claims(spark, [t[0] for t in table]).select("i", resolve("claims").alias("r"), entry("claims").alias("e")).orderBy("i").collect()
    for (_, value, status, reason, competing), g in zip(table, got):
        assert (g.r.value, g.r.status, g.r.reason, g.r.competing) == (value, status, reason, competing)
    assert got[0].e.evidence[-1].marker == NC and got[4].e.evidence[-1].marker == "conflict" and len(got[4].e.evidence) == 3


def test_a_competing_claim_needs_a_tier(spark):
    with pytest.raises(Exception, match="no tier"):
        claims(spark, [[(None, "A"), (2, "B")]]).select(resolve("claims")).collect()


def test_names(spark):
    want = {
        "s.vcf.gz": ("s", ".vcf", [".gz"], "VCF"),
        "S.G.VCF.GZ": ("S", ".g.vcf", [".gz"], "GVCF"),
        "r.fast5.tar.gz": ("r", ".fast5", [".tar", ".gz"], None),
        "graph.tar.gz": ("graph", None, [".tar", ".gz"], None),
        "hprc-v1.0-mc-grch38": ("hprc-v1.0-mc-grch38", None, [], None),
        "x.xyz": ("x.xyz", None, [], None),
        "a.vcf.bgz": ("a", ".vcf", [".bgz"], "VCF"),
        ".bam": ("", ".bam", [], "BAM"),
        "": ("", None, [], None),
        None: ("", None, [], None),
    }
    got = spark.createDataFrame([(k,) for k in want], "n string").select("n", parse_name(F.col("n")).alias("p")).collect()
    assert {r.n: (r.p.stem, r.p.extension, r.p.wrappers, r.p.format) for r in got} == want


def labels(df):
    return {r[0]: r[1:] for r in df.select("file_name", *[F.coalesce(f"classifications.{f}.value", f"classifications.{f}.status").alias(f) for f in FIELDS]).collect()}


def files(spark, rows, **extra):
    df = spark.createDataFrame([(n, s) for n, s in rows], "file_name string, file_size long")
    return df.withColumn("dataset_title", F.lit(None).cast("string")).withColumn("file_format", F.lit(None).cast("string")).withColumns({k: F.lit(v) for k, v in extra.items()})


def test_names_alone(spark):
    got = labels(C.classify(files(spark, [(n, 1) for n in ("a.hg38.chm13.bam", "x.bam", "s.targets.bed", "s.other.bed", "s.regions.bed", "v_b37.md5", "c.svs", "d.h5ad", "e_atac.bw", "f.sf", "quant.sf", "nothing")], platform="clash")))
    at = {f: i for i, f in enumerate(FIELDS)}
    assert got["a.hg38.chm13.bam"][at["reference_assembly"]] == NC  # two tokens of one tier
    assert got["x.bam"] == (NC,) * 5
    assert got["s.targets.bed"][at["data_modality"]] == NA  # so that the fallback doesn't fire
    assert got["s.other.bed"][:2] == ("genomic", "annotations")
    assert got["s.regions.bed"][:2] == ("genomic", "annotations")
    assert got["v_b37.md5"] == (NA,) * 5
    assert got["c.svs"] == ("imaging.histology", "images", "Histology", NA, NA)
    assert got["quant.sf"][1:3] == ("quantification", "RNA-seq") and got["f.sf"] == (NC,) * 5


def test_assay_bounds_are_strict(spark):
    sizes = {20: NC, 50: NC, 19: "WES", 21: "WGS", 51: "WGS"}
    text = "@RG\tID:1\tPL:ILLUMINA\n@PG\tID:b\tPN:bwa"
    got = labels(C.classify_alignments(files(spark, [(f"s{g}.bam", g * 10**9) for g in sizes], header_text=text)))
    assert {g: got[f"s{g}.bam"][2] for g in sizes} == sizes
    cram = {8: NC, 20: NC, 7: "WES", 9: "WGS", 21: "WGS"}
    got = labels(C.classify_alignments(files(spark, [(f"s{g}.cram", g * 10**9) for g in cram], header_text=text)))
    assert {g: got[f"s{g}.cram"][2] for g in cram} == cram


def test_alignment_headers(spark):
    sq = "\n".join(f"@SQ\tLN:{n}\tSN:chr{i}" for i, n in ((1, 248956422), (2, 242193529 + 900), (3, 5)))
    got = labels(C.classify_alignments(files(spark, [("x.bam", 1)], header_text="@HD\tVN:1\n" + sq + "\n@PG\tID:1\tPN:STAR")))
    assert got["x.bam"][0] == "transcriptomic.bulk" and got["x.bam"][3] == "GRCh38" and got["x.bam"][2] == "RNA-seq"
    assert labels(C.classify_alignments(files(spark, [("x.bam", 1)], header_text="@HD\tVN:1")))["x.bam"][3] == NA
    assert labels(C.classify_alignments(files(spark, [("x.hg19.bam", 1)], header_text=sq)))["x.hg19.bam"][3] == "GRCh38"  # content wins
    tied = "@SQ\tSN:chr1\tLN:248956422\n@SQ\tSN:chr1\tLN:249250621"
    assert labels(C.classify_alignments(files(spark, [("x.bam", 1)], header_text=tied)))["x.bam"][3] == NC


def test_variant_headers(spark):
    got = labels(C.classify_variants(files(spark, [("a.vcf.gz", 1)], header_text="##source=strelka2\n##reference=GRCh38")))
    assert got["a.vcf.gz"][1] == NC and got["a.vcf.gz"][3] == "GRCh38"  # both strelka rules: a conflict
    crlf = "##fileformat=VCFv4\r\n##contig=<ID=chr1,length=248387497,assembly=x>\r\n##INFO=<ID=SOMATIC,Number=0>\r"
    assert labels(C.classify_variants(files(spark, [("a.vcf", 1)], header_text=crlf)))["a.vcf"][3] == "CHM13"


def reads(spark, *names, file_name="r.fastq.gz"):
    df = files(spark, [(file_name, 1)]).withColumn("read_names", F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>"))
    return C.classify_reads(df).first()


def test_reads(spark):
    r = reads(spark, "@ERR3242571.1 A00297:44:HFKH3DSXX:2:1354:30508:28839/1")
    assert r.classifications.platform.value == "ILLUMINA" and r.is_paired_end and r.instrument_model == "NovaSeq 6000" and (r.archive_accession, r.archive_source) == ("ERR3242571", "ENA")
    assert r.classifications.data_modality.status == NC and r.classifications.reference_assembly.status == NA
    r = reads(spark, "@SRR1.1 m64011_1_2/5/ccs")
    assert r.classifications.platform.value == "ILLUMINA"  # the archive alone says so
    r = reads(spark, "@m84010_1_2/5/0_10")
    assert r.classifications.platform.value == "PACBIO" and r.instrument_model == "Revio" and r.is_paired_end is False
    r = reads(spark, "@A1:2:3:4:5:6:7")
    assert r.classifications.platform.status == NC  # two makers' patterns fit
    r = reads(spark)
    assert r.classifications.data_type.value == "reads" and r.is_paired_end is None and r.classifications.platform.evidence == []


def test_read_name_parts(spark):
    df = spark.createDataFrame([("@0a1b2c3d-0000-1111-2222-000000000001 runid=a ch=1 runid=b",), ("@V300012345L2C001R0030001/2",), ("x",)], "r string")
    got = df.select(H.ont(F.col("r")).alias("o"), H.mgi(F.col("r")).alias("m"), H.read_platform(F.col("r")).alias("p")).collect()
    assert got[0].o.metadata == {"runid": "b", "ch": "1"} and got[0].p == "ONT"
    assert got[1].m.pair == 2 and got[1].p == "MGI" and got[2].p is None


def test_sequences_graphs_archives_intervals(spark):
    def fasta(names, file_name="f.fa"):
        return labels(C.classify_sequences(files(spark, [(file_name, 1)]).withColumn("contig_names", F.array(*[F.lit(n) for n in names]))))[file_name]

    chroms = [f"chr{i}" for i in range(1, 23)]
    assert fasta(chroms)[:4] == ("genomic", "assembly.reference", NA, NC)
    assert fasta(chroms, "f.hg38.fa")[3] == "GRCh38"
    assert fasta(["h1tg0001l", "chr1"])[1:4] == ("assembly", NA, NA)
    assert fasta(["ENST0001", "NM_1", "chr1"])[0] == "transcriptomic.bulk"
    assert fasta([f"z{i}" for i in range(51)])[1] == "assembly" and fasta(["z"])[1] == "sequence"
    graph = files(spark, [("g.gfa.gz", 1)]).withColumn("gfa_segment_tags", F.expr("array(named_struct('sn', '', 'sr', '0'), named_struct('sn', 'chr1', 'sr', '1'))"))
    assert labels(C.classify_graphs(graph))["g.gfa.gz"][1] == "pangenome"
    graph = graph.withColumn("gfa_segment_tags", F.expr("array(named_struct('sn', 'chr1', 'sr', '0'))"))
    assert labels(C.classify_graphs(graph))["g.gfa.gz"][1] == "pangenome.reference"

    def tar(*names):
        return labels(C.classify_archives(files(spark, [("a.tar", 1)]).withColumn("member_names", F.array(*[F.lit(n) for n in names]))))["a.tar"][:2]

    assert tar("x/PL_var.tdb/__a.tdb") == ("genomic", "variants") and tar("x/genes.tdb") == (NC, NC)
    assert tar("a.fasta", "b.fq.gz", "c.fq.gz") == (NC, "reads") and tar("a.bam") == (NC, NC) and tar("d.v/vidmap.json") == ("genomic", "variants")

    def bed(chroms, prefix, tops):
        df = files(spark, [("b.regions.bed", 1)]).withColumn("bed", F.struct(F.array(*[F.lit(c) for c in chroms]).alias("chromosomes"), F.lit(prefix).alias("has_chr_prefix"), F.create_map(*[F.lit(x) for kv in tops.items() for x in kv]).cast("map<string,bigint>").alias("max_coordinates"), F.lit(1).alias("line_count")))
        return labels(C.classify_intervals(df))["b.regions.bed"][3]

    assert bed(["chr1"], True, {"chr1": 248_700_000}) == "GRCh38" and bed(["1"], False, {"1": 5}) == "GRCh37" and bed(["h1tg1"], False, {"h1tg1": 5}) == NA and bed(["chr1"], True, {"chr1": 5}) == NC


def test_rules_are_checked():
    good = RULES[0]
    for bad in (good._replace(tier=5), good._replace(scope="x"), good._replace(when={"nope": 1}), good._replace(then={"data_type": "index"}), good._replace(then={"colour": "red"}, status={}), good._replace(when={"extensions": ".bam"}), Rule("n", 1, "extension", {}, {"data_type": "unheard"}, {})):
        with pytest.raises(ValueError):
            checked([bad])
    with pytest.raises(ValueError):
        checked([good, good])
    assert len(RULES) == 129


VALID = {"entry_id": "e", "file_id": "f", "file_name": "a.bam", "file_format": ".bam", "file_size": 1, "file_md5sum": "0" * 32, "drs_uri": "drs://x", "dataset_id": "d", "dataset_title": "t", "is_supplementary": True, "data_modality": None, "other": {"x": 1}}


def test_contract(spark):
    cases = [
        ({}, []),
        ({"file_size": "123"}, ["file_size: expected an integer"]),
        ({"file_size": -1}, ["file_size: must be at least 0"]),
        ({"file_size": 1.5}, ["file_size: expected an integer"]),
        ({"file_size": True}, ["file_size: expected an integer"]),
        ({"file_md5sum": "A" * 32}, ["file_md5sum: does not match the required format"]),
        ({"file_name": ""}, ["file_name: does not match the required format"]),
        ({"entry_id": None}, ["entry_id: expected a string"]),
        ({"reference_assembly": 3}, ["reference_assembly: expected a string"]),
        ({"is_supplementary": "yes", "drs_uri": "http://x"}, ["drs_uri: does not match the required format", "is_supplementary: expected a boolean"]),
    ]
    texts = [json.dumps(VALID | c) for c, _ in cases] + ["[1]", "3", "no json", json.dumps({k: v for k, v in VALID.items() if k != "file_size"})]
    want = [r for _, r in cases] + [["<record>: expected an object"]] * 3 + [["file_size: required field is missing"]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, record string")
    assert [r.r for r in df.select("i", contract.reasons(F.col("record")).alias("r")).orderBy("i").collect()] == want
    valid, invalid = contract.split(df)
    assert valid.count() == 4 and invalid.count() == 10
    out = contract.not_validated(invalid).first()
    assert all(out.classifications[f].status == NC for f in FIELDS)
    kinds = {r.reason: r.n for r in contract.problem_kinds(df).collect()}
    assert kinds["<record>: expected an object"] == 3 and kinds["file_size: expected an integer"] == 3


def test_indexes_take_their_parents_labels(spark):
    rows = [("p1", "s.bam", ".bam", "m1", "d"), ("p2", "s.bam", ".bam", "m2", "d"), ("i1", "s.bam.bai", ".bai", "m3", "d"), ("i2", "s.bai", ".bai", "m4", "d"), ("i3", "s.bam.bai", ".bai", "m5", "other"), ("v", "x.bed.gz", ".bed.gz", "m6", "d"), ("i4", "x.tbi", ".tbi", "m7", "d"), ("i5", "x.fai", ".fai", "m8", "d")]
    df = spark.createDataFrame(rows, "entry_id string, file_name string, file_format string, file_md5sum string, dataset_id string").withColumn("dataset_title", F.lit("t")).withColumn("file_size", F.lit(1).cast("long"))
    got = {r.entry_id: r.parent_md5 for r in propagate.matched_indexes(df).collect()}
    assert got == {"i1": "m2", "i2": "m2", "i3": None, "i4": "m6"}
    assert [r.entry_id for r in propagate.unmatched(propagate.matched_indexes(df)).collect()] == ["i3"]
    run = {r.entry_id: r for r in classify_catalog(df).collect()}
    assert len(run) == 8 and run["i4"].classifications.data_type.value == "annotations" and run["i4"].phase == "index" and run["i3"].classifications.data_type.status == NA
    stats = {r.index_ext: (r.total, r.matched, r.unmatched, r.with_modality) for r in propagate.index_stats(propagate.matched_indexes(df), propagate.inherited(propagate.matched_indexes(df), C.classify(df))).collect()}
    assert stats == {".bai": (3, 2, 1, 0), ".tbi": (1, 1, 0, 1)}


def test_whole_run_with_payloads(spark):
    df = spark.createDataFrame([("a", "s.bam", "m1"), ("b", "t.bam", "m2"), ("c", "n.png", "m3")], "entry_id string, file_name string, file_md5sum string").withColumns({"file_format": F.lit(""), "dataset_id": F.lit("d"), "dataset_title": F.lit("t"), "file_size": F.lit(1).cast("long")})
    bam = spark.createDataFrame([("m1", "@RG\tPL:ONT")], "file_md5sum string, header_text string")
    got = {r.entry_id: (r.phase, r.classifications.platform.value, r.classifications.data_type.value) for r in classify_catalog(df, {"bam": bam}).collect()}
    assert got == {"a": ("bam", "ONT", None), "b": ("bam", None, None), "c": ("remaining", None, "images")}


def test_lint_only_speaks_of_classified_fields(spark):
    df = C.classify(files(spark, [("a_wgs_.bam", 1), ("c.svs", 1), ("x.md5", 1)])).withColumn("entry_id", F.col("file_name"))
    assert lint.violations(df).count() == 0
    bent = df.withColumn("classifications", F.col("classifications").withField("assay_type", F.struct(F.lit("RNA-seq").alias("value"), F.lit("classified").alias("status"), F.col("classifications.assay_type.evidence").alias("evidence"))))
    assert {(r.rule_id, r.file_name) for r in lint.violations(bent).collect()} == {("assay_for_genomic", "a_wgs_.bam"), ("imaging_exclusive", "c.svs")}


def test_records(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text(json.dumps(VALID) + "\n\n" + "[3]\n")
    assert records.read_json_lines(spark, str(tmp_path / "a.ndjson")).count() == 2
    for body, lenient, n in (({"results": [VALID], "files": []}, False, 1), ({"files": [VALID, 3]}, False, 2), ([VALID], True, 1), ({"files": []}, False, 0)):
        (tmp_path / "e.json").write_text(json.dumps(body))
        assert records.read_envelope(spark, str(tmp_path / "e.json"), lenient).count() == n
    for body in ([VALID], {"files": 3}, {"x": []}):
        (tmp_path / "e.json").write_text(json.dumps(body))
        with pytest.raises(Exception, match="no list of records"):
            records.read_envelope(spark, str(tmp_path / "e.json")).collect()
    assert records.typed(spark.createDataFrame([(json.dumps(VALID),)], "record string")).first().file_size == 1


def test_heads(spark, tmp_path):
    def put(name, data):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_bytes(data)
        return heads.read_heads(spark, str(tmp_path / name), name.split("-")[0]).first()

    packed = gzip.compress(b"##a\n#b\n") + gzip.compress(b"1\t2\n" * 150)
    assert len(put("vcf", packed).lines) == 102
    assert put("vcf-bad", b"x\n").error.startswith("ValueError")
    assert put("fastq", b"@a 1\nAC\n+\n@@@\n@b\nAC\n+\nII\n").lines == ["@a 1", "@b"]
    assert put("fasta", b">c1 x\nAC\n>c2\n").lines == ["c1", "c2"] and put("fasta-none", b"AC\n").lines == []
    assert put("gfa", b"S\ts1\tAC\tSN:Z:chr1\tSR:i:0\nS\ts2\tA\n").lines == ["chr1\t0"]
    put("bed", b"track x\n#c\nchr1\t1\t20\nCHR1\t2\t30\nchr1\tx\ty\nchr2\t1\n")
    b = heads.bed_signals(heads.read_heads(spark, str(tmp_path / "bed"), "bed")).first().bed
    assert b.has_chr_prefix and b.max_coordinates == {"chr1": 20, "CHR1": 30} and b.line_count == 2
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for n in ("a/b.vcf", "c"):
            t.addfile(tarfile.TarInfo(n))
    assert put("tar", out.getvalue()).lines == ["a/b.vcf", "c"] and put("tar-cut", out.getvalue()[:30]).error is None


def test_sinks_and_stream(spark, tmp_path):
    from quern.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.ndjson").write_text(json.dumps(VALID) + "\n" + json.dumps(VALID | {"file_size": "x"}) + "\n")
    for name, n in (("2.ndjson", 1), ("3.ndjson", 2)):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
        (tmp_path / "in" / name).write_text(json.dumps(VALID | {"file_name": "b.png"}))
    done = spark.read.parquet(str(tmp_path / "out"))
    sinks.write_run(done, report.run_tally(done.select(F.lit("successful").alias("outcome"), F.lit(False).alias("from_cache"), F.lit(False).alias("content_unreadable"))), str(tmp_path / "20260101_000000"))
    assert sinks.latest_run(spark, str(tmp_path)).endswith("20260101_000000")
    assert spark.read.json(str(tmp_path / "20260101_000000/metadata")).first().complete
    sinks.write_tsv(done, str(tmp_path / "tsv"))
    payload = spark.createDataFrame([("0" * 32, "@RG")], "file_md5sum string, header_text string")
    sinks.write_evidence(payload, str(tmp_path / "ev"))
    hit, miss = sinks.with_evidence(done, spark.read.parquet(str(tmp_path / "ev")))
    assert hit.count() == 2 and miss.count() == 0 and sinks.left_to_do(done, payload).count() == 0
    assert report.markdown(report.coverage(done), "Coverage").count("\n") > 7
