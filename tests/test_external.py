"""External catalogs, accessions and samples; reports; heads read in ranges; sizes; whole runs with every phase."""

import gzip
import io
import json
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from quern.functions import names as N
from quern.operators import classify as C
from quern.operators import external, propagate, report
from quern.plans.rules import FIELDS
from quern.plans.run import whole_run
from quern.sources import heads, records, sinks
from quern.sources.sizes import with_sizes

ENTRY = "struct<value:string,status:string>"
OUTPUT = "file_name string, classifications struct<" + ",".join(f"{f}:{ENTRY}" for f in FIELDS) + ">"


def outputs(spark, rows):
    """rows: (name, {field: value or (value, status)})."""
    made = []
    for name, given in rows:
        entry = lambda v: v if isinstance(v, tuple) else (v, "classified" if v else "not_classified")
        made.append((name, tuple(entry(given.get(f)) for f in FIELDS)))
    return spark.createDataFrame(made, OUTPUT)


def test_catalogs_by_name(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([
        {"filename": "a.bam", "platform": "PACBIO_SMRT", "librarySource": "genomic", "libraryStrategy": "WGS", "path": "s3://b/k/a.bam"},
        {"filename": "b.bam", "platform": "NEW", "librarySource": None, "fileSize": 7}, {"filename": "", "platform": "ILLUMINA"}, {"platform": "ONT"},
    ]))
    (tmp_path / "l.json").write_text(json.dumps([{"filename": "a.bam", "referenceCoordinates": "CHM13", "loc": "https://x/a.bam", "fileSize": 5}, {"filename": "b.bam", "referenceCoordinates": "none"}]))
    (tmp_path / "m.json").write_text(json.dumps([{"filename": "c.fa.gz", "awsFasta": "s3://b/c.fa.gz", "fileSize": "1.5"}]))
    catalogs = records.read_catalogs(spark, {"sequencing": str(tmp_path / "s.json"), "alignments": str(tmp_path / "l.json"), "assemblies": str(tmp_path / "m.json"), "annotations": str(tmp_path / "missing.json")})
    assert catalogs["annotations"].count() == 0
    found = {(r.catalog, r.file_name): r for r in records.catalog_records(catalogs).collect()}
    a = found["sequencing", "a.bam"]
    assert a.url == "https://s3-us-west-2.amazonaws.com/b/k/a.bam" and a.file_format == ".bam" and a.file_size is None and len(a.file_md5sum) == 32
    assert found["sequencing", "b.bam"].url is None and found["sequencing", "b.bam"].file_md5sum is None and found["sequencing", "b.bam"].file_size == 7
    assert found["alignments", "a.bam"].url == "https://x/a.bam" and found["assemblies", "c.fa.gz"].file_size is None
    ours = outputs(spark, [("a.bam", {"platform": "pacbio", "assay_type": (None, "not_applicable"), "reference_assembly": "GRCh38"}), ("b.bam", {"platform": "NEW"}), ("c.fa.gz", {}), ("z", {"platform": "ONT"})])
    verdicts = external.catalog_verdicts(ours, catalogs)
    got = {(r.file_name, r.catalog, r.field): r.verdict for r in verdicts.collect()}
    assert got == {("a.bam", "sequencing", "platform"): "match", ("a.bam", "sequencing", "data_modality"): "unknown", ("a.bam", "sequencing", "assay_type"): "unknown", ("a.bam", "alignments", "reference_assembly"): "mismatch", ("b.bam", "sequencing", "platform"): "match", ("c.fa.gz", "assemblies", None): None}
    assert {r.field: (r.match, r.mismatch, r.unknown, r.percent) for r in external.agreement(verdicts).collect()} == {"platform": (2, 0, 0, 100.0), "data_modality": (0, 0, 1, None), "assay_type": (0, 0, 1, None), "reference_assembly": (0, 1, 0, 0.0)}
    assert {r.catalog: r.n for r in external.matched_files(verdicts).collect()} == {"sequencing": 2, "alignments": 1, "assemblies": 1}


def test_run_accessions(spark):
    names = ["ERR3988887_1.fastq.gz", "HG002_ERR123456.bam", "XERR123456.bam", "SRR12345.bam", "ERR999999.bam", "ERR777777.bam", None]
    ours = outputs(spark, [(n, {"platform": "illumina", "data_modality": "transcriptomic.bulk", "assay_type": "WES"}) for n in names])
    runs = spark.createDataFrame([("ERR3988887", "ILLUMINA", "WXS", "TRANSCRIPTOMIC"), ("ERR123456", "ONT", "OTHER", ""), ("ERR999999", None, "WGS", "GENOMIC"), ("", "ILLUMINA", "", "")], "run_accession string, instrument_platform string, library_strategy string, library_source string")
    got = {r.file_name: tuple(r)[1:] for r in external.run_verdicts(ours, runs).collect()}
    assert got == {"ERR3988887_1.fastq.gz": ("ERR3988887", None, "match", "match", "match"), "HG002_ERR123456.bam": ("ERR123456", None, "mismatch", "mismatch", "unknown"), "ERR999999.bam": ("ERR999999", "no_platform", None, None, None), "ERR777777.bam": ("ERR777777", "no_record", None, None, None)}
    given = external.run_verdicts(ours.withColumn("archive_accession", F.when(F.col("file_name") == "SRR12345.bam", "ERR3988887")), runs)
    assert given.where("file_name = 'SRR12345.bam'").first().accession == "ERR3988887"


def test_samples(spark):
    ours = outputs(spark, [("NA12878.bam", {"platform": "PACBIO", "data_modality": "genomic"}), ("x.HG00096.rna.bam", {"platform": "ILLUMINA", "data_modality": "transcriptomic.single_cell"}), ("HG00097.bam", {"data_modality": "imaging.histology"}), ("HG99999.bam", {"platform": "ONT"}), ("HG001.bam", {})])
    samples = spark.createDataFrame([("NA12878", json.dumps({"_source": {"dataCollections": [{"title": "HiFi", "sequence": "PacBio HiFi"}, {"title": "1000 Genomes 30x"}]}})), ("HG00096", json.dumps({"dataCollections": [{"title": "t", "sequence": ["mRNA", None]}]})), ("HG00097", "{}")], "sample_id string, record string")
    got = {r.file_name: tuple(r)[1:] for r in external.sample_verdicts(ours, samples).collect()}
    assert got == {"NA12878.bam": ("NA12878", True, "match", "match"), "x.HG00096.rna.bam": ("HG00096", True, "match", "partial"), "HG00097.bam": ("HG00097", True, None, "mismatch"), "HG99999.bam": ("HG99999", False, None, None)}


def test_reasons_and_output_checks(spark):
    texts = ["inherited from a b.bam", "not applicable to x.vcf", "y.bam is not classified", "12 of 3 contigs"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(report.alike(F.col("t"))).collect()]
    assert got == ["inherited from parent", "not applicable to parent", "parent is not classified", "N of N contigs"]
    bent = outputs(spark, [("a", {"platform": ("ONT", "not_classified"), "data_type": ("x", "classified"), "assay_type": (None, None)}), ("b", {})])
    assert {r.file_name: r.f for r in bent.select("file_name", report.output_faults(bent).alias("f")).collect()} == {"a": ["data_type: value outside the vocabulary", "assay_type: status is missing", "platform: value and status don't fit"], "b": []}
    assert spark.range(1).select(report.output_faults(spark.range(1)).alias("f")).first().f == ["classifications: missing"]
    assert bent.where("file_name = 'b'").select(report.coherent("platform")).count() == 1
    with pytest.raises(Exception, match="don't fit"):
        bent.select(report.coherent("platform").alias("c")).collect()
    assert [report.shown(v) for v in (None, True, 1234567, 12.34, "a|b\nc")] == ["", "true", "1,234,567", "12.3", "a\\|b c"]


def test_index_files_share_a_reason(spark):
    rows = [(f"e{i}", f"s{i}.{x}", "d", f"m{i}{x}") for i in range(6) for x in ("unknownbam.bam", "unknownbam.bam.bai")]
    df = spark.createDataFrame(rows, "entry_id string, file_name string, dataset_id string, file_md5sum string").withColumns({"file_format": F.lit(""), "dataset_title": F.lit("t | x"), "file_size": F.lit(1).cast("long")})
    got = report.commonest_reasons(propagate.inherited(propagate.matched_indexes(df), C.classify(df))).where("reason = 'parent is not classified'").collect()
    assert got and all(r.n == 6 for r in got)
    text = report.coverage_report(C.classify(df), df)
    assert "# Datasets" in text and "t \\| x | 12 |" in text and "<td>" in report.coverage_report(C.classify(df), df, report.html)


def test_every_phase_of_a_run(spark):
    rows = [("a", "s.bam"), ("b", "n.PNG"), ("c", "x.fast5.tar.gz"), ("d", "s.bam.bai"), ("e", "notes.txt"), ("f", "y.tif"), ("g", "p.pvar")]
    df = spark.createDataFrame([(i, n, f"m{i}") for i, n in rows], "entry_id string, file_name string, file_md5sum string").withColumns({"file_format": F.lit(""), "dataset_id": F.lit("d"), "dataset_title": F.lit("t"), "file_size": F.lit(1).cast("long")})
    bam = spark.createDataFrame([("ma", "@RG\tPL:ONT")], "file_md5sum string, header_text string")
    got = {r.entry_id: r.phase for r in whole_run(df, {"bam": bam}).collect()}
    assert got == {"a": "bam", "b": "image", "c": "auxiliary", "d": "index", "e": "remaining", "f": "remaining", "g": "auxiliary"}
    group = {r.file_name: r.g for r in df.select("file_name", N.format_group(F.col("file_name"), F.regexp_extract("file_name", r"(\.[a-z0-9]+)$", 1)).alias("g")).collect()}
    assert group == {"s.bam": "BAM/CRAM", "n.PNG": "Other", "x.fast5.tar.gz": "Auxiliary", "s.bam.bai": "Index", "notes.txt": "Skipped", "y.tif": "Images", "p.pvar": "Auxiliary"}


class Counted(io.BytesIO):
    most = 0

    def read(self, n=-1):
        out = super().read(n)
        self.most += len(out)
        return out


def test_heads_stop_early():
    text = b"##fileformat=VCFv4.2\n#CHROM\n" + b"chr1\t5\n" * 3_000_000
    for data in (text, gzip.compress(text, 1)):
        s = Counted(data)
        assert len(heads.vcf(s)) == 102 and s.most <= heads.STEP
    reads = Counted(b"@r\nAC\n+\nII\n" * 2_000_000)
    assert len(heads.fastq(reads)) == heads.READS and reads.most <= heads.STEP
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for k in range(40):
            info = tarfile.TarInfo(f"d/{k}.bam")
            info.size = 200_000
            t.addfile(info, io.BytesIO(bytes(200_000)))
    s = Counted(out.getvalue())
    assert 1 < len(heads.tar(s)) < 6 and s.most < 1 << 20
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as t:
        for k in range(300):
            t.addfile(tarfile.TarInfo(f"n{k}"))
    assert len(heads.tar(Counted(plain.getvalue()))) == heads.MEMBERS


def test_heads_at_their_edges():
    read = lambda data, cap: [*heads.lines(io.BytesIO(data), cap)]
    assert read(b"a\nb", 100) == ["a", "b"] and read(b"a\nbcd", 3) == ["a"] and read(b"", 9) == [] and read(b"\xe9\n\xc3\xa9\n", 9) == ["é", "é"]
    two = gzip.compress(b"a\nb") + gzip.compress(b"c\nd")
    assert read(two, 100) == ["a", "bc", "d"] and read(two[:-6], 100) == ["a", "bc"]
    long = b"x" * (3 * heads.STEP) + b"\ny\n"
    assert [*map(len, read(long, 1 << 30))] == [3 * heads.STEP, 1] and [*map(len, read(gzip.compress(long), 1 << 30))] == [3 * heads.STEP, 1]
    header = b"@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:5\n"
    packed = gzip.compress(b"BAM\x01" + struct.pack("<i", len(header)) + header + b"\x00" * 50)
    assert heads.bam(io.BytesIO(packed)) == ["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:5"]
    with pytest.raises(ValueError):
        heads.bam(io.BytesIO(gzip.compress(b"CRAM")))


def test_heads_of_files(spark, tmp_path):
    (tmp_path / "a b.fa").write_bytes(b">c1\nAC\n")
    (tmp_path / "empty").write_bytes(b"")
    got = heads.read_heads(spark, str(tmp_path), "fasta").collect()
    assert [r.lines for r in got] == [["c1"]]

    def refuse(path):
        raise OSError("no way in")

    assert heads.read_heads(spark, str(tmp_path), "fasta", refuse).first().error == "OSError: no way in"


def test_sizes(spark):
    def size_of(url):
        return {"u1": 5, "u2": -1}[url]

    df = spark.createDataFrame([("a", "u1", None), ("b", "u2", None), ("c", "u3", None), ("d", "u1", 9), ("e", None, None), ("f", "u1", None)], "n string, url string, file_size long")
    assert {r.n: r.file_size for r in with_sizes(df, size_of).collect()} == {"a": 5, "b": None, "c": None, "d": 9, "e": None, "f": 5}


def test_finished_runs(spark, tmp_path):
    done = C.classify(spark.createDataFrame([("e1", "a.png", "m1"), ("e2", "b.png", "m2")], "entry_id string, file_name string, file_md5sum string").withColumns({"file_format": F.lit(""), "dataset_title": F.lit("t"), "file_size": F.lit(1).cast("long")}))
    assert not sinks.finished(spark, str(tmp_path / "run"), 1)
    sinks.write_run(done, spark.createDataFrame([(True,)], "complete boolean"), str(tmp_path / "run"))
    assert sinks.finished(spark, str(tmp_path / "run"), 2) and not sinks.finished(spark, str(tmp_path / "run"), 3)
    sinks.write_run(done, spark.createDataFrame([(False,)], "complete boolean"), str(tmp_path / "open"))
    assert not sinks.finished(spark, str(tmp_path / "open"), 2)
    left = sinks.left_to_do(done, spark.createDataFrame([("m9",)], "file_md5sum string"), 1)
    assert [r.file_md5sum for r in left.collect()] == ["m1"]


def test_lengths(spark):
    from quern.functions.reference import LENGTHS

    rows = [("GRCh38", "chr1", LENGTHS["GRCh38"][0]), ("GRCh38", "MT", 16569), ("CHM13", "2", 1)]
    got = {r.assembly: (r.matches, r.mismatches, r.status) for r in external.check_lengths(spark.createDataFrame(rows, "assembly string, contig string, length long")).collect()}
    assert got == {"GRCh38": (1, 0, "valid"), "CHM13": (0, 1, "mismatch"), "GRCh37": (0, 0, "missing")}


def test_files_are_never_broadcast_to_meet_records(spark):
    from quern import queries as Q

    for name in ("catalog_matches", "run_accession_join"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, name


def test_inherited_labels_shuffle_no_evidence(spark):
    """Files' evidence takes most of a task's memory when they are sorted by md5; only labels are inherited."""
    rows = [("e1", "a_wgs.bam", "m1", ".bam"), ("e2", "a_wgs.bam.bai", "m2", ".bai")]
    df = spark.createDataFrame(rows, "entry_id string, file_name string, file_md5sum string, file_format string").withColumns({"dataset_title": F.lit("t"), "dataset_id": F.lit("d"), "file_size": F.lit(30_000_000_000)})
    found = propagate.matched_indexes(df)
    with_evidence, without = (propagate.inherited(found, C.classify(df, evidence=e)) for e in (True, False))
    assert with_evidence.collect() == without.collect() and without.count() == 1
    last = with_evidence._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(x for x in last.splitlines() if "max_by(" in x)
    assert "classifications#" not in grouped
