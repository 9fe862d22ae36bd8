"""Comparison with external records: four file catalogs, run accessions, samples, and published contig lengths.

Each is an equi-join on a key that the files give; the records come as frames. Several records of one key count as one: the
greatest, by its fields in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.reference import CHROMS, LENGTHS, bare
from quern.plans.rules import CLASSIFIED

from .report import ANNOTATIONS, COORDINATES, PLATFORMS, RUN_STRATEGIES, SOURCES, STRATEGIES, translated

COMPARED = ("platform", "data_modality", "assay_type", "reference_assembly")
# A run accession in a file name; a sample's id in one.
ACCESSION, SAMPLE = r"(?<![A-Za-z0-9])([ESD]RR\d{6,})", r"\b((?:NA|HG)\d{5})\b"
# Modalities of sequence types; parts of titles and sequence types, in lower case, and what they stand for.
SEQUENCES = {
    "Exome": "genomic", "Low coverage WGS": "genomic", "PCR-free high coverage": "genomic", "High coverage WGS": "genomic", "Complete Genomics": "genomic", "PacBio SMRT genomic": "genomic",
    "PacBio HiFi": "genomic", "Oxford Nanopore Technologies": "genomic", "Illumina NovaSeq 6000": "genomic", "mRNA": "transcriptomic.bulk",
}
WHOLE_GENOME = ("1000 genomes 30x", "high coverage")
SEQUENCE_PLATFORMS = {"PACBIO": ("pacbio", "hifi", "smrt"), "ONT": ("nanopore", "ont"), "ILLUMINA": ("illumina", "novaseq", "hiseq")}
TITLE_PLATFORMS = {"PACBIO": ("pacbio", "hifi"), "ONT": ("1kg_ont_vienna", "oxford nanopore", "nanopore", "ont"), "ILLUMINA": ("illumina", "1000 genomes")}


# --- four catalogs ---------------------------------------------------------------------------------------------------


def catalog_truth(catalogs: dict[str, DataFrame]) -> DataFrame:
    """catalog, file_name, truth (field -> expected value) of every named file of the catalogs.

    sequencing: platform (unknown ones as they are), modality and assay where their names translate; alignments and
    annotations: the assembly, and only files that have one; assemblies: presence only, an empty map.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    values = {
        "sequencing": {"platform": translated(text("platform"), PLATFORMS, keep=True), "data_modality": translated(F.upper(text("librarySource")), SOURCES), "assay_type": translated(text("libraryStrategy"), STRATEGIES)},
        "alignments": {"reference_assembly": translated(F.lower(text("referenceCoordinates")), COORDINATES)},
        "annotations": {"reference_assembly": translated(text("annotationType"), ANNOTATIONS)},
        "assemblies": {},
    }
    parts = []
    for name, fields in values.items():
        own = F.struct(*[v.alias(f) for f, v in fields.items()]) if fields else F.struct(F.lit(0).alias("none"))
        rows = catalogs[name].where("filename <> ''").select(F.col("filename").alias("file_name"), own.alias("v")).groupBy("file_name").agg(F.max("v").alias("v"))
        if name in ("alignments", "annotations"):
            rows = rows.where("v.reference_assembly is not null")
        truth = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"v.{f}").alias("x")) for f in fields]), lambda e: F.coalesce(e["x"], F.lit("")) != "")) if fields else F.create_map().cast("map<string,string>")
        parts.append(rows.select(F.lit(name).alias("catalog"), "file_name", truth.alias("truth")))
    return reduce(DataFrame.unionByName, parts)


def catalog_verdicts(classified: DataFrame, catalogs: dict[str, DataFrame]) -> DataFrame:
    """file_name, catalog, field, ours, expected and verdict (match, mismatch, unknown) of every file that a catalog knows.

    One join on the name for all catalogs. A catalog that expects nothing of a file has one row for it without a field.
    """
    label = lambda f: F.coalesce(F.col(f"classifications.{f}.value"), F.col(f"classifications.{f}.status"))
    slim = classified.select("file_name", *[label(f).alias(f) for f in COMPARED]).repartition("file_name")  # a stage of its own: rules and a join are too much code for one
    ours = slim.select("file_name", F.create_map(*[x for f in COMPARED for x in (F.lit(f), F.col(f))]).alias("ours"))
    rows = ours.join(catalog_truth(catalogs).hint("merge"), "file_name").select("file_name", "catalog", "ours", F.explode_outer("truth").alias("field", "expected"))
    rows = rows.withColumn("ours", F.element_at("ours", F.col("field")))
    none = F.col("ours").isNull() | F.lower("ours").isin("not_classified", "not_applicable", "")
    verdict = F.when(F.col("field").isNull(), None).when(none, "unknown").when(F.upper("ours") == F.upper("expected"), "match").otherwise("mismatch")
    return rows.withColumn("verdict", verdict).select("file_name", "catalog", "field", "ours", "expected", "verdict")


def agreement(verdicts: DataFrame) -> DataFrame:
    """field, match, mismatch, unknown and percent of match among both."""
    n = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    out = verdicts.where("field is not null").groupBy("field").agg(n("match"), n("mismatch"), n("unknown"))
    return out.withColumn("percent", F.round(F.try_divide(F.col("match") * 100.0, F.col("match") + F.col("mismatch")), 2).cast("double"))


def matched_files(verdicts: DataFrame) -> DataFrame:
    """catalog, n: how many files each catalog knows."""
    return verdicts.groupBy("catalog").agg(F.count_distinct("file_name").alias("n"))


# --- run accessions --------------------------------------------------------------------------------------------------


def accession(files: DataFrame) -> Column:
    """The archive accession that a file's reads gave, else the one in its name, else null."""
    named = F.nullif(F.regexp_extract(F.coalesce("file_name", F.lit("")), ACCESSION, 1), F.lit(""))
    return F.coalesce(F.nullif(F.col("archive_accession"), F.lit("")), named) if "archive_accession" in files.columns else named


def run_verdicts(classified: DataFrame, runs: DataFrame) -> DataFrame:
    """file_name, accession, error and the verdicts on platform, modality and assay of every file with an accession.

    runs: run_accession, instrument_platform, library_strategy, library_source. error: no_record or no_platform; such
    files have no verdicts. unknown: one side has nothing to compare.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    known = runs.where("run_accession <> ''").groupBy(F.col("run_accession").alias("accession")).agg(F.max(F.struct(F.upper(text("instrument_platform")).alias("platform"), text("library_strategy").alias("strategy"), text("library_source").alias("source"))).alias("run"))
    rows = classified.withColumn("accession", accession(classified)).where("accession is not null").join(known.hint("merge"), "accession", "left")
    error = F.when(F.col("run").isNull(), "no_record").when(F.col("run.platform") == "", "no_platform")
    source, strategy = F.col("run.source"), F.col("run.strategy")
    modality = F.when((source == "") & (strategy == ""), None).when((source == "TRANSCRIPTOMIC") | strategy.isin("RNA-Seq", "FL-cDNA"), "transcriptomic").otherwise("genomic")

    def verdict(field: str, expected: Column, fits) -> Column:
        entry = F.col(f"classifications.{field}")
        ours = F.when(entry["status"] == CLASSIFIED, F.nullif(entry["value"], F.lit("")))
        return F.when(error.isNull(), F.when(ours.isNull() | expected.isNull(), "unknown").when(fits(ours, expected), "match").otherwise("mismatch"))

    return rows.select(
        "file_name", "accession", error.alias("error"),
        verdict("platform", F.col("run.platform"), lambda a, b: F.upper(a) == b).alias("platform"),
        verdict("data_modality", modality, lambda a, b: a.startswith(b)).alias("modality"),
        verdict("assay_type", translated(strategy, RUN_STRATEGIES), lambda a, b: a == b).alias("assay"),
    )


# --- samples ---------------------------------------------------------------------------------------------------------


def sample_collections(record: Column) -> Column:
    """title and sequences (a list, also where the record gives one text) of a sample's JSON record's dataCollections."""
    v = F.try_parse_json(record)
    found = F.from_json(F.to_json(F.coalesce(F.try_variant_get(v, "$._source.dataCollections", "variant"), F.try_variant_get(v, "$.dataCollections", "variant"))), "array<struct<title string, sequence string>>")
    one = lambda s: F.when(s.startswith("["), F.from_json(s, "array<string>")).when(s.isNotNull(), F.array(s)).otherwise(F.array().cast("array<string>"))
    listed = F.transform(found, lambda c: F.struct(F.coalesce(c["title"], F.lit("")).alias("title"), F.array_compact(one(c["sequence"])).alias("sequences")))
    return F.coalesce(listed, F.array().cast("array<struct<title:string,sequences:array<string>>>"))


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(text).contains(p) for p in parts])


def expected_modalities(collections: Column) -> Column:
    """The modalities that a sample's collections lead one to expect, each once, sorted."""
    typed = F.transform(F.flatten(F.transform(collections, lambda c: c["sequences"])), lambda s: translated(s, SEQUENCES))
    whole = F.when(F.exists(collections, lambda c: _any(c["title"], WHOLE_GENOME)), F.array(F.lit("genomic"))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(typed, whole))))


def expected_platforms(collections: Column) -> Column:
    """The platforms, sorted; ILLUMINA where nothing tells."""
    sequences = F.flatten(F.transform(collections, lambda c: c["sequences"]))

    def told(platform: str) -> Column:
        return F.exists(sequences, lambda s: _any(s, SEQUENCE_PLATFORMS[platform])) | F.exists(collections, lambda c: _any(c["title"], TITLE_PLATFORMS[platform]))

    some = F.array_sort(F.array_compact(F.array(*[F.when(told(p), F.lit(p)) for p in SEQUENCE_PLATFORMS])))
    return F.when(F.size(some) > 0, some).otherwise(F.array(F.lit("ILLUMINA")))


def sample_verdicts(classified: DataFrame, samples: DataFrame) -> DataFrame:
    """file_name, sample_id, known, platform (match, mismatch) and modality (match, partial, mismatch) of files named by a sample.

    samples: sample_id, record (JSON). Verdicts are null where we have no value or the sample isn't known. partial: the
    families agree, or an expected modality begins with ours.
    """
    sample = F.regexp_extract(F.coalesce("file_name", F.lit("")), SAMPLE, 1)
    known = samples.where("sample_id <> '' and record is not null").groupBy("sample_id").agg(F.max("record").alias("record")).select("sample_id", sample_collections(F.col("record")).alias("c")).select("sample_id", expected_modalities(F.col("c")).alias("modalities"), expected_platforms(F.col("c")).alias("platforms"))
    rows = classified.withColumn("sample_id", sample).where("sample_id <> ''").join(known, "sample_id", "left")
    has = F.col("platforms").isNotNull()
    platform, modality = F.upper(F.col("classifications.platform.value")), F.col("classifications.data_modality.value")
    part = F.exists("modalities", lambda m: modality.startswith(F.split(m, r"\.")[0]) | m.startswith(modality))
    return rows.select(
        "file_name", "sample_id", has.alias("known"),
        F.when(has & platform.isNotNull(), F.when(F.array_contains("platforms", platform), "match").otherwise("mismatch")).alias("platform"),
        F.when(has & modality.isNotNull(), F.when(F.array_contains("modalities", modality), "match").when(part, "partial").otherwise("mismatch")).alias("modality"),
    )


# --- reference lengths -----------------------------------------------------------------------------------------------


def check_lengths(published: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """assembly, matches, mismatches and status (valid, mismatch, missing) of references' contig lengths; without any, of the built-in ones.

    published, references: assembly, contig (with or without chr), length. Of several published lengths of a contig, the largest
    counts; contigs that aren't published don't.
    """
    if references is None:
        references = published.sparkSession.createDataFrame([(a, c, n) for a, v in LENGTHS.items() for c, n in zip(CHROMS, v)], "assembly string, contig string, length long")
    ours = references.select("assembly", bare(F.col("contig")).alias("contig"), F.col("length").alias("ours"))
    theirs = published.groupBy("assembly", bare(F.col("contig")).alias("contig")).agg(F.max("length").alias("length"))
    rows = ours.join(theirs, ["assembly", "contig"], "left")
    out = rows.groupBy("assembly").agg(F.count_if(F.col("ours") == F.col("length")).alias("matches"), F.count_if(F.col("ours") != F.col("length")).alias("mismatches"))
    return out.withColumn("status", F.when(F.col("mismatches") > 0, "mismatch").when(F.col("matches") > 0, "valid").otherwise("missing"))
