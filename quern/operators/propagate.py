"""Index files take their parents' labels; files that nothing classified form the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.plans.compile import claim
from quern.plans.rules import FIELDS, NOT_APPLICABLE, NOT_CLASSIFIED

# What an index file may belong to, in the order of trial.
PARENTS = {
    ".bai": (".bam",),
    ".tbi": (".vcf.gz", ".bed.gz", ".txt.gz", ".tsv.gz", ".gff.gz", ".gtf.gz"),
    ".csi": (".vcf.gz", ".bcf", ".bed.gz"),
    ".crai": (".cram",),
    ".pbi": (".bam",),
}


def index_extension(name: Column, file_format: Column) -> Column:
    return F.coalesce(*[F.when((file_format == e) | name.endswith(e), F.lit(e)) for e in PARENTS])


def parent_candidates(name: Column, ext: Column) -> Column:
    """Names that the parent may have: the name without an appended index extension, else with the extension replaced."""
    out = F.array().cast("array<string>")
    for e, parents in PARENTS.items():
        base = F.regexp_replace(name, e.replace(".", r"\.") + r"\z", "")
        appended = F.lit(False)
        for p in parents:
            appended = appended | base.endswith(p)
        out = F.when((ext == e) & name.endswith(e), F.when(appended, F.array(base)).otherwise(F.array(*[F.concat(base, F.lit(p)) for p in parents]))).otherwise(out)
    return out


def matched_indexes(files: DataFrame, order_col: str = "entry_id") -> DataFrame:
    """Every index file with index_ext, candidates, parent_name and parent_md5 (null: no parent in its dataset).

    One equi-join on dataset and name. Of several files of a name, the last by order_col counts, if it has an md5.
    """
    files = files.withColumn("dataset_id", F.coalesce("dataset_id", F.lit("unknown")))
    indexes = files.withColumn("index_ext", index_extension(F.col("file_name"), F.col("file_format"))).where("index_ext is not null")
    indexes = indexes.withColumn("candidates", parent_candidates(F.col("file_name"), F.col("index_ext")))
    parents = files.where("file_md5sum is not null and file_name is not null").groupBy(F.col("dataset_id").alias("_d"), F.col("file_name").alias("_n")).agg(F.max_by("file_md5sum", order_col).alias("_md5"))
    each = indexes.select("entry_id", "dataset_id", F.posexplode("candidates").alias("pos", "candidate"))
    hit = each.join(parents, (F.col("dataset_id") == F.col("_d")) & (F.col("candidate") == F.col("_n"))).groupBy("entry_id").agg(F.min_by(F.struct(F.col("candidate").alias("name"), F.col("_md5").alias("md5")), "pos").alias("_p"))
    return indexes.join(hit, "entry_id", "left").withColumns({"parent_name": F.col("_p.name"), "parent_md5": F.col("_p.md5")}).drop("_p")


def unmatched(indexes: DataFrame) -> DataFrame:
    return indexes.where("parent_md5 is null").select("file_name", "file_format", "file_md5sum", "entry_id", "dataset_id", "dataset_title", F.col("index_ext").alias("index_extension"), F.col("candidates").alias("candidates_tried"), F.lit("no_matching_parent_in_dataset").alias("reason"))


def inherited(indexes: DataFrame, classified: DataFrame) -> DataFrame:
    """Matched index files with their parents' labels as `classifications`. classified: file_md5sum, entry_id, classifications (evidence
    isn't needed, and isn't shuffled)."""
    labels = F.struct(*[F.struct(*[F.col(f"classifications.{f}.{x}").alias(x) for x in ("value", "status")]).alias(f) for f in FIELDS])
    last = classified.select(F.col("file_md5sum").alias("_md5"), "entry_id", labels.alias("_l")).groupBy("_md5").agg(F.max_by("_l", "entry_id").alias("_c"))
    rows = indexes.where("parent_md5 is not null").join(last, F.col("parent_md5") == F.col("_md5"), "left")

    def field(f):
        value, status = F.col(f"_c.{f}.value"), F.coalesce(F.col(f"_c.{f}.status"), F.lit(NOT_CLASSIFIED))
        reason = F.when(value.isNotNull(), F.concat(F.lit("inherited from "), F.col("parent_name"))).when(status == NOT_APPLICABLE, F.concat(F.lit("not applicable to "), F.col("parent_name"))).otherwise(F.concat(F.col("parent_name"), F.lit(" is not classified")))
        c = claim("inherited_from_parent", reason, F.lit(None).cast("int"), value, F.when(value.isNull(), status))
        return F.struct(value.alias("value"), status.alias("status"), F.array(c).alias("evidence")).alias(f)

    return rows.select(*indexes.columns, F.struct(*[field(f) for f in FIELDS]).alias("classifications"))


def remaining(files: DataFrame, classified: DataFrame) -> DataFrame:
    """Files whose name no classified file has (names, not md5s, are compared; blank names of classified files don't count)."""
    return files.join(classified.where("file_name is not null and file_name <> ''").select("file_name").distinct(), "file_name", "left_anti")


def index_stats(indexes: DataFrame, labelled: DataFrame) -> DataFrame:
    """index_ext, total, matched, unmatched, with_modality, with_ref. labelled: inherited()'s rows."""
    base = indexes.groupBy("index_ext").agg(F.count("*").alias("total"), F.count("parent_md5").alias("matched"), F.count_if(F.col("parent_md5").isNull()).alias("unmatched"))
    have = labelled.groupBy("index_ext").agg(F.count("classifications.data_modality.value").alias("with_modality"), F.count("classifications.reference_assembly.value").alias("with_ref"))
    return base.join(have, "index_ext", "left").na.fill(0, ["with_modality", "with_ref"])
