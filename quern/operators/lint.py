"""Contradictions between a record's fields, by declarative rules."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Lint(NamedTuple):
    id: str
    when: dict
    require: dict


# The consistency rules.
LINTS = [
    Lint("assay_for_transcriptomic", {"data_modality": {"prefix": "transcriptomic."}}, {"assay_type": {"value_in": ("RNA-seq",)}}),
    Lint("assay_for_genomic", {"data_modality": "genomic"}, {"assay_type": {"value_in": ("WGS", "WES")}}),
    Lint("assay_for_chromatin_accessibility", {"data_modality": "epigenomic.chromatin_accessibility"}, {"assay_type": {"value_in": ("ATAC-seq",)}}),
    Lint("assay_for_histone_modification", {"data_modality": "epigenomic.histone_modification"}, {"assay_type": {"value_in": ("ChIP-seq",)}}),
    Lint("assay_for_methylation", {"data_modality": "epigenomic.methylation"}, {"assay_type": {"value_in": ("Bisulfite-seq", "Methylation array")}}),
    Lint("imaging_exclusive", {"data_modality": "imaging.histology"}, {"data_type": {"value_in": ("images",)}, "assay_type": {"value_in": ("Histology",)}, "platform": {"status_not": "classified"}, "reference_assembly": {"status_not": "classified"}}),
    Lint("sequencing_platform_excludes_histology", {"platform": {"value_in": ("ILLUMINA", "PACBIO", "ONT", "MGI", "ELEMENT", "ULTIMA")}}, {"data_modality": {"value_not_in": ("imaging.histology",)}}),
    Lint("auxiliary_inert", {"data_type": {"value_in": ("checksum", "log")}}, {f: {"status_not": "classified"} for f in ("data_modality", "reference_assembly", "assay_type", "platform")}),
]


def _holds(field: str, test) -> Column:
    value, status = F.col(f"classifications.{field}.value"), F.col(f"classifications.{field}.status")
    test = {"exact": test} if isinstance(test, str) else test
    out = {
        "exact": lambda v: value == v,
        "prefix": lambda v: value.startswith(v),
        "value_in": lambda v: value.isin(*v),
        "value_not_in": lambda v: ~value.isin(*v),
        "status": lambda v: status == v,
        "status_not": lambda v: status != v,
    }
    return reduce(lambda a, b: a & b, [F.coalesce(out[k](v), F.lit(False)) for k, v in test.items()])


def _broken(field: str, test: dict) -> Column:
    """Value tests only speak of classified fields; status tests of all."""
    about = F.col(f"classifications.{field}.status") == "classified" if {"value_in", "value_not_in"} & {*test} else F.lit(True)
    return about & ~_holds(field, test)


def active(rule: Lint) -> Column:
    return reduce(lambda a, b: a & b, [_holds(f, t) for f, t in rule.when.items()])


def violations(classified: DataFrame, rules: list[Lint] | None = None) -> DataFrame:
    """A row for each required field that a record breaks: rule_id, entry_id, file_name, field, value, status."""
    hit = [F.when(active(r) & _broken(f, t), F.struct(F.lit(r.id).alias("rule_id"), F.lit(f).alias("field"), F.col(f"classifications.{f}.value").alias("value"), F.col(f"classifications.{f}.status").alias("status"))) for r in rules or LINTS for f, t in r.require.items()]
    return classified.select("entry_id", "file_name", F.explode(F.array_compact(F.array(*hit))).alias("v")).select("v.rule_id", "entry_id", "file_name", "v.field", "v.value", "v.status")


def activation(classified: DataFrame, rules: list[Lint] | None = None) -> DataFrame:
    """rule_id, active, broken, vacuous of every rule, in one pass over the records."""
    rules = rules or LINTS
    counts = []
    for r in rules:
        broken = sum((F.when(active(r) & _broken(f, t), 1).otherwise(0) for f, t in r.require.items()), F.lit(0))
        counts += [F.struct(F.count_if(active(r)).alias("active"), F.coalesce(F.sum(broken), F.lit(0)).alias("broken")).alias(r.id)]
    one = classified.agg(*counts)
    each = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.col(f"{r.id}.active").alias("active"), F.col(f"{r.id}.broken").alias("broken")) for r in rules])
    return one.select(F.inline(each)).withColumn("vacuous", F.col("active") == 0)
