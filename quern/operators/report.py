"""Coverage, agreement and run reports over classified files."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.functions.names import extension_of, map_of
from quern.plans.rules import CLASSIFIED, FIELDS, NOT_APPLICABLE, NOT_CLASSIFIED, VOCABULARY

# Translations between vocabularies; a map either passes unknown values on or drops them.
PLATFORMS = {"PACBIO_SMRT": "PACBIO", "OXFORD_NANOPORE": "ONT", "ILLUMINA": "ILLUMINA"}
SOURCES = {"GENOMIC": "genomic", "TRANSCRIPTOMIC": "transcriptomic.bulk"}
STRATEGIES = {"WGS": "WGS", "Hi-C": "Hi-C", "isoseq": "ISO-seq", "Iso-Seq": "ISO-seq"}
RUN_STRATEGIES = {"WGS": "WGS", "WXS": "WES", "WES": "WES", "RNA-Seq": "RNA-seq", "ATAC-seq": "ATAC-seq", "ChIP-Seq": "ChIP-seq", "Bisulfite-Seq": "Bisulfite-seq"}
COORDINATES = {"chm13": "CHM13", "grch38": "GRCh38", "grch37": "GRCh37"}
ANNOTATIONS = {"CAT_genes_chm13": "CHM13", "CAT_genes_hg38": "GRCh38", "chains CHM13": "CHM13", "chains GRCh38": "GRCh38", "Reference Mappings CHM13": "CHM13", "Reference Mappings GRCh38": "GRCh38", "ChromAlias T2T": "CHM13"}
REFERENCES = {"hg38": "GRCh38", "hg19": "GRCh37"}


def label(field: str, of: str = "classifications") -> Column:
    """The value, else the status."""
    return F.coalesce(F.col(f"{of}.{field}.value"), F.col(f"{of}.{field}.status"), F.lit(NOT_CLASSIFIED))


def translated(value: Column, table: dict[str, str], keep: bool = False) -> Column:
    found = F.element_at(map_of(table), value)
    return F.coalesce(found, value) if keep else found


def label_histogram(classified: DataFrame) -> DataFrame:
    """field, label, n."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), label(f).alias("label")) for f in FIELDS])
    return classified.select(F.inline(each)).groupBy("field", "label").agg(F.count("*").alias("n"))


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 1).cast("double")


def coverage(classified: DataFrame) -> DataFrame:
    """field, total, classified (not_applicable included), not_classified, percent; one aggregate, without evidence."""
    known = lambda f: F.col(f"classifications.{f}.value").isNotNull() | (F.col(f"classifications.{f}.status") == NOT_APPLICABLE)
    one = classified.agg(F.count("*").alias("total"), *[F.count_if(known(f)).alias(f) for f in FIELDS])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col("total").alias("total"), F.col(f).alias("classified")) for f in FIELDS])
    out = one.where("total > 0").select(F.inline(each))
    return out.select("field", "total", "classified", (F.col("total") - F.col("classified")).alias("not_classified"), _percent(F.col("classified"), F.col("total")).alias("percent"))


def all_counts(classified: DataFrame) -> DataFrame:
    """report, field, label, ext, reason, n: coverage, label, label_ext and reason counts from one scan of the files.

    A file is five slim rows (field, label, status, extension, and why for unclassified fields), which are counted together before
    any shuffle; the four reports are grouping sets over these counts. coverage: label is classified or not_classified;
    reason: every reason of an unclassified field by extension. Other columns of a report are null. classified: from
    classify(), with evidence or without.
    """
    slim = "why" in classified.schema["classifications"].dataType["data_type"].dataType.fieldNames()

    def row(f: str) -> Column:
        status = F.col(f"classifications.{f}.status")
        last = F.col(f"classifications.{f}.why") if slim else F.try_element_at(f"classifications.{f}.evidence", F.lit(-1))["reason"]
        known = F.col(f"classifications.{f}.value").isNotNull() | (status == NOT_APPLICABLE)
        return F.struct(F.lit(f).alias("field"), label(f).alias("label"), F.when(known, CLASSIFIED).otherwise(NOT_CLASSIFIED).alias("known"), F.when(status == NOT_CLASSIFIED, F.coalesce(alike(last), F.lit(""))).alias("reason"))

    ext = F.coalesce(extension_of(F.col("file_name")), F.lit(""))
    each = classified.select(ext.alias("ext"), F.explode(F.array(*[row(f) for f in FIELDS])).alias("x")).select("ext", "x.*")
    counts = each.groupBy("field", "label", "known", "ext", "reason").agg(F.count("*").alias("n"))
    sets = {"coverage": ("field", "known"), "label": ("field", "label"), "label_ext": ("field", "label", "ext"), "reason": ("field", "ext", "reason")}
    expand = F.array(*[F.struct(F.lit(name).alias("report"), *[(F.col("known") if c == "label" and "known" in by else F.col(c) if c in by else F.lit(None)).cast("string").alias(c) for c in ("field", "label", "ext", "reason")]) for name, by in sets.items()])
    out = counts.select(F.explode(expand).alias("s"), "n").select("s.*", "n").where("report <> 'reason' or reason is not null")
    return out.groupBy("report", "field", "label", "ext", "reason").agg(F.sum("n").alias("n"))


def coverage_by_extension(classified: DataFrame) -> DataFrame:
    """field, label, ext, n."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), label(f).alias("label")) for f in FIELDS])
    rows = classified.select(F.coalesce(extension_of(F.col("file_name")), F.lit("")).alias("ext"), F.explode(each).alias("x"))
    return rows.groupBy("x.field", "x.label", "ext").agg(F.count("*").alias("n"))


def alike(reason: Column) -> Column:
    """A reason without what differs from file to file: the parent's name, and numbers."""
    reason = F.regexp_replace(reason, r"(?s)^inherited from .+", "inherited from parent")
    reason = F.regexp_replace(reason, r"(?s)^not applicable to .+", "not applicable to parent")
    reason = F.regexp_replace(reason, r"(?s)^.+ is not classified$", "parent is not classified")
    return F.regexp_replace(reason, r"\d+", "N")


def commonest_reasons(classified: DataFrame) -> DataFrame:
    """field, ext, reason, n: the most frequent last reason of unclassified fields; reasons count as alike() makes them."""
    counted = all_counts(classified).where("report = 'reason'")
    best = counted.groupBy("field", "ext").agg(F.min(F.struct((-F.col("n")).alias("neg"), "reason")).alias("b"))
    return best.select("field", "ext", "b.reason", (-F.col("b.neg")).alias("n"))


def top_counts(files: DataFrame, what: Column, most: int = 20) -> DataFrame:
    """value, n: the most frequent values (`unknown` for null and empty ones); of equally frequent ones, the first by name."""
    value = F.coalesce(F.nullif(what, F.lit("")), F.lit("unknown"))
    return files.groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most)


def assembly_counts(classified: DataFrame, kind: Column) -> DataFrame:
    """kind, assembly, n: files of each kind by reference assembly, null for those without one. Null kinds are left out."""
    rows = classified.select(kind.alias("kind"), F.col("classifications.reference_assembly.value").alias("assembly"))
    return rows.where("kind is not null").groupBy("kind", "assembly").agg(F.count("*").alias("n"))


def coherent(field: str, of: str = "classifications") -> Column:
    """The field's entry; an error where a value stands beside a status other than classified, or the other way round."""
    entry = F.col(f"{of}.{field}")
    fits = entry["value"].isNotNull().eqNullSafe(entry["status"] == CLASSIFIED)
    return F.when(fits, entry).otherwise(F.raise_error(F.concat(F.lit(f"{field}: value and status don't fit: "), F.to_json(entry))))


def output_faults(outputs: DataFrame, of: str = "classifications") -> Column:
    """Faults of an output record, `<field>: <fault>`: a missing container, field or status, and values outside the vocabulary."""
    kinds = outputs.schema[of].dataType.fieldNames() if of in outputs.columns else []
    if not kinds:
        return F.array(F.lit(f"{of}: missing"))
    found = []
    for f in FIELDS:
        if f not in kinds:
            found.append(F.lit(f"{f}: missing"))
            continue
        value, status = F.col(f"{of}.{f}.value"), F.col(f"{of}.{f}.status")
        found.append(F.when(F.col(f"{of}.{f}").isNull(), f"{f}: missing").when(status.isNull(), f"{f}: status is missing").when(~status.isin(CLASSIFIED, NOT_APPLICABLE, NOT_CLASSIFIED), f"{f}: unknown status").when(value.isNotNull() & ~value.isin(*VOCABULARY[f]), f"{f}: value outside the vocabulary").when(value.isNotNull() != (status == CLASSIFIED), f"{f}: value and status don't fit"))
    return F.when(F.col(of).isNull(), F.array(F.lit(f"{of}: missing"))).otherwise(F.array_compact(F.array(*found)))


def compare(classified: DataFrame, truth: DataFrame, field: str, key: str = "file_md5sum") -> DataFrame:
    """outcome, n of one field against truth (key, truth): agree, discrepancy, we_inferred, not_classified, no_truth."""
    rows = _joined(classified, truth, field, key)
    return rows.groupBy("outcome").agg(F.count("*").alias("n"))


def discrepancies(classified: DataFrame, truth: DataFrame, field: str, key: str = "file_md5sum") -> DataFrame:
    """ours, truth, n, example (the smallest key) of every kind of discrepancy."""
    rows = _joined(classified, truth, field, key).where("outcome = 'discrepancy'")
    return rows.groupBy("ours", "truth").agg(F.count("*").alias("n"), F.min("_key").alias("example"))


def _joined(classified: DataFrame, truth: DataFrame, field: str, key: str) -> DataFrame:
    # both sides grow with the files; the estimate behind the generators of settled() is far too low, and would broadcast them
    ours = classified.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(F.col(f"classifications.{field}.value").alias("v"), F.col(f"classifications.{field}.status").alias("s")), "entry_id").alias("o"))
    rows = truth.where(F.col(key).isNotNull() & (F.col(key) != "")).select(F.col(key).alias("_key"), "truth").join(ours.hint("merge"), "_key")
    outcome = F.when(F.col("truth").isNull() & F.col("o.v").isNotNull(), "we_inferred").when(F.col("truth").isNull(), "no_truth").when(F.col("o.v").isNull(), "not_classified").when(F.col("o.v") == F.col("truth"), "agree").otherwise("discrepancy")
    return rows.select("_key", F.coalesce("o.v", "o.s").alias("ours"), "truth", outcome.alias("outcome"))


def accuracy(classified: DataFrame, truth: DataFrame, field: str, key: str = "file_name") -> DataFrame:
    """match, mismatch, unknown and percent of one field; case doesn't matter, files without truth don't count."""
    rows = classified.join(truth.where("truth is not null and truth <> ''").select(key, "truth").hint("merge"), key)
    value = F.col(f"classifications.{field}.value")
    out = rows.agg(F.count_if(F.lower(value) == F.lower("truth")).alias("match"), F.count_if(F.lower(value) != F.lower("truth")).alias("mismatch"), F.count_if(value.isNull()).alias("unknown"))
    return out.withColumn("percent", F.round(F.try_divide(F.col("match") * 100.0, F.col("match") + F.col("mismatch")), 1).cast("double"))


def run_tally(outcomes: DataFrame) -> DataFrame:
    """One row of counts over `outcome` (successful, errored, validation_failed), `from_cache` and `content_unreadable`."""
    return _derived(outcomes.agg(*_counts()))


def _counts() -> list[Column]:
    n = lambda o: F.count_if(F.col("outcome") == o).alias(o)
    flag = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c)
    return [F.count("*").alias("total_to_process"), n("successful"), n("errored"), n("validation_failed"), flag("from_cache"), flag("content_unreadable")]


def _derived(out: DataFrame) -> DataFrame:
    out = out.withColumn("dropped", F.lit(0).cast("long"))
    return out.withColumn("processed", F.col("successful") + F.col("errored") + F.col("validation_failed")).withColumn("failed", F.col("dropped") + F.col("errored")).withColumn("complete", F.col("processed") == F.col("total_to_process"))


def observed_tally(outcomes: DataFrame, name: str = "tally") -> tuple[DataFrame, Observation]:
    """outcomes as they are, and an observation that holds run_tally()'s counts once an action has read them all.

    So the counts come from the write itself; nothing is read again.
    """
    seen = Observation(name)
    return outcomes.observe(seen, *_counts()), seen


def tally_of(spark: SparkSession, seen: Observation) -> DataFrame:
    """run_tally()'s row of an observation whose action is done."""
    held = {k: int(v or 0) for k, v in seen.get.items()}
    return _derived(spark.createDataFrame([tuple(held.values())], ", ".join(f"{k} long" for k in held)))


def batch_stats(classified: DataFrame) -> DataFrame:
    """How many files have a modality and a reference, had them in the catalog, and got them from us alone."""
    m, r = F.col("classifications.data_modality.value"), F.col("classifications.reference_assembly.value")
    had_m, had_r = F.col("data_modality").isNotNull(), F.col("reference_assembly").isNotNull()
    return classified.agg(F.count("*").alias("total"), F.count(m).alias("with_modality"), F.count(r).alias("with_reference"), F.count_if(had_m).alias("had_modality"), F.count_if(had_r).alias("had_reference"), F.count_if(m.isNotNull() & ~had_m).alias("filled_modality"), F.count_if(r.isNotNull() & ~had_r).alias("filled_reference"))


def shown(value) -> str:
    """A cell of a report: thousands apart, percentages with one digit, lines and bars of a table escaped."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value:,}"
    if isinstance(value, float):
        return f"{value:,.1f}"
    return str(value).replace("|", "\\|").replace("\n", " ")


def markdown(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A small result (at most `most` rows) as a Markdown table."""
    found = rows.limit(most).collect()
    return "\n".join([f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns), *("| " + " | ".join(shown(v) for v in r) + " |" for r in found), ""])


def html(rows: DataFrame, title: str, most: int = 1000) -> str:
    """The same as an HTML fragment."""
    found, cell = rows.limit(most).collect(), lambda v, tag: f"<{tag}>{escape(v)}</{tag}>"
    lines = ["<tr>" + "".join(cell(c, "th") for c in rows.columns) + "</tr>", *("<tr>" + "".join(cell(shown(v), "td") for v in r) + "</tr>" for r in found)]
    return "\n".join([f"<h2>{escape(title)}</h2>", "<table>", *lines, "</table>", ""])


def coverage_report(classified: DataFrame, files: DataFrame, form=markdown) -> str:
    """Coverage by field, labels, commonest reasons, and the largest datasets and extensions, in markdown() or html()."""
    ext = extension_of(F.col("file_name"))
    parts = (
        ("Coverage", coverage(classified).orderBy("field")),
        ("Labels", label_histogram(classified).orderBy("field", F.desc("n"), "label")),
        ("Commonest reasons", commonest_reasons(classified).orderBy("field", F.desc("n"), "ext").limit(100)),
        ("Datasets", top_counts(files, F.col("dataset_title"))),
        ("Extensions", top_counts(files, ext)),
    )
    return "\n".join(form(rows, title) for title, rows in parts)
