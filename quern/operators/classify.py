"""Classification of files from names, sizes and header samples: one function for each kind of payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.headers import archive, illumina, lines_of, pacbio, paired_end, sam_lines, search
from quern.functions.names import extension_of, let, parse_name, settled, settled_extension
from quern.functions.reference import ASSEMBLIES, CHROMS, by_bed, sam_contigs, vcf_contigs, vote_winner
from quern.plans.compile import claim, rule_ids, with_claims, with_matches
from quern.plans.rules import CONTENT_TIER, FIELDS, NOT_APPLICABLE, NOT_CLASSIFIED, RNA_PROGRAMS, RULES, Rule, checked

from .claims import add_if, declared, entry, inferred_assay, last_reason, resolve, with_assay
from .labels import countable, labelled

Rules = list[Rule] | None

# Extensions that a kind of header is read for (compared with case), and patterns of contig names.
ROUTES = {
    "bam": (".bam", ".cram"),
    "vcf": (".vcf", ".vcf.gz", ".g.vcf.gz", ".gvcf.gz"),
    "fastq": (".fastq", ".fastq.gz", ".fq", ".fq.gz"),
    "fasta": (".fasta", ".fasta.gz", ".fa", ".fa.gz"),
    "gfa": (".gfa", ".rgfa", ".gfa.gz", ".rgfa.gz"),
    "tar": (".tar", ".tar.gz"),
    "bed": (".bed", ".bed.gz"),
}
ASSEMBLER = r"(^|#\d#)(h[12]tg|ptg|utg|ctg|tig\d|utig)|^(scaffold[_.]|contig[_.]|asm\d|haplotype\d|mat-|pat-|unassigned-)"
TRANSCRIPT = r"^(ENST\d|NM_\d|NR_\d|XM_\d|rna-)"
CLASH = {*FIELDS, "name", "ext", "matched", "vcf_parts", "classifications"}
STORE_FILES = ("callset.json", "vidmap.json", "vcfheader.vcf")
VARIANT_ARRAYS = (
    "gt", "ad", "dp", "gq", "pl", "min_dp", "sb", "pgt", "pid", "ps", "rgq", "dp_format", "ac", "af", "an", "qual", "filter", "id", "alt", "ref", "end", "mleac", "mleaf",
    "mq", "mq0", "mqranksum", "baseqranksum", "clippingranksum", "excesshet", "fs", "inbreedingcoeff", "qd", "raw_mq", "raw_mqanddp", "readposranksum", "sor",
)


def route(files: DataFrame, routes: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row of (file, kind) for every kind whose extensions end the file's name or format; `skip`-flagged files go.

    routes: others than ROUTES.
    """
    ends = lambda c, exts: F.coalesce(F.lit(False) if not exts else c.rlike("(" + "|".join(e.replace(".", r"\.") for e in exts) + r")\z"), F.lit(False))
    kinds = F.array_compact(F.array(*[F.when(ends(F.col("file_name"), x) | ends(F.col("file_format"), x), F.lit(k)) for k, x in (routes or ROUTES).items()]))
    if "skip" in files.columns:
        files = files.where(~F.coalesce(F.col("skip").cast("boolean"), F.lit(False)))
    return files.withColumn("kind", F.explode(kinds))


def _prepared(files: DataFrame, default: str | None = None) -> DataFrame:
    missing = {c: t for c, t in (("dataset_title", "string"), ("file_size", "long"), ("file_format", "string")) if c not in files.columns}
    files = files.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})
    # the input's own columns step aside where their names are those of fields or helpers
    files = settled(files.select(*[F.col(f"`{c}`").alias(f"_in_{c}" if c in CLASH else c) for c in files.columns]), {"file_name": F.col("file_name")})
    return settled(files, {"name": parse_name(F.col("file_name")), "ext": settled_extension(F.col("file_name"), F.lit(default) if default else F.col("file_format"))})


def _inferred(df: DataFrame, rules: Rules = None) -> DataFrame:
    assay = inferred_assay(resolve("data_modality")["value"], resolve("platform")["value"], F.col("ext"), F.col("file_size"), F.arrays_overlap(rule_ids(rules), F.array(*[F.lit(x) for x in RNA_PROGRAMS])))
    return settled(df, {"assay_type": with_assay("assay_type", assay)})


def _given(keep: list[str]) -> list[Column]:
    return [F.col(f"`_in_{c}`" if c in CLASH else f"`{c}`").alias(c) for c in keep if c != "classifications"]


def _finished(df: DataFrame, keep: list[str], also: tuple[Column, ...] = ()) -> DataFrame:
    df = settled(df, {f: F.col(f) for f in FIELDS})
    return settled(df, {"classifications": F.struct(*[entry(f).alias(f) for f in FIELDS])}).select(*_given(keep), "classifications", *also)


def _labelled(matched: DataFrame, keep: list[str], rules: Rules = None, extra: dict[str, tuple[Column, Column]] | None = None, also: tuple[Column, ...] = ()) -> DataFrame:
    """Labels by labels.labelled(); where a field has more decisions than a number has bits, by lists of claims."""
    if countable(rules):
        return labelled(matched, rules, extra).select(*_given(keep), "classifications", *also)
    df = _inferred(with_claims(matched, rules), rules)
    for f, (value, reason) in (extra or {}).items():
        df = df.withColumn(f, add_if(F.col(f), value.isNotNull(), claim("content", reason, CONTENT_TIER, value)))

    def field(f: str) -> Column:
        return let(resolve(f), lambda r: F.struct(r["value"].alias("value"), r["status"].alias("status"), last_reason(f, r).alias("why")))

    df = settled(df, {f: field(f) for f in FIELDS})
    return settled(df, {"classifications": F.struct(*[F.col(f) for f in FIELDS])}).select(*_given(keep), "classifications", *also)


def _base(files: DataFrame, default: str | None, header: Column | None = None, scope: str | None = None, rules: Rules = None) -> DataFrame:
    return _inferred(with_claims(with_matches(_prepared(files, default), header, scope, rules), rules), rules)


def classify(files: DataFrame, rules: Rules = None, evidence: bool = True) -> DataFrame:
    """files plus `classifications`, from name, format, dataset and size alone.

    rules: others than the built-in ones (see plans.rules_file). Without evidence, a field holds value, status and why, the
    reason that its evidence would end with.
    """
    if not evidence:
        return _labelled(with_matches(_prepared(files), rules=rules), files.columns, rules)
    return _finished(_base(files, None, rules=rules), files.columns)


def classify_alignments(files: DataFrame, rules: Rules = None) -> DataFrame:
    """files with `header_text` (SAM header): header rules, then the contigs' vote."""
    text = F.col("header_text")
    df = settled(_base(files, ".bam", text, "header", rules), {"vote": vote_winner(sam_contigs(sam_lines(text, "@SQ")))})
    hit = F.col("vote.assembly").isNotNull()
    reason = F.concat(F.col("vote.matches").cast("string"), F.lit(" contig lengths are those of "), F.col("vote.assembly"))
    df = df.withColumn("reference_assembly", add_if(F.col("reference_assembly"), hit, claim("contig_length_detection", reason, CONTENT_TIER, F.col("vote.assembly"))))
    df = df.withColumn("data_modality", add_if(F.col("data_modality"), hit & ~declared("data_modality"), claim("aligned_to_reference", F.concat(F.lit("aligned to "), F.col("vote.assembly")), CONTENT_TIER, "genomic")))
    return _finished(_inferred(df, rules), files.columns)


def classify_variants(files: DataFrame, rules: Rules = None, evidence: bool = True) -> DataFrame:
    """files with `header_text` (VCF header)."""
    text = F.col("header_text")
    df = with_matches(_prepared(files, ".vcf.gz"), text, "vcf_header", rules)
    df = settled(_inferred(with_claims(df, rules), rules) if evidence else df, {"vote": vote_winner(vcf_contigs(F.filter(lines_of(text), lambda x: x.startswith("##contig"))))})
    reason = F.concat(F.col("vote.matches").cast("string"), F.lit(" contig lengths are those of "), F.col("vote.assembly"))
    if not evidence:
        return _labelled(df, files.columns, rules, {"reference_assembly": (F.col("vote.assembly"), reason)})
    df = df.withColumn("reference_assembly", add_if(F.col("reference_assembly"), F.col("vote.assembly").isNotNull(), claim("vcf_contig_length", reason, CONTENT_TIER, F.col("vote.assembly"))))
    return _finished(df, files.columns)


def classify_reads(files: DataFrame, rules: Rules = None) -> DataFrame:
    """files with `read_names` (array): plus is_paired_end, instrument_model, instrument_hint, archive_accession, archive_source.

    Where the first read's archive prefix hides the platform, the rules run on the rest of the name again; its platform and
    modality are adopted as they are, and its claims join the evidence unresolved.
    """
    reads = F.col("read_names")
    given = F.coalesce(F.size(reads) > 0, F.lit(False)) & (F.coalesce(F.try_element_at(reads, F.lit(1)), F.lit("")) != "")
    first = F.try_element_at(reads, F.lit(1))
    df = _base(files.withColumn("_first", F.when(given, first)), ".fastq.gz", F.col("_first"), "fastq_header", rules)
    df = settled(df, {"_archive": archive(F.col("_first")), **{f"_own_{f}": F.col(f) for f in FIELDS}})
    rest = F.when((F.trim(F.col("_archive.remainder")) != "") & F.col("_archive.accession").isNotNull(), F.concat(F.lit("@"), F.trim(F.col("_archive.remainder"))))
    again = _inferred(with_claims(with_matches(settled(df, {"_rest": rest}), F.col("_rest"), "fastq_header", rules), rules), rules)
    adopt = F.coalesce(~declared("_own_platform") & F.col("_rest").isNotNull() & resolve("platform")["value"].isNotNull(), F.lit(False))

    def field(f):
        own, new = entry(f"_own_{f}"), entry(f)
        both = F.concat(own["evidence"], new["evidence"])
        taken = adopt & (F.lit(True) if f == "platform" else declared(f) if f == "data_modality" else F.lit(False))
        e = F.struct(F.when(taken, new["value"]).otherwise(own["value"]).alias("value"), F.when(taken, new["status"]).otherwise(own["status"]).alias("status"), F.when(adopt, both).otherwise(own["evidence"]).alias("evidence"))
        status = {"data_type": "classified", "reference_assembly": NOT_APPLICABLE}.get(f, NOT_CLASSIFIED)
        none = F.struct(F.lit("reads" if f == "data_type" else None).cast("string").alias("value"), F.lit(status).alias("status"), F.filter(F.col(f), lambda c: F.lit(False)).alias("evidence"))
        return F.when(given, e).otherwise(none)

    ten, five = F.slice(reads, 1, 10), F.slice(reads, 1, 5)
    paired = F.when(F.exists(ten, paired_end), F.lit(True)).when(F.coalesce(F.col("file_name"), F.lit("")) != "", paired_end(F.col("file_name")))
    parsed = F.transform(five, lambda r: F.struct(illumina(r).alias("i"), pacbio(r).alias("p"), archive(r).alias("a")))
    stop = F.array_min(F.filter(F.transform(parsed, lambda x, n: F.when(x["i"].isNotNull() | x["p"].isNotNull(), n + 1)), lambda x: x.isNotNull()))
    hit = F.try_element_at(parsed, stop)
    seen = F.filter(F.slice(parsed, F.lit(1), F.coalesce(stop, F.lit(5))), lambda x: x["a"]["accession"].isNotNull())
    last = F.try_element_at(seen, F.lit(-1))["a"]
    extra = {
        "is_paired_end": paired,
        "instrument_model": F.coalesce(hit["i"]["instrument_model"], F.when(hit["i"].isNull(), hit["p"]["instrument_model"])),
        "instrument_hint": hit["i"]["instrument"],
        "archive_accession": last["accession"],
        "archive_source": last["source"],
    }
    out = settled(again, {f"_x_{k}": F.when(given, v) for k, v in extra.items()})
    return out.select(*_given(files.columns), F.struct(*[field(f).alias(f) for f in FIELDS]).alias("classifications"), *[F.col(f"_x_{k}").alias(k) for k in extra])


def classify_sequences(files: DataFrame, rules: Rules = None) -> DataFrame:
    """files with `contig_names` (array)."""
    names = F.coalesce(F.col("contig_names"), F.array().cast("array<string>"))
    known = F.array(*[F.lit(p + c) for c in CHROMS for p in ("chr", "")])
    df = _base(files, ".fa.gz", rules=rules)
    ref = F.filter(names, lambda c: F.array_contains(known, c))
    other = F.filter(names, lambda c: ~F.array_contains(known, c))
    df = settled(df, {"_ref": F.size(ref), "_asm": F.filter(other, lambda c: search(c, ASSEMBLER)), "_tx": F.filter(other, lambda c: ~search(c, ASSEMBLER) & search(c, TRANSCRIPT))})
    # the three assemblies share their contig names, so that a name count alone never tells them apart
    kind = (
        F.when(F.size(names) == 0, "empty").when((F.size("_tx") > 0) & (F.size("_tx") > F.col("_ref")), "transcripts").when(F.col("_ref") >= 20, "reference")
        .when(F.size("_asm") > 0, "assembler").when((F.size(names) > 50) & (F.col("_ref") == 0), "many").otherwise("default")
    )
    df = settled(df, {"_kind": kind, "_own": resolve("reference_assembly")["value"]})
    is_, n = lambda k: F.col("_kind") == k, F.size(names).cast("string")
    C = lambda rule, reason, **v: claim(rule, reason, CONTENT_TIER, **v)  # noqa: E731, N806
    free = {f: ~declared(f) for f in ("data_modality", "data_type")}
    plan = {
        "data_modality": [(is_("transcripts"), C("fasta_transcript_contigs", "transcript ids", value="transcriptomic.bulk")), (is_("reference"), C("fasta_reference_contigs", "reference contig names", value="genomic")), (is_("assembler"), C("fasta_assembler_contigs", "assembler contig names", value="genomic")), (is_("many"), C("fasta_many_contigs", F.concat(n, F.lit(" contigs of unknown names")), value="genomic")), (is_("default") & free["data_modality"], C("fasta_default_genomic", F.concat(n, F.lit(" contigs")), value="genomic"))],
        "data_type": [(is_("transcripts"), C("fasta_transcript_contigs", "transcript sequences", value="sequence")), (is_("reference"), C("fasta_reference_contigs", "reference sequences", value="assembly.reference")), (is_("assembler"), C("fasta_assembler_contigs", "assembler output", value="assembly")), (is_("many"), C("fasta_many_contigs", "many contigs", value="assembly")), (is_("default") & free["data_type"], C("fasta_default_genomic", "contig names tell no type", value="sequence"))],
        "reference_assembly": [(is_("reference") & F.col("_own").isNotNull(), C("fasta_reference_contigs", "reference contig names", value=F.col("_own"))), (is_("reference") & F.col("_own").isNull(), C("fasta_reference_contigs", "contig names shared by several references", status=NOT_CLASSIFIED)), (is_("assembler"), C("fasta_assembler_contigs", "de novo assembly", status=NOT_APPLICABLE)), (is_("many"), C("fasta_many_contigs", "de novo assembly", status=NOT_APPLICABLE))],
    }
    new = {}
    for f, steps in plan.items():
        col = F.col(f)
        for when, c in steps:
            col = add_if(col, when, c)
        new[f] = col
    return _finished(df.withColumns(new), files.columns)


def classify_graphs(files: DataFrame, rules: Rules = None) -> DataFrame:
    """files with `gfa_segment_tags` (array of struct sn, sr): named segments of rank 0 make a reference graph."""
    back = F.filter(F.coalesce("gfa_segment_tags", F.array().cast("array<struct<sn:string,sr:string>>")), lambda t: (t["sr"] == "0") & (F.coalesce(t["sn"], F.lit("")) != ""))
    some = F.array_sort(F.array_distinct(F.transform(back, lambda t: t["sn"])))
    reason = F.concat(F.size(back).cast("string"), F.lit(" segments of rank 0 on "), F.array_join(F.slice(some, 1, 3), ", "))
    given = F.col("file_format") if "file_format" in files.columns else F.lit(None).cast("string")
    default = F.when(extension_of(given).isNotNull(), given).otherwise(F.lit(".gfa"))
    df = _prepared(files).withColumn("ext", settled_extension(F.col("file_name"), default))
    df = _inferred(with_claims(with_matches(df, rules=rules), rules), rules)
    return _finished(df.withColumn("data_type", add_if(F.col("data_type"), F.size(back) > 0, claim("rgfa_stable_rank_reference", reason, CONTENT_TIER, "pangenome.reference"))), files.columns)


def is_variant_store(members: Column) -> Column:
    parts = F.flatten(F.transform(members, lambda m: F.split(F.btrim(m, F.lit("/")), "/")))
    arrays = F.array(*[F.lit(x) for x in VARIANT_ARRAYS])
    stem = lambda s: F.lower(F.regexp_replace(F.regexp_extract(s, r"^(.*)\.tdb\z", 1), "_var$", ""))
    return F.exists(parts, lambda s: s.isin(*STORE_FILES) | (s.endswith(".tdb") & F.array_contains(arrays, stem(s))))


def dominant_extension(members: Column) -> Column:
    """extension, n and first example of the most frequent member extension; the first seen wins ties. Null without any."""
    base = F.transform(members, lambda m: F.element_at(F.split(m, "/"), -1))
    return let(F.filter(F.transform(base, lambda b: F.struct(extension_of(b).alias("e"), b.alias("b"))), lambda x: x["e"].isNotNull()), _dominant)


def _dominant(known: Column) -> Column:
    kinds = F.array_distinct(F.transform(known, lambda x: x["e"]))
    tally = F.transform(kinds, lambda k, i: F.struct(F.size(F.filter(known, lambda x: x["e"] == k)).alias("n"), (-i).alias("order"), k.alias("e")))
    found = let(F.array_max(tally), lambda top: F.struct(top["e"].alias("extension"), top["n"].alias("n"), F.try_element_at(F.filter(known, lambda x: x["e"] == top["e"]), F.lit(1))["b"].alias("example")))
    return F.when(F.size(known) > 0, found)


def _by_extension(field: str, rules: Rules = None) -> Column:
    """extension -> the value that the rules give it without a name, from the rules that look at extensions alone."""
    plain = [r for r in checked(rules or RULES) if r.scope == "extension" and not {"filename_pattern", "dataset_pattern"} & {*r.when}]
    from quern.functions.names import CATEGORIES, FORMATS

    out = {}
    for ext in sorted({*CATEGORIES, *FORMATS}):
        hits = [(r.tier, r.then.get(field) or r.status.get(field)) for r in plain if ext in [e.lower() for e in r.when.get("extensions", ())] or (r.when.get("format") and FORMATS.get(ext) == r.when["format"])]
        hits += [(2, "genomic" if field == "data_modality" else "annotations")] if ext in (".bed", ".narrowpeak", ".broadpeak") and field in ("data_modality", "data_type") else []
        top = [v for t, v in hits if v and t == max(t for t, v in hits if v)]
        if len({*top}) == 1 and top[0] not in (NOT_APPLICABLE, NOT_CLASSIFIED):
            out[ext] = top[0]
    return F.create_map(*[F.lit(x) for kv in out.items() for x in kv])


def classify_archives(files: DataFrame, rules: Rules = None, evidence: bool = True, told: bool = False) -> DataFrame:
    """files with `member_names` (array): a variant store by its files' names, else what the commonest members are.

    told: plus is_store and dominant, what is_variant_store() and dominant_extension() say of the members.
    """
    members = F.coalesce("member_names", F.array().cast("array<string>"))
    df = _prepared(files).withColumn("ext", F.coalesce(extension_of(F.col("file_name")), F.lit("")))
    df = with_matches(df, rules=rules)
    df = settled(_inferred(with_claims(df, rules), rules) if evidence else df, {"_store": is_variant_store(members), "_dom": dominant_extension(members)})
    extra = (F.col("_store").alias("is_store"), F.col("_dom").alias("dominant")) if told else ()
    reason = F.when(F.col("_store"), F.lit("files of a variant store")).otherwise(F.concat(F.col("_dom.n").cast("string"), F.lit(" members end in "), F.col("_dom.extension"), F.lit(", first "), F.col("_dom.example")))
    values = {f: F.when(F.col("_store"), F.lit(store)).otherwise(F.element_at(_by_extension(f, rules), F.col("_dom.extension"))) for f, store in (("data_modality", "genomic"), ("data_type", "variants"))}
    if not evidence:
        return _labelled(df, files.columns, rules, {f: (v, reason) for f, v in values.items()}, extra)
    return _finished(df.withColumns({f: add_if(F.col(f), v.isNotNull(), claim("tar_inner_format", reason, CONTENT_TIER, v)) for f, v in values.items()}), files.columns, extra)


def classify_intervals(files: DataFrame, rules: Rules = None) -> DataFrame:
    """files with `bed` (struct chromosomes, has_chr_prefix, max_coordinates, line_count)."""
    df = settled(_base(files, ".bed", rules=rules), {"_bed": by_bed(F.col("bed.chromosomes"), F.col("bed.has_chr_prefix"), F.col("bed.max_coordinates"))})
    free = resolve("reference_assembly")["status"] != NOT_APPLICABLE
    ref = add_if(F.col("reference_assembly"), F.col("_bed.assembly").isNotNull() & free, claim("bed_coordinate_reference", F.concat(F.lit("coordinates fit only "), F.col("_bed.assembly")), CONTENT_TIER, F.col("_bed.assembly")))
    ref = add_if(ref, F.col("_bed.assembly").isNull() & F.col("_bed.nonstandard"), claim("bed_nonstandard_contigs", "no standard chromosome name", CONTENT_TIER, None, NOT_APPLICABLE))
    return _finished(df.withColumn("reference_assembly", ref), files.columns)


def unreadable(files: DataFrame, reason: Column, rule: str = "fetch_failed") -> DataFrame:
    """files whose content can't be read (or that fail validation): no field is classified, all for the same reason."""
    none = F.struct(F.lit(None).cast("string").alias("value"), F.lit(NOT_CLASSIFIED).alias("status"), F.array(claim(rule, reason, CONTENT_TIER, None, NOT_CLASSIFIED)).alias("evidence"))
    return files.select(*files.columns, F.struct(*[none.alias(f) for f in FIELDS]).alias("classifications"))


CLASSIFIERS = {"bam": classify_alignments, "vcf": classify_variants, "fastq": classify_reads, "fasta": classify_sequences, "gfa": classify_graphs, "tar": classify_archives, "bed": classify_intervals}
__all__ = [*(f.__name__ for f in CLASSIFIERS.values()), "classify", "route", "unreadable", "ASSEMBLIES"]
