"""File names as structured facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffixes of containers, formats by extension, categories by extension.
WRAPPERS = ("bgz", "bz2", "zip", "tar", "gz", "xz")
FORMATS = {
    ".bam": "BAM", ".cram": "CRAM", ".sam": "SAM", ".vcf": "VCF", ".bcf": "BCF", ".gvcf": "GVCF", ".g.vcf": "GVCF", ".fastq": "FASTQ", ".fq": "FASTQ",
    ".fasta": "FASTA", ".fa": "FASTA", ".bed": "BED", ".gfa": "GFA", ".rgfa": "RGFA",
}
CATEGORIES = {
    ".bam": "alignment", ".cram": "alignment", ".sam": "alignment", ".vcf": "variant", ".bcf": "variant", ".gvcf": "variant", ".fastq": "reads", ".fq": "reads",
    ".bed": "intervals", ".narrowpeak": "intervals", ".broadpeak": "intervals", ".bigwig": "signal", ".bw": "signal", ".bedgraph": "signal",
    ".bai": "index", ".crai": "index", ".tbi": "index", ".csi": "index", ".fai": "index", ".idx": "index", ".pbi": "index", ".md5": "checksum",
    ".pgen": "genotype_plink", ".pvar": "genotype_plink", ".psam": "genotype_plink", ".h5ad": "single_cell_matrix", ".loom": "single_cell_matrix", ".mtx": "single_cell_matrix",
    ".idat": "methylation_array", ".fast5": "nanopore", ".pod5": "nanopore", ".svs": "histology_image", ".tiff": "image", ".tif": "image", ".png": "image", ".jpg": "image",
    ".fasta": "sequence", ".fa": "sequence", ".gfa": "pangenome", ".rgfa": "pangenome", ".gbz": "pangenome", ".vg": "pangenome", ".gbwt": "pangenome", ".xg": "pangenome",
    ".sf": "quantification", ".txt": "text_ambiguous", ".tsv": "text_ambiguous", ".csv": "text_ambiguous", ".log": "log_file",
}

IMAGES = (".svs", ".png", ".jpg", ".tiff")
AUXILIARY = (".fast5", ".pod5", ".fast5.tar", ".fast5.tar.gz", ".pvar", ".psam", ".pgen")
# Categories of formats for reports, in the order of trial; a part of the name also counts where one is given.
GROUPS = (
    ((".bai", ".tbi", ".csi", ".crai", ".pbi"), "Index", None),
    ((".bam", ".cram"), "BAM/CRAM", None),
    ((".vcf", ".vcf.gz", ".bcf", ".gvcf", ".gvcf.gz", ".g.vcf.gz"), "VCF", None),
    ((".fastq", ".fastq.gz", ".fq", ".fq.gz"), "FASTQ", None),
    ((".bed", ".bed.gz"), "BED", None),
    ((".svs", ".png", ".jpg", ".jpeg", ".tiff", ".tif"), "Images", None),
    ((".fast5", ".pod5"), "Auxiliary", ".fast5"),
    ((".pvar", ".psam", ".pgen", ".bim", ".fam"), "Auxiliary", None),
    ((".md5", ".log", ".txt", ".html", ".pdf", ".json", ".csv", ".tsv"), "Skipped", None),
    ((".tar", ".tar.gz", ".zip"), "Skipped", None),
)

_TAIL = r"((?:\.(?:" + "|".join(WRAPPERS) + r"))*)$"
_CORES = "|".join(sorted((x[1:].replace(".", r"\.") for x in {*FORMATS, *CATEGORIES}), key=len, reverse=True))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with the columns computed once for each row, however often what follows uses them.

    A generator of one row stands between: the optimizer neither copies the expressions into later ones nor pushes filters
    on them down, which would repeat them many times over.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def extension_of(name: Column) -> Column:
    """The core extension under all wrappers, lower-cased, or null."""
    found = F.regexp_extract(F.lower(name), r"(?s)(\.(?:" + _CORES + r"))(?:\.(?:" + "|".join(WRAPPERS) + r"))*\z", 1)
    return F.when(found != "", found)


def map_of(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def format_of(extension: Column) -> Column:
    return F.element_at(map_of(FORMATS), F.lower(extension))


def category_of(extension: Column) -> Column:
    return F.element_at(map_of(CATEGORIES), F.lower(extension))


def parse_name(name: Column) -> Column:
    """raw, stem, extension, wrappers, format, format_source of a file name; null names parse as the empty one."""
    raw = F.coalesce(name, F.lit(""))
    tail = F.regexp_extract(F.lower(raw), _TAIL.replace("$", r"\z"), 1)
    extension = extension_of(raw)
    cut = F.length(tail) + F.coalesce(F.length(extension), F.lit(0))
    fmt = format_of(extension)
    return F.struct(
        raw.alias("raw"),
        F.substring(raw, F.lit(1), F.length(raw) - cut).alias("stem"),
        extension.alias("extension"),
        F.transform(F.filter(F.split(tail, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("."), x)).alias("wrappers"),
        fmt.alias("format"),
        F.when(fmt.isNotNull(), F.lit("extension")).alias("format_source"),
    )


def settled_extension(name: Column, file_format: Column) -> Column:
    """What the rules go by: the name's extension, else the core of the format given, else that format in lower case."""
    given = F.when(file_format != "", F.coalesce(extension_of(file_format), F.lower(file_format)))
    return F.coalesce(extension_of(name), given, F.lit(""))


def _named(name: Column, file_format: Column, endings: tuple[str, ...]) -> Column:
    ends = F.lower(name).rlike("(?:" + "|".join(e.replace(".", r"\.") for e in endings) + r")\z")
    return F.coalesce(file_format.isin(*endings), F.lit(False)) | F.coalesce(ends, F.lit(False))


def is_image(name: Column, file_format: Column) -> Column:
    """Whether the format is one of IMAGES or the name ends so, whatever its case."""
    return _named(name, file_format, IMAGES)


def is_auxiliary(name: Column, file_format: Column) -> Column:
    """Whether the format is one of AUXILIARY or the name ends so, whatever its case."""
    return _named(name, file_format, AUXILIARY)


def format_group(name: Column, file_format: Column) -> Column:
    """The first of GROUPS whose formats hold the given one, or whose part of a name the name has; else Other."""
    out, fmt = F.lit("Other"), F.lower(F.coalesce(file_format, F.lit("")))
    for formats, group, part in reversed(GROUPS):
        hit = fmt.isin(*formats)
        out = F.when(hit | F.coalesce(F.lower(name).contains(part), F.lit(False)) if part else hit, group).otherwise(out)
    return out
