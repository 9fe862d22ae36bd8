"""Header texts and read names as structured columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import let


def search(text: Column, pattern: str) -> Column:
    """Whether the pattern is found anywhere, in any case; false for null. UNIX line ends only."""
    return F.coalesce(text.rlike("(?id)" + pattern), F.lit(False))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


# --- SAM -------------------------------------------------------------------------------------------------------------


def sam_lines(text: Column, section: str) -> Column:
    """Lines of one section, e.g. @SQ."""
    return F.filter(lines_of(text), lambda x: (x == section) | x.startswith(section + "\t"))


def sam_values(text: Column, section: str, field: str) -> Column:
    """The values of a field in a section's lines; the last one counts where a line has the field twice."""
    def value(line):
        parts = F.filter(F.split(line, "\t"), lambda p: p.startswith(field + ":"))
        return F.substring(F.element_at(parts, -1), F.lit(len(field) + 2), F.length(line))

    has = F.filter(sam_lines(text, section), lambda x: F.exists(F.split(x, "\t"), lambda p: p.startswith(field + ":")))
    return F.transform(has, value)


def sam_matches(text: Column, section: str, field: str, pattern: str) -> Column:
    return F.coalesce(F.exists(sam_values(text, section, field), lambda v: search(v, pattern)), F.lit(False))


# --- VCF -------------------------------------------------------------------------------------------------------------


def _structured(lines: Column, kind: str) -> Column:
    found = F.filter(lines, lambda x: x.startswith(f"##{kind}=<") & x.endswith(">"))
    return F.transform(found, lambda x: F.substring(x, F.lit(len(kind) + 5), F.length(x) - len(kind) - 5))


def _plain(lines: Column, kind: str) -> Column:
    found = F.filter(lines, lambda x: x.startswith(f"##{kind}=") & ~(x.startswith(f"##{kind}=<") & x.endswith(">")))
    return F.when(F.size(found) > 0, F.substring(F.element_at(found, -1), F.lit(len(kind) + 4), F.length(F.element_at(found, -1))))


def vcf_lines(text: Column, kind: str) -> Column:
    """Structured lines of one kind, e.g. contig, without the frame."""
    return _structured(lines_of(text), kind)


def vcf_field(line: Column, field: str) -> Column:
    """A field of a structured line, without quotes; null if it has none."""
    pattern = rf'(?:^|,){field}=("[^"]*"|[^,]*)'
    found = F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1))
    return F.regexp_replace(found, '^"|"$', "")


def contig_lines(text: Column) -> Column:
    """The contig lines, built again from their fields: values without quotes, in the fields' order."""
    fields = lambda x: F.regexp_extract_all(x, F.lit(r'([^=,]+=(?:"[^"]*"|[^,]*))'), 1)
    bare = lambda f: F.regexp_replace(f, r'=\"(.*)\"$', "=$1")
    return F.transform(vcf_lines(text, "contig"), lambda x: F.concat(F.lit("##contig=<"), F.array_join(F.transform(fields(x), bare), ","), F.lit(">")))


def vcf_value(text: Column, kind: str) -> Column:
    """The value of the last plain line of a kind, e.g. source; null without one."""
    return _plain(lines_of(text), kind)


#: Structured lines that rules look at, and the field that they search in each.
SEARCHED = {"contig": "assembly", "INFO": "ID", "FORMAT": "ID", "FILTER": "ID"}


def vcf_parts(text: Column) -> Column:
    """What rules search in a header, taken from it once: lines, reference, source, and SEARCHED's fields of their lines."""

    def parts(lines: Column) -> Column:
        listed = [F.transform(_structured(lines, kind), lambda x: vcf_field(x, field)).alias(kind) for kind, field in SEARCHED.items()]
        return F.struct(lines.alias("lines"), *[_plain(lines, k).alias(k) for k in ("reference", "source")], *listed)

    return let(lines_of(text), parts)


def vcf_matches(parts: Column, kind: str, pattern: str) -> Column:
    """parts: of vcf_parts()."""
    kind = kind.removeprefix("##")
    if kind in ("reference", "source"):
        return search(parts[kind], pattern)
    if kind in SEARCHED:
        return F.exists(parts[kind], lambda v: search(v, pattern))
    return F.exists(F.filter(parts["lines"], lambda x: x.startswith("##" + kind)), lambda x: search(x, pattern))


def vcf_max_positions(lines: Column) -> Column:
    """chrom (without `chr`) -> largest position over variant lines; unreadable lines are skipped."""
    parts = F.filter(F.transform(lines, lambda x: F.split(x, "\t")), lambda p: (F.size(p) > 1) & ~p[0].startswith("#") & F.try_element_at(p, F.lit(2)).rlike(r"^\d+$"))
    pairs = F.transform(parts, lambda p: F.struct(F.replace(p[0], F.lit("chr"), F.lit("")).alias("c"), p[1].cast("long").alias("n")))
    chroms = F.array_distinct(F.transform(pairs, lambda p: p["c"]))
    return F.map_from_entries(F.transform(chroms, lambda c: F.struct(c, F.array_max(F.transform(F.filter(pairs, lambda p: p["c"] == c), lambda p: p["n"])))))


# --- read names ------------------------------------------------------------------------------------------------------

# Patterns of read names, archives and instruments.
ARCHIVE = r"^@?(ERR|ERS|SRR|SRS|DRR|DRS)(\d+)(?:\.\d+)?\s*(.*)$"
ARCHIVE_SOURCE = {"ERR": "ENA", "ERS": "ENA", "SRR": "SRA", "SRS": "SRA", "DRR": "DDBJ", "DRS": "DDBJ"}
ILLUMINA_MODERN = r"^([A-Z0-9-]+):(\d+):([A-Z0-9]+):(\d+):(\d+):(\d+):(\d+)(?:\s+(\d):([YN]):(\d+):([ACGTN+]+))?"
ILLUMINA_LEGACY = r"^([A-Z0-9-]+):(\d+):(\d+):(\d+):(\d+)#([^/]+)/(\d)$"
PACBIO_MOVIE = r"m\d+[A-Za-z]*_\d+_\d+"
PACBIO = rf"^({PACBIO_MOVIE})/(\d+)(?:/(ccs)|/(\d+)_(\d+))?$"
ONT = r"^([a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12})\s*(.*)$"
MGI = r"^([A-Z]\d+)L(\d+)C(\d+)R(\d+)(\d+)(?:/(\d))?$"
PAIRED = r"[/\s][12]$|[/\s][12]:|_R[12]_|_R[12]\.|\.R[12]\.|_[12]\.fastq"
ILLUMINA_MODELS = (("A0", "NovaSeq 6000"), ("A1", "NovaSeq 6000"), ("A", "NovaSeq"), ("M", "MiSeq"), ("D", "HiSeq 2500"), ("E", "HiSeq X"), ("VH", "NextSeq 2000"), ("N", "NextSeq"), ("K", "HiSeq 4000"), ("J", "HiSeq 3000"))
PACBIO_MODELS = (("m84", "Revio"), ("m64", "Sequel II/IIe"), ("m54", "Sequel"))


def _group(text: Column, pattern: str, n: int) -> Column:
    found = F.regexp_extract(text, "(?d)" + pattern, n)
    return F.when(found != "", found)


def archive(read: Column) -> Column:
    """accession, source, remainder of a read name; remainder is the name itself without an accession."""
    hit = read.rlike("(?d)" + ARCHIVE)
    prefix = F.regexp_extract(read, "(?d)" + ARCHIVE, 1)
    source = F.element_at(F.create_map(*[F.lit(x) for kv in ARCHIVE_SOURCE.items() for x in kv]), prefix)
    rest = F.trim(F.regexp_extract(read, "(?d)" + ARCHIVE, 3))
    return F.struct(F.when(hit, F.concat(prefix, F.regexp_extract(read, "(?d)" + ARCHIVE, 2))).alias("accession"), F.when(hit, source).alias("source"), F.when(hit, rest).otherwise(F.ltrim(read, F.lit("@"))).alias("remainder"))


def _by_prefix(text: Column, table) -> Column:
    return F.coalesce(*[F.when(text.startswith(p), F.lit(m)) for p, m in table])


def illumina_model(instrument: Column) -> Column:
    return _by_prefix(F.upper(instrument), ILLUMINA_MODELS)


def pacbio_model(movie: Column) -> Column:
    return _by_prefix(movie, PACBIO_MODELS)


def illumina(read: Column) -> Column:
    """format, instrument, instrument_model and parts of an Illumina read name, or null."""
    a = archive(read)
    name = F.ltrim(a["remainder"], F.lit("@"))
    new, old = name.rlike("(?d)" + ILLUMINA_MODERN), name.rlike("(?d)" + ILLUMINA_LEGACY)
    part = lambda n, m: F.when(new, _group(name, ILLUMINA_MODERN, n)).when(old, _group(name, ILLUMINA_LEGACY, m)) if m else F.when(new, _group(name, ILLUMINA_MODERN, n))
    inst = part(1, 1)
    return F.when(new | old, F.struct(
        F.when(new, "modern").otherwise("legacy").alias("format"), inst.alias("instrument"), illumina_model(inst).alias("instrument_model"),
        part(2, 0).cast("long").alias("run_number"), part(3, 0).alias("flowcell"), part(4, 2).cast("int").alias("lane"), part(5, 3).cast("int").alias("tile"),
        part(6, 4).cast("long").alias("x"), part(7, 5).cast("long").alias("y"), part(8, 7).cast("int").alias("read"), (part(9, 0) == "Y").alias("filtered"),
        part(10, 0).cast("int").alias("control"), part(11, 6).alias("index"), a["accession"].alias("archive_accession"), a["source"].alias("archive_source"),
    ))


def pacbio(read: Column) -> Column:
    name = F.ltrim(read, F.lit("@"))
    movie = _group(name, PACBIO, 1)
    kind = F.when(_group(name, PACBIO, 3).isNotNull(), "ccs").when(_group(name, PACBIO, 4).isNotNull(), "clr").otherwise("generic")
    return F.when(name.rlike("(?d)" + PACBIO), F.struct(kind.alias("format"), movie.alias("movie"), _group(name, PACBIO, 2).cast("long").alias("zmw"), _group(name, PACBIO, 4).cast("long").alias("start"), _group(name, PACBIO, 5).cast("long").alias("end"), pacbio_model(movie).alias("instrument_model")))


def ont(read: Column) -> Column:
    name = F.ltrim(read, F.lit("@"))
    rest = F.regexp_extract(name, "(?d)" + ONT, 2)
    keys, values = (F.regexp_extract_all(rest, F.lit(r"(\w+)=(\S+)"), F.lit(n)) for n in (1, 2))
    # a key given twice keeps its last value
    last = F.transform(F.array_distinct(keys), lambda k: F.struct(k, F.element_at(F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda x: x["k"] == k), -1)["v"]))
    return F.when(name.rlike("(?d)" + ONT), F.struct(_group(name, ONT, 1).alias("uuid"), F.map_from_entries(last).alias("metadata")))


def mgi(read: Column) -> Column:
    name = F.ltrim(read, F.lit("@"))
    return F.when(name.rlike("(?d)" + MGI), F.struct(_group(name, MGI, 1).alias("flowcell"), *[_group(name, MGI, n).cast("long").alias(c) for n, c in ((2, "lane"), (3, "column"), (4, "row"), (5, "read_number"), (6, "pair"))]))


def read_platform(read: Column) -> Column:
    return F.when(illumina(read).isNotNull(), "ILLUMINA").when(pacbio(read).isNotNull(), "PACBIO").when(ont(read).isNotNull(), "ONT").when(mgi(read).isNotNull(), "MGI")


def paired_end(text: Column) -> Column:
    return search(text, PAIRED)
