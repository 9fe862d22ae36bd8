"""Reference assemblies from contig lengths and coordinates. The length table has 72 entries and lives in the plan as a literal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import let

# Lengths of chromosomes 1-22, X and Y of three assemblies.
LENGTHS = {
    "GRCh38": (248956422, 242193529, 198295559, 190214555, 181538259, 170805979, 159345973, 145138636, 138394717, 133797422, 135086622, 133275309, 114364328, 107043718, 101991189, 90338345, 83257441, 80373285, 58617616, 64444167, 46709983, 50818468, 156040895, 57227415),
    "GRCh37": (249250621, 243199373, 198022430, 191154276, 180915260, 171115067, 159138663, 146364022, 141213431, 135534747, 135006516, 133851895, 115169878, 107349540, 102531392, 90354753, 81195210, 78077248, 59128983, 63025520, 48129895, 51304566, 155270560, 59373566),
    "CHM13": (248387497, 242696747, 201106605, 193574945, 182045439, 172126628, 160567428, 146259331, 150617247, 134758134, 135127769, 133324548, 113566686, 101161492, 99753195, 96330374, 84276897, 80542538, 61707364, 66210255, 45090682, 51324926, 154259566, 62460029),
}
CHROMS = (*map(str, range(1, 23)), "X", "Y")
ASSEMBLIES = tuple(LENGTHS)
STANDARD = r"(?i)^(chr)?(\d{1,2}|X|Y|M|MT)$"
TOLERANCE, BED_TOLERANCE = 1000, 500
#: Chromosomes on which variant positions are compared.
POSITION_CHROMS = ("1", "2", "3", "10", "22")


def length_map() -> Column:
    """chromosome (without chr) -> its lengths in ASSEMBLIES' order."""
    return F.create_map(*[x for i, c in enumerate(CHROMS) for x in (F.lit(c), F.array(*[F.lit(LENGTHS[a][i]) for a in ASSEMBLIES]))])


def bare(contig: Column) -> Column:
    return F.regexp_replace(contig, "^chr", "")


def contig_vote(contig: Column, length: Column, tolerance: int = TOLERANCE) -> Column:
    """The assembly whose length of that contig is nearest, within the tolerance; earlier assemblies win ties. Or null."""
    held = F.element_at(length_map(), bare(contig))
    names = F.array(*[F.lit(a) for a in ASSEMBLIES])
    return let(F.transform(held, lambda x: F.abs(x - length)), lambda gaps: F.when(F.array_min(gaps) <= tolerance, F.element_at(names, F.array_position(gaps, F.array_min(gaps)).cast("int"))))


def vote_winner(votes: Column) -> Column:
    """assembly and matches of the most frequent vote; null and 0 if two share the top."""
    cast = F.filter(votes, lambda v: v.isNotNull())

    def best(tally):
        top = F.array_max(F.transform(tally, lambda t: t["n"]))
        first = F.filter(tally, lambda t: (t["n"] == top) & (t["n"] > 0))
        clear = F.size(first) == 1
        return F.struct(F.when(clear, F.try_element_at(first, F.lit(1))["assembly"]).alias("assembly"), F.when(clear, top).otherwise(0).alias("matches"))

    count = lambda c, a: F.struct(F.size(F.filter(c, lambda v: v == a)).alias("n"), F.lit(a).alias("assembly"))
    return let(cast, lambda c: let(F.array(*[count(c, a) for a in ASSEMBLIES]), best))


def sam_contigs(lines: Column) -> Column:
    return F.transform(lines, lambda x: contig_vote(F.regexp_extract(x, r"SN:([^\t]+)", 1), F.try_to_number(F.regexp_extract(x, r"LN:(\d+)", 1), F.lit("999999999999999")).cast("long")))


def vcf_contigs(lines: Column) -> Column:
    """lines: ##contig=... lines."""
    return F.transform(lines, lambda x: contig_vote(F.regexp_extract(x, r"ID=([^,>]+)", 1), F.try_to_number(F.regexp_extract(x, r"length=(\d+)", 1), F.lit("999999999999999")).cast("long")))


def by_max_positions(positions: Column) -> Column:
    """assembly and evidence from map<chrom, position>: the only assembly that no position exceeds."""
    over = lambda a, c: F.coalesce(F.coalesce(F.element_at(positions, F.lit(c)), F.element_at(positions, F.lit("chr" + c))) > LENGTHS[a][CHROMS.index(c)], F.lit(False))
    out = {a: F.array(*[over(a, c) for c in POSITION_CHROMS]) for a in ASSEMBLIES}
    possible = F.filter(F.array(*[F.when(~F.exists(out[a], lambda x: x), F.lit(a)) for a in ASSEMBLIES]), lambda x: x.isNotNull())
    evidence = sum((F.when(over("GRCh37", c) | over("GRCh38", c) | over("CHM13", c), 1).otherwise(0) for c in POSITION_CHROMS), F.lit(0))
    clear = (F.size(possible) == 1) & (evidence > 0)
    return F.struct(F.when(clear, F.try_element_at(possible, F.lit(1))).alias("assembly"), F.when(clear, evidence).otherwise(0).alias("evidence"))


def by_bed(chromosomes: Column, has_prefix: Column, max_coordinates: Column) -> Column:
    """assembly and nonstandard from BED signals. Assemblies with a coordinate past a chromosome's end are ruled out."""
    some = F.size(F.map_keys(max_coordinates)) > 0
    standard = F.exists(chromosomes, lambda c: c.rlike(STANDARD))
    entries = F.map_entries(max_coordinates)
    def fits(i):
        def past(e):
            c = F.upper(F.regexp_replace(F.lower(e["key"]), "^chr", ""))
            return F.coalesce(e["value"] > F.element_at(length_map(), c)[i] + BED_TOLERANCE, F.lit(False))
        return ~F.exists(entries, past)
    left = F.filter(F.array(*[F.when(fits(i), F.lit(a)) for i, a in enumerate(ASSEMBLIES)]), lambda x: x.isNotNull())
    left = F.when((F.size(left) > 1), F.filter(left, lambda x: x != "GRCh37")).otherwise(left)
    found = F.when(F.size(left) == 1, F.try_element_at(left, F.lit(1)))
    return F.struct(F.when(some & standard, F.when(~has_prefix, F.lit("GRCh37")).otherwise(found)).alias("assembly"), F.coalesce(some & ~standard, F.lit(False)).alias("nonstandard"))
