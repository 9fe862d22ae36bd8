"""Resolution of competing claims, markers, added claims and the assay's inference.

Over a column of claims, all are expressions, and none shuffles. resolve_rows() resolves a long table of claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.names import let
from quern.plans.compile import CLAIM, claim
from quern.plans.rules import NOT_APPLICABLE, NOT_CLASSIFIED


CONFLICT, NO_CLAIMS = "top-tier rules disagree: ", "no rule claims a value"

# Expressions over one column of claims are SQL text: they are built once a field, and text costs one call to the JVM each.

_RESOLVE = """
transform(array(filter(transform({c}, c -> named_struct('d', case when c.marker is null then coalesce(c.value, c.status) end, 't', c.tier)), c -> c.d is not null)), real ->
transform(array(filter(real, c -> c.d <> 'not_classified')), firm ->
transform(array(array_distinct(transform(firm, c -> c.d))), kinds ->
transform(array(array_sort(array_distinct(transform(filter(firm, c -> c.t = array_max(transform(firm, x -> x.t))), c -> c.d)))), best ->
transform(array(case
  when size(real) = 0 then named_struct('d', 'not_classified', 'r', 'no_claims')
  when size(firm) = 0 then named_struct('d', 'not_classified', 'r', if(size(real) > 1, 'unanimous', 'single_claim'))
  when size(kinds) = 1 then named_struct('d', get(kinds, 0), 'r', if(size(firm) > 1, 'unanimous', 'single_claim'))
  when exists(firm, c -> c.t is null) then named_struct('d', cast(raise_error('a competing claim has no tier') as string), 'r', '')
  when array_contains(best, 'not_applicable') then named_struct('d', 'not_applicable', 'r', 'not_applicable_terminal')
  when size(best) = 1 then named_struct('d', get(best, 0), 'r', 'higher_specificity_override')
  else named_struct('d', 'not_classified', 'r', 'conflict') end), x ->
named_struct('value', if(x.d in ('not_applicable', 'not_classified'), cast(null as string), x.d), 'status', if(x.d in ('not_applicable', 'not_classified'), x.d, 'classified'),
             'reason', x.r, 'competing', if(x.r = 'conflict', best, cast(null as array<string>)))
)[0])[0])[0])[0])[0]"""

_MARKER = "cast(named_struct('rule_id', cast(null as string), 'reason', {reason}, 'tier', cast(null as int), 'value', cast(null as string), 'status', 'not_classified', 'marker', '{kind}', 'competing_values', {competing}) as " + CLAIM + ")"
_ENTRY = (
    "transform(array({resolve}), r -> named_struct('value', r.value, 'status', r.status, 'evidence', transform(array(filter({c}, c -> c.marker is null)), k -> case when r.reason = 'conflict' then array_append(k, "
    + _MARKER.format(reason=f"concat('{CONFLICT}', array_join(r.competing, ', '))", kind="conflict", competing="r.competing")
    + ") when r.reason = 'no_claims' then array_append(k, "
    + _MARKER.format(reason=f"'{NO_CLAIMS}'", kind="not_classified", competing="cast(null as array<string>)")
    + ") else k end)[0]))[0]"
)


def resolve(claims: str) -> Column:
    """value, status, reason and competing (sorted, only for conflicts) of a column of claims, given by name.

    Claims that only say not_classified never compete. Agreement wins at any tiers; otherwise the top tier decides, where
    not_applicable is terminal and two values are a conflict. Markers are no claims.
    """
    return F.expr(_RESOLVE.format(c=claims))


def entry(claims: str) -> Column:
    """value, status and evidence: the claims without old markers, and a new one after a conflict or without any claim."""
    return F.expr(_ENTRY.format(resolve=_RESOLVE.format(c=claims), c=claims))


def last_reason(claims: str, resolved: Column) -> Column:
    """The reason that entry()'s evidence of these claims ends with, given what they resolve to."""
    real = F.filter(claims, lambda c: c["marker"].isNull())
    conflict = F.concat(F.lit(CONFLICT), F.array_join(resolved["competing"], ", "))
    return F.when(resolved["reason"] == "conflict", conflict).when(resolved["reason"] == "no_claims", NO_CLAIMS).otherwise(F.try_element_at(real, F.lit(-1))["reason"])


def declared(claims: str) -> Column:
    """Whether the claims resolve to a value or to not_applicable."""
    return resolve(claims)["status"] != NOT_CLASSIFIED


def resolve_rows(claims: DataFrame, keys: list[str]) -> DataFrame:
    """keys, value, status, reason, competing and n_claims of every key of a long table of claims (tier, value, status, marker).

    Equal to resolve() of each key's claims, but no list of claims is built: claims are counted by key, tier and what they
    declare before any shuffle, and a key is resolved from these few counts, so a key with any number of claims is a handful of
    rows. A key with markers only has no claims. tier, value, status and keys can be null; marker can be missing.
    """
    marker = F.col("marker").isNotNull() if "marker" in claims.columns else F.lit(False)
    own = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    said = F.when(~marker, F.coalesce("value", "status"))
    counts = claims.select(*own, F.col("tier").cast("int").alias("t"), said.alias("d")).groupBy(*[f"k{i}" for i in range(len(keys))], "t", "d").agg(F.count("d").alias("n"))
    firm = F.col("d").isNotNull() & (F.col("d") != NOT_CLASSIFIED)
    state = counts.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(
        F.sum("n").alias("n"), F.sum(F.when(firm, F.col("n")).otherwise(0)).alias("firm"), F.max(F.when(firm, F.col("t"))).alias("top"), F.bool_or(firm & F.col("t").isNull()).alias("untiered"),
        F.min(F.when(firm, F.col("d"))).alias("low"), F.max(F.when(firm, F.col("d"))).alias("high"), F.collect_set(F.when(firm, F.struct("t", "d"))).alias("said"),
    )
    best = F.array_sort(F.array_distinct(F.transform(F.filter("said", lambda s: s["t"] == F.col("top")), lambda s: s["d"])))
    state = state.withColumn("best", best)
    reason = (
        F.when(F.col("n") == 0, "no_claims")
        .when(F.col("firm") == 0, F.when(F.col("n") > 1, "unanimous").otherwise("single_claim"))
        .when(F.col("low") == F.col("high"), F.when(F.col("firm") > 1, "unanimous").otherwise("single_claim"))
        .when(F.col("untiered"), F.raise_error(F.lit("a competing claim has no tier")).cast("string"))
        .when(F.array_contains("best", NOT_APPLICABLE), "not_applicable_terminal")
        .when(F.size("best") == 1, "higher_specificity_override")
        .otherwise("conflict")
    )
    found = F.when(F.col("firm") == 0, NOT_CLASSIFIED).when(F.col("low") == F.col("high"), F.col("low")).when(F.col("reason") == "not_applicable_terminal", NOT_APPLICABLE).when(F.col("reason") == "conflict", NOT_CLASSIFIED).otherwise(F.get("best", F.lit(0)))
    state = state.withColumn("reason", reason).withColumn("d", found)
    is_status = F.col("d").isin(NOT_APPLICABLE, NOT_CLASSIFIED)
    return state.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.when(~is_status, F.col("d")).alias("value"), F.when(is_status, F.col("d")).otherwise("classified").alias("status"), "reason", F.when(F.col("reason") == "conflict", F.col("best")).alias("competing"), F.col("n").alias("n_claims"))


def markers(resolved: DataFrame, keys: list[str]) -> DataFrame:
    """The markers that resolve_rows()'s keys get beside their claims, as rows of a long table of evidence (keys and CLAIM's fields)."""
    conflict = F.col("reason") == "conflict"
    why = F.when(conflict, F.concat(F.lit(CONFLICT), F.array_join("competing", ", "))).otherwise(NO_CLAIMS)
    made = F.struct(F.lit(None).cast("string").alias("rule_id"), why.alias("reason"), F.lit(None).cast("int").alias("tier"), F.lit(None).cast("string").alias("value"), F.lit(NOT_CLASSIFIED).alias("status"), F.when(conflict, "conflict").otherwise(NOT_CLASSIFIED).alias("marker"), F.col("competing").alias("competing_values"))
    return resolved.where(conflict | (F.col("reason") == "no_claims")).select(*[F.col(f"`{k}`") for k in keys], made.cast(CLAIM).alias("m")).select(*[F.col(f"`{k}`") for k in keys], "m.*")


def add_if(claims: Column, when: Column, new: Column) -> Column:
    """claims with one more, where the condition holds."""
    return F.when(F.coalesce(when, F.lit(False)), F.array_append(claims, new)).otherwise(claims)


def implied_by(assay: Column) -> Column:
    return F.concat(F.lit("implied by modality, platform and size: "), assay)


def inferred_assay(modality: Column, platform: Column, ext: Column, file_size: Column, rna: Column) -> Column:
    """The assay that other fields imply, or null. rna: whether a program for RNA was run. Bounds are strict: a size on a bound implies nothing."""
    gb = file_size / F.lit(1e9)
    genomic, cram = modality == "genomic", ext == ".cram"
    short = genomic & (platform == "ILLUMINA")
    return (
        F.when(rna, "RNA-seq")
        .when(modality.contains("transcriptomic"), "RNA-seq")
        .when(genomic & platform.isin("PACBIO", "ONT"), "WGS")
        .when(short & ~cram & ((gb > 50) | ((gb > 20) & (gb < 50))), "WGS")
        .when(short & ~cram & (gb < 20), "WES")
        .when(short & cram & ((gb > 20) | ((gb > 8) & (gb < 20))), "WGS")
        .when(short & cram & (gb < 8), "WES")
    )


def with_assay(claims: str, assay: Column) -> Column:
    """assay_type's claims, with the inferred one where nothing is declared and no conflict stands."""
    open_ = let(resolve(claims), lambda r: (r["status"] == NOT_CLASSIFIED) & (r["reason"] != "conflict")) & assay.isNotNull()
    return add_if(F.col(claims), open_, claim("infer_assay_type", implied_by(assay), 3, assay))
