"""Rules as columns.

A frame gets one column `matched`: the numbers of the rules that fire, in order. Claims are looked up from it in literal
arrays, so that each pattern stands in the plan once. Rules that ask whether a field is set run over the first pass's matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.headers import sam_lines, sam_matches, search, vcf_matches, vcf_parts
from quern.functions.names import FORMATS, settled

from .rules import FIELDS, NOT_CLASSIFIED, RULES, Rule, checked

CLAIM = "struct<rule_id:string,reason:string,tier:int,value:string,status:string,marker:string,competing_values:array<string>>"
_STATE = {"modality_not_set": "data_modality", "reference_not_set": "reference_assembly"}


def claim(rule_id, reason, tier, value=None, status=None) -> Column:
    """One claim; all parts but value and status can be columns or Python values."""
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(col(rule_id).alias("rule_id"), col(reason).alias("reason"), col(tier).alias("tier"), col(value).cast("string").alias("value"), col(status).cast("string").alias("status"), F.lit(None).cast("string").alias("marker"), F.lit(None).cast("array<string>").alias("competing_values")).cast(CLAIM)


def condition(rule: Rule, header: Column | None) -> Column:
    """When a rule fires, but for what it asks of earlier claims. Columns: ext, name.raw, dataset_title, file_size."""
    w, tests = rule.when, []
    if w.get("always"):
        return F.lit(True)
    if "extensions" in w:
        tests.append(F.col("ext").isin([e.lower() for e in w["extensions"]]))
    if "format" in w:
        tests.append(F.col("ext").isin([e for e, f in FORMATS.items() if f == w["format"]]))
    if "file_format" in w:
        tests.append(F.col("ext") == w["file_format"])
    gb = F.col("file_size") / F.lit(1e9)
    if w.get("file_size_min_gb"):
        tests.append(F.coalesce(gb >= w["file_size_min_gb"], F.lit(False)))
    if w.get("file_size_max_gb"):
        tests.append(F.coalesce(gb <= w["file_size_max_gb"], F.lit(False)))
    if "filename_pattern" in w:
        tests.append(search(F.col("name.raw"), w["filename_pattern"]))
    if "dataset_pattern" in w:
        tests.append(search(F.col("dataset_title"), w["dataset_pattern"]))
    if w.get("header_absent"):
        tests.append(F.coalesce(header.isNotNull() & (F.size(sam_lines(header, w["header_section"])) == 0), F.lit(False)))
    elif rule.scope == "header" and "header_section" in w:
        tests.append(header.isNotNull() & sam_matches(header, w["header_section"], w["header_field"], w["header_pattern"]))
    if rule.scope == "vcf_header" and "vcf_header_type" in w:
        tests.append(header.isNotNull() & vcf_matches(F.col("vcf_parts"), w["vcf_header_type"], w["vcf_pattern"]))
    if rule.scope == "fastq_header" and "fastq_pattern" in w:
        tests.append(header.isNotNull() & search(header, w["fastq_pattern"]))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def with_matches(df: DataFrame, header: Column | None = None, scope: str | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """df plus `matched`, the numbers (from 0) of the rules that fire, by tier and order.

    scope: that of the header column (header, vcf_header, fastq_header); without one, tiers 1 and 2 only.
    """
    table = checked(rules or RULES)
    if scope == "vcf_header":
        df = settled(df, {"vcf_parts": vcf_parts(header)})
    use = [i for i, r in enumerate(table) if r.tier < 3 or (header is not None and r.scope == scope)]
    first = [i for i in use if not {*_STATE, "platform"} & {*table[i].when}]
    hits = F.array_compact(F.array(*[F.when(condition(table[i], header), F.lit(i)) for i in first]))
    df = settled(df, {"matched": hits})

    def late(i: int) -> Column:
        tests = [condition(table[i], header)]
        for key, field in _STATE.items():
            if table[i].when.get(key):
                setters = [j for j, r in enumerate(table) if r.then.get(field) or r.status.get(field, NOT_CLASSIFIED) != NOT_CLASSIFIED]
                tests.append(~F.arrays_overlap(F.col("matched"), F.array(*[F.lit(j) for j in setters])))
        if platform := table[i].when.get("platform"):
            setters = [j for j, r in enumerate(table) if r.then.get("platform") == platform]
            tests.append(F.arrays_overlap(F.col("matched"), F.array(*[F.lit(j) for j in setters])))
        return F.when(reduce(lambda a, b: a & b, tests), F.lit(i))

    states = [late(i) for i in use if i not in first]
    return settled(df, {"matched": F.concat(F.col("matched"), F.array_compact(F.array(*states)))}) if states else df


def claims_of(field: str, rules: list[Rule] | None = None) -> Column:
    """The claims that the matched rules make on a field, in order."""
    table = checked(rules or RULES)
    own = {i: r for i, r in enumerate(table) if field in r.then or field in r.status}
    if not own:
        return F.array().cast(f"array<{CLAIM}>")
    # one literal in SQL text: a call for each part of each claim would cost more than the query
    held = ", ".join(f"named_struct('rule_id', {_quoted(r.id)}, 'reason', {_quoted(reason_of(r))}, 'tier', {r.tier}, 'value', {_quoted(r.then.get(field))}, 'status', {_quoted(r.status.get(field))}, 'marker', cast(null as string), 'competing_values', cast(null as array<string>))" for r in own.values())
    order = ", ".join(f"{i}, {n}" for n, i in enumerate(own))
    return F.expr(f"transform(filter(transform(matched, i -> map({order})[i]), n -> n is not null), n -> array({held})[n])")


def _quoted(text: str | None) -> str:
    return "cast(null as string)" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_claims(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """df plus a column of claims for each field, named as the field."""
    return settled(df, {f: claims_of(f, rules) for f in FIELDS})


def reason_of(rule: Rule) -> str:
    """What the rule looked at, in words."""
    w = rule.when
    parts = [f"{k.replace('_', ' ')} {', '.join(v) if isinstance(v, tuple) else v}" for k, v in w.items()]
    return "; ".join(parts)


def rule_ids(rules: list[Rule] | None = None) -> Column:
    """The ids of the matched rules."""
    names = F.array(*[F.lit(r.id) for r in checked(rules or RULES)])
    return F.transform("matched", lambda i: F.element_at(names, i + 1))
