"""What claims resolve to, without their evidence: whole numbers in place of lists of claims.

The decisions that rules can make on a field are known beforehand, so a file's claims on it are one whole number a tier, with a bit
for each decision. Agreement, the top tier and conflicts are then tests of bits: claims.resolve() says the same of lists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.names import settled
from quern.plans.compile import reason_of
from quern.plans.rules import CONTENT_TIER, FIELDS, NOT_APPLICABLE, NOT_CLASSIFIED, RNA_PROGRAMS, RULES, VOCABULARY, Rule, checked

from .claims import CONFLICT, NO_CLAIMS, implied_by, inferred_assay

#: Decisions of a field that a long has bits for.
MOST = 62


def decisions(field: str, rules: list[Rule] | None = None) -> list[str]:
    """All that a field can be decided to be: values of the rules and of the vocabulary, and not_applicable; in order."""
    said = {r.then.get(field) or r.status.get(field) for r in checked(rules or RULES)}
    return sorted(({*said, *VOCABULARY[field], NOT_APPLICABLE}) - {None, NOT_CLASSIFIED})


def countable(rules: list[Rule] | None = None) -> bool:
    """Whether every field's decisions fit in a long."""
    return all(len(decisions(f, rules)) <= MOST for f in FIELDS)


def _held(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _union(codes: Column) -> Column:
    return F.aggregate("matched", F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(F.get(codes, i)))


class _Field:
    """One field's columns over `matched`: its bits by tier, and the reason of its last claim."""

    def __init__(self, field: str, table: list[Rule]):
        self.field, self.names = field, decisions(field, table)
        self.bit = {d: 1 << i for i, d in enumerate(self.names)}
        self.said = {i: r.then.get(field) or r.status.get(field) for i, r in enumerate(table) if field in r.then or field in r.status}
        self.tiers = sorted({table[i].tier for i in self.said})
        self.table = table

    def counted(self) -> dict[str, Column]:
        """The columns that hold the field's bits and last reason."""
        out = {}
        for t in self.tiers:
            codes = _held([self.bit.get(self.said.get(i), 0) if r.tier == t else 0 for i, r in enumerate(self.table)], "bigint")
            out[f"_{self.field}_{t}"] = _union(codes)
        reasons = _held([reason_of(r) if i in self.said else None for i, r in enumerate(self.table)], "string")
        out[f"_{self.field}_why"] = F.aggregate("matched", F.lit(None).cast("string"), lambda a, i: F.coalesce(F.get(reasons, i), a))
        return out

    def decided(self, extra: Column | None = None) -> tuple[Column, Column, Column]:
        """The decision's bit (0: none), all bits, and the top tier's. extra: a value claimed on the tier of contents, or null."""
        tiers = [(t, F.col(f"_{self.field}_{t}")) for t in self.tiers]
        if extra is not None:
            told = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for d, b in self.bit.items() for x in (d, b)]).cast("map<string,bigint>"), extra), F.lit(0).cast("long"))
            if CONTENT_TIER in self.tiers:
                tiers = [(t, c.bitwiseOR(told) if t == CONTENT_TIER else c) for t, c in tiers]
            else:
                tiers = sorted([*tiers, (CONTENT_TIER, told)], key=lambda x: x[0])
        if not tiers:
            none = F.lit(0).cast("long")
            return none, none, none
        every = reduce(lambda a, b: a.bitwiseOR(b), [c for _, c in tiers])
        top = F.coalesce(*[F.when(c != 0, c) for _, c in reversed(tiers)], F.lit(0).cast("long"))
        never = F.lit(self.bit[NOT_APPLICABLE]).cast("long")
        one = F.when(F.bit_count(every) == 1, every).when(top.bitwiseAND(never) != 0, never).when(F.bit_count(top) == 1, top).otherwise(F.lit(0).cast("long"))
        return one, every, top

    def name(self, bit: Column) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for d, b in self.bit.items() for x in (b, d)]).cast("map<bigint,string>"), bit)

    def listed(self, bits: Column) -> Column:
        return F.array_compact(F.array(*[F.when(bits.bitwiseAND(F.lit(b).cast("long")) != 0, d) for d, b in self.bit.items()]))


def labelled(matched: DataFrame, rules: list[Rule] | None = None, extra: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """matched (with_matches() of prepared files) plus `classifications`: value, status and why of every field.

    why is the reason that the field's evidence would end with. The assay is inferred from what rules decide. extra: by field, a value
    that the file's content tells (null: none) and its reason; it counts on the tier of contents, after the inference.
    """
    table = checked(rules or RULES)
    extra, fields = extra or {}, {f: _Field(f, table) for f in FIELDS}
    df = settled(matched, {k: c for f in fields.values() for k, c in f.counted().items()} | {f"_{f}_{part}": c for f, (value, reason) in extra.items() for part, c in (("told", value), ("reason", reason))})
    bits = {}
    for f, own in fields.items():
        for part, c in zip(("one", "all", "top"), own.decided()):
            bits[f"_{f}_{part}"] = c
        if f in extra:
            for part, c in zip(("one", "all", "top"), own.decided(F.col(f"_{f}_told"))):
                bits[f"_{f}_new_{part}"] = c
    df = settled(df, bits)

    def value(f: str, new: str = "") -> Column:
        one = F.col(f"_{f}{new}_one")
        return F.when(one != fields[f].bit[NOT_APPLICABLE], fields[f].name(F.nullif(one, F.lit(0).cast("long"))))

    programs = F.array(*[F.lit(i) for i, r in enumerate(table) if r.id in RNA_PROGRAMS]).cast("array<int>")
    assay = inferred_assay(value("data_modality"), value("platform"), F.col("ext"), F.col("file_size"), F.arrays_overlap("matched", programs))
    df = settled(df, {"_implied": F.when(F.col("_assay_type_all") == 0, assay)})

    def entry(f: str) -> Column:
        new = "_new" if f in extra else ""
        one, every, top = (F.col(f"_{f}{new}_{part}") for part in ("one", "all", "top"))
        found, why = value(f, new), F.coalesce(F.col(f"_{f}_why"), F.lit(NO_CLAIMS))
        if f in extra:
            why = F.when(F.col(f"_{f}_told").isNotNull(), F.col(f"_{f}_reason")).otherwise(why)
        if f == "assay_type":
            found, why = F.coalesce(found, "_implied"), F.when(F.col("_implied").isNotNull(), implied_by(F.col("_implied"))).otherwise(why)
        why = F.when((every != 0) & (one == 0), F.concat(F.lit(CONFLICT), F.array_join(fields[f].listed(top), ", "))).otherwise(why)
        status = F.when(found.isNotNull(), "classified").when(one == fields[f].bit[NOT_APPLICABLE], NOT_APPLICABLE).otherwise(NOT_CLASSIFIED)
        return F.struct(found.alias("value"), status.alias("status"), why.alias("why"))

    return settled(df, {"classifications": F.struct(*[entry(f).alias(f) for f in FIELDS])})
