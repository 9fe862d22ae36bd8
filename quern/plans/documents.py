"""Whole reports, in Markdown or HTML: how labels agree with external records, and whether records contradict themselves.

Everything that grows with the files is counted in Spark; what reaches the driver are tables of a row a field, catalog, rule or kind
of discrepancy, of which the largest are cut where the report says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import external, lint, report
from quern.operators.samples import first_of_groups
from quern.sources.sinks import once

#: Kinds of discrepancies and conflicts that a report lists, and examples of each.
KINDS, EXAMPLES = 100, 3


def discrepancy_kinds(verdicts: DataFrame, most: int = KINDS, examples: int = EXAMPLES) -> DataFrame:
    """field, catalog, ours, expected, n and examples (names of files) of the most frequent kinds of mismatch."""
    kinds = first_of_groups(verdicts.where("verdict = 'mismatch'"), ["field", "catalog", "ours", "expected"], "file_name", examples)
    return kinds.orderBy(F.desc("n"), "field", "catalog", "ours", "expected").limit(most).select("field", "catalog", "ours", "expected", "n", F.array_join("first", ", ").alias("examples"))


def validation_report(classified: DataFrame, catalogs: dict[str, DataFrame], form=report.markdown) -> str:
    """Agreement with the external catalogs: in sum, by catalog, and the commonest kinds of discrepancy with examples."""
    verdicts = once(external.catalog_verdicts(classified, catalogs), "verdicts")
    by_catalog = verdicts.where("field is not null").groupBy("catalog", "field").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("match", "mismatch", "unknown")])
    parts = (
        ("Agreement by field", external.agreement(verdicts).orderBy("field")),
        ("Agreement by catalog", by_catalog.orderBy("catalog", "field")),
        ("Files that a catalog knows", external.matched_files(verdicts).orderBy("catalog")),
        (f"Discrepancies, the {KINDS} commonest", discrepancy_kinds(verdicts)),
    )
    return "\n".join(form(rows, title) for title, rows in parts)


def consistency_report(classified: DataFrame, rules: list[lint.Lint] | None = None, form=report.markdown) -> str:
    """Each rule's records and violations, the rules that no record met, and examples of what was broken."""
    broken = lint.violations(classified, rules)
    active = once(lint.activation(classified, rules), "rule-activation")
    said = first_of_groups(broken.withColumn("found", F.coalesce("value", "status")), ["rule_id", "field", "found"], "file_name", EXAMPLES)
    parts = (
        ("Rules", active.orderBy(F.desc("broken"), "rule_id")),
        ("Rules that no record met", active.where("vacuous").select("rule_id").orderBy("rule_id")),
        (f"Violations, the {KINDS} commonest", said.orderBy(F.desc("n"), "rule_id", "field", "found").limit(KINDS).select("rule_id", "field", "found", "n", F.array_join("first", ", ").alias("examples"))),
    )
    return "\n".join(form(rows, title) for title, rows in parts)
