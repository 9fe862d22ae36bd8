"""Rules from a user's file.

The file is a JSON object with `rules`, a list of objects: id, tier, scope, when (conditions), then (values by field, and under
`status` statuses by field), rationale. Every fault is an error that names the rule and the key.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from .rules import CONDITIONS, FIELDS, NOT_APPLICABLE, NOT_CLASSIFIED, SCOPES, VOCABULARY, Rule, checked

KEYS = {"id", "tier", "scope", "when", "then", "rationale"}
#: What each condition must be given as.
KINDS = {
    "always": bool, "extensions": list, "format": str, "filename_pattern": str, "dataset_pattern": str, "file_format": str, "file_size_min_gb": (int, float), "file_size_max_gb": (int, float), "platform": str,
    "modality_not_set": bool, "reference_not_set": bool, "header_section": str, "header_field": str, "header_pattern": str, "header_absent": bool, "vcf_header_type": str, "vcf_pattern": str, "fastq_pattern": str,
}
#: Conditions that only make sense together, or in one scope.
TOGETHER = {"header_pattern": ("header_section", "header_field"), "header_absent": ("header_section",), "vcf_pattern": ("vcf_header_type",), "vcf_header_type": ("vcf_pattern",)}
SCOPED = {"header_pattern": "header", "header_absent": "header", "vcf_pattern": "vcf_header", "fastq_pattern": "fastq_header"}


def rules_of(text: str) -> list[Rule]:
    """The rules of a file's text, in their order."""
    try:
        document = json.loads(text)
    except ValueError as e:
        raise ValueError(f"the rules aren't JSON: {e}") from None
    if not isinstance(document, dict) or not isinstance(document.get("rules"), list):
        raise ValueError("rules: expected a list")
    return checked([_rule(raw, n) for n, raw in enumerate(document["rules"])])


def _rule(raw, n: int) -> Rule:
    if not isinstance(raw, dict) or not isinstance(raw.get("id"), str) or not raw["id"]:
        raise ValueError(f"rules[{n}]: id: expected a text")

    def need(ok, key: str, why: str) -> None:
        if not ok:
            raise ValueError(f"rule {raw['id']}: {key}: {why}")

    for key in raw:
        need(key in KEYS, key, "unknown key")
    tier, scope, when, then = raw.get("tier"), raw.get("scope"), raw.get("when") or {}, raw.get("then") or {}
    need(type(tier) is int and tier in (1, 2, 3), "tier", "expected 1, 2 or 3")
    need(scope in SCOPES, "scope", "expected one of " + ", ".join(sorted(SCOPES)))
    need(isinstance(when, dict), "when", "expected an object")
    need(isinstance(then, dict), "then", "expected an object")
    for key, value in when.items():
        need(key in CONDITIONS, f"when.{key}", "unknown condition")
        need(isinstance(value, KINDS[key]) and (KINDS[key] is bool or not isinstance(value, bool)), f"when.{key}", "wrong type")
        need(key not in SCOPED or SCOPED[key] == scope, f"when.{key}", f"belongs to scope {SCOPED.get(key)}")
        need(all(k in when for k in TOGETHER.get(key, ())), f"when.{key}", "needs " + " and ".join(TOGETHER.get(key, ())))
        need(tier == 3 or key not in SCOPED, f"when.{key}", "headers are looked at in tier 3")
    need(all(isinstance(e, str) and e.startswith(".") for e in when.get("extensions", [])), "when.extensions", "expected texts that begin with a dot")
    need("platform" not in when or when["platform"] in VOCABULARY["platform"], "when.platform", "outside the vocabulary")
    status = then.get("status")
    need(status is None or isinstance(status, dict), "then.status", "expected an object")
    values = {f: v for f, v in then.items() if f != "status" and v is not None}
    for f, v in values.items():
        need(f in FIELDS, f"then.{f}", "unknown field")
        need(v in VOCABULARY[f], f"then.{f}", f"{v!r} is outside the vocabulary")
    for f, v in (status or {}).items():
        need(f in FIELDS, f"then.status.{f}", "unknown field")
        need(v in (NOT_APPLICABLE, NOT_CLASSIFIED), f"then.status.{f}", f"{v!r} can't be claimed")
        need(f not in values, f"then.status.{f}", "has a value, too")
    return Rule(raw["id"], tier, scope, {k: tuple(v) if isinstance(v, list) else v for k, v in when.items()}, values, dict(status or {}))


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """The rules of a file on any store that Spark reads."""
    return rules_of(spark.read.text(path, wholetext=True).first()[0])
