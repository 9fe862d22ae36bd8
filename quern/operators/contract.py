"""The input contract: strict types and patterns, checked on JSON texts before anything is cast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.names import let

from .classify import unreadable
from .samples import first_of_groups

# Fields, kinds and formats of an input record; blocking fields are those that classification needs.
REQUIRED = ("entry_id", "file_id", "file_name", "file_format", "file_size", "file_md5sum", "drs_uri", "dataset_id", "dataset_title", "is_supplementary")
PATTERNS = {"file_md5sum": "^[0-9a-f]{32}$", "drs_uri": "^drs://"}
NULLABLE = ("data_modality", "reference_assembly")
BLOCKING = ("file_md5sum", "file_name", "file_size", "file_format")
EXPECTED = {"file_size": ("BIGINT", "expected an integer"), "is_supplementary": ("BOOLEAN", "expected a boolean")}
MISSING, FORMAT, NEGATIVE, OBJECT = "required field is missing", "does not match the required format", "must be at least 0", "expected an object"


def reasons(record: Column) -> Column:
    """array<string> of `field: why` for a JSON text; empty if it meets the contract. Texts that are no JSON object: one reason.

    A reason never holds the offending value, so equal faults have equal texts. Unknown keys are ignored; a string where a
    number is expected is a fault, as JSON types are looked at before any cast.
    """
    parsed = F.struct(F.try_parse_json(record).alias("v"), F.coalesce(F.json_object_keys(record), F.array().cast("array<string>")).alias("keys"))
    return let(parsed, lambda p: _reasons(p["v"], p["keys"]))


def _reasons(v: Column, keys: Column) -> Column:
    kind = lambda f: F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))

    def fault(f: str) -> Column:
        want, text = EXPECTED.get(f, ("STRING", "expected a string"))
        value = F.try_variant_get(v, f"$.{f}", "string")
        given, whole = F.array_contains(keys, f), kind(f)
        right = whole.rlike("^(BIGINT|DECIMAL\\(\\d+,0\\))$") if want == "BIGINT" else whole == want
        out = F.when(~given, F.lit(f"{f}: {MISSING}")).when(~F.coalesce(right, F.lit(False)), F.lit(f"{f}: {text}"))
        if f == "file_size":
            return out.when(value.cast("decimal(38,0)") < 0, F.lit(f"{f}: {NEGATIVE}"))
        return out if want == "BOOLEAN" else out.when(~value.rlike(PATTERNS.get(f, "(?s)^.+$")), F.lit(f"{f}: {FORMAT}"))

    def optional(f: str) -> Column:
        return F.when(F.array_contains(keys, f) & ~F.coalesce(kind(f).isin("STRING", "VOID"), F.lit(True)), F.lit(f"{f}: expected a string"))

    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, F.array_compact(F.array(*[fault(f) for f in REQUIRED], *[optional(f) for f in NULLABLE]))).otherwise(F.array(F.lit(f"<record>: {OBJECT}")))


def blocking(found: Column) -> Column:
    """The reasons that make a record unclassifiable."""
    return F.filter(found, lambda r: F.split_part(r, F.lit(":"), F.lit(1)).isin(*BLOCKING, "<record>"))


def split(records: DataFrame, json_col: str = "record") -> tuple[DataFrame, DataFrame]:
    """Valid and invalid records of a frame of JSON texts; the invalid ones echo their identity and carry `reasons`."""
    checked = records.withColumn("reasons", reasons(F.col(json_col)))
    bad = F.size(blocking(F.col("reasons"))) > 0
    text = lambda f: F.coalesce(F.get_json_object(F.col(json_col), f"$.{f}"), F.lit(""))
    invalid = checked.where(bad).select(json_col, text("file_name").alias("file_name"), text("file_format").alias("file_format"), F.get_json_object(json_col, "$.file_md5sum").alias("file_md5sum"), F.get_json_object(json_col, "$.entry_id").alias("entry_id"), blocking(F.col("reasons")).alias("reasons"))
    return checked.where(~bad), invalid


def not_validated(invalid: DataFrame) -> DataFrame:
    """Output rows of invalid records: nothing classified, the reasons as evidence."""
    return unreadable(invalid, F.array_join("reasons", "; "), "input_validation")


def problem_kinds(records: DataFrame, json_col: str = "record", samples: int = 5) -> DataFrame:
    """reason, n, sample_ids (the first entry ids in order) over a whole corpus."""
    each = records.select(F.get_json_object(json_col, "$.entry_id").alias("id"), F.explode(reasons(F.col(json_col))).alias("reason"))
    return first_of_groups(each, ["reason"], "id", samples).withColumnRenamed("first", "sample_ids")
