"""Catalog records: JSON lines, JSON envelopes, nested API hits and external catalogs, all brought into one record shape."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.names import extension_of

from .envelopes import read_envelopes

RECORD = T.StructType([
    T.StructField("entry_id", T.StringType()), T.StructField("file_id", T.StringType()), T.StructField("file_name", T.StringType()), T.StructField("file_format", T.StringType()),
    T.StructField("file_size", T.LongType()), T.StructField("file_md5sum", T.StringType()), T.StructField("drs_uri", T.StringType()), T.StructField("dataset_id", T.StringType()),
    T.StructField("dataset_title", T.StringType()), T.StructField("is_supplementary", T.BooleanType()), T.StructField("data_modality", T.StringType()), T.StructField("reference_assembly", T.StringType()), T.StructField("url", T.StringType()),
])


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """record: one JSON text a line, blank lines left out. Lines stay as text, so that a contract can look at JSON types."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("record"))


def read_envelope(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """record: the elements of a JSON object's `results`, else `files`, list. A bare list only where lenient; otherwise an error.

    Files of any size are cut in parallel, see envelopes.
    """
    return read_envelopes(spark, path, lenient)


def typed(records: DataFrame, json_col: str = "record") -> DataFrame:
    """Checked JSON texts as columns of RECORD."""
    return records.select(F.from_json(json_col, RECORD).alias("r")).select("r.*")


def flat_hits(hits: DataFrame) -> DataFrame:
    """API hits (entryId, files[], datasets[], donors[]) as flat rows: the first element of every list, null where there is none."""
    first = lambda c: F.try_element_at(F.col(c), F.lit(1))
    inner = lambda c, k: F.try_element_at(first(c)[k], F.lit(1))
    f = first("files")
    return hits.select(
        F.col("entryId").alias("entry_id"), f["file_id"].alias("file_id"), f["file_name"].alias("file_name"), f["file_format"].alias("file_format"), f["file_size"].alias("file_size"),
        f["file_md5sum"].alias("file_md5sum"), f["drs_uri"].alias("drs_uri"), f["is_supplementary"].alias("is_supplementary"), inner("files", "data_modality").alias("data_modality"),
        inner("files", "reference_assembly").alias("reference_assembly"), inner("datasets", "dataset_id").alias("dataset_id"), inner("datasets", "title").alias("dataset_title"),
    )


def search_after(url):
    """The JSON value of a next-page url's search_after parameter, as text."""
    return F.try_url_decode(F.parse_url(url, F.lit("QUERY"), F.lit("search_after")))


# The column that holds a file's place in each of the four external catalogs.
PLACES = {"sequencing": "path", "assemblies": "awsFasta", "alignments": "loc", "annotations": "fileLocation"}
_CATALOG = "filename string, fileSize string, path string, awsFasta string, loc string, fileLocation string, platform string, librarySource string, libraryStrategy string, instrumentModel string, sampleId string, referenceCoordinates string, annotationType string"


def read_catalogs(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The external catalogs (JSON lists) by name. One that isn't there is empty, so that the others still count."""
    found = {}
    for name in PLACES:
        try:
            found[name] = spark.read.schema(_CATALOG).option("multiLine", "true").json(paths[name])
        except (KeyError, AnalysisException):
            found[name] = spark.createDataFrame([], _CATALOG)
    return found


def catalog_records(catalogs: dict[str, DataFrame], store: str = "https://s3-us-west-2.amazonaws.com/") -> DataFrame:
    """file_name, file_format, file_md5sum, url, file_size and catalog of all rows of read_catalogs().

    The key is the md5 of the whole url, as names repeat between folders; without a place, url and key are null. The format
    is the name's known extension, else empty. Sizes that aren't whole numbers are null.
    """
    parts = []
    for name, rows in catalogs.items():
        at, file_name = F.nullif(F.col(PLACES[name]), F.lit("")), F.coalesce("filename", F.lit(""))
        url = F.when(at.startswith("s3://"), F.concat(F.lit(store), F.substring(at, F.lit(6), F.length(at)))).otherwise(at)
        size = F.when(F.col("fileSize").rlike(r"^\d+$"), F.try_to_number("fileSize", F.lit("9" * 18)).cast("long"))
        parts.append(rows.select(file_name.alias("file_name"), F.coalesce(extension_of(file_name), F.lit("")).alias("file_format"), F.md5(url).alias("file_md5sum"), url.alias("url"), size.alias("file_size"), F.lit(name).alias("catalog")))
    return reduce(DataFrame.unionByName, parts)
