"""Where results go: Parquet, JSON lines with a one-row summary beside them, TSV, and the table of evidence."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.report import label, observed_tally, tally_of
from quern.plans.compile import CLAIM
from quern.plans.rules import FIELDS

OUTPUT = ("file_name", "md5sum", "file_size", "file_format", "dataset_title", "classifications", "entry_id")
#: What a stored output holds, of any kind.
STORED = "file_name string, md5sum string, file_size long, file_format string, dataset_title string, classifications struct<" + ", ".join(f"{f}: struct<value: string, status: string, evidence: array<{CLAIM}>>" for f in FIELDS) + ">, entry_id string, is_paired_end boolean, instrument_model string, instrument_hint string, archive_accession string, archive_source string"


def output_records(classified: DataFrame) -> DataFrame:
    """Classified files in the published shape."""
    return classified.withColumn("md5sum", F.col("file_md5sum")).select(*OUTPUT)


def write_run(classified: DataFrame, tally: DataFrame, path: str) -> None:
    """path/classifications as JSON lines and path/metadata as one JSON row; each is committed as a whole."""
    output_records(classified).write.json(f"{path}/classifications")
    tally.coalesce(1).write.json(f"{path}/metadata")


def write_observed(classified: DataFrame, path: str) -> DataFrame:
    """write_run() with the tally taken by the write itself: one job over the files, none to count them. Returns the tally.

    classified needs outcome, from_cache and content_unreadable beside what output_records() takes.
    """
    rows, seen = observed_tally(classified)
    output_records(rows).write.json(f"{path}/classifications")
    tally = tally_of(classified.sparkSession, seen)
    tally.coalesce(1).write.json(f"{path}/metadata")
    return tally


def stored_outputs(spark: SparkSession, root: str) -> DataFrame:
    """The records of all outputs that write_run() left below root (a folder for each kind), with the folder's name as `kind`.

    Folders without output, and columns that only some kinds have, don't matter: what a kind lacks is null.
    """
    return spark.read.schema(STORED).json(f"{root}/*/classifications").withColumn("kind", F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/classifications/", 1))


def write_tsv(classified: DataFrame, path: str) -> None:
    """One line a file: name, md5 and the five labels."""
    classified.select("file_name", "file_md5sum", *[label(f).alias(f) for f in FIELDS]).write.csv(path, sep="\t", header=True)


def write_evidence(payloads: DataFrame, path: str) -> None:
    """Appends payloads (file_md5sum and whatever was read) to a Parquet table, dealt by the md5's first two digits."""
    payloads.withColumn("prefix", F.substring("file_md5sum", 1, 2)).withColumn("fetched_at", F.current_timestamp()).write.mode("append").partitionBy("prefix").parquet(path)


def with_evidence(files: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with their cached payload (the newest of each md5), and the files that must be read."""
    newest = evidence.groupBy("file_md5sum").agg(F.max_by(F.struct(*[c for c in evidence.columns if c not in ("file_md5sum", "prefix")]), "fetched_at").alias("payload"))
    return files.join(newest, "file_md5sum"), files.join(newest.select("file_md5sum"), "file_md5sum", "left_anti")


def left_to_do(files: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Files whose md5 no finished run holds; with a limit, the first so many by md5 and name."""
    left = files.join(done.select("file_md5sum").distinct(), "file_md5sum", "left_anti")
    return left if limit is None else left.orderBy("file_md5sum", "file_name").limit(limit)


def finished(spark: SparkSession, path: str, files: int) -> bool:
    """Whether write_run()'s path holds a run that says it is complete, with a result for at least so many files."""
    try:
        complete = spark.read.json(f"{path}/metadata").where("complete").count() > 0
        return complete and spark.read.schema("entry_id string").json(f"{path}/classifications").count() >= files
    except AnalysisException:  # nothing there, or no such flag
        return False


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir); what is written there is deleted when the session ends.

    Without that folder, local runs use a new temp folder; on a cluster it must be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(at.getParent())
    store.deleteOnExit(at)
    return path


def once(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back, so that what several parts read is worked out once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The last folder below root whose name begins with a digit (run names are times)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    found = [s.getPath().getName() for s in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at) if s.isDirectory()]
    return max((f"{root}/{n}" for n in found if n[:1].isdigit()), default=None)
