"""The table of evidence: what was read of files' heads, dealt by md5 so that joining it with files doesn't shuffle it.

A table is bucketed by md5 and holds appended rows; compact() rewrites it to the newest good row of each md5. A reader takes
the newest row of each md5; a row that is corrupt, empty or of another shape than asked for is a miss, and so are files without a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a new table. A bucket of a table of 10 ** 9 heads of 4 KB holds some 4 GB.
BUCKETS = 1024
KEY = "file_md5sum"


class EvidenceTable:
    """Evidence of one kind of file: file_md5sum, payload (a JSON text of the payload's columns), fetched_at.

    schema: the payload's columns. may_be_empty: whether a payload without any content is evidence (an archive without members)
    or a miss (a header without text).
    """

    def __init__(self, spark: SparkSession, name: str, schema: str, may_be_empty: bool = False, buckets: int = BUCKETS):
        self.spark, self.name, self.may_be_empty, self.buckets = spark, name, may_be_empty, buckets
        self.schema = T.StructType.fromDDL(schema)

    def _write(self, rows: DataFrame, name: str, mode: str) -> None:
        rows.write.format("parquet").bucketBy(self.buckets, KEY).sortBy(KEY).mode(mode).saveAsTable(name)

    def append(self, payloads: DataFrame) -> None:
        """Adds payloads: file_md5sum and the schema's columns; fetched_at is now where it isn't given."""
        at = F.col("fetched_at") if "fetched_at" in payloads.columns else F.current_timestamp()
        told = F.to_json(F.struct(*[F.col(f"`{f}`") for f in self.schema.names]), {"ignoreNullFields": "false"})
        rows = payloads.where(F.col(KEY).isNotNull()).select(KEY, told.alias("payload"), at.alias("fetched_at"))
        self._write(rows.repartition(self.buckets, KEY), self.name, "append")

    def _parsed(self) -> Column:
        """The payload's columns, or null where it is no JSON object of the asked-for shape, or empty where that is a miss."""
        shape = T.StructType([*self.schema.fields, T.StructField("_bad", T.StringType())])
        got = F.from_json("payload", shape, {"columnNameOfCorruptRecord": "_bad"})
        keys = F.json_object_keys("payload")
        good = got["_bad"].isNull() & F.coalesce(F.forall(F.array(*map(F.lit, self.schema.names)), lambda f: F.array_contains(keys, f)), F.lit(False))
        if not self.may_be_empty:
            some = [F.coalesce(F.size(got[f.name]) > 0 if isinstance(f.dataType, (T.ArrayType, T.MapType)) else F.length(got[f.name].cast("string")) > 0, F.lit(False)) for f in self.schema.fields if not isinstance(f.dataType, T.StructType)]
            for one in some[:1]:
                good = good & one
        return F.when(good, F.struct(*[got[f].alias(f) for f in self.schema.names]))

    def newest(self) -> DataFrame:
        """file_md5sum, payload (struct) and fetched_at of the newest row of each md5 that is no miss; the table isn't shuffled."""
        rows = self.spark.table(self.name).select(KEY, "fetched_at", self._parsed().alias("payload")).where("payload is not null")
        return rows.groupBy(KEY).agg(F.max_by(F.struct("payload", "fetched_at"), F.struct("fetched_at", F.to_json("payload"))).alias("n")).select(KEY, "n.payload", "n.fetched_at")

    def split(self, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Files with the payload's columns, and the files that must be read. Files are dealt as the table is; it stays where it is."""
        dealt = files.repartition(self.buckets, KEY)
        known = self.newest().select(F.col(KEY).alias("_md5"), F.col("payload").alias("_payload"))
        joined = dealt.join(known.hint("merge"), dealt[KEY] == F.col("_md5"), "left").drop("_md5")
        found = joined.where("_payload is not null").select(*files.columns, "_payload.*")
        return found, joined.where("_payload is null").select(*files.columns)

    def compact(self, to: str) -> "EvidenceTable":
        """Writes a table `to` of the newest good row of each md5, dealt alike, and returns it; this one stays as it is."""
        told = F.to_json("payload", {"ignoreNullFields": "false"})
        self._write(self.newest().select(KEY, told.alias("payload"), "fetched_at"), to, "errorifexists")
        out = EvidenceTable(self.spark, to, "x int", self.may_be_empty, self.buckets)
        out.schema = self.schema
        return out
