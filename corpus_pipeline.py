"""A corpus pipeline of four stages over documents; each stage's result is written as Parquet and read by the next.

1. language ID: documents that it rejects (null text, or none with a letter: `und`) go.
2. n-gram Jaccard join: one row, that of the smallest id, stays of every component.
3. mixing sources to target weights: every document stays; the rows come in the order of the mix (slot, place in block),
   files in ascending order. Shares: square-root tempered counts of the stage's input.
4. byte-level BPE: doc_id, n_tokens and the digests of the ids and of the bytes that they decode to; part and row: the documents' place
   in the mix (the name of the file and the row in it that stage 3 put them in; in this order they are mixed).

Stages take and return COLUMNS only, other columns of the documents are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import byte_bpe, language_id, mixing, ngram_join
from quern.llm.shared import bloom, frugal, may_hold, partitions, remove, shared_path, text_batches, written
from quern.llm.shingles import shingle_hashes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Units of the mix for each source, on average, once there are so many sources that mixing.UNITS would be too coarse.
UNITS_EACH = 20


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted language. lang, where given and not held out, is what the model learns from.

    Without anything to learn from, documents with a letter stay.
    """
    model = language_id.train(docs, ~language_id.held_out())
    if not model.nodes:
        return docs.select(*COLUMNS).where(F.col("text").rlike("\\p{L}"))
    return language_id.identify(docs.select(*COLUMNS), model).where(F.col("lang_pred") != language_id.UND).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component: that of the smallest id (null ids last), then class of text, then columns in order.

    Rows without words are components of their own and stay; of those that repeat an id and text, one.
    Rows whose ids a filter of fixed size clears of being dropped or repeated pass without a shuffle; only the others'
    texts, and those of null ids, are named by their class again, summed up a class and id, and joined with what goes.
    """
    docs = docs.select(*COLUMNS)
    rows, named = ngram_join.near_classes(docs)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first")
    known = named.join(named.groupBy("root").agg(first), "root").select("node", "first")
    stays = F.col("node").isNull() | ((F.col("node") == F.col("first.node")) & F.col("doc_id").eqNullSafe(F.col("first.id")))
    found = rows.join(known, "node", "left").withColumn("stays", stays).groupBy("doc_id", "node", "stays").agg(F.count("*").alias("n"))
    found = written(found, "near-copies")
    odd = found.where("doc_id is not null").groupBy("doc_id").agg(F.sum("n").alias("n"), F.bool_and("stays").alias("stays")).where("n > 1 or not stays")
    bits = spark.sparkContext.broadcast(bloom(odd.select("doc_id")))  # 16 MB at most

    def maybe(batches):
        for b in text_batches(batches):
            ids = b.column(0)
            given = ids.is_valid().to_numpy(zero_copy_only=False)
            may = ~given | may_hold(bits.value, ids.fill_null(0).to_numpy(zero_copy_only=False))
            node = [None] * b.num_rows
            at = np.flatnonzero(may)
            if len(at):
                for i, s in zip(at.tolist(), shingle_hashes(b.column(1).take(pa.array(at)))):
                    node[i] = ngram_join.class_of(s)
                    may[i] = given[i] or node[i] is not None
            yield pa.RecordBatch.from_arrays([pa.array(may), pa.array(node, pa.int64()), *b.columns], ["maybe", "node", *COLUMNS])

    marked = docs.mapInArrow(frugal(maybe), "maybe boolean, node long, " + ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
    clear = marked.where(~F.col("maybe")).select(*COLUMNS)
    bare = F.when(F.col("node").isNull(), F.col("text")).alias("bare")
    one = marked.where("maybe").groupBy("doc_id", "node", bare).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("node", "row.*")
    gone = found.where("not stays").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))
    rest = one.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("node") == F.col("__node")), "left_anti")
    return clear.unionByName(rest.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix. Rows of one id all take the first of its places; null ids come last."""
    docs = docs.select(*COLUMNS)
    path = shared_path(spark, "mix-places")
    units = max(mixing.UNITS, UNITS_EACH * docs.select("source").distinct().count())
    places = mixing.mix_sources(docs, mixing.tempered_units(docs, units=units)).where("doc_id is not null")
    places.groupBy("doc_id").agg(F.min(F.struct("slot", "in_block")).alias("place")).write.parquet(path)
    placed = docs.join(spark.read.parquet(path), "doc_id", "left")
    order = [F.col("place.slot").asc_nulls_last(), F.col("place.in_block").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return placed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, part and row of every document.

    Documents that don't come from files have a null part, and rows in the order of the frame.
    """
    import public_tokenizers

    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        placed = docs.select("doc_id", "text", F.lit(None).cast("string").alias("part"), F.monotonically_increasing_id().alias("row"))
    return byte_bpe.round_trip(placed, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=("part", "row"))


STAGES = [("language ID", keep_language), ("n-gram Jaccard join", keep_one_of_each), ("mixing sources to target weights", mix), ("byte-level BPE", encode)]

#: Neither the learned language nor the ids of a rank file can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over all documents; the last one's result is not written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
