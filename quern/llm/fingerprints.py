"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the K smallest distinct shingle hashes (48 bits each). The sketch of a union is the K smallest of the
sketches' hashes together, so parts can be sketched apart and merged. From two sketches: resemblance (the share of the
K smallest of the union that both hold), containment, and distinct shingles (K - 1 over the K-th smallest hash as a
fraction; exact below K).

Defined results. Null and empty texts: the empty sketch, ""; two empty sketches are alike (1.0), an empty and another one
aren't (0.0). Equal texts: equal fingerprints. Repeated ids: rows of one id stand in any order, next to each other; null
ids come first. One document: it is its own next one. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bucket_of, partitions, range_bounds, repeatable, text_batches, written
from .shingles import shingle_hashes

K = 128
BITS = 48


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct of shingle_hashes()' values, cut to 48 bits."""
    x = hashes[: 2 * k] >> np.uint64(64 - BITS)  # ascending already; the cut can make a few equal
    return x[np.r_[True, x[1:] != x[:-1]]][:k] if len(x) else x


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()).decode()


def from_text(t: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(t), dtype=np.uint8).reshape(-1, 6)
    return np.concatenate([raw, np.zeros((len(raw), 2), np.uint8)], axis=1).copy().view("<u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both parts' shingles together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    x = np.concatenate([a, b])
    x.sort()
    twice = x[1:] == x[:-1]
    first = np.r_[True, ~twice]
    n = min(k, int(first.sum()))
    last = x[first][n - 1]
    return float(twice[x[1:] <= last].sum() / n)


def distinct_shingles(s: np.ndarray, k: int = K) -> float:
    return float(len(s)) if len(s) < k else (k - 1) / (float(s[k - 1] + 1) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The estimated share of a's shingles that b holds."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return min(1.0, both / distinct_shingles(a, k))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """doc_id, fingerprint and n_shingles (estimated) of every row; no shuffle."""

    def run(batches):
        for b in text_batches(batches):
            s = [sketch(h, k) for h in shingle_hashes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_text(x) for x in s], pa.string()), pa.array([distinct_shingles(x, k) for x in s], pa.float64())], ["doc_id", "fingerprint", "n_shingles"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fingerprint string, n_shingles double")


def _edited(batches, k: int):
    """Rows sorted by bucket; a bucket's last row is a copy of the document after its last one."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # the row before: bucket, doc_id, is_border, text, sketch
    for b in text_batches(batches):
        texts = pc.fill_null(b.column(3), "")
        sketches = [sketch(h, k) for h in shingle_hashes(texts)]
        rows = ([held] if held else []) + list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts.to_pylist(), sketches))
        held = rows[-1]
        pairs = [(x, y) for x, y in zip(rows[:-1], rows[1:]) if not x[2]]
        edited = [x[3][: len(x[3]) - len(x[3]) // 2] + y[3][: len(x[3]) // 2] for x, y in pairs]
        again = [sketch(h, k) for h in shingle_hashes(pa.array(edited, pa.large_string()))]
        out = [(x[1], len(x[3]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), to_text(x[4]), to_text(s), resemblance(x[4], s, k), resemblance(x[4], y[4], k)) for (x, y), e, s in zip(pairs, edited, again)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 500) -> DataFrame:
    """bucket, doc_id, is_border, text: documents dealt to buckets that follow the ids' order, sorted by id in each, and
    after a bucket's last document a copy of the one that comes next (after the last of all: the first).

    Texts are shuffled once. Only a bucket's first id goes through the driver, at most 16,384 of them. Rows are told apart by
    their place in the input, which must be the same at each reading: what isn't repeatable() is written to a table first.
    """
    spark = docs.sparkSession
    docs = docs.select(id_col, text_col)
    if not repeatable(docs):
        docs = written(docs, "fingerprint-texts")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    n = ids.count()
    bounds = range_bounds(ids, "doc_id", max(1, min(16_384, max(partitions(spark) * 4, n // per_bucket))), n)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("ord", F.monotonically_increasing_id())
    rows = rows.withColumn("own", bucket_of(F.col("doc_id"), bounds, F.col("ord")))
    first = [(r.own, r.head.ord) for r in rows.groupBy("own").agg(F.min(F.struct("doc_id", "ord")).alias("head")).orderBy("own").collect()]
    before = [(head, first[i - 1][0]) for i, (_, head) in enumerate(first)]  # i = 0: the last bucket
    heads = F.broadcast(spark.createDataFrame(before or [(-1, 0)], "ord long, before int"))  # a row for each bucket
    places = F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("is_border")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("is_border"))))
    dealt = rows.join(heads, "ord", "left").select(F.explode(F.array_compact(places)).alias("p"), "doc_id", "ord", "text").select("p.bucket", "doc_id", "p.is_border", "text", "ord")
    return dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "is_border", "doc_id", "ord").drop("ord")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near it is to that and to the next document."""
    return with_next(docs, id_col, text_col).mapInArrow(lambda it: _edited(it, k), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    """compare_edited() of all documents."""
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
