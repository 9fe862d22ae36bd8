"""Vector codes: every vector is cut into parts, and each part is named by the nearest entry of its codebook.

Vectors are whole numbers (floor of SCALE times each component). Codebooks start as the parts of the vectors with the smallest
ids; a round assigns every part and moves each entry to the componentwise floor of its parts' mean. Tasks add up the parts of
each entry, Spark adds up the tasks, and only the codebooks pass the driver (PARTS * ENTRIES entries at most, whatever the
table's size).

Assignment filters entries by lower bounds, coarse to fine. A vector is cut into segments; the means of its segments, each times
the root of the segment's length, and the norm of what is left are a short vector whose distance to an entry's is never more
than theirs (projections shorten distances, and norms of rests differ by at most the distance of the rests). The bound with one
segment is taken of all entries; the entry with the least one gives an exact distance to beat; whatever may still beat it meets
bounds of 4, 16, ... segments. Survivors get exact integer distances. Bounds have slack for their rounding, so no entry is lost.

Defined results. Vectors that are null, empty, or hold null or non-finite components: no rows. Vectors of unlike lengths: each
length has codebooks of its own. Lengths that PARTS doesn't divide: parts as equal as they can be. Null ids come after all others
in the choice of first entries, equal ids in their vectors' order. Fewer vectors than ENTRIES: as many entries as vectors. Null
labels are one label. Components beyond 2 ** 52 after scaling count as that; errors that don't fit in a long are null. Empty table:
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, written
from .vectors import lengths, matrix, whole_numbers

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
MOST = 1 << 52
#: Share of the squared norms that a bound may be off by rounding; float64 errs by some 1e-14 of them.
SLACK = 1e-9
CHUNK = 1024


def edges(dim: int, parts: int) -> list[int]:
    return [dim * i // parts for i in range(parts + 1)]


def segments(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine."""
    out, g = [], 1
    while g < dim:
        out.append(g)
        g *= 4
    return out


def short_vectors(v: np.ndarray, g: int) -> np.ndarray:
    """Means of g segments times the root of the segment's length, and the norm of the rest."""
    cut = np.array(edges(v.shape[1], g))
    size = np.diff(cut)
    means = np.add.reduceat(v, cut[:-1], axis=1) / size
    rest = v - np.repeat(means, size, axis=1)
    return np.column_stack([means * np.sqrt(size), np.sqrt(np.einsum("ij,ij->i", rest, rest))])


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=1)


def _firsts(i: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.r_[True, i[1:] != i[:-1]])


def _least(values: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of equal i, the place of its first least value, and that value."""
    first = _firsts(i)
    least = np.minimum.reduceat(values, first)
    at = np.flatnonzero(values == np.repeat(least, np.diff(np.r_[first, len(i)])))
    return at[_firsts(i[at])], least


class Codebook:
    """The entries (whole numbers) of one part."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.numbers = entries, entries.astype(np.float64)
        self.squares = np.einsum("ij,ij->i", self.numbers, self.numbers)
        self.short = [short_vectors(self.numbers, g) for g in segments(entries.shape[1])]
        self.seen = self.pairs = 0  # exact distances, and pairs of parts and entries

    def _bits(self, v: np.ndarray) -> int:
        """Bits that squared distances may take."""
        top = max((int(np.abs(x).max(initial=0)) for x in (v, self.entries)))
        return (v.shape[1] * 4 * top * top).bit_length()

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry, the lowest of equals, and the exact squared distance, of each row."""
        if not v.shape[1]:
            return np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        bits, index, distance = self._bits(v), [], []
        kind = np.int64 if bits < 62 else object
        entries = self.entries.astype(kind)
        for low in range(0, len(v), CHUNK):
            x, numbers = v[low : low + CHUNK].astype(kind), v[low : low + CHUNK].astype(np.float64)
            squares = np.einsum("ij,ij->i", numbers, numbers)
            both = squares[:, None] + self.squares
            alive, i, j, best = np.ones(both.shape, dtype=bool), None, None, None
            for g, short in zip(segments(v.shape[1]), self.short):
                if i is None and 20 * np.count_nonzero(alive) < both.size:  # few are left: pairs are cheaper than matrices
                    i, j = np.nonzero(alive)
                s = short_vectors(numbers, g)
                if i is None:
                    bound = (1 - SLACK) * both - 2 * (s @ short.T)
                    first = np.where(alive, bound, np.inf).argmin(axis=1)
                else:
                    bound = ((s[i] - short[j]) ** 2).sum(axis=1) - SLACK * both[i, j]
                    first = j[_least(bound, i)[0]]
                now = exact(x, entries[first])
                best = now if best is None else np.minimum(best, now)
                most = best.astype(np.float64) * (1 + 1e-12)
                if i is None:
                    alive &= bound <= most[:, None]
                else:
                    keep = bound <= most[i]
                    i, j = i[keep], j[keep]
            if i is None and bits < 53:  # sums of whole numbers below 2 ** 53 are exact in floats
                d = np.where(alive, both - 2 * (numbers @ self.numbers.T), np.inf)
                at = d.argmin(axis=1)
                index.append(at)
                distance.append(d[np.arange(len(d)), at].astype(np.int64))
                self.seen += np.count_nonzero(alive)
            else:
                i, j = np.nonzero(alive) if i is None else (i, j)
                d = exact(x[i], entries[j])
                at, least = _least(d, i)
                index.append(j[at])
                distance.append(least)
                self.seen += len(d)
            self.pairs += both.size
        return (np.concatenate(index), np.concatenate(distance)) if index else (np.zeros(0, np.int64),) * 2


Books = list[np.ndarray]


def _numbers(column: pa.Array, dim: int) -> np.ndarray:
    return np.clip(matrix(column, dim), -MOST, MOST)


def _moved(rows: DataFrame, books: Books, dim: int) -> Books:
    """The codebooks after one round over rows of x."""
    cut = edges(dim, len(books))

    def add(batches):
        known, sums, times = [Codebook(b) for b in books], [np.zeros(b.shape, dtype=object) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for b in batches:
            x = _numbers(b.column(0), dim)
            for k, book in enumerate(known):
                part = x[:, cut[k] : cut[k + 1]]
                at, _ = book.nearest(part)
                now = np.zeros(sums[k].shape, dtype=np.int64 if len(x) * int(np.abs(part).max(initial=0)) < 2**62 else object)
                np.add.at(now, at, part.astype(now.dtype))
                used = np.unique(at)
                sums[k][used] += now[used].astype(object)
                times[k] += np.bincount(at, minlength=len(times[k]))
        found = [(k, e) for k in range(len(books)) for e in np.flatnonzero(times[k]).tolist()]
        values = pa.array([sums[k][e].tolist() for k, e in found], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([e for _, e in found], pa.int32()), pa.array([int(times[k][e]) for k, e in found], pa.int64()), values], ["part", "entry", "n", "sums"])

    added = rows.select("x").mapInArrow(add, "part int, entry int, n long, sums array<decimal(38,0)>")
    widest = max(b.shape[1] for b in books)
    total = added.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(F.get("sums", F.lit(i))) for i in range(widest)])
    new = [b.copy() for b in books]
    for part, entry, n, *sums in total.collect():  # a row for each entry in use
        new[part][entry] = [int(s) // n for s in sums[: new[part].shape[1]]]
    return new


def learn(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks (entries x dimensions, for each part) of rows (vec_id, x of length dim), which are read once a round."""
    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start, cut = np.clip(np.array([r.x for r in first], dtype=np.int64).reshape(len(first), dim), -MOST, MOST), edges(dim, parts)
    books = [start[:, cut[k] : cut[k + 1]] for k in range(parts)]
    for _ in range(rounds):
        books = _moved(rows, books, dim)
    return books


def digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: Books, dim: int) -> DataFrame:
    """vec_id, label, code, error (decimal) and codebooks_sha256 of rows (vec_id, x, label)."""
    cut, sha = edges(dim, len(books)), digest(books)
    digits = max(2, len(f"{max(1, len(books[0])) - 1:x}"))

    def run(batches):
        known = [Codebook(b) for b in books]
        for b in batches:
            x = _numbers(b.column(1), dim)
            found = [book.nearest(x[:, cut[k] : cut[k + 1]]) for k, book in enumerate(known)]
            code = ["".join(f"{e:0{digits}x}" for e in c) for c in zip(*(at.tolist() for at, _ in found))]
            error = [sum(e) for e in zip(*(d.tolist() for _, d in found))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(code, pa.string()), pa.array(error, pa.decimal128(38, 0)), pa.array([sha] * len(x), pa.string())], ["vec_id", "label", "code", "error", "codebooks_sha256"])

    return rows.select("vec_id", "x", "label").mapInArrow(run, "vec_id long, label string, code string, error decimal(38,0), codebooks_sha256 string")


def with_label_sums(coded: DataFrame) -> DataFrame:
    """coded plus label_error, the sum of error over the rows of equal labels (nulls together).

    A label with more than its share of the rows (there are at most two such labels a shuffle partition, so their sums are
    broadcast) is joined where its rows lie; the others' rows are dealt by label.
    """
    labels = written(coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"), F.count("*").alias("n")), "label-errors")
    most = (labels.agg(F.sum("n")).first()[0] or 0) // (2 * partitions(coded.sparkSession))
    same = lambda a, b: a["label"].eqNullSafe(b["its_label"])
    sums = labels.withColumnRenamed("label", "its_label")
    large = F.broadcast(sums.where(F.col("n") > most).withColumnRenamed("label_error", "large_error").withColumn("large", F.lit(True)).drop("n"))
    marked = coded.join(large, same(coded, large), "left").drop("its_label")
    own, few = marked.where("large").withColumnRenamed("large_error", "label_error"), marked.where("large is null").drop("large_error")
    small = sums.where(F.col("n") <= most).drop("n")
    return own.drop("large").unionByName(few.join(small, same(few, small)).drop("its_label", "large"))


def code_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row."""
    rows, coded = written(whole_numbers(vectors, scale, id_col, vector_col, label_col), "code-vectors"), []
    for d in lengths(rows):
        own = rows.where(F.size("x") == d)
        coded.append(encode(own, learn(own, d, parts, entries, rounds), d))
    if not coded:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    found = with_label_sums(written(reduce(DataFrame.unionAll, coded), "vector-codes"))
    whole = lambda c: F.expr(f"try_cast({c} AS bigint)").alias(c)
    return found.select("vec_id", "code", whole("error"), whole("label_error"), "codebooks_sha256")


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all embeddings after ROUNDS rounds."""
    return code_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    """Every round as a table of assigned parts and one of moved entries, over all pairs of parts and entries."""
    dot = "list_dot_product(a.v, b.v)"
    near = "SELECT a.vec_id, a.label, a.p, a.v, arg_min(b.e, a.sq + b.sq - 2 * {dot} + b.e / 1e6) AS e, min(a.sq + b.sq - 2 * {dot}) AS d FROM parts a JOIN books{n} b ON a.p = b.p GROUP BY ALL"
    ctes = [
        f"kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v, len(embedding) // {PARTS} AS w FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * w + 1 : p * w + w] AS v, list_dot_product(v[p * w + 1 : p * w + w], v[p * w + 1 : p * w + w]) AS sq FROM kept, range({PARTS}) r(p))",
        f"books0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v, sq FROM parts QUALIFY e < {ENTRIES})",
    ]
    for n in range(ROUNDS):
        ctes.append(f"near{n} AS MATERIALIZED ({near.format(dot=dot, n=n)})")
        ctes.append(f"mean{n} AS (SELECT p, e, list(m ORDER BY i) AS v FROM (SELECT p, e, i, floor(sum(x) / count(*)) AS m FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{n}) GROUP BY ALL) GROUP BY ALL)")
        ctes.append(f"books{n + 1} AS MATERIALIZED (SELECT p, e, v, list_dot_product(v, v) AS sq FROM (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM books{n} b LEFT JOIN mean{n} m ON m.p = b.p AND m.e = b.e))")
    ctes.append(f"last AS MATERIALIZED ({near.format(dot=dot, n=ROUNDS)})")
    ctes.append("coded AS (SELECT vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY ALL)")
    ctes.append(f"sha AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS s FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM books{ROUNDS}))")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256 FROM coded, sha"


ORACLE = _oracle()
