"""Embedding whitening by upper-triangle column aggregates.

The fit list is every distinct vector of whole numbers, once. One aggregation gives n and each dimension's sum; a second one
is generated as a Spark SQL expression for each pair of dimensions, which sums the products of the centred columns over the
whole list. Above WIDE dimensions, rows are cut into blocks of BLOCK columns and the same expressions are grouped by
pair of blocks, so that neither a row of buffers nor the generated code grows with the square of the length. Only sums reach the
driver, which puts the covariance together and has LAPACK decompose it; vectors are projected in tasks.

Defined results. Vectors that are null, empty, or hold null or non-finite components: no rows. Vectors of unlike lengths: each
length has a fit list and components of its own. Null and repeated vec_id: rows of their own. Fewer dimensions than asked-for
components: as many rows as dimensions. Components without variance (also all of one distinct vector): whitened is null, explained
0.0 (null where nothing varies), and they don't count in identity_error (null if none is left). A deviation that doesn't fit in a
long: null. Empty table: empty result. Other columns are ignored. Signs: a component's largest entry, the first of equals, is positive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .vectors import lengths, matrix, whole_numbers

SCALE = 256
COMPONENTS = 4
#: Dimensions whose pairs are expressions of one aggregation without grouping; above, columns of a block.
WIDE, BLOCK = 64, 32
#: A component has variance if its eigenvalue is above this share of the trace for each dimension.
RANK = 1e-13


@dataclass
class Whitening:
    """What fit() found for the vectors of one length: sums and covariance of n vectors, eigenvalues falling, unit rows of axes."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    identity_error: float | None = None

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def varies(self, k: int) -> bool:
        trace = float(np.trace(self.covariance))
        return trace > 0 and self.values[k] > RANK * len(self.sums) * trace


def centred_products(rows: DataFrame, means: list[float]) -> np.ndarray:
    """The sums of (x_i - mean_i) * (x_j - mean_j) over all rows of x, for each pair of dimensions."""
    d, out = len(means), np.zeros((len(means), len(means)))
    if d <= WIDE:
        # no entry is null; that the expressions say so halves their time
        columns = rows.selectExpr(*[f"coalesce(cast(x[{i}] AS double), 0D) - {m!r}D AS c{i}" for i, m in enumerate(means)])
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        found = columns.selectExpr(*[f"sum(c{i} * c{j}) AS s{i}_{j}" for i, j in pairs]).first()
        for (i, j), s in zip(pairs, found):
            out[i, j] = out[j, i] = s
        return out
    blocks = range(-(-d // BLOCK))
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in blocks for q in blocks if p <= q])
    c = F.zip_with("x", F.lit([float(m) for m in means]), lambda x, m: x.cast("double") - m)
    part = lambda i: F.slice("c", i * BLOCK + 1, BLOCK)
    cut = rows.select(c.alias("c")).select(F.explode(pairs).alias("pair"), "c").select("pair.p", "pair.q", part(F.col("pair.p")).alias("a"), part(F.col("pair.q")).alias("b"))
    sums = [f"sum(get(a, {i}) * get(b, {j})) AS s{i}_{j}" for i in range(BLOCK) for j in range(BLOCK)]
    for p, q, *found in cut.groupBy("p", "q").agg(*map(F.expr, sums)).collect():  # a row for each pair of blocks
        i, j = p * BLOCK, q * BLOCK
        block = np.array(found, dtype=float).reshape(BLOCK, BLOCK)[: d - i, : d - j]
        out[i : i + BLOCK, j : j + BLOCK], out[j : j + BLOCK, i : i + BLOCK] = block, block.T
    return out


def _projected(x: np.ndarray, model: Whitening, components: list[int]) -> np.ndarray:
    return (x - model.means) @ (model.axes[components] / np.sqrt(model.values[components])[:, None]).T


def fit(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """A Whitening for each length of vectors. identity_error: of the first so many components, measured on the whitened list."""
    rows = whole_numbers(vectors, scale, id_col, vector_col).select("x")
    once, found = written(rows.distinct(), "whitening-fit"), {}
    for d in lengths(once):
        fit_list = once.where(F.size("x") == d)
        n, *sums = fit_list.agg(F.count("*"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(d)]).first()
        sums = [int(s) for s in sums]
        covariance = centred_products(fit_list, [s / n for s in sums]) / n
        values, axes = np.linalg.eigh(covariance)
        values, axes = np.maximum(values[::-1], 0.0), axes.T[::-1]
        largest = np.abs(axes).argmax(axis=1)
        model = Whitening(n, sums, covariance, values, axes * np.where(axes[np.arange(d), largest] < 0, -1.0, 1.0)[:, None])
        firm = [k for k in range(min(components, d)) if model.varies(k)]
        if firm:

            def white(batches, d=d, model=model, firm=firm):
                for b in batches:
                    y = _projected(matrix(b.column(0), d), model, firm)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in y.T], [f"w{k}" for k in firm])

            y = fit_list.select("x").mapInArrow(white, ", ".join(f"w{k} double" for k in firm))
            pairs = [(a, b) for a in firm for b in firm if a <= b]
            got = y.agg(*[F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs]).first()
            model.identity_error = max(abs(c - float(a == b)) for (a, b), c in zip(pairs, got))
        found[d] = model
    return found


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum over dimensions of (n * x - sum) ** 2 of every row."""
    most, top = max((abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))), max(map(abs, sums))
    kind = np.int64 if x.shape[1] * most * max(most, top) < 2**62 else object
    x, s = x.astype(kind), np.array(sums, dtype=kind)
    squares, products, fixed = (x * x).sum(axis=1).tolist(), (x * s).sum(axis=1).tolist(), sum(v * v for v in sums)
    return [n * n * a - 2 * n * b + fixed for a, b in zip(squares, products)]


def whiten(vectors: DataFrame, models: dict[int, Whitening], components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Vectors of a length without a model have no rows.
    """
    rows = whole_numbers(vectors, scale, id_col, vector_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names, types = [c.split()[0] for c in schema.split(", ")], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def project(d, model):
        k, trace = min(components, d), float(np.trace(model.covariance))
        firm = [i for i in range(k) if model.varies(i)]
        explained = [float(model.values[i]) / trace if trace > 0 else None for i in range(k)]
        explained = [e if e is None or i in firm else 0.0 for i, e in enumerate(explained)]

        def run(batches):
            for b in batches:
                x = matrix(b.column(1), d)
                whole = [v if v < 2**63 else None for v in deviations(x, model.n, model.sums)]
                y = np.full((len(x), k), np.nan)
                if firm:
                    y[:, firm] = _projected(x, model, firm)
                m = len(x)
                each = np.repeat(np.arange(m), k)
                columns = [b.column(0).take(pa.array(each)), np.tile(np.arange(1, k + 1), m), np.full(m * k, model.n), pa.array(whole, pa.int64()).take(pa.array(each)), pa.array(y.ravel(), from_pandas=True), pa.array(explained * m, pa.float64()), pa.array([model.identity_error] * (m * k), pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c.cast(t) for c, t in zip(columns, types)], names)

        return rows.where(F.size("x") == d).select("vec_id", "x").mapInArrow(run, schema)

    parts = [project(d, m) for d, m in models.items()]
    return reduce(DataFrame.unionAll, parts) if parts else vectors.sparkSession.createDataFrame([], schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """The first COMPONENTS whitened components of all embeddings."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(vectors, fit(vectors))
