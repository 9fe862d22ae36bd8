"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors of length one with cosine at least c are at most 2 - 2c apart, squared. Rotated by a fixed random rotation and
split into blocks of neighbouring dimensions, they must be near in at least one block: within the part of the budget
that the block's share of the dimensions gets. Each block is joined by range: its first coordinate is cut into cells as
wide as the block's radius, and only vectors of one or two neighbouring cells meet, in tiles of bounded size. In a tile, the range
join goes on over all the block's coordinates: bitmaps of their cells leave the pairs that are beside each other on every
one, and only these are compared by the block's distance. The union of all blocks' candidates is verified exactly, on the vectors as
given; a pair that qualifies in several blocks is taken in the first of them, so that every link is counted once.

Equal vectors of a label are one class with a count, joined once. A tile returns sums of links and a spanning forest, never
pairs; hot cells are split into chunks of CHUNK classes.

Defined results. Vectors that are null, empty, zero, or hold null or non-finite components: no links, a component of their
own. Null labels: likewise. Vectors of unlike dimensions don't link. Null vec_id: no links, null component, kept. Repeated
rows are vectors of their own and link. Empty table: empty result. Other columns are ignored. Classes are named by 64-bit
hashes of label and vector: two of n distinct vectors get one name with a chance of n * n / 2 ** 65 (3 in 100 for 10 ** 9), and
would then count as equal.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components, local_roots
from .shared import written

COSINE = 0.93
#: Classes of a cell that one side of a tile holds at most, about.
CHUNK = 1500
SLACK = 1e-6
#: Cells to a radius on each coordinate, within tiles.
FINE = 4


@functools.lru_cache(16)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(17).standard_normal((dim, dim)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T)


@functools.lru_cache(16)
def blocks(dim: int, cosine: float) -> list[tuple[int, int, float]]:
    """First and last dimension (excluded) and squared-distance budget of every block."""
    edges = [dim * i // max(1, min(4, dim)) for i in range(max(1, min(4, dim)) + 1)]
    return [(i, j, (2 - 2 * cosine + SLACK) * (j - i) / dim) for i, j in zip(edges[:-1], edges[1:])]


def rotated(v: np.ndarray) -> np.ndarray:
    """Rows at length one, rotated. No BLAS: a row's result doesn't depend on the rows around it."""
    unit = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return np.einsum("ij,kj->ik", unit, rotation(v.shape[1]))


def _classes(batches):
    for b in batches:
        lists = b.column(2)
        good = pc.and_(pc.is_valid(lists), pc.and_(pc.is_valid(b.column(0)), pc.is_valid(b.column(1))))
        labels = b.column(1).to_pylist()
        node, dim, raw = [], [], []
        for ok, label, x in zip(good.to_pylist(), labels, lists):
            v = x.values if ok else None
            v = v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0 if v is not None and len(v) and not v.null_count else None
            if v is None or not np.isfinite(v).all() or not v.any() or not np.isfinite(v @ v) or not v @ v > 0:
                node.append(None), dim.append(None), raw.append(None)
                continue
            raw.append(v.tobytes())
            dim.append(len(v))
            node.append(int.from_bytes(hashlib.blake2b(raw[-1] + str(label).encode(), digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.int64()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "label", "node", "dim", "vec"])


def _cells(batches, cosine: float):
    for b in batches:
        dims = b.column(1).to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            part = b.take(pa.array(at))
            v = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.float64).reshape(-1, dim)
            y = rotated(v)
            for k, (i, _, budget) in enumerate(blocks(dim, cosine)):
                cell = np.floor(y[:, i] / (np.sqrt(budget) * (1 + 1e-9))).astype(np.int64)
                n = len(at)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(n, k, np.int32)), pa.array(cell), part.column(2), part.column(3), part.column(4)], ["label", "dim", "block", "cell", "node", "vec", "n"])


class Beside:
    """Bitmaps over rows of vectors: for each coordinate and cell (FINE to the radius), those at most FINE cells from it."""

    def __init__(self, rows: np.ndarray, radius: float):
        self.width, self.maps = radius / FINE * (1 + 1e-9), []
        words = -(-len(rows) // 64)
        for y in np.floor(rows / self.width).astype(np.int64).T:
            low, high = int(y.min()) - FINE - 1, int(y.max()) + FINE + 1  # at these, nothing is near
            near = np.packbits(np.abs(y - np.arange(low, high + 1)[:, None]) <= FINE, axis=1, bitorder="little")
            held = np.zeros((len(near), words * 8), dtype=np.uint8)
            held[:, : near.shape[1]] = near
            self.maps.append((low, high, held.view(np.uint64)))

    def pairs(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of left and of the bitmaps that are beside each other on every coordinate: all that may be within the radius."""
        both = None
        for x, (low, high, held) in zip(np.floor(left / self.width).astype(np.int64).T, self.maps):
            own = held[np.clip(x, low, high) - low]
            both = own if both is None else np.bitwise_and(both, own, out=both)
        i, word = np.nonzero(both)
        at, bit = np.nonzero(np.unpackbits(both[i, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return i[at], word[at] * 64 + bit


def block_pairs(left: np.ndarray, right: np.ndarray, budget: float, rows: int = 512) -> tuple[np.ndarray, np.ndarray, int]:
    """Which rows of left and right are at most budget apart, squared, and how many pairs' distances were computed for that.

    Only pairs that lie beside each other on all coordinates are compared; where these are many (long blocks, whose coordinates
    are all within the radius), all are, by a product of matrices.
    """
    found, compared, index = [], 0, Beside(right, float(np.sqrt(budget)))
    square = np.einsum("ij,ij->i", right, right)
    for low in range(0, len(left), rows):
        part = left[low : low + rows]
        a, b = index.pairs(part)
        if 8 * len(a) > len(part) * len(right):
            gap = np.einsum("ij,ij->i", part, part)[:, None] + square - 2 * (part @ right.T)
            a, b = np.nonzero(gap <= budget + 1e-9)
            compared += len(part) * len(right)
        else:
            near = ((part[a] - right[b]) ** 2).sum(axis=1) <= budget + 1e-9
            compared += len(a)
            a, b = a[near], b[near]
        found.append((a + low, b))
    return *(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1)), compared


def _tile(table: pa.Table, cosine: float) -> pa.Table:
    """Links between the two chunks of a tile (side 0 and 1), or within one chunk (side 2)."""
    block, dim = table.column("block")[0].as_py(), table.column("dim")[0].as_py()
    side = table.column("side").to_numpy()
    node, times = table.column("node").to_numpy(), table.column("n").to_numpy()
    v = np.frombuffer(b"".join(table.column("vec").to_pylist()), dtype=np.float64).reshape(-1, dim)
    own = bool((side == 2).any())
    left, right = (np.flatnonzero(side == 2),) * 2 if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    found = []
    if len(left) and len(right):
        y, parts = rotated(v), blocks(dim, cosine)
        i0, i1, budget = parts[block]
        near, other, _ = block_pairs(y[left, i0:i1], y[right, i0:i1], budget)
        for low in range(0, len(near), 65_536):
            a, b = left[near[low : low + 65_536]], right[other[low : low + 65_536]]
            if own:
                a, b = a[a < b], b[a < b]
            gap = [((y[a, i:j] - y[b, i:j]) ** 2).sum(axis=1) <= most for i, j, most in parts[: block + 1]]
            first = gap[block] & ~np.any(gap[:block], axis=0) if block else gap[0]
            a, b = a[first], b[first]
            norm = np.sqrt(np.einsum("ij,ij->i", v[a], v[a])) * np.sqrt(np.einsum("ij,ij->i", v[b], v[b]))
            link = np.einsum("ij,ij->i", v[a], v[b]) / norm >= cosine
            found.append((a[link], b[link]))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    links = np.bincount(a, times[b], minlength=len(node)) + np.bincount(b, times[a], minlength=len(node))
    nodes, roots = local_roots(node[a], node[b])
    at = np.searchsorted(nodes, node[links > 0])
    return pa.table({"node": pa.array(node[links > 0]), "links": pa.array(links[links > 0].astype(np.int64)), "root": pa.array(roots[at])})


def link_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = written(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")).mapInArrow(_classes, "vec_id long, label string, node long, dim int, vec binary"), "vectors")
    classes = written(rows.where("node is not null").groupBy("label", "dim", "node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("vec").alias("vec")), "vector-classes")
    cells = classes.select("label", "dim", "node", "vec", "n").mapInArrow(lambda it: _cells(it, cosine), "label string, dim int, block int, cell long, node long, vec binary, n long")
    key = ["label", "dim", "block", "cell"]
    parts = written(cells.groupBy(*key).agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts")), "vector-cells")
    w = Window.partitionBy("label", "dim", "block").orderBy("cell")  # some dozens of cells a block
    beside = parts.select(*key, "parts", F.when(F.lead("cell").over(w) == F.col("cell") + 1, F.lead("parts").over(w)).otherwise(0).alias("up"), F.when(F.lag("cell").over(w) == F.col("cell") - 1, F.lag("parts").over(w)).otherwise(0).alias("down"))
    dealt = cells.join(beside, key).withColumn("part", F.pmod(F.xxhash64("node", "block"), F.col("parts")).cast("int"))

    def tile(side, c1, p1, c2, p2):
        return F.struct(F.lit(side).alias("side"), c1.cast("long").alias("c1"), p1.cast("int").alias("p1"), c2.cast("long").alias("c2"), p2.cast("int").alias("p2"))

    c, p = F.col("cell"), F.col("part")
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda x: x < n)
    tiles = F.concat(
        F.array(tile(2, c, p, c, p)),
        F.transform(F.filter(upto(F.col("parts")), lambda x: x > p), lambda x: tile(0, c, p, c, x)),
        F.transform(F.filter(upto(F.col("parts")), lambda x: x < p), lambda x: tile(1, c, x, c, p)),
        F.transform(upto(F.col("up")), lambda x: tile(0, c, p, c + 1, x)),
        F.transform(upto(F.col("down")), lambda x: tile(1, c - 1, x, c, p)),
    )
    tiled = dealt.select("label", "dim", "block", "node", "vec", "n", F.explode(tiles).alias("t")).select("label", "dim", "block", "t.*", "node", "vec", "n")
    found = written(tiled.groupBy("label", "dim", "block", "c1", "p1", "c2", "p2").applyInArrow(lambda t: _tile(t, cosine), "node long, links long, root long"), "vector-links")
    roots = components(found.select("node", "root"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "vec_id", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    result = named.join(least, "root").join(links, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("vec_id", "node").join(result, "node", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at COSINE within their labels."""
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Brute force in SQL: rows linked pair by pair, components by the reach of each row.
ORACLE = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= {COSINE}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
"""
