"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents with equal shingle sets are one class. All shingles have one global order, rare ones first, by a count sketch of
fixed size over all documents. Two classes whose sets have a Jaccard similarity of 3/4 or more share at least
o = ceil(3n/4) shingles with n the larger size, so they share at least L shingles among the first n - o + L of each, for every
L. Each class takes the L at which its estimated cost is least: a longer prefix has more places to meet others, but a
candidate must meet it L times, so fewer are verified. A pair needs the smaller L of the two.

Prefix shingles are dealt, packed, to buckets by hash. In a bucket, the classes that share a shingle form a star around
the smallest of them; every candidate pair has a star's centre in common, so stars, not pairs, leave the buckets. A
centre's members meet in tiles of bounded size, twice. First with one bit a shingle: the bits in which two parity bitmaps
differ bound the sets' difference, so members that can't be similar to any other leave without loss. Then the rest with
their sets: pairs are kept by size, then by shared prefix shingles, then verified on the whole sets, by products of 0/1
matrices. A tile returns a spanning forest of its links.

Defined results. Null and empty texts and texts without words: set size 0, no links, a component of their own. Fewer than
five words: the whole sequence is the one shingle. Copies: linked, as equal sets are. Repeated ids: their rows' classes get
the smallest id of their component each. Null ids: take part; a component of null ids only is null. Empty table: empty
result. Other columns are ignored. Shingles and classes are named by 64-bit hashes: two of n distinct sets get one name with
a chance of n * n / 2 ** 65 (3 in 100 for 10 ** 9 sets), and would then count as copies; two shingles of a pair's n get one
likewise, which changes the shared count by one.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, local_roots
from .shared import bloom, frugal, may_hold, partitions, text_batches, written
from .shingles import shingle_hashes

#: Slots of the count sketch, and the most matches a class may ask for.
SKETCH_BITS, MOST_MATCHES = 22, 8
#: A shingle of more documents than this, by the sketch, is dealt to several buckets.
HOT = 200_000
#: Members of a star, and shingles of theirs, that one side of a tile holds, about.
CHUNK, CHUNK_SHINGLES = 384, 4_000_000


def class_of(shingles: np.ndarray) -> int | None:
    """A name for a set: 64 bits of a digest of its hashes."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each slot of a power of two of at least the set's size: whether an odd number of shingles falls there."""
    size = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount(((shingles >> np.uint64(12)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


@frugal
def _classes(batches):
    """doc_id, node, n for every document, and at the end a row with the task's part of the count sketch."""
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for b in text_batches(batches):
        sets = shingle_hashes(b.column(1))
        if sets:
            np.add.at(sketch, _slots(np.concatenate(sets)), np.uint32(1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(len(sets), pa.binary())], ["doc_id", "node", "n", "bits", "sketch"])
    if sketch.any():
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.nulls(1, pa.binary()), pa.array([zlib.compress(sketch.tobytes(), 1)], pa.binary())], ["doc_id", "node", "n", "bits", "sketch"])


def _summed(batches):
    total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for b in batches:
        for x in b.column(0):
            total += np.frombuffer(zlib.decompress(x.as_py()), dtype=np.uint32)
    yield pa.RecordBatch.from_pydict({"sketch": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


class Order:
    """The global order of shingles, and the matches a class asks for."""

    def __init__(self, packed: bytes | None):
        self.count = np.frombuffer(zlib.decompress(packed), dtype=np.uint32) if packed else np.zeros(1 << SKETCH_BITS, np.uint32)
        mean = float(self.count.mean())
        self.noise = mean + 3 * mean**0.5

    def ranked(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles in the global order, and their counts."""
        count = self.count[_slots(shingles)]
        at = np.lexsort((shingles, count))
        return shingles[at], count[at]

    def matches(self, count: np.ndarray) -> tuple[int, int]:
        """How many shared prefix shingles a class asks for, and its prefix's length. count: of its ranked shingles.

        The cost of L matches: one for each estimated meeting in the prefix, and a verification (a fifth of the set's
        size) for each candidate, of which there are at most meetings / L.
        """
        n = len(count)
        shortest = n - (-(-3 * n // 4)) + 1
        most = max(1, min(MOST_MATCHES, n - shortest + 1))
        meet = np.cumsum(np.maximum(count - self.noise, 0.0))
        each = np.arange(1, most + 1)
        met = meet[shortest + each - 2]
        best = int(np.argmin(met + 0.2 * n * met / each + 0.5 * each))
        return best + 1, shortest + best


_orders: dict[bytes, Order] = {}


def _order(shipped) -> Order:
    """One Order a worker, named by the sketch's digest: all tasks of a join must use the same order."""
    key = hashlib.blake2b(shipped.value or b"").digest()
    if key not in _orders:
        _orders.clear()
        _orders[key] = Order(shipped.value)
    return _orders[key]


def _spread(token: np.ndarray, salt: np.ndarray, buckets: int) -> np.ndarray:
    x = (token + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


@frugal
def _prefixes(batches, shipped, buckets: int, hot: int):
    """Packed prefix shingles: rows of bucket, tokens (40 bits: 32 and 8), nodes, sizes and whether a token is hot."""
    order, seen, held, size = _order(shipped), set(), [], 0

    def packed():
        token, node, n, is_hot, bucket = (np.concatenate([h[k] for h in held]) for k in range(5))
        at = np.argsort(bucket, kind="stable")
        token, node, n, is_hot, bucket = token[at], node[at], n[at], is_hot[at], bucket[at]
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())
        high, low = (token >> np.uint64(8)).astype("<u4"), (token & np.uint64(255)).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]].astype(np.int32)), cut(high), cut(low), cut(node), cut(n), cut(is_hot)], ["bucket", "high", "low", "node", "n", "hot"])

    for b in text_batches(batches):
        for s in shingle_hashes(b.column(0)):
            node = class_of(s)
            if node is None or node in seen:
                continue
            seen.add(node)
            ranked, count = order.ranked(s)
            _, length = order.matches(count)
            token = ranked[:length] >> np.uint64(24)
            parts = np.maximum(1, -(-count[:length].astype(np.int64) // hot))
            salt = (node & 0x7FFFFFFF) % parts
            held.append((token, np.full(length, node), np.full(length, len(s), np.int32), parts > 1, _spread(token, salt, buckets)))
            size += length
        if size > 1_000_000:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


@frugal
def _stars(batches):
    """Rows sorted by bucket. centre, centre's size, node for the classes that share a shingle; the token where it is hot."""
    names = ["token", "centre_n", "centre", "node"]
    bucket, held = None, []

    def out():
        high, low, node, n, hot = (np.frombuffer(b"".join(h[k] for h in held), dtype=t) for k, t in enumerate(("<u4", np.uint8, np.int64, np.int32, np.bool_)))
        token = (high.astype(np.int64) << 8) | low
        at = np.lexsort((node, n, token))
        token, node, n, hot = token[at], node[at], n[at], hot[at]
        start = np.r_[True, token[1:] != token[:-1]]
        first = np.maximum.accumulate(np.where(start, np.arange(len(token)), 0))
        use = (node != node[first]) | hot
        first = first[use]
        star = np.rec.fromarrays([np.where(hot[use], token[use], -1), n[first].astype(np.int64), node[first], node[use]], names=names)
        star = np.unique(star)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(star[k])) for k in names], names)

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(6))):
            if held and row[0] != bucket:
                yield out()
                held = []
            bucket = row[0]
            held.append(row[1:])
    if held:
        yield out()


@frugal
def _sets(batches, shipped, wanted: bytes):
    """node, matches, prefix, shingles (ranked, packed) of the documents that may be wanted, a class once a task."""
    order, seen = _order(shipped), set()
    for b in text_batches(batches):
        ids = b.column(0)
        keep = may_hold(wanted, ids.fill_null(0).to_numpy(zero_copy_only=False)) | ids.is_null().to_numpy(zero_copy_only=False)
        rows = []
        for s in shingle_hashes(b.column(1).take(pa.array(np.flatnonzero(keep)))):
            node = class_of(s)
            if node is not None and node not in seen:
                seen.add(node)
                ranked, count = order.ranked(s)
                rows.append((node, *order.matches(count), ranked.tobytes()))
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["node", "matches", "prefix", "shingles"])


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each array of left has in common with each of right. The numbers in an array are distinct."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    x, y = (np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (left, right))
    both = np.intersect1d(np.unique(x), np.unique(y), assume_unique=True)
    if not len(both):
        return out
    sides = []
    for values, arrays in ((x, left), (y, right)):
        at = np.searchsorted(both, values)
        at[at == len(both)] = 0
        hit = both[at] == values
        col, row = at[hit], np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])[hit]
        by = np.argsort(col, kind="stable")
        sides.append((col[by], row[by]))
    step = 4096
    for low in range(0, len(both), step):
        m = []
        for (col, row), k in zip(sides, (len(left), len(right))):
            i, j = np.searchsorted(col, [low, low + step])
            a = np.zeros((k, min(step, len(both) - low)), dtype=np.float32)
            a[row[i:j], col[i:j] - low] = 1
            m.append(a)
        out += m[0] @ m[1].T
    return out


def _possible(table: pa.Table) -> pa.Table:
    """centre and node of a tile's members that some other member may be similar to, by the bound of the bitmaps.

    Members of a centre of one tile come as groups that such pairs hold together, each with a centre of its own, named by its members:
    documents that meet at many centres are verified once.
    """
    side, node, n = (table.column(c).to_numpy() for c in ("side", "node", "n"))
    raw = [np.frombuffer(x, dtype=np.uint8) for x in table.column("bits").to_pylist()]
    size = np.array([len(x) * 8 for x in raw])
    own = bool((side == 2).any())
    keep, whole, links = np.zeros(len(node), dtype=bool), own and table.column("parts")[0].as_py() == 1, []
    for level in np.unique(size).tolist():  # sizes of similar sets, and so of their bitmaps, are at most one step apart
        rows = np.flatnonzero((size == level) | (size == 2 * level))
        bits = np.stack([raw[i][: level // 8] ^ raw[i][level // 8 :] if len(raw[i]) * 8 > level else raw[i] for i in rows])
        left, right = (np.arange(len(rows)),) * 2 if own else (np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1))
        nn, differ = n[rows], np.zeros((len(left), len(right)), dtype=np.float32)
        for low in range(0, level // 8, 1024):  # some thousand bits at a time, whatever the sets' size
            b = np.unpackbits(bits[:, low : low + 1024], axis=1).astype(np.float32)
            ones = b.sum(axis=1)
            differ += ones[left][:, None] + ones[right] - 2 * (b[left] @ b[right].T)
        both = nn[left][:, None] + nn[right]
        small, large = np.minimum(nn[left][:, None], nn[right]), np.maximum(nn[left][:, None], nn[right])
        ok = (100 * small >= 75 * large) & (175 * (both - differ) >= 150 * both) & (node[rows[left]][:, None] != node[rows[right]])
        ok &= (size[rows[left]] == level)[:, None] | (size[rows[right]] == level)  # pairs of the larger size have their own turn
        keep[rows[left[ok.any(axis=1)]]] = True
        keep[rows[right[ok.any(axis=0)]]] = True
        if whole:
            a, b = np.nonzero(np.triu(ok))
            links.append((rows[left[a]], rows[right[b]]))
    out = table.select(["centre", "node", "n"])
    if whole and keep.any():
        members, roots = local_roots(*(node[np.concatenate(x)] for x in zip(*links)))
        order = np.lexsort((members, roots))
        members, roots = members[order], roots[order]
        edge = np.flatnonzero(np.r_[True, roots[1:] != roots[:-1], True])
        names = [class_of(members[i:j]) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())]
        of = dict(zip(members.tolist(), np.repeat(np.array(names, dtype=np.int64), np.diff(edge)).tolist()))
        out = out.set_column(0, "centre", pa.array([of.get(x, 0) for x in node.tolist()], pa.int64()))
    return out.filter(pa.array(keep))


def _tile(table: pa.Table) -> pa.Table:
    """The links of a tile: side 2 within one chunk, or side 0 against side 1; node and the smallest node it links to."""
    side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
    matches, prefix = table.column("matches").to_numpy(), table.column("prefix").to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
    n = np.array([len(s) for s in sets], dtype=np.int64)
    own = bool((side == 2).any())
    left, right = (np.flatnonzero(side == 2),) * 2 if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    heads = [s[:p] for s, p in zip(sets, prefix.tolist())]
    met = shared_counts([heads[i] for i in left], [heads[i] for i in right])
    small, large = np.minimum(n[left][:, None], n[right]), np.maximum(n[left][:, None], n[right])
    near = (100 * small >= 75 * large) & (met >= np.minimum(matches[left][:, None], matches[right]))
    if own:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))
    a, b = np.nonzero(near)
    links = np.zeros(len(a), dtype=bool)
    if len(a) > 64:
        ra, rb = np.unique(a), np.unique(b)
        common = shared_counts([sets[i] for i in left[ra]], [sets[i] for i in right[rb]])[np.searchsorted(ra, a), np.searchsorted(rb, b)].astype(np.int64)
    else:
        common = np.array([len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True)) for i, j in zip(a, b)], dtype=np.int64)
    links = 100 * common >= 75 * (n[left[a]] + n[right[b]] - common)
    nodes, roots = local_roots(node[left[a[links]]], node[right[b[links]]])
    return pa.table({"node": pa.array(nodes), "root": pa.array(roots)})


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """doc_id, n and node (the class, null without words) of every row; node, id (its rows' smallest) and root of every class."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = written(texts.mapInArrow(_classes, "doc_id long, node long, n long, bits binary, sketch binary"), "ngram-classes")
    rows = first.where("sketch is null").drop("sketch")
    packed = first.where("sketch is not null").select("sketch").coalesce(8).mapInArrow(_summed, "sketch binary").coalesce(1).mapInArrow(_summed, "sketch binary").collect()
    order = spark.sparkContext.broadcast(bytes(packed[0][0]) if packed else None)  # 16 MB at most, whatever the input
    buckets = 4 * partitions(spark)
    dealt = texts.select("text").mapInArrow(lambda it: _prefixes(it, order, buckets, hot), "bucket int, high binary, low binary, node binary, n binary, hot binary")
    stars = dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(_stars, "token long, centre_n long, centre long, node long")
    stars = written(stars, "ngram-stars")
    # the parts of a hot shingle get one centre
    heads = stars.where("token >= 0").groupBy("token").agg(F.min(F.struct("centre_n", "centre")).alias("head"))
    joined = stars.where("token >= 0").join(heads, "token").select(F.col("head.centre").alias("centre"), "node")
    pairs = stars.where("token < 0").select("centre", "node").union(joined).where("centre <> node").distinct()
    pairs = written(pairs.union(pairs.select("centre", F.col("centre").alias("node")).distinct()), "ngram-members")
    p = F.col("part")
    tile = lambda side, x, y: F.struct(F.lit(side).alias("side"), x.cast("int").alias("p1"), y.cast("int").alias("p2"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != p)
    tiles = F.concat(F.array(tile(2, p, p)), F.transform(others, lambda x: F.when(x > p, tile(0, p, x)).otherwise(tile(1, x, p))))

    def tiled(members: DataFrame, each: int) -> DataFrame:
        size = F.greatest(F.count("*") / chunk, F.sum("n") / each)
        parts = members.groupBy("centre").agg(F.ceil(size).cast("int").alias("parts"))
        return members.join(parts, "centre").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select("centre", "node", "parts", F.explode(tiles).alias("t")).select("centre", "node", "parts", "t.*")

    light = rows.join(pairs.select("node").distinct(), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    sized = pairs.join(light.select("node", "n"), "node")
    possible = tiled(sized, 64 * CHUNK_SHINGLES).join(light.drop("doc_id"), "node").groupBy("centre", "p1", "p2").applyInArrow(_possible, "centre long, node long, n long")
    pairs = written(possible.distinct(), "ngram-possible")
    wanted = light.join(pairs.select("node").distinct(), "node").select("doc_id")
    bits = spark.sparkContext.broadcast(bloom(wanted))  # 16 MB at most
    sets = texts.mapInArrow(lambda it: _sets(it, order, bits.value), "node long, matches int, prefix int, shingles binary")
    sets = sets.groupBy("node").agg(*[F.first(c).alias(c) for c in ("matches", "prefix", "shingles")])
    links = tiled(pairs, CHUNK_SHINGLES).join(sets, "node").groupBy("centre", "p1", "p2").applyInArrow(_tile, "node long, root long")
    roots = components(written(links, "ngram-links"))
    named = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("id")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows.select("doc_id", "n", "node"), named


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows, named = near_classes(docs, id_col, text_col, hot, chunk)
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    known = named.join(least, "root").select("node", "component_id")
    out = rows.join(known, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    """The components of all documents linked by 5-word shingles at a Jaccard similarity of 0.75."""
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Brute force in SQL: the share of every two documents that have a shingle in common, components by reach.
ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sized AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
each AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM sized LEFT JOIN low ON low.a = doc_id
"""
