"""Language ID by hierarchical discrimination.

First the family of a text's language, then, within the family, the language: at every node of this tree, one-versus-one
linear support vector machines vote between its children. A node of more than FANOUT children gets further nodes below it,
of neighbouring names, so the number of machines grows with the number of languages, not with its square. Features: counts
of hashed byte trigrams of the whole lower-cased text, damped by a square root and brought to length one.

Features are computed by Spark's tasks, in batches, for training and prediction alike; a node's machines are trained in
one task, by sub-gradient steps on the hinge loss, over a sample of at most PER_LANGUAGE distinct labelled texts a language
and PER_CHILD a child of a node. Only the trained machines reach the driver. Counts and predictions read all texts.

Defined results. Null text or text without a letter: `und`, score 0. No labelled rows: `und`, score 0 for all. One
language or one family: no vote is needed at that step. Null labels are not learned from. Languages that FAMILIES
doesn't list form the family `other`. Equal votes: the larger sum of margins, then the name. Repeated rows: a row each.
Empty table: empty result. The columns of the input are carried in one struct, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import frugal, give_back, level, partitions, spans, text_batches, written

UND = "und"
#: At most so many labelled texts a language are learned from; at most so many for a child of a node.
PER_LANGUAGE, PER_CHILD = 400, 1600
#: Children of a node at most.
FANOUT = 12
BITS = 13
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn mr gu pa ne ur si",
    "semitic": "ar he am mt",
    "cjk": "zh ja ko",
}
FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}


def features(texts: pa.Array, rows: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's bounds, and the slots and values of its features, one text after another."""
    low = pc.utf8_lower(pc.fill_null(level(texts).cast(pa.large_string()), ""))
    wide = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), low, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    data = np.frombuffer(wide.buffers()[2] or b"", dtype=np.uint8)
    off = np.frombuffer(wide.buffers()[1] or bytes(8), dtype=np.int64)[: len(wide) + 1]
    bounds, slots, values = [np.zeros(1, np.int64)], [], []
    for i in range(0, len(texts), rows):
        n = np.maximum(np.diff(off[i : i + rows + 1]) - 2, 0)
        raw = data[off[i] : off[min(i + rows, len(texts))]].astype(np.uint32)
        at = spans(off[i : i + len(n)] - off[i], n)
        code = (raw[at] << np.uint32(16)) | (raw[at + 1] << np.uint32(8)) | raw[at + 2]
        slot = ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
        count = np.bincount(np.repeat(np.arange(len(n)) << BITS, n) + slot, minlength=len(n) << BITS)
        held = np.flatnonzero(count)
        many = count[held].astype(np.float64)
        ends = np.searchsorted(held, np.arange(1, len(n) + 1) << BITS)
        bounds.append(bounds[-1][-1] + ends)
        slots.append((held & ((1 << BITS) - 1)).astype(np.uint16))
        values.append((np.sqrt(many) / np.sqrt(np.maximum(n, 1))[held >> BITS]).astype(np.float32))
    return np.concatenate(bounds), np.concatenate([np.zeros(0, np.uint16), *slots]), np.concatenate([np.zeros(0, np.float32), *values])


def _machine(plus: np.ndarray, minus: np.ndarray, rounds: int = 30, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine; both sides weigh alike. Steps in a fixed order."""
    x = np.concatenate([plus, minus])
    y = np.concatenate([np.ones(len(plus)), -np.ones(len(minus))])
    weight = np.where(y > 0, 0.5 / len(plus), 0.5 / len(minus)) * len(y)
    w, c, t = np.zeros(x.shape[1]), 0.0, 0
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            t += 1
            step = 1 / (decay * (t + 1 / (decay * 5)))
            short = at[y[at] * (x[at] @ w + c) < 1]
            pull = weight[short] * y[short] / len(at)
            w *= 1 - step * decay
            w += step * (pull @ x[short])
            c += 0.1 * step * pull.sum()
    return w.astype(np.float32), float(c)


@dataclass
class Node:
    """A vote between children: languages, or the numbers of nodes below. A machine for every two of them, in order."""

    children: list[str | int]
    weights: np.ndarray
    offsets: np.ndarray

    def winners(self, bounds: np.ndarray, slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every text (none without features), the child with the most wins, and a confidence of 0 to 1 from its narrowest duel."""
        rows, n = len(bounds) - 1, len(self.children)
        if n == 1:
            return np.zeros(rows, np.int64), np.ones(rows)
        wins, total, least = np.zeros((rows, n)), np.zeros((rows, n)), np.full((rows, n), np.inf)
        for (a, b), w, c in zip(combinations(range(n), 2), self.weights, self.offsets.tolist()):
            margin = np.add.reduceat(values * w[slots].astype(np.float64), bounds[:-1]) + c
            for side, m, won in ((a, margin, margin >= 0), (b, -margin, margin < 0)):
                wins[:, side] += won
                total[:, side] += m
                least[:, side] = np.minimum(least[:, side], m)
        best = np.where(wins == wins.max(axis=1, keepdims=True), total, -np.inf).argmax(axis=1)
        return best, 1 / (1 + np.exp(-4 * np.clip(least[np.arange(rows), best], -10, 10)))


@dataclass
class LanguageModel:
    """The tree's nodes, the root first and every node before those below it. Without nodes, nothing has been learned."""

    nodes: list[Node]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of every text and its score."""
        lang, score = [UND] * len(texts), np.zeros(len(texts))
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(letters)
        if not self.nodes or not len(at):
            return lang, score
        bounds, slots, values = features(texts.take(pa.array(at)))
        size, score[at] = np.diff(bounds), 1.0
        waiting = {0: np.arange(len(at))}
        for k, node in enumerate(self.nodes):
            rows = waiting.pop(k, None)
            if rows is None:
                continue
            use = spans(bounds[rows], size[rows])
            best, sure = node.winners(np.concatenate([[0], np.cumsum(size[rows])]), slots[use], values[use])
            score[at[rows]] *= sure
            for i, child in enumerate(node.children):
                mine = rows[best == i]
                if isinstance(child, int) and len(mine):
                    waiting[child] = mine
                elif len(mine):
                    for r in at[mine].tolist():
                        lang[r] = child
        return lang, score


def tree(languages: list[str], fanout: int = FANOUT) -> tuple[list[list[str | int]], dict[str, list[tuple[int, int]]]]:
    """The children of every node, and each language's way: the nodes from the root and the child taken at each."""
    families: dict[str, list[str]] = {}
    for lang in sorted(languages):
        families.setdefault(FAMILY.get(lang.lower().split("-")[0], "other"), []).append(lang)
    nodes: list[list[str | int]] = []
    ways: dict[str, list[tuple[int, int]]] = {lang: [] for lang in languages}

    def grow(parts: list[list[str]], before: list[tuple[int, int]]) -> int:
        """A node over parts (lists of languages); returns its number."""
        own = len(nodes)
        nodes.append([])
        step = 1
        while -(-len(parts) // step) > fanout:
            step *= fanout
        for i in range(0, len(parts), step):
            group = parts[i : i + step]
            way = [*before, (own, len(nodes[own]))]
            nodes[own].append("")
            if len(group) == 1 and len(group[0]) == 1:
                nodes[own][-1] = group[0][0]
                ways[group[0][0]] = way
            else:
                nodes[own][-1] = grow(group if len(group) > 1 else [[lang] for lang in group[0]], way)
        return own

    if languages:
        grow([families[f] for f in sorted(families)], [])
    return nodes, ways


def _trained(table: pa.Table) -> pa.Table:
    """The machine between two children of a node, from their samples: node, a, b, child, draw, lang, slots, values."""
    table = table.sort_by([("child", "ascending"), ("draw", "ascending"), ("lang", "ascending")])
    child = table.column("child").to_numpy()
    slots, values = table.column("slots").to_pylist(), table.column("values").to_pylist()

    def dense(k: int) -> np.ndarray:
        at = np.flatnonzero(child == k)
        x = np.zeros((len(at), 1 << BITS), dtype=np.float32)
        for row, i in zip(x, at.tolist()):
            row[np.frombuffer(slots[i], np.uint16)] = np.frombuffer(values[i], np.float32)
        return x

    node, a, b = (table.column(c)[0].as_py() for c in ("node", "a", "b"))
    weights, offset = _machine(dense(a), dense(b))
    give_back()
    return pa.table({"node": pa.array([node], pa.int32()), "a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()), "weights": pa.array([weights.tobytes()], pa.binary()), "offset": pa.array([offset])})


@frugal
def _featured(batches):
    for b in text_batches(batches):
        bounds, slots, values = features(b.column(2))
        cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), cut(slots), cut(values)], ["lang", "draw", "slots", "values"])


def train(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """A model from the rows where learn_from holds and neither text nor label is null.

    The sample holds those distinct texts of each language whose hashes are smallest: one pass counts every language's
    distinct texts, the next takes the texts below a threshold on the hash; copies are one before any ranking.
    """
    spark = docs.sparkSession
    labelled = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("draw"), F.col(text_col).alias("text"))
    counts = written(labelled.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")), "language-counts")
    nodes, ways = tree([r.lang for r in counts.select("lang").collect()])
    if not nodes:
        return LanguageModel([])
    share = F.least(F.lit(1.0), (2.0 * per_language + 60) / F.greatest(F.col("n"), F.lit(1)))
    low = labelled.join(counts, "lang").where((F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30))) < share)
    one = low.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = one.withColumn("k", rank).where(F.col("k") <= per_language).select("lang", "draw", "text")
    steps = spark.createDataFrame([(lang, k, c) for lang, way in ways.items() for k, c in way], "lang string, node int, child int")
    sample = written(sample.mapInArrow(_featured, "lang string, draw long, slots binary, values binary"), "language-sample")
    rank = F.row_number().over(Window.partitionBy("node", "child").orderBy("draw", "lang"))
    dealt = sample.join(steps, "lang").withColumn("k", rank).where(F.col("k") <= PER_CHILD).drop("k")
    # every machine is a group of its own: a sample goes to the duels of its child, 11 at most
    pairs = spark.createDataFrame([(k, a, b, c) for k, children in enumerate(nodes) for a, b in combinations(range(len(children)), 2) for c in (a, b)], "node int, a int, b int, child int")
    dealt = dealt.join(pairs, ["node", "child"]).repartition(partitions(spark), "node", "a", "b")
    made = {(r.node, r.a, r.b): r for r in dealt.groupBy("node", "a", "b").applyInArrow(_trained, "node int, a int, b int, weights binary, offset double").collect()}
    out = []
    for k, children in enumerate(nodes):
        own = [made[k, a, b] for a, b in combinations(range(len(children)), 2)]
        weights = np.frombuffer(b"".join(bytes(m.weights) for m in own), np.float32).reshape(len(own), 1 << BITS)
        out.append(Node(children, weights, np.array([m.offset for m in own])))
    return LanguageModel(out)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """row (a struct of docs' columns), lang_pred and score of every row; only the text is looked at."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # some six machines of 32 KB a language
    framed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches):
        known = shipped.value
        for b in text_batches(batches, 512):
            lang, score = known.predict(pc.struct_field(b.column(0), text_col))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return framed.mapInArrow(frugal(run), framed.selectExpr("row", "cast(null as string) as lang_pred", "cast(null as double) as score").schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """The predicted language of every document; learned from those that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out())
    return identify(docs.select("doc_id", "text"), model).select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
