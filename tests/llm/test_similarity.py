"""Embedding links, n-gram components, fingerprints, components and language ID against brute force."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quern.llm import embedding_dedup, fingerprints, language_id, ngram_join
from quern.llm.components import components

NAN, INF = float("nan"), float("inf")


def closed(ids, links):
    """The smallest id reachable from every id."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (-4, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = closed({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.standard_normal(16)
            for _ in range(rng.integers(1, 6)):
                rows.append((n, (base * rng.uniform(0.5, 3) + rng.standard_normal(16) * rng.choice([0.05, 0.25, 0.4])).astype(np.float32).tolist(), label))
                n += 1
    rows += [(n + i, [1.0] + [0.0] * 15, 1) for i in range(30)]  # a hot vector
    n += 30
    odd = [None, [], [0.0] * 16, [NAN] + [1.0] * 15, [INF] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 0.0], [1.0, 0.1], [3.0]]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows + [(None, [1.0] + [0.0] * 15, 1)], "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("clash"))

    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for (a, x, l), (b, y, m) in combinations(rows, 2):
        if l is not None and l == m and good(x) and good(y) and len(x) == len(y):
            x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
            if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93:
                links.append((a, b))
    assert len(links) > 450
    root = closed([r[0] for r in rows], links)
    want = {(i, sum(i in e for e in links), root[i], root[i] == i) for i, _, _ in rows} | {(None, 0, None, True)}
    for chunk in (embedding_dedup.CHUNK, 7):
        assert {tuple(r) for r in embedding_dedup.link_vectors(df, chunk=chunk).collect()} == want
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "A  b\nc d e "]
    for _ in range(14):
        base = [word() for _ in range(rng.randint(20, 90))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, 7)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    return texts + ["x y z " * 9000, "x y z " * 9001, *["hot copy of a text that is long enough"] * 40]


def test_ngram_components_match_brute_force(spark):
    texts = corpus()
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = closed(range(len(texts)), links)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).withColumn("n", F.lit("clash")).withColumn("node", F.lit(1))
    want = {(i, len(sets[i]), root[i]) for i in range(len(texts))}
    assert sum(r != i for i, r in root.items()) > 50
    for hot, chunk in ((ngram_join.HOT, ngram_join.CHUNK), (3, 5)):
        assert {tuple(r) for r in ngram_join.near_components(df, hot=hot, chunk=chunk).collect()} == want
    assert ngram_join.near_components(df.limit(0)).count() == 0


def test_ngram_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (4, "other words are in this one here"), (9, "other words are in this one here"), (None, None)]
    got = sorted(map(tuple, ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 3, 4), (4, 3, 4), (4, 3, 4), (9, 3, 4), (None, 0, None)], key=str)


def test_fingerprints_of_edited_and_next_texts(spark):
    texts = corpus()
    ids = [3 * i for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5).withColumn("bucket", F.lit("clash"))
    got = {r.doc_id: r for r in fingerprints.compare_edited(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[ids[i]]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = shingles(t), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < (1e-9 if len(a | b) <= fingerprints.K else 0.15)
        assert r.fingerprint == got[ids[(i + 1) % len(texts)]].fingerprint or texts[i] != texts[(i + 1) % len(texts)]
    assert fingerprints.compare_edited(df.limit(0)).count() == 0
    one = fingerprints.compare_edited(df.where("doc_id = 30")).first()
    assert one.near_next == 1.0


def test_sketches_merge_and_estimate():
    from quern.llm.shingles import shingle_hashes
    import pyarrow as pa

    rng = random.Random(2)
    a, b = [f"w{rng.randint(0, 10**6)}" for _ in range(4000)], [f"w{rng.randint(0, 10**6)}" for _ in range(2000)]
    x, y, whole = (fingerprints.sketch(h) for h in shingle_hashes(pa.array([" ".join(a[:2500]), " ".join(a[2496:]), " ".join(a)])))
    assert (fingerprints.merged(x, y) == whole).all()
    assert (fingerprints.from_text(fingerprints.to_text(whole)) == whole).all()
    assert abs(fingerprints.distinct_shingles(whole) - 3996) < 1300
    part, both = (fingerprints.sketch(h) for h in shingle_hashes(pa.array([" ".join(b), " ".join(b + a)])))
    assert fingerprints.containment(part, both) > 0.8 and fingerprints.containment(both, part) < 0.6


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs, ~language_id.held_out())
    seen = language_id.identify(docs, model).where(language_id.held_out("row.doc_id")).select("row.lang", "lang_pred", "score").collect()
    assert len(seen) > 200 and np.mean([r.lang == r.lang_pred for r in seen]) > 0.97
    assert all(0 <= r.score <= 1 for r in seen)
    assert language_id.held_out  # and its remainder is that of crc32 of the id as text
    got = docs.select("doc_id", language_id.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    rows = [(1, None, "en", "x"), (2, "12 !? 34", "en", "x"), (3, "", None, "x"), (None, "the words of this and that", "en", "x"), (5, "die Wörter von dem und der " * 3000, "de", "x"), (5, "the words", None, "x")]
    df = spark.createDataFrame(rows, schema)
    model = language_id.train(df, F.lit(True))
    got = language_id.identify(df, model).select("row.doc_id", "lang_pred").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de"), (5, "en")], key=str)
    none = language_id.train(df.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(df, none).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_language_votes_match_brute_force(spark):
    import pyarrow as pa

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    named = docs.withColumn("lang", F.concat(F.when(F.col("doc_id") % 3 == 0, "x").otherwise(""), "lang"))
    model = language_id.train(named, F.lit(True))
    texts = [r.text for r in docs.collect()] + [None, "", "1 2", "a", "é", "ab " * 5000]
    lang, score = model.predict(pa.array(texts))

    def feature(text):
        raw = (" " + text.lower() + " ").encode()
        x = np.zeros(1 << language_id.BITS)
        for i in range(len(raw) - 2):
            code = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
            x[(code * 2654435761 & 0xFFFFFFFF) >> (32 - language_id.BITS)] += 1
        return np.sqrt(x) / np.sqrt(x.sum())

    def judged(node, x):
        names = node.children
        won, total, least = [0] * len(names), [0.0] * len(names), [float("inf")] * len(names)
        for (a, b), w, c in zip(combinations(range(len(names)), 2), node.weights, node.offsets):
            m = float(x @ w.astype(float) + c)
            won[a if m >= 0 else b] += 1
            for k, v in ((a, m), (b, -m)):
                total[k] += v
                least[k] = min(least[k], v)
        best = max(range(len(names)), key=lambda k: (won[k], total[k]))
        sure = 1.0 if len(names) == 1 else 1 / (1 + np.exp(-4 * min(10, max(-10, least[best]))))
        if isinstance(names[best], int):
            lang, also = judged(model.nodes[names[best]], x)
            return lang, sure * also
        return names[best], sure

    assert len({*lang}) > 4 and len(model.nodes) > 2
    for t, found, sure in zip(texts, lang, score):
        want = judged(model.nodes[0], feature(t)) if t and any(c.isalpha() for c in t) else ("und", 0.0)
        assert found == want[0] and abs(sure - want[1]) < 1e-4


def test_many_languages_are_all_learned(spark):
    langs = [f"l{i:03}" for i in range(260)]
    nodes, ways = language_id.tree([*langs, "en", "de", "fr"])
    assert max(map(len, nodes)) <= language_id.FANOUT and {*ways} == {*langs, "en", "de", "fr"}
    for lang, way in ways.items():
        assert nodes[way[-1][0]][way[-1][1]] == lang and way[0][0] == 0
        assert all(nodes[k][c] == way[i + 1][0] for i, (k, c) in enumerate(way[:-1]))
    rows = [(f"{lang} {lang[1:] * 3} word{lang}{k} {lang}{lang}", lang) for lang in langs for k in range(3)]
    df = spark.createDataFrame(rows, "text string, lang string")
    found = language_id.identify(df, language_id.train(df, F.lit(True))).select("row.lang", "lang_pred").collect()
    assert len({r.lang_pred for r in found}) > 200


def test_few_pairs_are_compared():
    rng = np.random.default_rng(7)
    v = rng.standard_normal((1500, 64))
    v[1000:1400] = v[:400] + 0.15 * rng.standard_normal((400, 64))
    y, total, seen = embedding_dedup.rotated(v), 0, np.zeros((1500, 1500), bool)
    for i, j, budget in embedding_dedup.blocks(64, 0.93):
        a, b, compared = embedding_dedup.block_pairs(y[:, i:j], y[:, i:j], budget)
        gap = ((y[:, None, i:j] - y[None, :, i:j]) ** 2).sum(axis=2)
        want = gap <= budget + 1e-9
        got = np.zeros_like(want)
        got[a, b] = True
        assert (got == want).all()
        total += compared
        seen |= got
    assert total < 0.1 * 1500 * 1500  # of all blocks together
    assert seen[v @ v.T / np.linalg.norm(v, axis=1)[:, None] / np.linalg.norm(v, axis=1) >= 0.93].all()
    x, z = rng.standard_normal((30, 5)), rng.standard_normal((17, 5))
    for budget in (0.01, 1.0, 9.0, 100.0):
        a, b, _ = embedding_dedup.block_pairs(x, z, budget)
        assert {*zip(a.tolist(), b.tolist())} == {(i, j) for i in range(30) for j in range(17) if ((x[i] - z[j]) ** 2).sum() <= budget}


def test_members_of_many_centres_are_one_group():
    """Whatever else two documents meet beside, they are verified in one tile; groups that nothing holds together are apart."""
    rng = np.random.default_rng(4)
    sets = {}
    for i in range(6):  # nodes 2i and 2i + 1 are near each other; the last two have sizes beside a power of two
        s = rng.integers(0, 2**63, 300 if i < 5 else 512).astype(np.uint64)
        sets |= {2 * i: s, 2 * i + 1: np.concatenate([s[3:], rng.integers(0, 2**63, 5).astype(np.uint64)])}

    def possible(centre, members, parts=1, side=2):
        rows = [(centre, m, parts, side, 0, 0, len(sets[m]), ngram_join.bitmap(sets[m])) for m in members]
        names = ["centre", "node", "parts", "side", "p1", "p2", "n", "bits"]
        return {(r["centre"], r["node"]) for r in ngram_join._possible(pa.table(dict(zip(names, zip(*rows))))).to_pylist()}

    a, b = possible(100, [0, 1, 2, 3, 10, 11]), possible(101, [0, 1, 4, 6, 10, 11])
    assert {n for _, n in a} == {0, 1, 2, 3, 10, 11} and {n for _, n in b} == {0, 1, 10, 11}
    assert b < a and len({c for c, _ in a}) == 3
    assert possible(100, [0, 1, 4], parts=2) == {(100, 0), (100, 1)} and possible(100, [0, 2, 4]) == set()
