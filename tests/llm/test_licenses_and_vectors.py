"""License scans, vector codes and whitening against brute force, and their defined results for odd tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import license_scan as L
from quern.llm import vector_codes as V
from quern.llm import whitening as W

BODY = L.TEMPLATES[1][1]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    w, at, labels = words(text), [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places_equal_brute_force(spark):
    rng = random.Random(3)
    pieces = ["MIT", "mit", "License", "LICENSE", "Apache", "general", "Public", "license", "É", "ß", "K", "ſ", "İ", "x", "9", "日本", "🙂", " "]
    gaps = [" ", "\n", "-", ", ", "", "_", "\x7f", "\x00", "@", "`", "{", " "]
    texts = ["".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [None, "", " ", "MIT", "x " * 60_000 + "mit license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 7):
        got = {r.doc_id: r for r in L.scan_licenses(docs.repartition(parts)).collect()}
        for i, t in enumerate(texts):
            r = got[i]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_spans_by_diagonals(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(["the", "of", "a", "river", "and", "copy", "notice", "house", "to", "any", "rights"]) for _ in range(n))
    w = BODY.split()
    lost, added = [x for i, x in enumerate(w) if i % 17], [y for i, x in enumerate(w) for y in ([x, "extra"] if i % 23 == 5 else [x])]
    texts = {
        "whole": (prose(50) + " " + BODY + " " + prose(50), "mit"),
        "upper": (BODY.upper().replace(" ", "\n"), "mit"),
        "lost": (prose(500) + " " + " ".join(lost), "mit"),
        "added": (" ".join(added) + prose(30), "mit"),
        "half": (prose(9) + " " + " ".join(w[: len(w) // 2]), ""),
        "shuffled": (" ".join(rng.sample(w, len(w))), ""),
        "clean": (prose(3000), ""),
        "short": ("foo. Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        "two": (BODY + " " + prose(20) + " All rights reserved. " + L.TEMPLATES[8][1], "all-rights-reserved,bsd,mit"),
        "gpl": (dict(L.TEMPLATES)["gpl"] + prose(5), "gpl"),
        "agpl": (dict(L.TEMPLATES)["agpl"], "agpl,gpl"),  # it holds the phrase
        "far": ("x " * 40_000 + BODY, "mit"),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts.values())], "doc_id long, text string")
    got = {list(texts)[r.doc_id]: r for r in L.scan_licenses(docs).collect()}
    assert {k: r.labels for k, r in got.items()} == {k: v for k, (_, v) in texts.items()}
    assert got["whole"].score == 1.0 and 0.8 <= got["lost"].score < 1 and got["half"].score < 0.8
    at = got["whole"].spans[0]
    assert (at.label, at.first_word, at.last_word) == ("mit", 50, 49 + len(words(BODY)))
    assert got["far"].spans[0].first_word == 40_000


def test_odd_license_tables(spark):
    rows = [(None, BODY, 1, "a", 2), (5, "the mit license", 1, "a", 2), (5, "the mit license", 1, "a", 2), (5, None, 1, "a", 2), (None, "", 1, "a", 2)] + [(7, BODY, 1, "a", 2)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, ord long, labels string, grams int")
    got = L.scan_licenses(docs).select("doc_id", "labels", "score").collect()
    assert len(got) == 305 and sorted(map(str, got)) == sorted(str(x) for x in got)
    assert sum(r.labels == "mit" for r in got) == 303 and sum(r.score == 0 for r in got) == 2
    assert L.scan_licenses(docs.limit(0)).collect() == []
    assert sum(r.labels == "mit" for r in L.scan_licenses(docs, templates=[]).collect()) == 2
    assert {r.labels for r in L.scan_licenses(docs, phrases={}, templates=[("own", "The MIT license")]).collect()} == {"", "own"}


def codes(rows, parts=4, entries=256, rounds=4):
    """Brute force over Python numbers: rows of (vec_id, vector, label)."""
    kept = [(i, [int(np.floor(1024 * float(c))) for c in v], label) for i, v, label in rows]
    d = len(kept[0][1])
    cut = [d * k // parts for k in range(parts + 1)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[r[1][a:b] for r in first] for a, b in zip(cut, cut[1:])]
    def near(v, book):
        return min((sum((x - y) ** 2 for x, y in zip(v, e)), i) for i, e in enumerate(book))
    for step in range(rounds + 1):
        found = [[near(v[cut[k] : cut[k + 1]], books[k]) for k in range(parts)] for _, v, _ in kept]
        if step < rounds:
            for k in range(parts):
                for e in {f[k][1] for f in found}:
                    own = [v[cut[k] : cut[k + 1]] for (_, v, _), f in zip(kept, found) if f[k][1] == e]
                    books[k][e] = [sum(c) // len(own) for c in zip(*own)]
    error = [sum(x[0] for x in f) for f in found]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{x[1]:02x}" for x in f), e, by[label], sha) for (i, _, label), f, e in zip(kept, found, error)), key=str)


@pytest.mark.parametrize("dim,n", [(8, 700), (64, 300), (10, 40), (3, 300), (1, 20)])
def test_codes_equal_brute_force(spark, dim, n):
    rng = np.random.default_rng(dim)
    v = np.round(rng.standard_normal((n, dim)) * rng.choice([0.01, 1, 30], (n, 1)), 2)
    v[n // 2 :: 3] = v[0]  # ties and repeated rows
    rows = [(int(i), v[i].tolist(), int(i % 3) if i % 4 else None) for i in rng.permutation(n)]
    got = V.code_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == codes(rows)


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    for kind in (10, 1000, 2**25, 2**51):
        for dim in (1, 2, 5, 16, 33):
            v, e = rng.integers(-kind, kind, (400, dim)), rng.integers(-kind, kind, (100, dim))
            e[50:] = v[:50]
            e[::7] = e[1]
            book = V.Codebook(e)
            at, d = book.nearest(v)
            whole = ((v[:, None].astype(object) - e[None].astype(object)) ** 2).sum(axis=2)
            assert (at == np.array([[*r].index(min(r)) for r in whole])).all() and (d == whole.min(axis=1)).all()
    smooth = np.cumsum(rng.integers(-3, 4, (500, 16)), axis=1) + rng.integers(-900, 900, (500, 1))
    book = V.Codebook(smooth[:256])
    book.nearest(smooth)
    assert book.seen < book.pairs / 4  # the bounds filter


def test_odd_vector_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [0.5 * i, -1.0, 2.0, 0.25 * (i % 3)], "a") for i in range(30)] + [(None, [1.0, 1.0, 1.0, 1.0], None), (3, [9.0, 9.0, 9.0, 9.0], None)]
    bad = [(90, None, "a"), (91, [1.0, None, 0.0, 0.0], "a"), (92, [nan, 0.0, 0.0, 0.0], "a"), (93, [0.0, inf, 0.0, 0.0], "a"), (94, [], "a")]
    df = spark.createDataFrame([(*r, 1, 2) for r in good + bad], "vec_id long, embedding array<double>, label string, x int, error int")
    assert sorted(map(tuple, V.code_vectors(df).collect()), key=str) == codes(good)
    ids = lambda rows: sorted({r.vec_id if r.vec_id is not None else -1 for r in rows})
    white = W.whiten(df, W.fit(df)).collect()
    assert ids(white) == [-1, *range(30)] and len(white) == 4 * 32
    assert V.code_vectors(df.limit(0)).collect() == [] and W.whiten(df.limit(0), W.fit(df.limit(0))).collect() == []
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, [1.0]), (4, [1e30, -1e300]), (5, [-0.0, 0.0])], "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    assert ids(V.code_vectors(mixed).collect()) == [1, 2, 3, 4, 5]
    one = [r for r in W.whiten(mixed, W.fit(mixed)).collect() if r.vec_id == 3]
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)]


@pytest.mark.parametrize("dim,n", [(6, 400), (3, 50), (70, 300)])
def test_whitening_equals_brute_force(spark, dim, n):
    rng = np.random.default_rng(dim)
    v = rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim)) * 0.1
    v[n // 3 : n // 2] = v[0]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    rows = W.whiten(df, W.fit(df)).collect()
    x = np.floor(256 * v).astype(np.int64)
    u = np.unique(x, axis=0)
    s, m = u.sum(axis=0), len(u)
    c = (u - s / m).T @ (u - s / m) / m
    values, axes = np.linalg.eigh(c)
    assert len(rows) == n * min(4, dim) and {r.n for r in rows} == {m} and max(r.identity_error for r in rows) < 1e-9
    assert {(r.vec_id, r.deviation) for r in rows} == {(i, int(e)) for i, e in enumerate(((m * x - s) ** 2).sum(axis=1))}
    for k in range(1, min(4, dim) + 1):
        got = np.array([r.whitened for r in sorted((r for r in rows if r.component == k), key=lambda r: r.vec_id)])
        want = (x - s / m) @ axes[:, -k] / np.sqrt(values[-k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert abs(next(r.explained for r in rows if r.component == k) - values[-k] / values.sum()) < 1e-12


def test_deviations_of_large_numbers():
    x = np.array([[2**40, -(2**41)], [3, 4]])
    assert W.deviations(x, 10**9, [7, -5]) == [sum((10**9 * int(c) - s) ** 2 for c, s in zip(r, [7, -5])) for r in x]
