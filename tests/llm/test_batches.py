"""Results don't depend on how rows lie in batches and partitions: thousands of rows in one batch, slices, other partition counts."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import byte_bpe, embedding_dedup, fingerprints, language_id, mixing, ngram_join, sharding, token_counts, token_files, url_filters
from quern.llm.shared import Words, level, shared_path, text_batches
from quern.llm.shingles import shingle_hashes

from .test_similarity import closed, shingles

ROWS = 5500


def texts():
    rng = random.Random(8)
    made = []
    while len(made) < ROWS:
        base = [f"{rng.choice(['The', 'a', 'Über', 'x'])}{rng.randrange(5000)}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.choice([1, 1, 1, 2, 5])):
            w = list(base)
            if w and rng.random() < 0.5:
                w[rng.randrange(len(w))] = "Edited"
            made.append(" ".join(w) if rng.random() < 0.99 else None)
    made = made[:ROWS]
    rng.shuffle(made)
    return made


TEXTS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", "fr")[i % 3], f"src{i % 5}", len(t or "")) for i, t in enumerate(TEXTS)]
    path = shared_path(spark, "test-batches")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def both_ways(docs, query):
    """query's rows from one partition of one batch; the same from many partitions, in another order, and once more."""
    one = docs.coalesce(1)
    assert one.rdd.getNumPartitions() == 1
    first = rows_of(query(one))
    assert rows_of(query(one)) == first
    assert rows_of(query(docs.repartition(24))) == first
    return first


def test_slices_read_as_fresh_arrays():
    whole = pa.array(TEXTS)
    for i, n in ((0, 700), (1024, 1024), (3000, 999), (ROWS - 3, 3)):
        cut, fresh = whole.slice(i, n), pa.array(TEXTS[i : i + n])
        assert level(cut).equals(fresh) and level(cut).offset == 0
        assert all(np.array_equal(a, b) for a, b in zip(shingle_hashes(cut), shingle_hashes(fresh)))
        a, b = Words(cut), Words(fresh)
        assert a.distinct == b.distinct and (a.which == b.which).all() and (a.offsets == b.offsets).all()
    parts = [*text_batches([pa.RecordBatch.from_pydict({"t": whole, "s": pa.array([{"x": t} for t in TEXTS])})])]
    assert all(c.offset == 0 for p in parts for c in p.columns) and sum(p.num_rows for p in parts) == ROWS
    assert [t for p in parts for t in pc.struct_field(p.column(1), "x").to_pylist()] == TEXTS


def test_join_matches_brute_force_in_one_batch(docs):
    sets, holds, links = [shingles(t) for t in TEXTS], defaultdict(list), set()
    for i, s in enumerate(sets):
        met = defaultdict(int)
        for x in s:
            for j in holds[x]:
                met[j] += 1
            holds[x].append(i)
        links |= {(j, i) for j, n in met.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)}
    root = closed(range(ROWS), links)
    assert sum(r != i for i, r in root.items()) > 1000
    assert both_ways(docs, ngram_join.near_components) == sorted(((i, len(sets[i]), root[i]) for i in range(ROWS)), key=str)
    kept = both_ways(docs, lambda d: corpus_pipeline.keep_one_of_each(d.sparkSession, d, "").select("doc_id"))
    assert sorted(i for i, in kept) == [i for i in range(ROWS) if root[i] == i]


def test_fingerprints_of_equal_texts_are_equal(docs):
    found, plain = {}, dict(rows_of(fingerprints.fingerprint(docs.coalesce(1)).select("doc_id", "fingerprint")))
    for r in both_ways(docs, fingerprints.compare_edited):
        assert found.setdefault(TEXTS[r[0]] or "", r[3]) == r[3] == plain[r[0]]
    assert len({*found.values()}) > 1000


def test_tokens_don_t_depend_on_batches(spark, docs):
    both_ways(docs, lambda d: token_counts.count_tokens(d, P.path("word_bpe_49k.json")))
    both_ways(docs, lambda d: byte_bpe.round_trip(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN))

    def files(d):
        path = shared_path(spark, "test-files")
        token_files.write_tokens(d, path, P.path("byte_bpe_50k.json"))
        return token_files.read_tokens(spark, path, with_ids=False)

    both_ways(docs, files)


def test_languages_shards_mixes_urls_don_t_depend_on_batches(docs):
    both_ways(docs, lambda d: language_id.identify(d, language_id.train(d, ~language_id.held_out())).select("row.doc_id", "lang_pred", F.round("score", 9)))
    both_ways(docs, lambda d: sharding.plan_shards(d, 20_000))
    both_ways(docs, lambda d: mixing.mix_sources(d, mixing.tempered_units(d)))
    url = F.concat(F.lit("http://h"), F.col("doc_id") % 50, F.lit(".example.org/"), F.coalesce("text", F.lit("")))
    both_ways(docs.select("doc_id", url.alias("url")), lambda d: url_filters.judge_urls(d, url_filters.RULES, id_col="doc_id"))


def test_vectors_don_t_depend_on_batches(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((900, 12))
    rows = [(i, (base[i % 900] + 0.12 * rng.standard_normal(12)).tolist(), i % 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    got = both_ways(df, embedding_dedup.link_vectors)
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    label = np.array([r[2] for r in rows])
    near = (v @ v.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    assert near.sum() > 3000 and [n for _, n, *_ in sorted(got)] == near.sum(axis=1).tolist()
