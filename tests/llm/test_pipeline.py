"""The pipeline's stages against brute force on a small table with nulls, copies and repeated rows."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import mixing

from .test_similarity import closed, shingles


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = spark.createDataFrame([(5000, None, "en", "src1", 0), (5001, "12 34", "en", None, 5), (5002, "the same words in this text are here", "en", "src1", 5), (5002, "the same words in this text are here", "en", "src1", 5), (None, "a text without an id that stays where it is", None, "src2", 1)], docs.schema)
    docs = docs.unionByName(more).cache()
    (_, first), (_, second), (_, third), (_, last) = corpus_pipeline.STAGES
    one = first(spark, docs, "")
    assert one.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in one.collect()}
    assert gone == {5000, 5001} | {r.doc_id for r in docs.collect() if r.text is not None and not any(c.isalpha() for c in r.text)}
    rows = one.collect()
    two = second(spark, one, "")
    sets = {r.doc_id: shingles(r.text) for r in rows if r.doc_id is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = closed(ids, links)
    kept = sorted((r.doc_id for r in two.collect()), key=str)
    assert two.columns == docs.columns and kept == sorted([*(i for i in ids if root[i] == i), None], key=str)
    three = third(spark, two, "")
    order = [r.doc_id for r in three.collect()]
    assert three.columns == docs.columns and sorted(order, key=str) == kept
    plan = {r.doc_id: (r.slot, r.in_block) for r in mixing.mix_sources(two, mixing.tempered_units(two)).collect()}
    named = [i for i in order if i is not None]
    assert named == sorted(named, key=plan.get) and order[-1] is None
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    four = {tuple(r)[:4] for r in last(spark, three, "").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert four == {(r.doc_id, len(i), sha(np.array(i, "<u4").tobytes()), sha(r.text.encode())) for r in three.collect() for i in [lib.encode_ordinary(r.text)]}


def test_run_goes_through_all_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").cache()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    left = docs.join(got.select("doc_id"), "doc_id", "left_semi")
    plan = {r.doc_id: (r.slot, r.in_block) for r in mixing.mix_sources(left, mixing.tempered_units(left)).collect()}
    order = [r.doc_id for r in got.orderBy("part", "row").collect()]
    assert order == sorted(order, key=plan.get)  # the places of the mix are in the result
    assert got.count() > 100 and got.select(F.count_distinct("doc_id")).first()[0] == got.count()


def test_one_row_stays_of_every_component(spark):
    a, b, c, d = ("one two three four five six seven " + x for x in ("alpha beta", "gamma delta", "eta theta", "iota kappa"))
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(3, b), (4, b), (4, a), (7, near), (7, near + " tail"), (8, near), (None, c), (None, c), (None, c), (None, d), (9, d), (None, " "), (None, " "), (10, " "), (10, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()]
    assert len([x for x in got if x[0] == 7]) == 1 and (8, near) not in got
    assert sorted((x for x in got if x[0] != 7), key=str) == sorted([(3, b), (4, a), (None, c), (9, d), (None, " "), (None, " "), (10, " ")], key=str)


def test_texts_with_letters_stay_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "12 34"), (3, None), (4, "слово")], "doc_id long, text string").selectExpr("doc_id", "text", "cast(null as string) as lang", "'s' as source", "1L as n_chars")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_language(spark, docs, "").collect()) == [1, 4]
