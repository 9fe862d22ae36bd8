"""Token counts, byte-level BPE and token files against the libraries, on odd and random texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import byte_bpe, token_counts, token_files
from quern.llm.shared import PieceCache, Words, shared_path

PARTS = ["a", "b", "'s", "'T", " ", "  ", "\n", "\t", "é", "é", "Σ", "ΑΣ", "İ", "ß", "<|endoftext|>", "<|startoftext|>", "<|", "1", "23", " ", " ", "漢字", "🙂", "\x1c", "\x85", "!!", "don't", "ﬁ", " ", "aaaaaaa", "\r\n", "_", "٣"]
rng = random.Random(4)
TEXTS = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(500)] + [None, "", " ", "x" * 20_000, "ab " * 9000, "ab" * 3000, "same", "same"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("n_tokens", F.lit("clash")).withColumn("ids", F.lit(0))


def name(i):
    return i if i != 3 else None


def test_words_put_together_are_the_texts():
    w = Words(pa.array(TEXTS))
    bounds = w.offsets.tolist()
    assert ["".join(w.distinct[k] for k in w.which[i:j]) for i, j in zip(bounds, bounds[1:])] == [t or "" for t in TEXTS]


def test_counts_are_the_library_s(docs):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {(name(i), len((t or "").encode()), n, n > 100) for i, t in enumerate(TEXTS) for n in [len(lib.encode(t or "", add_special_tokens=False).ids)]}
    assert {tuple(r) for r in token_counts.count_tokens(docs, P.path("word_bpe_49k.json"), limit=100).collect()} == want
    assert token_counts.count_tokens(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_ids_are_the_library_s_and_decode_to_the_texts(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode_texts(docs, path, P.PATTERN)
    want = {name(i): lib.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    back = byte_bpe.decode_ids(encoded, path, P.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {name(i): t or "" for i, t in enumerate(TEXTS)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    both = {(name(i), len(want[name(i)]), sha(np.array(want[name(i)], "<u4").tobytes()), sha((t or "").encode())) for i, t in enumerate(TEXTS)}
    assert {tuple(r) for r in byte_bpe.round_trip(docs, path, P.PATTERN).collect()} == both
    assert byte_bpe.round_trip(docs.limit(0), path, P.PATTERN).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = [str(i * i).encode() for i in range(5000)]
    h = byte_bpe.PerfectHash(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(5000))
    assert (h.slots([b"no", b"-1", b""]) == -1).all()


def test_files_hold_the_library_s_ids(spark, docs):
    lib, path = Tokenizer.from_file(P.path("byte_bpe_50k.json")), shared_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, P.path("byte_bpe_50k.json"), per_bucket=60)
    got = token_files.read_tokens(spark, path).collect()
    want, start = [], 0
    for i in sorted(range(len(TEXTS)), key=lambda i: (name(i) is not None, i)):
        ids = [*lib.encode(TEXTS[i] or "", add_special_tokens=False).ids, 0]
        want.append((name(i), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    shard = spark.read.schema(token_files.SHARD).parquet(path).orderBy(F.desc("n_ids")).first().asDict()
    all_ids = token_files.ids_between(shard, 0, shard["n_ids"])
    for i, j in ((0, 1), (5, 50), (shard["n_ids"] - 3, shard["n_ids"])):
        assert (token_files.ids_between(shard, i, j) == all_ids[i:j]).all()
    empty = shared_path(spark, "test-none")
    token_files.write_tokens(docs.limit(0), empty, P.path("byte_bpe_50k.json"))
    assert token_files.read_tokens(spark, empty).count() == 0


def test_grammar_keeps_runs_and_repeats():
    for ids in ([7] * 101, [1, 2] * 60 + [1], [1, 2, 3, 1, 2, 3, 9] * 30, [5]):
        ids = np.array(ids)
        starts = np.array([0, 10]) if len(ids) > 20 else np.array([0])
        rules, lengths, symbols = token_files.compress(ids, starts, 100)
        assert (token_files.expand(symbols, rules, 100, lengths) == ids).all()
        assert len(symbols) < len(ids) or len(ids) == 1


def test_grammar_leaves_no_frequent_pair():
    draw = np.random.default_rng(1)
    for _ in range(150):
        ids = draw.integers(0, draw.integers(1, 8), draw.integers(1, 3000))
        starts = np.unique(np.r_[0, draw.integers(0, len(ids), 4)])
        rules, lengths, symbols = token_files.compress(ids, starts, 10)
        assert (token_files.expand(symbols, rules, 10, lengths) == ids).all()
        size = [int(lengths[s - 10]) if s >= 10 else 1 for s in symbols.tolist()]
        left, firsts = {}, {*starts.tolist()}
        for a, b, end in zip(symbols.tolist(), symbols.tolist()[1:], np.cumsum(size).tolist()):
            if end not in firsts:
                left[a, b] = left.get((a, b), 0) + 1
        assert all(n < token_files.MIN_COUNT for n in left.values())


def test_files_follow_the_ids(spark):
    rows = spark.range(3000).selectExpr("(id * 7919) % 3000 as doc_id", "concat('word ', id) as text").repartition(7)
    path = shared_path(spark, "test-order")
    token_files.write_tokens(rows, path, P.path("byte_bpe_50k.json"), per_bucket=100)
    shards = spark.read.parquet(path).select(F.input_file_name().alias("file"), "bucket", "seq", "doc_ids").orderBy("file", "bucket", "seq").collect()
    assert len({r.file for r in shards}) > 1 and [i for r in shards for i in r.doc_ids] == [*range(3000)]


def test_cached_pieces_come_back_the_same():
    class Cut(Words):
        def __init__(self, texts):
            super().__init__(pa.array(texts))

    asked = []

    def compute(pieces):
        asked.extend(pieces)
        return np.concatenate([np.frombuffer(p.encode(), np.uint8).astype(np.int32) for p in pieces]), np.array([len(p.encode()) for p in pieces])

    cache = PieceCache(compute, most=300)
    for k in range(40):
        words = Cut([f"w{i} and é{i}, w{i}" for i in range(k * 20, k * 20 + 60)])
        starts, lengths = cache.look_up(words)
        got = [bytes(cache.pool[s : s + n].astype(np.uint8)).decode() for s, n in zip(starts.tolist(), lengths.tolist())]
        assert got == words.distinct
    assert len(asked) < 2 * len({*asked}) and cache.young.n + cache.old.n < 700


def test_repeated_ids_are_documents_of_their_own(spark):
    rows = spark.createDataFrame([(7, "a b c")] * 50 + [(8, "d")], "doc_id long, text string")
    path = shared_path(spark, "test-repeats")
    token_files.write_tokens(rows, path, P.path("byte_bpe_50k.json"), per_bucket=5)
    got = sorted((r.start, r.doc_id) for r in token_files.read_tokens(spark, path, with_ids=False).collect())
    assert [d for _, d in got] == [7] * 50 + [8] and [s for s, _ in got] == [4 * i for i in range(51)]


def test_any_pattern_is_followed(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b  c. d", "x. y, z", "one two. ", None, "né è. q"])], "doc_id long, text string")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    for pattern in (r"[^x]+|x", r"\S+\s*|\s+", P.PATTERN):
        lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        got = {r.doc_id: r.ids for r in byte_bpe.encode_texts(docs, P.path("byte_bpe_multi_50k.tiktoken"), pattern).collect()}
        assert got == {r.doc_id: lib.encode_ordinary(r.text or "") for r in docs.collect()}
    assert P.PATTERN in byte_bpe.SAFE


def test_words_meet_the_library_once_whatever_stands_between_them():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    library, lib = token_files.Library(raw), Tokenizer.from_str(raw.decode())
    first, second = [f"élan{'xyz' * i}" for i in range(40)], [f"Word{'ab' * i}" for i in range(40)]
    texts = [f"{a}.\n{b} {a},*** {b}\n{a}" for a in first for b in second]
    ids, bounds = library.encode(pa.array(texts))
    assert library.cache.young.n < 5 * (len(first) + len(second))  # before: a piece for each pair of words
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_cuts_at_line_ends_keep_the_library_s_ids():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    library, lib, draw = token_files.Library(raw), Tokenizer.from_str(raw.decode()), random.Random(9)
    parts = ["a", "word", "é", "\n", "\n", "\n\n", "\r\n", " ", "  ", "\x85", "\xa0", "\x0b", "\u3000", ".", "***", "%", "'s", "'", "<|endoftext|>", "<|", "٣", "漢", "\u0301", "_", "\x00"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(4000)]
    ids, bounds = library.encode(pa.array(texts))
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_told_apart_whatever_the_vocabulary():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    library, pieces = token_files.Library(raw), [" a", "", " <|endoftext|>b", "x", " né", "\n ", " a b", "<|endoftext|>", " 12", "  y"]
    want = [library.tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
    for widths in (library.widths, library.widths + 1, None):  # wrong widths: nothing fits, so marks tell pieces apart
        library.widths = widths
        values, lengths = library.encode_pieces(pieces)
        ends = np.cumsum(lengths).tolist()
        assert [values[i:j].tolist() for i, j in zip([0, *ends], ends)] == want
