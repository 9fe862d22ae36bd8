"""License scans by diagonal voting.

Templates are license texts and notices. Every run of GRAM words of a document that are all words of templates is a k-gram,
named by the number that its words' places in the templates' vocabulary make up (a run with any other word is in no template,
so these are all the k-grams that can join). Spark joins them with the templates' k-grams; a hit at word i of a document and word j
of a template votes for the diagonal i - j. Votes are added up by document, template and diagonal; diagonals that lie at most SLIP
apart are one run, as an inserted or lost word moves the rest of a text to the next diagonal. A run with enough votes is a candidate;
its words are compared with the template's, and a span is found if enough of the template's words stand in it in order. Of spans that
overlap, the one with more words stays.

Texts aren't shuffled: a document's words around its hits travel as vocabulary numbers of two bytes. Documents are told apart by a
number given once, in a written table, so that copies and repeated ids are no hot key.

Defined results. Words: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. Null and empty texts: no words, no labels (""),
null first_word and last_word, score 0.0. Repeated ids: each row by itself. Null ids: kept. Empty table: empty result. Other columns
are ignored. score: 1.0 where a base phrase stands; else the share of a template's words found, of the best span or candidate. No
templates: base labels only. Two documents' words never meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import level, text_batches, written

GRAM = 3
#: Diagonals that belong together differ by this much at most from one to the next.
SLIP = 4
#: Share of a template's k-grams that must vote, and of its words that must be found in order.
VOTES, FOUND = 0.4, 0.8
#: k-grams of templates up to which they are broadcast (24 MB); more are joined by sorting.
MOST_BROADCAST = 1 << 20

# Phrases that name a license.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Texts and notices of common licenses, as published.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
]

_BYTE = np.arange(256)
_FOLDED = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_IN_WORD = (_BYTE >= 128) | ((_BYTE >= 48) & (_BYTE <= 57)) | ((_FOLDED >= 97) & (_FOLDED <= 122))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a batch, which of them stands at each place, and the texts' bounds among the places."""
    t = level(pc.fill_null(level(texts).cast(pa.large_string()), ""))
    _, bounds, data = t.buffers()
    off = np.frombuffer(bounds, np.int64)[: len(t) + 1] if bounds else np.zeros(len(t) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[: off[-1]] if data else np.zeros(0, np.uint8)
    inside = np.concatenate([_IN_WORD[raw], [False]])
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[off[:-1]] |= inside[off[:-1]]
    kept = _FOLDED[raw[inside[:-1]]]
    begin = np.flatnonzero(start[:-1][inside[:-1]])
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.r_[begin, len(kept)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept)))
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(start[:-1])])[off]


class Library:
    """Templates as vocabulary numbers. width: words of a k-gram; templates with fewer words are left out."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str] = PHRASES, width: int = GRAM):
        phrase = list(phrases)
        distinct, at, off = words_of(pa.array([t for _, t in templates] + phrase, pa.string()))
        self.vocabulary, self.width = distinct.to_pylist(), width
        if len(self.vocabulary) ** width >= 2**63 or len(self.vocabulary) >= 2**15:
            raise ValueError("the templates have too many distinct words for k-grams of this width to be told apart by a long")
        runs = [at[i:j] for i, j in zip(off[:-1], off[1:])]
        kept = [(label, r) for (label, _), r in zip(templates, runs) if len(r) >= width]
        self.labels, self.words = [label for label, _ in kept], [r.tolist() for _, r in kept]
        self.phrases = [(phrases[p], r) for p, r in zip(phrase, runs[len(templates) :])]
        self.reach = max((len(w) for w in self.words), default=0)
        self.positions = [(int(g), t, j) for t, (_, r) in enumerate(kept) for j, g in enumerate(self.grams(r))]
        self.known = np.unique(np.array([g for g, _, _ in self.positions], dtype=np.int64))

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """The number of the k-gram that begins at each place but the last width - 1; -1 if it holds an unknown word."""
        m = max(0, len(codes) - self.width + 1)
        out, bad = np.zeros(m, np.int64), np.zeros(m, bool)
        for k in range(self.width):
            out = out * len(self.vocabulary) + codes[k : k + m]
            bad |= codes[k : k + m] < 0
        return np.where(bad, -1, out)

    def drift(self, t: int) -> int:
        """How far words of template t may stand from their diagonal."""
        return max(SLIP, len(self.words[t]) // 4)


_SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, grams array<struct<pos: int, gram: bigint>>, pieces array<struct<at: int, codes: binary>>"


def _scan(batches, library: Library):
    """Per document: base phrases, k-grams that templates hold, and the words around them."""
    vocabulary, reach, names = pa.array(library.vocabulary, pa.large_string()), 2 * library.reach + SLIP, [c.split()[0] for c in _SCANNED.split(", ", 6)[:6]]
    for b in text_batches(batches, text=1):
        distinct, at, off = words_of(b.column(1))
        number = pc.fill_null(pc.index_in(distinct, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = number[at] if len(at) else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(b.num_rows), np.diff(off))
        base = []
        for k, (_, phrase) in enumerate(library.phrases):
            m = max(0, len(codes) - len(phrase) + 1)
            hit = doc[:m] == doc[len(phrase) - 1 : len(phrase) - 1 + m]
            for j, c in enumerate(phrase):
                hit &= codes[j : j + m] == c
            base.append((np.flatnonzero(hit), k))
        place = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in base)])
        which = np.concatenate([np.zeros(0, np.int64), *(np.full(len(p), k) for p, k in base)])
        n_base = np.bincount(doc[place], minlength=b.num_rows)
        first, last = np.full(b.num_rows, 1 << 62), np.full(b.num_rows, -1)
        np.minimum.at(first, doc[place], place - off[doc[place]])
        np.maximum.at(last, doc[place], place - off[doc[place]])
        named = [set() for _ in range(b.num_rows)]
        for d, k in {*zip(doc[place].tolist(), which.tolist())}:
            named[d].add(library.phrases[k][0])
        gram = library.grams(codes)
        hit = np.flatnonzero(np.isin(gram, library.known) & (doc[: len(gram)] == doc[library.width - 1 :][: len(gram)]))
        grams, pieces = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
        small = codes.astype("<i2")
        for i in hit.tolist():
            d = int(doc[i])
            grams[d].append({"pos": i - int(off[d]), "gram": int(gram[i])})
        for d in np.unique(doc[hit]).tolist():
            at_d = np.array([g["pos"] for g in grams[d]])
            new = np.flatnonzero(np.r_[True, np.diff(at_d) > 2 * reach])
            for i, j in zip(new.tolist(), [*(new[1:] - 1).tolist(), len(at_d) - 1]):
                low, high = max(0, int(at_d[i]) - reach), min(int(off[d + 1] - off[d]), int(at_d[j]) + library.width + reach)
                pieces[d].append({"at": low, "codes": small[off[d] + low : off[d] + high].tobytes()})
        none = n_base == 0
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.diff(off)), pa.array(n_base.astype(np.int64)), pa.array(first, mask=none), pa.array(last, mask=none), pa.array([sorted(x) for x in named], pa.list_(pa.string())),
             pa.array(grams, pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64())]))), pa.array(pieces, pa.list_(pa.struct([("at", pa.int32()), ("codes", pa.binary())])))],
            [*names, "grams", "pieces"],
        )


def in_order(template: list[int], words: list[int]) -> int:
    """How many of the template's words stand among words in its order: the longest common subsequence, in bits."""
    masks: dict[int, int] = {}
    for i, c in enumerate(template):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(template)) - 1
    open_ = full
    for c in words:
        m = open_ & masks.get(c, 0)
        if m:
            open_ = ((open_ + m) | (open_ - m)) & full
    return len(template) - open_.bit_count()


def candidates(scanned: DataFrame, library: Library) -> DataFrame:
    """ord, template, low, high, diagonals of every run of neighbouring diagonals with enough votes; low to high: words that voted."""
    spark = scanned.sparkSession
    positions = spark.createDataFrame(library.positions, "gram long, template int, j int")
    needed = F.lit([int(np.ceil(VOTES * (len(w) - library.width + 1))) for w in library.words])
    hits = scanned.select("ord", F.explode("grams").alias("g")).select("ord", "g.pos", "g.gram")
    joined = hits.join(F.broadcast(positions) if len(library.positions) <= MOST_BROADCAST else positions, "gram")
    votes = joined.groupBy("ord", "template", (F.col("pos") - F.col("j")).alias("diagonal")).agg(F.count("*").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    w = Window.partitionBy("ord", "template").orderBy("diagonal")  # no more rows than a document has words
    apart = (F.col("diagonal") - F.lag("diagonal").over(w) > SLIP).cast("int")
    runs = votes.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("run", F.sum("apart").over(w))
    found = runs.groupBy("ord", "template", "run").agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"), F.array_sort(F.collect_list("diagonal")).alias("diagonals"))
    enough = found.where(F.col("votes") >= F.get(needed, F.col("template")))
    return enough.select("ord", "template", "low", (F.col("high") + library.width).alias("high"), "diagonals")


def _verified(batches, library: Library):
    """For each document, the spans in which enough of a template's words stand in order, and the best share met."""
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])
    for b in batches:
        spans, best = [], []
        for found, pieces in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            met, most = [], 0.0
            held = [(p["at"], np.frombuffer(p["codes"], "<i2")) for p in pieces]
            for f in found:
                t, drift, words = library.words[f["template"]], library.drift(f["template"]), 0
                at, codes = next((at, c) for at, c in held if at <= f["low"] < at + len(c))
                for d in f["diagonals"]:
                    if words < len(t):
                        words = max(words, in_order(t, codes[max(0, d - drift - at) : d + len(t) + drift - at].tolist()))
                share = words / len(t)
                most = max(most, share)
                if share >= FOUND:
                    met.append((words, share, f["low"], f["high"], library.labels[f["template"]]))
            kept: list[tuple] = []
            for x in sorted(met, key=lambda x: (-x[0], -x[1], x[2], x[4])):
                if all(min(x[3], y[3]) - max(x[2], y[2]) <= 0 for y in kept):
                    kept.append(x)
            spans.append([{"label": x[4], "first_word": x[2], "last_word": x[3] - 1, "share": x[1]} for x in sorted(kept, key=lambda x: x[2])])
            best.append(most)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span)), pa.array(best, pa.float64())], ["ord", "spans", "best"])


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every row.

    templates: pairs of a label and a text. spans: label, first_word, last_word and share of words found, in the text's order.
    """
    library = Library(templates, phrases)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanned = written(slim.mapInArrow(lambda it: _scan(it, library), _SCANNED).withColumn("ord", F.monotonically_increasing_id()), "license-hits")
    spans_type = "array<struct<label: string, first_word: bigint, last_word: bigint, share: double>>"
    if library.words:
        found = candidates(scanned.where(F.size("grams") > 0), library).groupBy("ord").agg(F.collect_list(F.struct("template", "low", "high", "diagonals")).alias("found"))
        rows = found.join(scanned.select("ord", "pieces"), "ord").select("ord", "found", "pieces")
        verified = rows.mapInArrow(lambda it: _verified(it, library), f"ord long, spans {spans_type}, best double")
        out = scanned.drop("grams", "pieces").join(verified, "ord", "left")
    else:
        out = scanned.withColumns({"spans": F.lit(None).cast(spans_type), "best": F.lit(None).cast("double")})
    spans = F.coalesce("spans", F.array().cast(spans_type))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform(spans, lambda s: s["label"]))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), spans.alias("spans"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named or quoted in all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
