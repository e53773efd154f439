"""Licence statements by TF-IDF cosine to templates, inherited from the nearest directory above; DataFrame operations only.

Templates are short notices and the opening sentences of licences' own texts. Terms are runs of a-z and 0-9 after
lower-casing; a term's IDF counts the corpus's lines. Every line of a whole text is compared with every template, and so
are spans of a text about as long as a template, wherever lines end: a notice beside other words, at the end of a line of
prose or wrapped over lines states its licence too. Both are scored alike: a word that is not the template's weighs as
much as one of its words on average, so that the same words have the same score in a corpus of any size.

A passage states a licence only with the words that name it, its version among them, and without words that name
another one of its family: another version, or a licence that has no template, is not taken for the nearest one. Texts
without such words are not compared at all.

``licenses`` has every licence that a document states, by name; null if it states none. ``license`` is that of its best
passage. A document that states none takes the licence of its directory, or of the nearest directory above that has one.
A directory's licence is that of its licence file: the stating document right in it with the smallest id, or, where
documents lie only in its subdirectories, the one below it with the smallest id.

Cases: null and empty texts state nothing; long texts are searched whole; a null path is the empty directory; rows that
repeat a ``doc_id`` and path are one document, judged by all their passages; null ids are one document of their directory;
ties between templates go to the first name; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.llm.columns import settle
from ledgerkit.llm.scratch import stored

#: Short public licence notices, by licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, Version 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: First sentences of licences' own texts.
OPENINGS = {
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files.",
}
THRESHOLD = 0.75
#: Words that a passage must have to state a template's licence, and words it must not have. A licence's
#: own text follows the notice, after a ``#``.
NAMING = {
    "Apache-2.0": "apache 2", "BSD-3-Clause": "bsd 3", "CC-BY-4.0": "attribution 4", "CC-BY-NC-4.0": "nc 4",
    "CC-BY-SA-4.0": "sa 4", "GPL-3.0": "gnu general 3", "ISC": "isc license", "LGPL-3.0": "lesser 3", "MIT": "mit license",
    "MPL-2.0": "mozilla 2", "Proprietary": "reserved rights", "Unlicense": "unencumbered", "BSD-3-Clause#": "endorse neither",
    "ISC#": "hereby distribute fee", "MIT#": "hereby charge obtaining",
}
OTHERS = {
    "CC-BY-4.0": "nc nd sa noncommercial noderivatives noderivs sharealike", "CC-BY-NC-4.0": "nd sa noderivatives sharealike",
    "CC-BY-SA-4.0": "nc nd noncommercial", "GPL-3.0": "affero lesser library", "LGPL-3.0": "affero", "Apache-2.0": "1",
    "BSD-3-Clause": "2 4", "MPL-2.0": "1",
}
#: Words that a longer span may have between a passage's own.
EXTRA = 3


def terms_of(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def template_terms(templates: dict[str, str]) -> dict[str, Counter]:
    words = {name: "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()) for name, text in templates.items()}
    return {name: Counter(text.split()) for name, text in words.items()}


class Passage(NamedTuple):
    """A template: its licence, terms with their numbers and squared IDF, words it needs and words that rule it out."""

    license: str
    place: int
    size: int
    square: float
    must: list[str]
    never: list[str]
    words: list[dict[str, str | float]]


def passages_of(counts: dict[str, Counter], idf: dict[str, float]) -> list[Passage]:
    out = []
    for place, (name, c) in enumerate(sorted(counts.items())):
        must = NAMING.get(name, "").split()
        if not must or not set(must) <= set(c):
            must = [max(c, key=lambda w: (idf[w], w))]
        words = [{"w": w, "n": float(n), "q": idf[w] ** 2} for w, n in c.items()]
        square = sum((n * idf[w]) ** 2 for w, n in c.items())
        out.append(Passage(name.rstrip("#"), place, sum(c.values()), square, must, OTHERS.get(name, "").split(), words))
    return out


def _held(terms: Column, passage: Column) -> Column:
    return F.forall(passage.must, lambda w: F.array_contains(terms, w))


def _named(terms: Column, passage: Column) -> Column:
    return _held(terms, passage) & ~F.exists(passage.never, lambda w: F.array_contains(terms, w))


def _scored(terms: Column, passage: Column, *where: Column) -> Column:
    """The cosine of ``terms`` with the passage's, 0 without its naming words; the passage's place, its licence, ``where``.

    A word that is not the passage's weighs as much as one of its words on average, however large the corpus is: with k
    such words, a passage of n words scores 1 / sqrt(1 + k / n).
    """
    tf = F.transform(passage.words, lambda w: F.struct(F.size(F.filter(terms, lambda x: x == w.w)).alias("k"), w.n.alias("n"), w.q.alias("q")))
    zero = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("own"), F.lit(0).alias("k"))
    cosine = F.aggregate(
        tf,
        zero,
        lambda s, t: F.struct(
            (s.dot + t.k * t.n * t.q).alias("dot"), (s.own + t.k * t.k * t.q).alias("own"), (s.k + t.k).alias("k")
        ),
        lambda s: s.dot / F.sqrt((s.own + (F.size(terms) - s.k) * (passage.square / passage.size)) * passage.square),
    )
    return F.struct(
        F.when(_named(terms, passage), cosine).otherwise(0.0).alias("score"), (-passage.place).alias("order"),
        passage.license.alias("license"), *where,
    )


def _spans(terms: Column, passage: Column) -> Column:
    """For each place in ``terms`` of the passage's first naming word, the best span around it."""
    at = F.filter(F.transform(terms, lambda x, i: F.when(x == passage.must[0], i + 1)), lambda i: i.isNotNull())

    def span(begin: Column, length: Column) -> Column:
        return _scored(F.slice(terms, begin, length), passage, begin.alias("begin"), (begin + length - 1).alias("end"))

    def best(i: Column) -> Column:
        lengths = F.sequence(passage.size, passage.size + EXTRA)
        begins = lambda m: F.sequence(F.greatest(i - (m - 1), F.lit(1)), i)
        return F.array_max(F.flatten(F.transform(lengths, lambda m: F.transform(begins(m), lambda b: span(b, m)))))

    return F.transform(at, best)


def span_statements(docs: DataFrame, passages: list[Passage], threshold: float) -> DataFrame:
    """(doc_id, path, score, order, license): all licences that spans of whole texts state, wherever lines end.

    Where spans overlap only the best one states; ties go to the first name.
    """
    low = F.lower("text")
    any_named = F.lit(False)
    for passage in passages:  # as parts of words first, which is cheap
        any_named |= reduce(Column.__and__, (low.contains(w) for w in passage.must))
    terms = F.col("terms")
    rows = docs.filter(any_named).select("doc_id", "path", terms_of(F.col("text")).alias("terms"))
    compared = F.filter(_literal(passages), lambda p: _held(terms, p))
    spans = F.flatten(F.transform(compared, lambda p: _spans(terms, p)))
    rows = rows.select("doc_id", "path", F.filter(spans, lambda x: x.score >= threshold).alias("spans"))
    spans = F.reverse(F.array_sort("spans"))
    kept = F.aggregate(
        spans,
        F.filter(spans, lambda x: F.lit(False)),
        lambda kept, x: F.when(F.exists(kept, lambda y: (y.begin <= x.end) & (x.begin <= y.end)), kept).otherwise(F.concat(kept, F.array(x))),
    )
    rows = rows.select("doc_id", "path", F.explode(kept).alias("x"))
    return rows.select("doc_id", "path", "x.score", "x.order", "x.license")


def line_statements(lines: DataFrame, passages: list[Passage], threshold: float) -> DataFrame:
    """(doc_id, path, score, order, license): all licences that whole lines (doc_id, path, terms) state."""
    firsts = F.array(*(F.lit(w) for w in sorted({p.must[0] for p in passages})))
    terms = F.col("terms")
    compared = F.filter(_literal(passages), lambda p: _named(terms, p))
    rows = lines.filter(F.arrays_overlap("terms", firsts))
    rows = rows.select("doc_id", "path", F.inline(F.transform(compared, lambda p: _scored(terms, p))))
    return rows.filter(F.col("score") >= threshold)


def _literal(passages: list[Passage]) -> Column:
    """All passages as one constant array, so that what is done with each stands in the plan once."""

    def listed(values: list[str] | list[float]) -> Column:
        return F.split(F.lit(" ".join(map(str, values))), " ") if values else F.array().cast("array<string>")

    def of(p: Passage) -> Column:
        columns = [listed([w[k] for w in p.words]) for k in ("w", "n", "q")]
        words = F.arrays_zip(*columns).cast("array<struct<w:string,n:double,q:double>>")
        parts = p._asdict() | {"must": listed(p.must), "never": listed(p.never), "words": words}
        return F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in parts.items()))

    return F.array(*map(of, passages))


def statements(docs: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """(doc_id, path, license, score, licenses): each document's best passage and all licences that it states."""
    counts = template_terms(templates)
    vocabulary = sorted({w for c in counts.values() for w in c})
    lines = docs.select("doc_id", "path", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("doc_id", "path", terms_of(F.col("line")).alias("terms")).filter(F.size("terms") > 0)
    known = F.array_intersect("terms", F.array(*map(F.lit, vocabulary)))
    often = lines.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("term")).groupBy("term").count()
    often = dict(often.collect())  # the templates' terms, and all lines as the empty term
    n = often.get("", 0)
    idf = {w: math.log((n + 1) / (often.get(w, 0) + 1)) + 1 for w in vocabulary}
    passages = passages_of(counts, idf)
    every = line_statements(lines, passages, threshold).unionByName(span_statements(docs, passages, threshold))
    best = F.max(F.struct("score", "order", "license"))
    every = every.groupBy("doc_id", "path").agg(best.alias("best"), F.array_sort(F.collect_set("license")).alias("licenses"))
    return every.select("doc_id", "path", "best.license", "best.score", "licenses")


def directory(path: Column) -> Column:
    """``path`` without its last part."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")


def above(path: Column) -> Column:
    """The directory itself and those above it, the empty root last."""
    parts = F.split(path, "/")
    every = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(F.reverse(every))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, license, score, inherited_from, licenses) per document of ``docs`` (doc_id, path, text)."""
    if templates is None:
        templates = TEMPLATES | {f"{name}#": text for name, text in OPENINGS.items()}
    files = settle(docs, ["doc_id", "path", "text"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.col("text").cast("string").alias("text"),
    )
    found = stored(statements(files, templates, threshold), "statements")

    # licence files: right in a directory first (depth 0), else from below
    stating = found.select("doc_id", "license", directory(F.col("path")).alias("own"))
    first = stating.groupBy("own").agg(F.min(F.struct("doc_id", "license")).alias("file"))
    up = first.select("file", "own", F.explode(above(F.col("own"))).alias("dir"))
    indirect = F.col("dir") != F.col("own")
    holders = up.groupBy("dir").agg(F.min(F.struct(indirect.alias("indirect"), "file.doc_id", "file.license")).alias("file"))
    holders = holders.select(F.col("dir").alias("of"), "file.license")

    names = files.select("doc_id", "path").distinct().withColumn("dir", directory(F.col("path")))
    wanted = names.select("dir").distinct().select("dir", F.posexplode(above(F.col("dir"))).alias("steps", "of"))
    nearest = wanted.join(holders, "of").groupBy("dir").agg(F.min(F.struct("steps", "license", "of")).alias("given"))

    stated = found.select(F.col("doc_id").alias("d"), F.col("path").alias("p"), F.col("license").alias("own"), "score", "licenses")
    rows = names.join(stated, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("path") == F.col("p")), "left")
    rows = rows.join(nearest, "dir", "left")
    return rows.select(
        "doc_id", "path", F.coalesce("own", "given.license").alias("license"), "score",
        F.when(F.col("own").isNull(), F.col("given.of")).alias("inherited_from"), "licenses",
    )
