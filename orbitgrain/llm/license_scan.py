"""Licence scan by a positional rare-token index, in DataFrame functions only.

Words of the licence templates are weighted by inverse document frequency over
all files. Each template is indexed under its highest-IDF words. A file's words
that stand in the index are looked up; a hit at word p of a posting at template
word q proposes the template at offset p - q. A proposal stands if the
template's index words agree on the offset, and counts if the template's
mandatory key phrase stands at its place in the file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitgrain.llm import license_texts as texts
from orbitgrain.llm.common import ascii_lower, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels of the base rule.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, words of a licence or of a reference to it, mandatory key phrase in it.
TEMPLATES = (
    ("mit", texts.MIT, "to deal in the software without restriction"),
    ("isc", texts.ISC, "permission to use copy modify and or distribute this software"),
    ("bsd", texts.BSD, "redistribution and use in source and binary forms"),
    ("zlib", texts.ZLIB, "the origin of this software must not be misrepresented"),
    ("apache", texts.APACHE, "apache license"),
    ("gpl", texts.GPL, "gnu general public license"),
    ("mpl", texts.MPL, "mozilla public license"),
    ("unlicense", texts.UNLICENSE, "unencumbered software released into the public domain"),
    ("bsl", texts.BOOST, "documentation covered by this license"),
    ("gpl", "under the terms of the gnu general public license", "gnu general public license"),
    ("gpl", "licensed under the gnu general public license version", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc0", "this work is dedicated to the public domain under cc0", "public domain under cc0"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def inverse_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """IDF over all files of each word of the templates."""
    vocabulary = sorted({w for _, body, _ in templates for w in body.split()})
    found = docs.select(F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary))).alias("w"))
    counted = found.select(F.explode(F.array_append("w", F.lit(""))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    n = {r.w: r.n for r in counted.collect()}  # at most a row for each word of the templates
    return {w: math.log((n.get("", 0) + 1) / (n.get(w, 0) + 1)) for w in vocabulary}


def rare_index(idf: dict[str, float], templates=TEMPLATES, rare: int = 3) -> list[list[tuple[str, int]]]:
    """For each template its ``rare`` highest-IDF words with their places; ties go to the earlier word."""
    out = []
    for _, body, _ in templates:
        words = body.split()
        first = {w: i for i, w in reversed(list(enumerate(words)))}
        out.append(sorted(first.items(), key=lambda x: (-idf[x[0]], x[1]))[:rare])
    return out


def phrase_at(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether the phrase's words stand at word ``at`` and after; false past either end."""
    hit = at >= 0
    for i, w in enumerate(phrase):
        hit = hit & F.coalesce(F.get(words, at + i) == w, F.lit(False))
    return hit


def places_of(words: Column, spots: Column, phrase: list[str]) -> Column:
    return F.filter(spots, lambda p: phrase_at(words, p, phrase))


def scan(docs: DataFrame, idf: dict[str, float], templates=TEMPLATES, rare: int = 3, agree: int = 2) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), see :func:`op3_license_scan`.

    Null text counts as empty: no words, no labels, score 0. Repeated rows are
    scanned each; other columns are ignored.
    """
    index = rare_index(idf, templates, rare)
    postings: dict[str, list[int]] = {}
    for t, entries in enumerate(index):
        for w, q in entries:
            postings.setdefault(w, []).append(q * len(templates) + t)
    anchors = {p.split()[0] for p, _ in BASE}
    lookup = sorted(anchors | set(postings))
    posting_map = F.create_map(*(x for w, ids in sorted(postings.items()) for x in (F.lit(w), F.array(*map(F.lit, ids)))))
    k = len(templates)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    # positions are kept only where an indexed word occurs at all
    some = F.arrays_overlap("words", F.array(*map(F.lit, lookup)))
    none = F.expr("array(cast(null as int))")
    hits = F.filter(F.when(some, F.transform("words", lambda w, i: F.when(w.isin(lookup), i))).otherwise(none), lambda p: p.isNotNull())
    rows = rows.withColumn("hits", hits)
    words, spots = F.col("words"), F.col("hits")

    for i, (phrase, _) in enumerate(BASE):
        rows = rows.withColumn(f"base{i}", places_of(words, spots, phrase.split()))
    places = F.concat(*(F.col(f"base{i}") for i in range(len(BASE))))

    def proposals(p: Column) -> Column:
        ids = F.coalesce(F.try_element_at(posting_map, F.get(words, p)), F.expr("array(cast(null as int))"))
        # (offset, template) as one number; offsets may be negative, hence the shift
        return F.transform(ids, lambda q: (p - F.floor(q / k).cast("long") + 1_000) * k + q % k)

    rows = rows.withColumn("proposed", F.array_distinct(F.filter(F.flatten(F.transform(spots, proposals)), lambda x: x.isNotNull())))

    # of each template: its words, its index words and their places, its key phrase and where that stands
    own, keys = [body.split() for _, body, _ in templates], [key.split() for *_, key in templates]
    starts = [next(i for i in range(len(w)) if w[i : i + len(key)] == key) for w, key in zip(own, keys, strict=True)]
    literal = lambda lists: F.array(*(F.array(*map(F.lit, x)) for x in lists))
    bodies, phrases, first = literal(own), literal(keys), F.array(*map(F.lit, starts))
    rare_words, rare_at = literal([[w for w, _ in e] for e in index]), literal([[q for _, q in e] for e in index])

    def in_place(expected: Column, at) -> Column:
        """How many of the expected words stand where ``at`` puts them."""
        return F.size(F.filter(F.transform(expected, lambda w, q: F.coalesce(F.get(words, at(q)) == w, F.lit(False))), lambda hit: hit))

    def judged(x: Column) -> Column:
        """Share of the template's words in place, 0 unless the index words agree and the key phrase stands."""
        t, offset = (x % k).cast("int"), (F.floor(x / k) - 1_000).cast("int")
        body, phrase, rarest = F.get(bodies, t), F.get(phrases, t), F.get(rare_words, t)
        agreed = in_place(rarest, lambda q: offset + F.get(F.get(rare_at, t), q)) >= F.least(F.lit(agree), F.size(rarest))
        stands = in_place(phrase, lambda q: offset + F.get(first, t) + q) == F.size(phrase)
        return F.when(agreed & stands, in_place(body, lambda q: offset + q) / F.size(body)).otherwise(0.0)

    rows = rows.withColumn("found", F.filter(F.transform("proposed", lambda x: F.struct((x % k).cast("int").alias("t"), judged(x).alias("share"))), lambda s: s["share"] > 0))
    names = F.array(*(F.lit(label) for label, _, _ in templates))
    base_labels = F.filter(F.array(*(F.when(F.size(f"base{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(BASE))), lambda x: x.isNotNull())
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("found", lambda s: F.get(names, s["t"]))))), ",").alias("labels"),
        F.greatest(F.when(F.size(places) > 0, 0.5).otherwise(0.0), F.coalesce(F.array_max(F.transform("found", lambda s: s["share"])), F.lit(0.0))).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of all documents."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, inverse_frequencies(docs))
