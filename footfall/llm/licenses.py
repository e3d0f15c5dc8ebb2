"""License scans by a positional index of rare words.

Each licence template is a run of words with a mandatory key phrase.  The index holds, for
every template, the three words of its key phrase (two, of short ones) with the highest inverse
document frequency, counted over all documents, with their positions in the template.  A file
looks up its own highest-IDF licence words there; each posting fixes, by relative position,
where the template would begin.  The begins that the postings of the rarest, the second and the
third word give are intersected; what all of them agree on is a candidate.  Of it the key
phrase is verified word by word, and the rest is scored by the IDF of the words that stand
where the template has them.

Any accepted place holds its template's whole key phrase, so none is missed.  Everything is a
DataFrame expression on one row's words; nothing but the counts of the few licence words
is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

#: Label, template and key phrase of further licence texts.
NOTICES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "permission is hereby granted free of charge"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "permission to use copy modify"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution license", "creative commons attribution"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
]
#: Words of each key phrase that the index holds.
POSTINGS = 3
#: A template counts from this share of its words' weight on.
ENOUGH = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key_at: int
    key: tuple[str, ...]
    base: bool


def _template(label: str, text: str, key: str, base: bool) -> Template:
    words, key_words = tuple(text.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i : i + len(key_words)] == key_words)
    return Template(label, words, at, key_words, base)


TEMPLATES = [_template(label, phrase, phrase, True) for label, phrase in BASE]
TEMPLATES += [_template(*notice, False) for notice in NOTICES]
VOCABULARY = sorted({w for t in TEMPLATES for w in t.words})


def _words(docs: DataFrame, key: str, text: str) -> DataFrame:
    low = lower_ascii(F.col(text).cast("string"))
    return docs.select(F.col(key).alias("key"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("words"))


def _strings(words: list[str] | tuple[str, ...]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def word_weights(docs: DataFrame, key: str = "doc_id", text: str = "text") -> dict[str, float]:
    """Inverse document frequency of each licence word, over all documents.

    The counts are of a fixed vocabulary, summed before their shuffle.
    """
    found = _words(docs, key, text).select(F.explode(F.array_intersect("words", _strings(VOCABULARY))).alias("word"))
    counts = {r[0]: r[1] for r in found.groupBy("word").count().collect()}
    documents = docs.count()
    return {w: math.log((documents + 1) / (counts.get(w, 0) + 1)) + 1 for w in VOCABULARY}


def _postings(t: Template, weights: dict[str, float]) -> list[int]:
    """Positions in the template of the ``POSTINGS`` rarest words of its key phrase, rarest first; the first of equals.

    A shorter phrase repeats its rarest word's.
    """
    ranked = sorted(range(len(t.key)), key=lambda i: (-weights[t.key[i]], i))[:POSTINGS]
    ranked += ranked[:1] * (POSTINGS - len(ranked))
    return [t.key_at + i for i in ranked]


def scan(docs: DataFrame, weights: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``n_base`` counts all places of base phrases; the first and last of their word numbers
    are null if there is none.  ``labels`` holds the base ones and those of the templates.
    The score is the highest share of a found template's weight, 0 without any, to six
    digits.  A null or empty text has no word.  Rows are judged one by one: repeats, null
    keys and further columns do no harm.
    """
    index = [_postings(t, weights) for t in TEMPLATES]
    # by rank: the words that templates have there, and their postings
    ranks = [[(t.words[at[r]], i, at[r]) for i, (t, at) in enumerate(zip(TEMPLATES, index))] for r in range(POSTINGS)]
    library = F.array(*[
        F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _strings(t.words).alias("words"),
            F.lit(t.key_at).alias("key_at"), _strings(t.key).alias("key"), F.lit(len(t.key)).alias("key_size"),
            F.array(*[F.lit(weights[w]) for w in t.words]).alias("weights"),
        )
        for t in TEMPLATES
    ])
    words = F.col("words")
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i")))

    def begins(rank: list[tuple[str, int, int]]) -> Column:
        """Where templates begin, as the file's words of this rank have it."""
        rare = sorted({w for w, _, _ in rank})
        postings = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(i).alias("template"), F.lit(at).alias("at")) for w, i, at in rank])
        hits = F.filter(numbered, lambda h: h["word"].isin(rare))
        return F.flatten(F.transform(hits, lambda h: F.transform(
            F.filter(postings, lambda p: p["word"] == h["word"]),
            lambda p: F.struct(p["template"].alias("template"), (h["i"] - p["at"]).alias("start")),
        )))

    # the rarest words first: most files have none, and the others' postings need not be read
    first = F.when(F.arrays_overlap(words, _strings(sorted({w for w, _, _ in ranks[0]}))), begins(ranks[0]))
    agreed = F.col("begins")
    for rank in ranks[1:]:
        agreed = F.array_intersect(agreed, begins(rank))
    agreed = F.when(F.size("begins") > 0, agreed)
    candidates = F.transform("agreed", lambda c: F.struct(F.element_at(library, c["template"] + 1).alias("t"), c["start"].alias("start")))
    key_stands = lambda c: (c["start"] + c["t"]["key_at"] >= 0) & (
        F.slice(words, F.greatest(c["start"] + c["t"]["key_at"], F.lit(0)) + 1, c["t"]["key_size"]) == c["t"]["key"]
    )
    verified = F.filter(candidates, key_stands)
    share = lambda c: F.aggregate(
        F.zip_with(c["t"]["words"], c["t"]["weights"], lambda w, x: F.struct(w.alias("w"), x.alias("x"))),
        F.struct(F.lit(0).alias("j"), F.lit(0.0).alias("met"), F.lit(0.0).alias("all")),
        lambda s, v: F.struct(
            (s["j"] + 1).alias("j"),
            (s["met"] + F.when(F.get(words, c["start"] + s["j"]) == v["w"], v["x"]).otherwise(0.0)).alias("met"),
            (s["all"] + v["x"]).alias("all"),
        ),
        lambda s: F.round(s["met"] / s["all"], 6),
    )
    scored = F.transform(verified, lambda c: F.struct(
        c["t"]["label"].alias("label"), c["t"]["base"].alias("base"), c["start"].alias("start"), share(c).alias("share")
    ))
    found = F.coalesce(F.filter(scored, lambda c: c["share"] >= ENOUGH), F.array())
    rows = _words(docs, key, text).select("key", "words", first.alias("begins")).select("key", "words", agreed.alias("agreed"))
    rows = rows.select("key", F.size("words").cast("long").alias("n_words"), found.alias("found"))
    base = F.filter("found", lambda c: c["base"])
    starts = F.transform(base, lambda c: c["start"].cast("long"))
    joined = lambda part: F.array_join(F.array_sort(F.array_distinct(F.transform(part, lambda c: c["label"]))), ",")
    return rows.select(
        F.col("key").alias(key), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda c: c["share"])), F.lit(0.0)).alias("score"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, word_weights(docs))


def scan_sql(docs: str = "documents") -> str:
    """The same over a table named ``docs``, trying every template at every word of it."""
    quoted = lambda s: "'" + s + "'"
    strings = lambda ws: "[" + ", ".join(map(quoted, ws)) + "]"
    library = ",\n".join(
        f"({i}, '{t.label}', {t.base}, {strings(t.words)}, {t.key_at}, {strings(t.key)})" for i, t in enumerate(TEMPLATES)
    )
    return rf"""
    WITH words AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM {docs}),
    library(id, label, base, tw, key_at, key) AS (VALUES {library}),
    vocabulary AS (SELECT DISTINCT unnest(tw) AS w FROM library),
    counted AS (SELECT w, count(DISTINCT r) AS df FROM (SELECT r, unnest(ws) AS w FROM words) SEMI JOIN vocabulary USING (w) GROUP BY w),
    weights AS (SELECT w, ln(((SELECT count(*) FROM words) + 1)::DOUBLE / (coalesce(df, 0) + 1)) + 1 AS x FROM vocabulary LEFT JOIN counted USING (w)),
    firsts AS (SELECT id, key[1] AS w FROM library),
    places AS (
      SELECT r, id, p - key_at - 1 AS start FROM (SELECT r, ws, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM words)
      JOIN firsts USING (w) JOIN library USING (id) WHERE ws[p:p + len(key) - 1] = key),
    shares AS (
      SELECT r, id, start, any_value(label) AS label, any_value(base) AS base,
        round(sum(CASE WHEN start + j > 0 AND ws[start + j] = tw[j] THEN x ELSE 0 END) / sum(x), 6) AS share
      FROM places JOIN library USING (id) JOIN words USING (r), unnest(range(1, len(tw) + 1)) AS u(j)
      JOIN weights ON weights.w = tw[j] GROUP BY r, id, start),
    found AS (SELECT * FROM shares WHERE share >= {ENOUGH})
    SELECT doc_id, len(ws)::BIGINT AS n_words, (count(*) FILTER (base))::BIGINT AS n_base, min(start) FILTER (base) AS first_word,
      max(start) FILTER (base) AS last_word,
      coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
      coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share IS NOT NULL), '') AS labels,
      coalesce(max(share), 0.0) AS score
    FROM words LEFT JOIN found USING (r) GROUP BY r, doc_id, ws"""
