"""Licence scan by a positional index of rare words.

Method. A template is a label with its words, of which a key phrase is mandatory. Words are weighted by
inverse document frequency, counted over all texts. For each template the two highest-weighted words of
its key phrase are posted with their places in it. In a text only the places of posted words are looked
up; the starts they imply are intersected, so that both words must stand at the right distance; at the
starts left over the key phrase is verified word by word, and the share of the template's words in
their places decides on the label. Any place of a key phrase has its rarest words in their places, so
none is missed, whatever the weights are.

All steps are expressions on one row: nothing is shuffled but the word counts, and texts without any
posted word are not searched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import computed, lower_ascii

_MATCHES = "array<struct<template: int, start: bigint, in_place: int>>"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str  # lower-case words, blank-separated
    key: str  # the mandatory phrase, a run of the words
    share: float = 1.0  # of the template's words that must be in place
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        size = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + size] == self.key_words)


def _base(label: str, phrase: str) -> Template:
    return Template(label, phrase, phrase, base=True)


# The base phrases, then the wording of common notices and licences.
TEMPLATES = (
    _base("mit", "mit license"),
    _base("apache", "apache license"),
    _base("gpl", "general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "hereby granted free of charge", 0.8),
    Template("apache", "licensed under the apache license version 2 0", "under the apache license version 2 0", 0.8),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license version 3", 0.8),
    Template("lgpl", "gnu lesser general public license", "lesser general public license", 0.8),
    Template("agpl", "gnu affero general public license", "affero general public license", 0.8),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms", 0.8),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license",
             "mozilla public license", 0.2),
    Template("cc", "licensed under cc by nc 4 0", "licensed under cc by", 0.6),
    Template("cc", "licensed under a creative commons attribution license", "creative commons attribution", 0.4),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "unencumbered software released into the public domain", 0.8),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS, -1), "")


def word_weights(docs: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency of the key phrases' words, over all texts."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(F.array_union(found, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    counts = {r.word: r["count"] for r in counted.collect()}  # one row per word of the vocabulary, '' for all texts
    total = counts.get("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}


def _posted(template: Template, weights: dict[str, float]) -> list[tuple[str, int]]:
    """The two highest-weighted words of the key phrase with their places in the template."""
    key = template.key_words
    order = sorted(range(len(key)), key=lambda i: (-weights[key[i]], i))
    return [(key[i], template.key_at + i) for i in order[:2]]


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, matches) of every row; ``matches`` has (template, start, in_place) of each place
    where a template's key phrase stands: ``start`` is the word at which the key phrase starts, from 0.

    Null and empty texts have no words. Repeated rows give repeated rows, equal words in several
    templates give a match for each, an empty table gives an empty result, other columns are not read.
    """
    weights = word_weights(docs, templates, text_col)
    postings = [_posted(t, weights) for t in templates]
    rare = sorted({w for p in postings for w, _ in p})
    rows = computed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words=words_of(F.col("text")))
    places = F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    held = computed(rows.drop("text"), hits=F.filter(places, lambda x: x.w.isin(rare)))

    def starts(word: str, place: int) -> Column:
        return F.transform(F.filter("hits", lambda x: x.w == word), lambda x: x.i - place)

    def matches(number: int, template: Template) -> Column:
        found = starts(*postings[number][0])
        for word, place in postings[number][1:]:
            found = F.array_intersect(found, starts(word, place))
        key = F.array(*map(F.lit, template.key_words))
        at = template.key_at
        # a notice may start before the text does; its key phrase must be inside
        whole = F.filter(found, lambda s: (s >= -at) & (F.slice("words", F.greatest(s + at + 1, F.lit(1)), len(template.key_words)) == key))

        def in_place(s: Column) -> Column:
            # places outside the text give null, which counts as not in place
            return sum(
                (F.coalesce((F.get("words", s + k) == w).cast("int"), F.lit(0)) for k, w in enumerate(template.words)), F.lit(0)
            )

        return F.transform(whole, lambda s: F.struct(
            F.lit(number).alias("template"), (s + at).cast("long").alias("start"), in_place(s).alias("in_place")))

    every = F.flatten(F.array(*[matches(n, t) for n, t in enumerate(templates)])).cast(_MATCHES)
    return held.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.when(F.size("hits") > 0, every).otherwise(F.array().cast(_MATCHES)).alias("matches"),
    )


def labelled(found: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Digest of ``scan``: base places, labels, and as score the best share of a template in place."""
    base = [n for n, t in enumerate(templates) if t.base]
    rows = computed(
        found,
        starts=F.transform(F.filter("matches", lambda m: m.template.isin(base)), lambda m: m.start),
        matches=F.transform("matches", lambda m: F.struct(
            _of(m.template, [t.label for t in templates]).alias("label"),
            (m.in_place / _of(m.template, [len(t.words) for t in templates])).alias("share"),
            _of(m.template, [t.share for t in templates]).alias("least"),
            m.template.isin(base).alias("base"))),
    )
    names = lambda kept: F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("matches", kept), lambda m: m.label))), ",")
    return rows.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        names(lambda m: m.base).alias("base_labels"), names(lambda m: m.base | (m.share >= m.least)).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.share)), F.lit(0.0)).alias("score"),
    )


def _of(number: Column, values: list) -> Column:
    return F.array(*map(F.lit, values))[number]


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The digest in DuckDB SQL: every template is tried at every word."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    parts = []
    for t in templates:
        at, size = t.key_at, len(t.key_words)
        in_place = " + ".join(
            f"CASE WHEN p - {at} + {k} >= 0 AND w[p - {at} + {k} + 1] = '{x}' THEN 1 ELSE 0 END" for k, x in enumerate(t.words)
        )
        parts.append(
            f"SELECT doc_id, p, '{t.label}' AS label, ({in_place}) / {len(t.words)}.0::DOUBLE AS share, {t.share} AS least, {t.base} AS base"
            f" FROM places WHERE word = '{t.key_words[0]}' AND w[p + 1 : p + {size}] = {quoted(t.key_words)}"
        )
    return f"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs WHERE len(w) > 0),
matches AS ({' UNION ALL '.join(parts)}),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(p) FILTER (base) AS first_word, max(p) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR share >= least) AS labels, max(share) AS score
  FROM matches GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN found USING (doc_id)"""
