"""License scan by a positional rare-token index, in DataFrame operations only.

The index holds, for every template, its words with their positions. A
template's anchors are the two words of its first mandatory phrase that are
rarest over all documents (highest IDF). In a file, the positions of anchor
words are looked up; each one proposes a start for every template that has the
word (file position - template position), and only starts proposed by both
anchors are looked at further. There the mandatory phrases must stand word for
word. A phrase holds its anchors, so no place is missed; the IDF only decides
which words are looked up. The index and the lists of places of one file are
columns of that file's row: there is no shuffle besides the count of template
words over the corpus.

Defined cases: null text is the empty text (no words, no labels, score 0); ids
play no part, so null or repeated ones are rows like others; an empty table
gives no rows; other columns take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``phrases`` are mandatory and stand in ``text``; ``base``: every place counts as a base place."""
    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def spans(self) -> list[tuple[int, list[str]]]:
        """(place in the template, words) of each mandatory phrase."""
        words = self.words
        return [(next(i for i in range(len(words)) if words[i:i + len(p)] == p), p)
                for p in (phrase.split() for phrase in self.phrases)]


def _phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, (text,), base)


# The base phrases, then sentences of common licences
TEMPLATES = (
    _phrase("mit", "under the mit license", True),
    _phrase("apache-2", "apache license version 2", True),
    _phrase("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                         "compliance with the license", ("you may not use this file except in compliance",)),
    Template("gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    Template("lgpl", "licensed under the gnu lesser general public license version", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license version", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "are permitted provided that")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
                    "is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
)


def words_of(text: Column) -> Column:
    """A-Z in lower case; runs of lower case letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BREAKS), "")


def word_idf(rows: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of the template words over all rows (column ``words``); a row per template word comes back."""
    found = rows.select(F.explode(F.array_intersect("words", F.lit(vocabulary))).alias("word"))
    df = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    n = rows.count()
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in vocabulary}


def anchors(template: Template, idf: dict[str, float]) -> list[tuple[int, str]]:
    """(place, word) of the two rarest words of the first mandatory phrase."""
    at, phrase = template.spans()[0]
    order = sorted(range(len(phrase)), key=lambda i: (-idf[phrase[i]], i))
    return [(at + i, phrase[i]) for i in order[:2]]


def _proposals(place: int, word: str) -> Column:
    return F.transform(F.filter("hits", lambda h: h["w"] == word), lambda h: h["i"] - place)


def _starts(template: Template, chosen: list[tuple[int, str]]) -> Column:
    """Starts of the template in the file that all anchors propose and all mandatory phrases confirm."""
    proposed = None
    for place, word in chosen:
        mine = _proposals(place, word)
        proposed = F.array_distinct(mine) if proposed is None else F.array_intersect(proposed, mine)

    def confirmed(s: Column) -> Column:
        ok = F.lit(True)
        for at, phrase in template.spans():
            # (a slice may not begin before the first word)
            here = F.when(s + at >= 0, F.slice("words", F.greatest(s + at + 1, F.lit(1)), len(phrase)))
            ok = ok & F.coalesce(here == F.lit(phrase), F.lit(False))
        return ok
    return F.filter(proposed, confirmed)


def _share(template: Template, starts: Column) -> Column:
    """Largest share of the template's words that stand at their places."""
    words = template.words
    if template.phrases == (template.text,):
        return F.when(F.size(starts) > 0, 1.0).otherwise(0.0)

    def share(s: Column) -> Column:
        return sum((F.coalesce((F.get("words", s + k) == w).cast("int"), F.lit(0)) for k, w in enumerate(words)),
                   F.lit(0)) / F.lit(float(len(words)))
    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row ``doc_id, n_words, places, scores``: ``places`` has, in template
    order, the starts of each template found in the file; ``scores`` its share."""
    rows = id_text(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.words})
    idf = word_idf(rows, vocabulary)
    chosen = [anchors(t, idf) for t in templates]
    looked_up = F.lit(sorted({w for c in chosen for _, w in c}))
    spots = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                     lambda h: F.array_contains(looked_up, h["w"]))
    rows = rows.withColumn("hits", F.when(F.arrays_overlap("words", looked_up), spots))
    none = F.lit([]).cast("array<int>")
    found = rows.withColumn("places", F.when(F.col("hits").isNull(), F.array(*[none] * len(templates))).otherwise(
        F.array(*[_starts(t, c) for t, c in zip(templates, chosen)])))
    shares = F.when(F.col("hits").isNull(), F.array(*[F.lit(0.0)] * len(templates))).otherwise(
        F.array(*[_share(t, F.col("places")[k]) for k, t in enumerate(templates)]))
    return found.select("doc_id", F.size("words").cast("long").alias("n_words"), "places", shares.alias("scores"))


def summary(found: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Base places and labels of ``scan``'s rows."""
    def labels(which) -> Column:
        named = [F.when(F.size(F.col("places")[k]) > 0, F.lit(t.label)) for k, t in enumerate(templates) if which(t)]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))), ",")

    base = F.flatten(F.array(*[F.col("places")[k] for k, t in enumerate(templates) if t.base]))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).cast("long").alias("first_word"),
        F.array_max(base).cast("long").alias("last_word"), labels(lambda t: t.base).alias("base_labels"),
        labels(lambda t: True).alias("labels"), F.array_max("scores").alias("score"))


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same result in plain SQL: every phrase tried at every word."""
    def quoted(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    places, shares = [], []
    for k, t in enumerate(templates):
        (at, first), *others = t.spans()
        rest = "".join(f" AND list_slice(words, i + {o - at} + 1, i + {o - at + len(p)}) = {quoted(p)}" for o, p in others)
        places.append(f"list_filter(range(0, len(words)), lambda i: words[i + 1] = '{first[0]}' AND "
                      f"list_slice(words, i + 1, i + {len(first)}) = {quoted(first)}{rest}) AS p{k}")
        if t.phrases == (t.text,):
            shares.append(f"CASE WHEN len(p{k}) > 0 THEN 1.0 ELSE 0.0 END")
        else:
            same = " + ".join(f"coalesce((i - {at} + {j} >= 0 AND words[i - {at} + {j} + 1] = '{w}')::INT, 0)"
                              for j, w in enumerate(t.words))
            shares.append(f"coalesce(list_max(list_transform(p{k}, lambda i: ({same}) / {float(len(t.words))})), 0.0)")
    base = [k for k, t in enumerate(templates) if t.base]
    joined = " || ".join(f"p{k}" for k in base)

    def labels(which) -> str:
        named = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{t.label}' END" for k, t in enumerate(templates) if which(t))
        return f"coalesce(list_aggregate(list_sort(list_distinct([{named}])), 'string_agg', ','), '')"

    return f"""
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                   '{BREAKS}'), lambda x: x <> '') AS words FROM documents),
         f AS (SELECT doc_id, words, {', '.join(places)} FROM w)
    SELECT doc_id, len(words)::BIGINT AS n_words, len({joined})::BIGINT AS n_base,
           list_min({joined})::BIGINT AS first_word, list_max({joined})::BIGINT AS last_word,
           {labels(lambda t: t.base)} AS base_labels, {labels(lambda t: True)} AS labels,
           greatest({', '.join(shares)})::DOUBLE AS score
    FROM f"""
