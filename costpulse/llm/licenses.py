"""License scan with a positional index of rare words.

A template is a licence's wording with mandatory key phrases. The index holds, for each
template, the ``RARE`` words of its key phrases with the highest IDF (counted over all scanned
texts) and their positions in the wording. A file's words that the index knows are looked up;
each hit at position i of a word that stands at position q of a template proposes the
alignment i - q. The postings are then intersected by relative position: an alignment is a
candidate if all of the template's rare words stand where it puts them. It is a find if every
key phrase stands word by word in its place and the words of the whole wording that are in
place have at least the template's ``agree`` share of the wording's IDF; that share is its score.

Base phrases are templates whose only key phrase is the whole wording, so they are found exactly
where their words stand consecutively. All of it is DataFrame functions without a shuffle of
texts: one pass counts the document frequencies of the templates' words, one pass scans.
Texts are lower-cased; words are runs of ASCII letters, digits and all non-ASCII characters.
A null text counts as empty; rows are scanned one by one whatever their ids.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 4
BIAS = 1 << 36             # keeps alignments that begin before the text positive
SHIFT = 40
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    wording: str
    keys: tuple[str, ...] = ()      # mandatory phrases, each standing in the wording; () = all of it
    agree: float = 1.0              # IDF share of the wording that must be in place
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.wording.split()

    def phrases(self) -> list[tuple[int, list[str]]]:
        out = []
        for key in self.keys or (self.wording,):
            k, w = key.split(), self.words
            at = next(i for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k)
            out.append((at, k))
        return out


BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
# Opening words of public licence notices.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files",
             ("permission is hereby granted free of charge",), 0.4),
    Template("gpl-3", "gnu general public license version 3", ("gnu general public license",
                                                               "version 3")),
    Template("gpl-2", "gnu general public license version 2", ("gnu general public license",
                                                               "version 2")),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-3", "gnu affero general public license", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms",), 0.4),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",), 0.4),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted", ("distribute this software for any purpose",), 0.4),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",), 0.4),
)
TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), GAPS, -1), "")


def idf(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> dict[str, float]:
    """IDF of the templates' words over all texts; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in templates for w in t.words})
    known = F.array(*[F.lit(w) for w in vocabulary])
    seen = docs.select(F.array_intersect(words_of(F.col(text)), known).alias("w"))
    counts = {r["w"]: r["count"] for r in
              seen.select(F.explode(F.concat("w", F.array(F.lit("")))).alias("w"))
              .groupBy("w").count().collect()}
    n = counts.get("", 0)                       # one for every text
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-9 for w in vocabulary}


def _index(templates, weights: dict[str, float], rare: int):
    """Per template the (position, word) of its rare words, by falling IDF."""
    out = []
    for t in templates:
        best: dict[str, int] = {}
        for at, phrase in t.phrases():
            for q, w in enumerate(phrase):
                best.setdefault(w, at + q)
        top = sorted(best, key=lambda w: (-weights[w], w))[:rare]
        out.append([(best[w], w) for w in top])
    return out


def scan(docs: DataFrame, weights: dict[str, float], text: str = "text", templates=TEMPLATES,
         rare: int = RARE) -> DataFrame:
    """``docs`` with n_words (long) and finds: array<struct<template int, start long, score double>>
    in the order of the text, ``template`` being the place in ``templates``."""
    index = _index(templates, weights, rare)
    postings: dict[str, list[int]] = {}
    for t, entries in enumerate(index):
        for q, w in entries:
            postings.setdefault(w, []).append((t << SHIFT) + BIAS - q)
    known = F.array(*[F.lit(w) for w in sorted(postings)])
    table = F.create_map(*[x for w, codes in sorted(postings.items())
                           for x in (F.lit(w), F.array(*[F.lit(c).cast("long") for c in codes]))])
    words = F.col("_words")

    def in_place(at: Column, q: int, word: str) -> Column:
        return F.coalesce(F.get(words, (at + q).cast("int")) == word, F.lit(False))

    def agreement(t: int, at: Column) -> Column:
        wording = templates[t].words
        whole = sum(weights[w] for w in wording)
        total = F.lit(0.0)
        for q, w in enumerate(wording):
            total = total + F.when(in_place(at, q, w), weights[w] / whole).otherwise(0.0)
        return F.round(total, 9)

    def verified(t: int, at: Column) -> Column:
        held = F.lit(True)
        for q, w in index[t]:
            held = held & in_place(at, q, w)
        for q, phrase in templates[t].phrases():
            for n, w in enumerate(phrase):
                held = held & in_place(at, q + n, w)
        return held

    def judged(code: Column) -> Column:
        at = code.bitwiseAND(F.lit((1 << SHIFT) - 1)) - F.lit(BIAS)
        number = F.shiftright(code, SHIFT).cast("int")
        score = F.lit(0.0)
        for t in range(len(templates)):
            found = agreement(t, at)
            score = F.when((number == t) & verified(t, at) & (found >= templates[t].agree - 1e-6),
                           found).otherwise(score)
        return F.struct(number.alias("template"), at.alias("start"), score.alias("score"))

    hits = F.filter(F.sequence(F.lit(0), F.size(words) - 1),
                    lambda i: F.array_contains(known, F.get(words, i)))
    codes = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(
        F.element_at(table, F.get(words, i)), lambda c: c + i))))
    finds = F.array_sort(F.filter(F.transform(codes, judged), lambda x: x["score"] > 0), lambda a, b:
                         F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                         .otherwise((a["template"] - b["template"]).cast("int")))
    none = F.array().cast("array<struct<template:int,start:bigint,score:double>>")
    return (docs.withColumn("_words", words_of(F.col(text)))
            .withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("finds", F.when(F.arrays_overlap("_words", known), finds).otherwise(none))
            .drop("_words"))


def labels_of(finds: Column, templates=TEMPLATES, base_only: bool = False) -> Column:
    """Distinct labels of the finds, sorted and comma-joined."""
    names = F.array(*[F.lit(t.label) for t in templates])
    chosen = finds
    if base_only:
        chosen = F.filter(finds, lambda f: F.get(F.array(*[F.lit(t.base) for t in templates]), f["template"]))
    return F.array_join(F.array_sort(F.array_distinct(
        F.transform(chosen, lambda f: F.get(names, f["template"])))), ",")
