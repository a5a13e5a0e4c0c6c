"""Licence scan by a positional index of rare words, in DataFrame expressions only.

A template is a short licence text with a label and mandatory key phrases inside it.  The index holds, for
every template, postings (word and place in the template) of its key phrases' highest-IDF words: ``RARE`` of
the first phrase and one of each other phrase, by document frequencies over all texts.  A file's licence words are looked up
by falling IDF: a template stays open while the file holds its words, and as all words of key phrases are
mandatory, those are the highest-IDF words of that template in every file that can match it.  Each occurrence of
a posted word proposes the place at which the template would begin; the proposals of a template's words are
intersected.  An alignment stands if every key phrase is found there: the first at its place, the others within
``SLACK`` words of theirs, so that a word put in or left out between two phrases does not hide a licence.
The alignment scores the share of the template's words, weighted by IDF, that stand at their places, for
templates of several phrases within the same tolerance.

Everything happens inside the row, so neither a frequent word nor a long text moves data; work and memory grow
with a text's length.

Defined results: a null text is empty, has no words, no labels (empty strings) and score 0; repeated rows are
scanned once each; words of equal IDF are taken in falling alphabetical order, which changes no result; other columns than those asked for are not read.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 2  # posted words of a template's first key phrase
SLACK = 3  # words by which a later key phrase may be off its place


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases of the text that must stand where the text has them
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrases(self) -> list[list[tuple[int, str]]]:
        """The key phrases, each as places and words."""
        words, found = self.words, []
        for key in self.keys:
            parts = key.split()
            starts = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
            if not starts:
                raise ValueError(f"{key!r} is not in the template {self.text!r}")
            found.append([(starts[0] + i, word) for i, word in enumerate(parts)])
        return found

    @property
    def mandatory(self) -> list[int]:
        """Places of the key phrases' words."""
        return sorted({place for phrase in self.phrases for place, _ in phrase})

    @property
    def slack(self) -> int:
        return SLACK if len(self.keys) > 1 else 0

    def postings(self, idf: dict[str, float]) -> list[tuple[str, int, int]]:
        """Word, place and tolerance of the highest-IDF words, a phrase's words once each."""
        found = []
        for n, phrase in enumerate(self.phrases):
            places = {word: place for place, word in reversed(phrase)}
            ranked = sorted(places, key=lambda word: (idf[word], word), reverse=True)
            found += [(word, places[word], self.slack if n else 0) for word in ranked[:1 if n else RARE]]
        return found


def phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, (text,), base)


# Public licence texts, lower-cased, as words.
BASE = [
    phrase("mit", "mit license", True),
    phrase("apache", "apache license", True),
    phrase("gpl", "general public license", True),
]
TEMPLATES = [
    *BASE,
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "copy of this software")),
    Template("apache", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("this program is free software", "gnu general public license")),
    phrase("gpl", "gnu gpl"),
    Template("lgpl", "gnu lesser general public license version", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license version", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "are permitted")),
    phrase("bsd", "bsd license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    phrase("proprietary", "all rights reserved"),
]


def words(text: str | Column) -> Column:
    """Lower-case words of a text: runs of digits, letters and whatever lies above ASCII."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, NOT_A_WORD), "")


def frequencies(docs: DataFrame, templates: list[Template] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each word of the templates, over all texts."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.array_intersect(words("text"), F.array(*map(F.lit, vocabulary))).alias("w"))
    counted = found.select(F.explode_outer("w").alias("w")).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counted.collect()}  # at most one row per word of the templates
    number = docs.count()
    return {w: math.log((number + 1) / (seen.get(w, 0) + 1)) + 1 for w in vocabulary}


def _shifts(slack: int) -> Column:
    return F.array(*map(F.lit, range(-slack, slack + 1)))


def _entry(number: int, template: Template, idf: dict[str, float]) -> Column:
    """A template as a row of the index."""
    total = sum(idf[w] for w in template.words)
    needed = sorted({template.words[p] for p in template.mandatory}, key=lambda w: (idf[w], w), reverse=True)
    word = lambda place, w: F.struct(F.lit(w).alias("word"), F.lit(place).alias("at"))
    return F.struct(
        F.lit(number).alias("template"), F.lit(template.label).alias("label"), F.lit(template.base).alias("base"),
        F.array(*map(F.lit, needed)).alias("needed"),
        F.array(*(F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"), _shifts(slack).alias("shifts")) for w, at, slack in template.postings(idf))).alias("postings"),
        F.array(*(F.struct(F.array(*(word(at, w) for at, w in p)).alias("words"), _shifts(template.slack if n else 0).alias("shifts")) for n, p in enumerate(template.phrases))).alias("phrases"),
        F.array(*(F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"), F.lit(idf[w] / total).alias("weight")) for at, w in enumerate(template.words))).alias("words"),
        _shifts(template.slack).alias("shifts"),
    )


def scan(docs: DataFrame, idf: dict[str, float], *columns: str | Column, templates: list[Template] = TEMPLATES) -> DataFrame:
    """The columns asked for with ``n_words`` and ``found``: each standing alignment as template number,
    label, ``base``, first word and score."""
    index = F.array(*(_entry(n, t, idf) for n, t in enumerate(templates)))
    posted = sorted({word for t in templates for word, _, _ in t.postings(idf)})
    needed = sorted({t.words[p] for t in templates for p in t.mandatory})
    w, places = F.col("_words"), F.col("_places")

    def stands_at(first: Column, words: Column) -> Column:
        return F.forall(words, lambda x: F.coalesce(F.get(w, first + x["at"]) == x["word"], F.lit(False)))

    def proposed(posting: Column) -> Column:
        """The places at which the template would begin, by one of its words."""
        own = F.filter(places, lambda h: h["word"] == posting["word"])
        return F.flatten(F.transform(own, lambda h: F.transform(posting["shifts"], lambda d: h["at"] - posting["at"] + d)))

    def aligned(entry: Column) -> Column:
        """Proposals that all posted words agree on, the key phrases verified."""
        rest = F.slice(entry["postings"], F.lit(2), F.size(entry["postings"]))
        agreed = F.aggregate(rest, F.array_distinct(proposed(F.get(entry["postings"], F.lit(0)))), lambda some, posting: F.array_intersect(some, proposed(posting)))
        phrase_stands = lambda first: F.forall(entry["phrases"], lambda p: F.exists(p["shifts"], lambda d: stands_at(first + d, p["words"])))
        return F.transform(F.filter(agreed, phrase_stands), lambda first: F.struct(
            entry["template"].alias("template"), entry["label"].alias("label"), entry["base"].alias("base"),
            first.cast("long").alias("first"), share(entry, first).alias("score"),
        ))

    def share(entry: Column, first: Column) -> Column:
        there = lambda x: F.exists(entry["shifts"], lambda d: F.coalesce(F.get(w, first + x["at"] + d) == x["word"], F.lit(False)))
        return F.least(F.aggregate(entry["words"], F.lit(0.0), lambda total, x: total + F.when(there(x), x["weight"]).otherwise(0.0)), F.lit(1.0))

    read = docs.select(*columns, words("text").alias("_words"))
    held = read.withColumn("_held", F.array_intersect(w, F.array(*map(F.lit, needed))))
    # a template is open while the file holds its words, asked for by falling IDF
    opened = held.withColumn("_open", F.filter(index, lambda e: F.forall(e["needed"], lambda x: F.array_contains("_held", x))))
    any_open = F.size("_open") > 0
    looked = F.filter(F.transform(w, lambda x, i: F.when(x.isin(posted), F.struct(x.alias("word"), i.alias("at")))), lambda h: h.isNotNull())
    placed = opened.withColumn("_places", F.when(any_open, looked))
    nothing = F.array().cast("array<struct<template:int,label:string,base:boolean,first:bigint,score:double>>")
    found = F.when(any_open, F.flatten(F.transform("_open", aligned))).otherwise(nothing)
    return placed.withColumns({"n_words": F.size(w).cast("long"), "found": found}).drop("_words", "_held", "_open", "_places")


def summarise(found: DataFrame) -> DataFrame:
    """Replace ``found`` by counts, places, labels and the best score."""
    base = F.filter("found", lambda f: f["base"])
    firsts = F.transform(base, lambda f: f["first"])
    joined = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(a, lambda f: f["label"]))))
    return found.withColumns({
        "n_base": F.size(base).cast("long"), "first_word": F.array_min(firsts), "last_word": F.array_max(firsts),
        "base_labels": joined(base), "labels": joined(F.col("found")),
        "score": F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)),
    }).drop("found")
