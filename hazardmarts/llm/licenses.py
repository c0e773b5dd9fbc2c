"""Licence scans by a positional index of rare words, in DataFrame expressions only.

Templates are word sequences with mandatory key phrases at known places. Document frequencies of the
templates' words are counted over all texts. Each template is looked up by its highest-IDF key words:
the places of the rarest give the possible starts, the others must stand at their places relative to it, and
then all key phrases are verified. Since the looked-up words are taken from the key phrases, no place that
would pass the verification is missed, whatever the frequencies are. What share of the whole template
stands at the place is the score.

Words are runs of ASCII letters, digits and non-ASCII characters; only A-Z is lower-cased. Null texts count
as empty and have no words. Texts of any length are scanned whole; texts without any key word are told by one
hash probe per word. Overlapping and repeated places all count. Repeated rows are scanned alike. Columns
of the input are passed through; the added ones start with ``lic_`` and replace input columns of that name.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import let, text_of

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# How many of a template's rarest key words are looked up.
ANCHORS = 3


@dataclass(frozen=True)
class Template:
    """``keys``: the mandatory phrases as (start, length) in ``words``."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, int], ...]

    @property
    def key_places(self) -> list[int]:
        return [i for start, n in self.keys for i in range(start, start + n)]


def template(label: str, text: str, *phrases: str) -> Template:
    """A template from its text; without phrases, the whole text is mandatory."""
    words = tuple(text.split())
    keys = []
    for phrase in phrases or (text,):
        wanted = tuple(phrase.split())
        at = next((i for i in range(len(words)) if words[i : i + len(wanted)] == wanted), None)
        if at is None:
            raise ValueError(f"{phrase!r} is not in the template {label}")
        keys.append((at, len(wanted)))
    return Template(label, words, tuple(keys))


# Phrases and the opening sentences of public licences, as lower-case words.
BASE = (
    template("mit", "under the mit license"),
    template("apache-2", "apache license version 2"),
    template("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge", "this software and associated documentation files",
    ),
    template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license",
        "licensed under the apache license", "you may not use this file except in compliance",
    ),
    template("gpl-3", "under the gnu general public license version 3", "gnu general public license version 3"),
    template(
        "gpl",
        "free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",
        "you can redistribute it and or modify it", "gnu general public license",
    ),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms", "the following conditions are met",
    ),
    template("cc-by-sa", "cc by sa"),
    template("all-rights-reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """The words of a text. Two capitals outside ASCII would lower to ASCII letters and are put aside."""
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("å")), F.lit("İ"), F.lit("å"))
    return F.array_remove(F.split(F.lower(safe), SEPARATORS), "")


def frequencies(docs: DataFrame, templates: Sequence[Template], text: str = "text") -> tuple[dict[str, int], int]:
    """In how many texts each key word occurs, and the number of texts. As many rows are
    collected as the templates have words."""
    vocabulary = sorted({t.words[i] for t in templates for i in t.key_places})
    known = F.array(*[F.lit(w) for w in vocabulary])
    found = docs.select(F.explode(F.array_append(F.array_intersect(words_of(text_of(text)), known), "")).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return counts, counts.pop("", 0)


def anchors(t: Template, counts: dict[str, int]) -> list[int]:
    """Places of the rarest distinct key words; by frequency, then by place."""
    first: dict[str, int] = {}
    for i in t.key_places:
        first.setdefault(t.words[i], i)
    return sorted(first.values(), key=lambda i: (counts.get(t.words[i], 0), i))[:ANCHORS]


def _starts(words: Column, places: Column, t: Template, counts: dict[str, int]) -> Column:
    """All starts of a template: posting lists intersected by relative position, then key phrases."""
    rarest, *others = anchors(t, counts)
    rest = [i for i in t.key_places if i not in {rarest, *others}]
    listed = F.filter(places, lambda p: p["w"] == t.words[rarest])
    starts = F.transform(listed, lambda p: p["i"] - rarest)
    at = lambda s, i: F.coalesce(F.get(words, s + i) == t.words[i], F.lit(False))
    fits = lambda s: reduce(lambda a, i: a & at(s, i), [*others, *rest], s >= 0)
    return F.filter(starts, fits)


def _share(words: Column, start: Column, t: Template) -> Column:
    """The share of the template's words that stand at their places."""
    hit = lambda i: F.coalesce(F.get(words, start + i) == t.words[i], F.lit(False)).cast("int")
    return reduce(lambda a, b: a + b, [hit(i) for i in range(len(t.words))]).cast("double") / float(len(t.words))


def _placed(words: Column, t: Template):
    return lambda s: F.struct(F.lit(t.label).alias("label"), s.alias("start"), _share(words, s, t).alias("score"))


def scan(
    docs: DataFrame, text: str = "text", base: Sequence[Template] = BASE, templates: Sequence[Template] = TEMPLATES
) -> DataFrame:
    """The input with ``lic_words`` (number of words), ``lic_base`` and ``lic_found``: arrays of
    (label, start, score) with the places of base phrases and of templates."""
    counts, _ = frequencies(docs, (*base, *templates), text)
    looked_up = sorted({t.words[anchors(t, counts)[0]] for t in (*base, *templates)})
    added = ("lic_words", "lic_base", "lic_found", "lic_w", "lic_hits")
    kept = [c for c in docs.columns if c not in added]
    kind = "array<struct<label:string,start:int,score:double>>"

    def places(words: Column) -> Column:
        marked = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        return F.filter(marked, lambda x: x["w"].isin(looked_up))

    def hits(words: Column, listed: Column, chosen: Sequence[Template]) -> Column:
        each = [F.transform(_starts(words, listed, t, counts), _placed(words, t)) for t in chosen]
        return F.concat(*each).cast(kind)

    def found(words: Column) -> Column:
        both = lambda p: F.struct(hits(words, p, base).alias("base"), hits(words, p, templates).alias("own"))
        nothing = F.struct(F.array().cast(kind).alias("base"), F.array().cast(kind).alias("own"))
        known = F.array(*[F.lit(w) for w in looked_up])
        listed = F.when(F.arrays_overlap(words, known), let(places(words), both)).otherwise(nothing)
        return F.struct(F.size(words).cast("bigint").alias("n"), listed.alias("hits"))

    staged = docs.select(*kept, let(words_of(text_of(text)), found).alias("lic_w"))
    return staged.select(
        *kept, F.col("lic_w.n").alias("lic_words"), F.col("lic_w.hits.base").alias("lic_base"),
        F.col("lic_w.hits.own").alias("lic_found"),
    )


def joined_labels(places: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")
