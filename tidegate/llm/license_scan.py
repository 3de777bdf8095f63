"""License scan: phrases, and an exact containment join of text blocks with license templates."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.sqltext import ascii_lower, words
from tidegate.session import materialise

#: Share of a template's tokens that a block must hold.
CONTAINMENT = (85, 100)
#: Words of a window, as a multiple of its template's words.
SPAN = 2
#: Templates of at most so many distinct tokens must be held whole in a window.
SHORT = 12
#: Words after a window in which its mark is looked for as well; one word before it.
CONTEXT = 16

# Phrases whose words stand consecutively, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wording of public license notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("reserved", "All rights reserved."),
)

# What tells a license from its relatives, by label, in words with spaces around them.
MARKS = {
    "mit": " (?:mit license|restriction) ",
    "apache-2": " apache license (?!version 1 (?!(?:[01] )?or (?:version )?2 ))",
    "cc-by-nc": " cc by nc (?:(?!sa |nd )[^ ]+ )?4 0 ",
    # The first GNU license named is the general one, and not of version 1 or 2 alone.
    "gpl-3": "^(?: (?!gnu (?:[^ ]+ )?general public license )[^ ]+)* gnu general public license "
    "(?!(?:(?!version |v[0-9])[^ ]+ ){0,10}(?:version |v)[12] (?!or (?:version )?3 ))",
    "bsd": " redistribution ",
    "reserved": "(?<! some) rights ",
}


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    tokens: tuple[str, ...]
    need: int


def _template_words(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def template_tokens(text: str) -> list[str]:
    """Distinct tokens of a template, sorted."""
    return sorted(set(_template_words(text)))


def _templates(texts, share: tuple[int, int]) -> list[Template]:
    num, den = share
    out = []
    for number, (label, text) in enumerate(texts):
        tokens = tuple(template_tokens(text))
        if not tokens:
            raise ValueError(f"template {number} has no tokens")
        out.append(Template(number, label, tokens, -(-num * len(tokens) // den)))
    return out


def _literals(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _places(text: Column, n_words: Column, phrase: str) -> dict[str, Column]:
    """Number, smallest and largest start of a phrase in a text with one space around each word."""
    sought, size = f" {phrase} ", len(phrase.split())
    # Places share the space between them, so the space after is only looked at.
    count = F.regexp_count(text, F.lit(f" {phrase}(?= )"))
    spaces = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
    before = F.substring_index(text, sought, 1)
    after = F.substring_index(text, sought, -1)
    # One space stands before each word, and one at the end.
    first = spaces(before)
    last = n_words - spaces(after) - size
    return {"count": count, "first": first, "last": last}


def _base(scanned: DataFrame, phrases) -> DataFrame:
    """Phrase columns; the spaced text is built only where it can hold a phrase."""
    may = F.lit(False)
    for phrase, _ in phrases:
        hit = F.lit(True)
        for word in sorted(set(phrase.split())):
            hit = hit & F.contains("text", F.lit(word))
        may = may | hit
    joined = F.concat(F.lit(" "), F.array_join(F.flatten("lines"), " "), F.lit(" "))
    out = scanned.withColumn("spaced", F.when(may, joined))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        found = F.contains("spaced", F.lit(f" {phrase} "))
        place = _places(F.col("spaced"), F.col("n_words"), phrase)
        counts.append(F.when(found, place["count"]).otherwise(F.lit(0)))
        firsts.append(F.when(found, place["first"]))
        lasts.append(F.when(found, place["last"]))
        labels.append(F.when(found, F.lit(label)))
    total = sum(counts[1:], counts[0])
    least = F.least(*firsts) if len(firsts) > 1 else firsts[0]
    most = F.greatest(*lasts) if len(lasts) > 1 else lasts[0]
    return out.withColumns(
        {
            "n_base": total.cast("bigint"),
            "first_word": least.cast("bigint"),
            "last_word": most.cast("bigint"),
            "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
        }
    ).drop("spaced")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    share: tuple[int, int] = CONTAINMENT,
) -> DataFrame:
    """One row per row of ``docs``: phrase places, labels and score.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased; a null
    text has none. ``n_base`` counts the places where a phrase's words stand consecutively,
    ``first_word`` and ``last_word`` are their smallest and largest start (null without places).
    A block is a line of the text; it meets a template when it holds at least ``share`` of the
    template's distinct tokens. ``labels`` are those of phrases and of templates met, distinct and
    sorted; ``score`` is 1 with a phrase, else the largest share of a template met, else 0. Ids
    may be null or repeat, rows are kept one for one; other columns are ignored.

    How it runs. One pass over the texts keeps of each line only the tokens that some template
    has. Their document frequencies over all lines give the global order. A template's rarest
    tokens (as many as a line that meets it cannot all miss) are joined with the lines' tokens;
    length and position bound what can still be shared, and each line and template is compared
    once. Templates are constants of the query: a table of a few dozen rows.
    """
    known = _templates(templates, share)
    vocabulary = sorted({token for t in known for token in t.tokens})
    least = min(t.need for t in known)
    rows = docs.select(
        F.col(id_col).alias("id"),
        ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
    )
    # From a generator, so that the optimizer does not split a text more than once.
    lines = F.explode(F.array(F.transform(F.split("text", "\n"), words))).alias("lines")
    scanned = rows.select("*", lines).withColumn(
        "n_words", F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, line: n + F.size(line))
    )
    blocks = F.transform(
        "lines",
        lambda line: F.struct(
            F.size(line).alias("size"), F.array_intersect(line, _literals(vocabulary)).alias("tokens")
        ),
    )
    scanned = _base(scanned, phrases).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base",
        F.filter(blocks, lambda b: F.size(b["tokens"]) > 0).alias("blocks"),
    )
    scanned = materialise(scanned, "license-rows")
    met = _join(scanned, known, least)
    found = met.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share")
    )
    out = scanned.drop("blocks").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )


def _join(scanned: DataFrame, known: list[Template], least: int) -> DataFrame:
    """``(row, label, share)`` of every line that meets a template."""
    spark = scanned.sparkSession
    lines = scanned.select("row", F.posexplode("blocks").alias("line", "block")).select(
        "row", "line", "block.size", "block.tokens"
    )
    tokens = lines.select("row", "line", "size", F.explode("tokens").alias("token"))
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("lines"))
    parts = spark.createDataFrame(
        [(t.number, t.label, len(t.tokens), t.need, token) for t in known for token in t.tokens],
        "template int, label string, n int, need int, token string",
    )
    # Rarest first; tokens that no line has come before all others.
    order = Window.partitionBy("template").orderBy(F.coalesce("lines", F.lit(0)), "token")
    ranked = (
        parts.join(frequency, "token", "left")
        .withColumn("place", F.row_number().over(order) - 1)
        .select("template", "label", "n", "need", "token", "place")
    )
    in_order = F.array_sort(F.collect_list(F.struct("place", "token")))
    whole = ranked.groupBy("template").agg(
        F.transform(in_order, lambda x: x["token"]).alias("all")
    )
    prefix = ranked.filter(F.col("place") <= F.col("n") - F.col("need")).join(whole, "template")
    # Fixed size: one row for each token of each template's prefix.
    prefix = F.broadcast(prefix.select("template", "label", "n", "need", "token", "place", "all"))
    met = lines.filter((F.size("tokens") >= least)).select(
        "row", "line", "size", "tokens", F.explode("tokens").alias("token")
    )
    met = met.join(prefix, "token").filter(F.col("size") >= F.col("need"))
    shared = F.array_intersect("all", "tokens")
    # A line meets a template at its rarest shared token alone: it lacks the rarer ones, so it can
    # hold that one and those after it.
    rarer = F.filter("all", lambda token, i: i < F.col("place"))
    met = met.filter(F.col("n") - F.col("place") >= F.col("need"))
    met = met.filter(~F.arrays_overlap(rarer, "tokens"))
    met = met.filter(F.size(shared) >= F.col("need"))
    return met.select("row", "label", (F.size(shared) / F.col("n")).alias("share"))


def windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    share: tuple[int, int] = CONTAINMENT,
    span: int = SPAN,
    marks=MARKS,
) -> DataFrame:
    """As ``scan``, but a notice may wrap and relatives are told apart: the columns are the same.

    A block is a window: ``span`` times as many consecutive words of the text as the template has,
    wherever lines end, from any word that is a token of the template (fewer at the end of the
    text). It meets the template when it holds at least ``share`` of its distinct tokens, all of
    them if those are at most ``SHORT``, and has the mark of the label, if there is one; a mark is
    also looked for in the word before the window and the ``CONTEXT`` words after it.

    How it runs. One narrow pass: each text is reduced to the template tokens it has at all, and
    only the templates of which it has enough are looked for, in every window of the text.
    """
    known = [
        replace(t, need=len(t.tokens)) if len(t.tokens) <= SHORT else t
        for t in _templates(templates, share)
    ]
    vocabulary = sorted({token for t in known for token in t.tokens})
    rows = docs.select(
        F.col(id_col).alias("id"),
        ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
    )
    # From a generator, so that the optimizer does not split a text more than once.
    lines = F.explode(F.array(F.array(words(F.col("text"))))).alias("lines")
    scanned = rows.select("*", lines).withColumn("n_words", F.size(F.col("lines")[0]).cast("bigint"))
    scanned = _base(scanned, phrases).select(
        "id", "n_words", "n_base", "first_word", "last_word", "base",
        F.col("lines")[0].alias("words"),
        F.array_intersect(F.col("lines")[0], _literals(vocabulary)).alias("present"),
    )
    met = F.array(
        *(
            F.struct(
                F.lit(t.label).alias("label"),
                _most(t, span * len(_template_words(text)), marks.get(t.label)).alias("share"),
            )
            for t, (_, text) in zip(known, templates)
        )
    )
    # As above: the windows are looked through once.
    out = scanned.withColumn("met", F.explode(F.array(F.filter(met, lambda m: m["share"] > 0)))).drop("words")
    more = F.transform("met", lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("met", lambda m: m["share"])), F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def _most(template: Template, size: int, mark: str | None) -> Column:
    """Largest share of a template in a window of ``size`` words that meets it, else 0."""
    tokens = _literals(template.tokens)

    def held(i):
        n = F.size(F.array_intersect(tokens, F.slice("words", i, size)))
        met = n >= template.need
        if mark:
            before = F.least(i - 1, F.lit(1))
            around = F.slice("words", i - before, before + size + CONTEXT)
            met = met & F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" ")).rlike(mark)
        return F.when(met, n).otherwise(F.lit(0))

    starts = F.filter(
        F.sequence(F.lit(1), F.size("words")), lambda i: F.array_contains(tokens, F.get("words", i - 1))
    )
    enough = F.size(F.array_intersect("present", tokens)) >= template.need
    most = F.when(enough, F.array_max(F.transform(starts, held)))
    return F.coalesce(most, F.lit(0)) / F.lit(len(template.tokens))
