"""License scan: an exact set-similarity join of text blocks and templates.

A block for a template of n words is any 2 n words in a row of a text, over
line breaks and blank lines alike, so layout does not matter and a block's
size is bound to the template's. Only blocks that begin with a template token
are formed: any other holds no more than the next of these. Tokens are ordered
by their global frequency over all blocks, rarest first. A template T is
contained in a block B where |T and B| >= alpha = ceil(threshold * |T|). Then
B holds one of the first
|T| - alpha + 1 tokens of T (prefix filter), has at least alpha template
tokens (length filter), and after the first shared token both sides have
enough tokens left (positional filter); what passes is counted exactly. Before
blocks are formed, texts are cut into overlapping pieces that hold each block
whole, and pieces that miss too many tokens of a template have no blocks for
it. A block must also name the license (``NAMES``). Fixed phrases are found besides, by their places in the whole text. Only DataFrame
operations, no Python on the executors; what is shuffled or sent to the driver
is counts of template tokens and the few pieces and blocks that may match.

Defined cases: a null text is empty and has no words, no places and no
labels. Rows are scanned one by one (a row number is fixed when the blocks
are stored), so ids may repeat or be null. Texts of any length are scanned whole.
An empty table of documents gives an empty result; without templates only the
phrases count. Tokens that are equally frequent are ordered by their text.
Other columns are not read, so their names may be anything.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRINGS = "array<string>"

#: Words of a block for each word of the template, and words of a piece beside
#: those that its last block needs.
BLOCK_WORDS = 2
PIECE_WORDS = 256

#: Phrase -> label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label -> opening sentence of the public notice, or the usual
#: one-line reference to it.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
)

#: template's text -> what a block must hold besides the share of
#: its tokens, as a pattern over the block's words with a blank on either side.
#: The words that tell a license or its version from others are a small part
#: of a template's tokens, so the share alone does not ask for them.
NAMES = {
    TEMPLATES[0][1]: " apache license version 2 0 ",
    TEMPLATES[1][1]: " apache license version 2 0 ",
    TEMPLATES[3][1]: " attribution 4 0 ",
    TEMPLATES[4][1]: " cc by nc 4 0 ",
    TEMPLATES[5][1]: " gnu general public license (.* )?(version 3|v3) ",
    TEMPLATES[6][1]: " gnu general public license (.* )?(version 3|v3) ",
    TEMPLATES[7][1]: " mit license ",
    TEMPLATES[8][1]: " associated documentation ",
}


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast(STRINGS)


def _rows(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals; lists are arrays of strings."""
    lit = lambda v: _strings(v) if isinstance(v, list) else F.lit(v)
    structs = [F.struct(*[lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def template_sets(spark, templates, names=NAMES) -> list[tuple[int, str, list[str], int, str]]:
    """(number, label, distinct tokens, words of a block, pattern of the name)
    of each template; without a name, any block fits the pattern."""
    df = _rows(spark, [(i, lab, t) for i, (lab, t) in enumerate(templates)], ["i", "label", "t"])
    w = _tokens(F.col("t"))
    rows = df.select("i", "label", F.sort_array(F.array_distinct(w)), F.size(w) * BLOCK_WORDS).collect()
    return [(*r, names.get(templates[r[0]][1], "")) for r in rows]


def _spaced(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _alpha(threshold: float, ts: list[str]) -> int:
    return max(1, ceil(threshold * len(ts) - 1e-9))


def _pieces(w: Column, sets, vocabulary: list[str], threshold: float) -> Column:
    """array<struct<x array<string>, widths array<int>>>: the pieces of the
    words that may hold a block, and how wide that may be."""
    widest = max(width for _, _, _, width, _ in sets)

    def piece(x: Column) -> Column:
        def of(held: Column) -> Column:
            fits = [(F.size(F.array_intersect(held, _strings(ts))) >= _alpha(threshold, ts)) & _spaced(x).rlike(name) for _, _, ts, _, name in sets]
            widths = [F.when(fit, F.lit(t[3])) for fit, t in zip(fits, sets)]
            return F.struct(x.alias("x"), F.array_distinct(F.array_compact(F.array(*widths))).alias("widths"))

        return let(F.array_intersect(x, _strings(vocabulary)), of)

    starts = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w), F.lit(PIECE_WORDS))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, lambda i: piece(F.slice(w, i, PIECE_WORDS + widest))), lambda p: F.size(p["widths"]) > 0)


def places(words: Column, phrases: dict[str, str]) -> Column:
    """array<struct<at int, label string>>: every place of every phrase."""
    split = [(p.split(" "), lab) for p, lab in phrases.items()]

    def here(w: Column, i: Column, parts: list[str]) -> Column:
        hit = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(w, i + k) == part, F.lit(False))
        return hit

    def of(w: Column, at: Column, parts: list[str], label: str) -> Column:
        return F.transform(F.filter(at, lambda i: here(w, i, parts)), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    def scan(w: Column) -> Column:
        none = F.array().cast("array<struct<at:int,label:string>>")
        first = _strings({parts[0] for parts, _ in split})
        at = F.sequence(F.lit(0), F.size(w) - 1)
        return F.when(F.arrays_overlap(w, first), F.concat(*[of(w, at, parts, lab) for parts, lab in split])).otherwise(none)

    return let(words, scan)


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates=TEMPLATES,
    phrases: dict[str, str] | None = None,
    threshold: float = 0.8,
    names: dict[str, str] = NAMES,
) -> DataFrame:
    """(doc_id, n_words long, places array<struct<at,label>>, found
    array<string>, containment double), one row per input row: the phrases'
    places, the labels of the templates that a block contains and names, and
    the highest share of a template that one does. Templates not in ``names``
    need the share of their tokens only."""
    spark = docs.sparkSession
    sets = [t for t in template_sets(spark, templates, names) if t[2]] if templates else []
    vocabulary = sorted({t for _, _, ts, _, _ in sets for t in ts})
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[doc_id].alias("doc_id"),
        _tokens(F.coalesce(docs[text], F.lit(""))).alias("w"),
    )
    told = stored(
        words.select(
            "row",
            "doc_id",
            F.size("w").alias("n_words"),
            places(F.col("w"), PHRASES if phrases is None else phrases).alias("places"),
            *([let(F.col("w"), lambda w: _pieces(w, sets, vocabulary, threshold)).alias("pieces")] if sets else []),
        ),
        "blocks",
    )
    if not sets:
        best = told.select("row", F.lit(None).cast(STRINGS).alias("found"), F.lit(None).cast("double").alias("containment")).where("false")
    else:
        best = _contained(told, sets, vocabulary, threshold)
    return told.join(best, "row", "left").select(
        F.col("doc_id").alias(doc_id),
        F.col("n_words").cast("long").alias("n_words"),
        "places",
        F.coalesce("found", F.array().cast(STRINGS)).alias("found"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def _contained(told: DataFrame, sets, vocabulary: list[str], threshold: float) -> DataFrame:
    """(row, found, containment) of the documents with a matching block."""
    spark = told.sparkSession
    # a block begins with a token of a template of its width
    opening = {width: _strings(sorted({t for _, _, ts, n, _ in sets if n == width for t in ts})) for _, _, _, width, _ in sets}
    pieces = told.select("row", F.explode("pieces").alias("p")).select("row", "p.x", F.explode("p.widths").alias("width"))
    opens = F.coalesce(*[F.when(F.col("width") == width, ts) for width, ts in opening.items()])
    starts = let(opens, lambda ts: F.filter(F.sequence(F.lit(1), F.least(F.size("x"), F.lit(PIECE_WORDS))), lambda i: F.array_contains(ts, F.get("x", i - 1))))
    windows = pieces.select("row", "width", F.explode(F.transform(starts, lambda i: F.slice("x", i, F.col("width")))).alias("x"))
    blocks = windows.select("row", "width", _spaced(F.col("x")).alias("x"), F.array_intersect("x", _strings(vocabulary)).alias("b"))
    seen = dict(map(tuple, blocks.select(F.explode("b").alias("t")).groupBy("t").count().collect()))  # at most the vocabulary
    order = sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    prefixes = []
    for _, label, ts, width, name in sets:
        ts = sorted(ts, key=rank.__getitem__)
        alpha = _alpha(threshold, ts)
        prefix = ts[: len(ts) - alpha + 1]
        prefixes += [(t, width, i, label, ts, prefix, alpha, name) for i, t in enumerate(prefix)]
    heads = _rows(spark, prefixes, ["t", "width", "i", "label", "ts", "prefix", "alpha", "name"])
    least = min(p[-2] for p in prefixes)
    by_rank = blocks.where(F.size("b") >= least).select("row", "width", "x", F.array_intersect(_strings(order), "b").alias("s"))
    probe = by_rank.select("row", "width", "x", "s", F.explode(F.array_intersect("s", _strings(sorted({p[0] for p in prefixes})))).alias("t"))
    left_t = F.size("ts") - F.col("i")
    left_s = F.size("s") - F.array_position("s", F.col("t")) + 1
    pairs = (
        probe.join(F.broadcast(heads), ["t", "width"])  # the templates' prefixes
        .where(F.size("s") >= F.col("alpha"))
        .where(F.least(left_t, left_s) >= F.col("alpha"))
        .where(F.expr("x rlike name"))
        .where(F.array_intersect("prefix", "s")[0] == F.col("t"))  # once for each block and template
        .select("row", "label", "alpha", F.size(F.array_intersect("ts", "s")).alias("both"), F.size("ts").alias("n"))
        .where("both >= alpha")
    )
    return pairs.groupBy("row").agg(F.collect_set("label").alias("found"), F.max(F.col("both") / F.col("n")).alias("containment"))


def summary(result: DataFrame) -> DataFrame:
    """The scan's rows as counts, joined labels and one score: 1 with a
    phrase, else the highest containment."""
    at = F.transform("places", lambda p: p["at"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    return result.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, "found")), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.col("containment")).alias("score"),
    )
