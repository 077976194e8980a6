"""Line dedup, near dedup, decontamination and license scan against plain
versions, over odd rows and the smallest tables."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridpull.llm import decontam, license_scan, line_dedup, minhash, queries

from . import brute
from .cases import LINE, PASSAGE, SF, documents, odd_rows, rows_of

ITEMS = [
    (1, PASSAGE),
    (2, PASSAGE.title()),
    (3, "alpha beta gamma"),
    (4, None),
    (5, " .,;"),
    (None, "zeta eta theta"),
    (6, "one two"),
    (6, "one two"),
    (7, "no such words here at all in any of the documents"),
    (8, "long word long word long word long word long word long"),
]


def small_documents():
    con = duckdb.connect()
    return con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


# ------------------------------------------------------------- line dedup
@pytest.mark.parametrize("keys", [line_dedup.BROADCAST_KEYS, 0])  # 0: documents are joined with their keys
@pytest.mark.parametrize("bits", [1 << 27, 1 << 11])  # the small one is full: all lines are suspects
def test_lines_match_brute(spark, bits, keys, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", keys)
    got = line_dedup.drop_repeated_lines(documents(spark), ["doc_id", "row"], filter_bits=bits)
    got = rows_of(got.select("row.doc_id", "n_lines", "n_dropped", "kept"))
    assert got == sorted(brute.lines(odd_rows()), key=str)
    dropped = {r[0]: r[2] for r in got}
    assert dropped[100] == 1 and dropped[120] == 0


def test_lines_shuffle_no_texts(spark):
    got = line_dedup.drop_repeated_lines(documents(spark), ["doc_id"])
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    bits = line_dedup.bits_for(documents(spark), "text", 40, 1 << 28)
    assert bits == line_dedup.LEAST_BITS and line_dedup.bits_for(documents(spark), "text", 40, 1 << 10) == 1 << 10


def test_lines_with_equal_half_digests(spark, monkeypatch):
    """Keys that share the first half of their digest are told apart."""
    real = line_dedup._marks

    def marks(keys):
        m = real(keys).copy()
        m["a"] %= 3
        return m

    monkeypatch.setattr(line_dedup, "_marks", marks)
    rows = [(d, "\n".join(f"this is the repeated line number {i} of the documents" for i in range(9))) for d in range(6)]
    got = rows_of(line_dedup.drop_repeated_lines(documents(spark, rows), ["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", "kept"))
    assert got == sorted(brute.lines(rows), key=str)


def test_lines_thresholds(spark):
    """Exactly ``min_docs`` documents and exactly ``min_chars`` code points."""
    key = "é" * 40
    rows = [(i, key) for i in range(5)] + [(i + 10, key[:-1] + "\nx") for i in range(5)] + [(i + 20, "z" * 40) for i in range(4)]
    got = {r[0]: r[1] for r in line_dedup.drop_repeated_lines(documents(spark, rows), ["doc_id"]).select("row.doc_id", "n_dropped").collect()}
    assert [got[i] for i in range(5)] == [1, 1, 1, 1, 0]
    assert not any(got[i] for i in got if i >= 10)


def test_lines_whole_table(spark):
    got = rows_of(queries.q_line_dedup(spark, SF))
    assert got == sorted([(d, n, x, brute.sha(k)) for d, n, x, k in brute.lines(small_documents())], key=str)


# -------------------------------------------------------------- near dedup
def test_near_matches_brute(spark):
    got = rows_of(minhash.near_duplicates(documents(spark)).select("doc_id", "n_shingles", "component_id", "kept"))
    assert got == sorted(brute.near(odd_rows()), key=str)


def test_near_big_groups(spark):
    """A group of many near copies, and as many texts that share a passage
    but are not near: all links are found, none made up."""
    import random

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefgh", k=7))
    base, passage = [word() for _ in range(150)], [word() for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(40)])) for i in range(60)]
    chain = list(base[:100])
    for i in range(12):  # each near the one before, the ends are not near
        chain[8 * i : 8 * i + 2] = [word(), word()]
        rows.append((200 + i, " ".join(chain)))
    got = rows_of(minhash.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept"))
    assert got == sorted(brute.near(rows), key=str)


def test_near_whole_table(spark):
    got = rows_of(queries.q_minhash(spark, SF))
    assert got == sorted(brute.near(small_documents()), key=str)


def test_union_sketch_estimate():
    import numpy as np

    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(50):
        u = np.sort(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))
        p, q = u[rng.random(len(u)) < 0.9], u[rng.random(len(u)) < 0.9]
        pairs.append((p[:64], q[:64], u))
    got = minhash.estimates([p.tobytes() for p, _, _ in pairs], [q.tobytes() for _, q, _ in pairs])
    for (p, q, _), g in zip(pairs, got):
        low = set(sorted(set(p.tolist()) | set(q.tolist()))[:64])
        assert g == pytest.approx(len(low & set(p.tolist()) & set(q.tolist())) / max(len(low), 1))


def test_shingles_of_very_long_words():
    sets = minhash.shingle_sets(["a" * 70_000 + "b", "a" * 70_000 + "c", "", "A b", "a  B"])
    assert len(sets[0]) == 1 and sets[0][0] != sets[1][0] and not len(sets[2]) and sets[3][0] == sets[4][0]


# ---------------------------------------------------------- decontamination
def brute_contamination(rows, items, size=10):
    import re  # noqa: F401

    windows = {}
    for item, text in items:
        w = brute.words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(None if item is None else str(item))
    out = []
    for d, text in rows:
        w = brute.words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        found.discard(None)
        out.append((d, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return out


def test_contamination_matches_brute(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("q", F.lit(1)).withColumn("window", F.lit("x"))
    got = rows_of(decontam.contamination(documents(spark), items).drop("text_hash"))
    assert got == sorted(brute_contamination(odd_rows(), ITEMS), key=str)


def test_phrases_and_proximity(spark):
    docs = documents(spark, [(1, "a b c x a c b y a a b"), (2, "b a")])
    q = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", "b", "a"]), (3, ["a", "a"])], "q long, window array<string>")
    index = decontam.build_index(docs, q.select(F.explode("window")))
    of = index.ids.select("row", "doc_id")
    got = rows_of(decontam.phrase_matches(index, q).join(of, "row").select("q", "doc_id", "start"))
    assert got == [(1, 1, 0), (1, 1, 9), (3, 1, 8)]
    near = rows_of(decontam.proximity_matches(index, q.where("q = 2"), 3).join(of, "row").select("doc_id", "start"))
    assert near == [(1, 0), (1, 4)]


def test_index_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "VOCABULARY_BROADCAST", 0)
    monkeypatch.setattr(decontam, "ROWS_BROADCAST", 0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows_of(decontam.contamination(documents(spark), items).drop("text_hash"))
    assert got == sorted(brute_contamination(odd_rows(), ITEMS), key=str)


# ------------------------------------------------------------- license scan
def brute_scan(text, templates=license_scan.TEMPLATES, names=license_scan.NAMES, threshold=0.8):
    """Every run of 2 n words, for a template of n words, is a block (a shorter
    text is one); it holds the template if it has the share of its distinct
    words and, in order, the words that name the license."""
    w = brute.words(text)
    places = [(i, lab) for p, lab in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    labels, best = set(), 0.0
    for lab, t in templates:
        own = brute.words(t)
        if not own:
            continue
        need, width = set(own), 2 * len(own)
        for i in range(len(w)):
            block = w[i : i + width]
            share = len(need & set(block)) / len(need)
            if share >= threshold - 1e-9 and re.search(names.get(t, ""), " " + " ".join(block) + " "):
                labels.add(lab)
                best = max(best, share)
    base, at = {lab for _, lab in places}, [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else best)


def distorted(seed: int, n: int) -> list[tuple]:
    """Templates with words left out, changed, spread out, wrapped or cut."""
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        out = []
        for _ in range(rng.randrange(1, 3)):
            words = rng.choice(license_scan.TEMPLATES)[1].split()
            loss, gap = rng.choice([0, 0.05, 0.15, 0.3]), rng.choice([0, 0.1, 0.6])
            for x in words:
                if rng.random() < loss:
                    x = rng.choice(["", "other", "2", "3", "mit", "the"])
                out.append(x.upper() if rng.random() < 0.1 else x)
                if rng.random() < gap:
                    out.append(rng.choice(["\n", "some", "license", "\n\n // ", "words"]))
            out += ["filler"] * rng.randrange(4)
        rows.append((d, " ".join(out)))
    return rows


def test_licenses_of_distorted_templates(spark):
    rows = distorted(1, 250)
    got = rows_of(license_scan.summary(license_scan.scan_licenses(documents(spark, rows))))
    want = sorted([(d, *brute_scan(t)) for d, t in rows], key=str)
    assert got == want
    assert 50 < sum(bool(r[-2]) for r in want) < 250


@pytest.mark.parametrize("source", ["odd", "table"])
def test_licenses_match_brute(spark, source):
    if source == "odd":
        more = [
            (30, "mit license mit license cc  by CC, BY"),
            (31, "This work, licensed under Creative Commons: an Attribution 4.0 International work"),
            (32, "mit\nlicense gnu general public"),
            (33, license_scan.TEMPLATES[6][1][:70]),
        ]
        rows = odd_rows() + more
        got = rows_of(license_scan.summary(license_scan.scan_licenses(documents(spark, rows))))
    else:
        rows, got = small_documents(), rows_of(queries.q_license_scan(spark, SF))
    assert got == sorted([(d, *brute_scan(t)) for d, t in rows], key=str)


WRAPPED = {
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:

1. Redistributions of source code must retain the above notice.""",
    "mit-notice": """Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction""",
    "gpl-3.0": """    # This program is free software: you can redistribute it and/or modify
    # it under the terms of the GNU General Public License as published by
    # the Free Software Foundation, either version 3 of the License, or
    # (at your option) any later version.""",
    "apache-2.0": """ * Licensed under the Apache
 * License,
 *
 * Version 2.0""",
}


def test_licenses_over_line_breaks(spark):
    """A notice in its wrapped layout, anywhere in a long text."""
    rows, expected = [], {}
    for label, notice in WRAPPED.items():
        for n in (0, 1, 230, 250, 256, 300, 5000):
            rows.append((len(rows), f"{'word ' * n}\n\n{notice}\n{'more ' * n}"))
            expected[len(rows) - 1] = [label]
    got = license_scan.scan_licenses(documents(spark, rows))
    assert {r["doc_id"]: r["found"] for r in got.collect()} == expected
    assert {r["containment"] for r in got.collect()} == {1.0}


def test_licenses_not_in_scattered_words(spark):
    """A block is at most twice as long as its template."""
    long = license_scan.TEMPLATES[2][1].split()
    rows = [(1, " x y z ".join(long)), (2, "released " + "a " * 20 + "under the old license"), (3, " x ".join(long[:20]))]
    got = license_scan.scan_licenses(documents(spark, rows))
    assert {r["doc_id"]: r["found"] for r in got.collect()} == {1: [], 2: [], 3: ["bsd"]}


OTHERS = [
    "Released under the BSD License.",
    "Licensed under the Mozilla Public License, Version 2.0",
    "Licensed under the Apache License, Version 1.1",
    "This work is licensed under the GNU General Public License, version 2",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License\n"
    "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License\n"
    "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under CC BY 4.0",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "This was released under pressure of the press, with no license",
]


def test_other_licenses_have_no_label(spark):
    """The words that name a license or its version must be there."""
    rows = list(enumerate(OTHERS)) + [(100, "Released under an MIT License"), (101, "This work is licensed under the GNU General Public License v3")]
    got = {r["doc_id"]: r["found"] for r in license_scan.scan_licenses(documents(spark, rows)).collect()}
    assert got == {**{i: [] for i in range(len(OTHERS))}, 100: ["mit-notice"], 101: ["gpl-3.0"]}


def test_no_templates(spark):
    got = license_scan.summary(license_scan.scan_licenses(documents(spark), templates=()))
    assert {r["labels"] for r in got.collect()} == {r["base_labels"] for r in got.collect()}


# -------------------------------------------------------------- empty tables
def test_empty_tables(spark):
    none = documents(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.drop_repeated_lines(none, ["doc_id"]).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert decontam.contamination(none, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    got = decontam.contamination(documents(spark), items)
    assert got.count() == len(odd_rows()) and got.where("contaminated or n_hit > 0").count() == 0


def test_hot_line_is_one_row_per_document(spark):
    rows = [(i, LINE) for i in range(200)]
    got = line_dedup.drop_repeated_lines(documents(spark, rows), ["doc_id"]).where("n_dropped = 0").select("row.doc_id")
    assert rows_of(got) == [(199,)]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.select(*cols)) == sorted(res.fetchall(), key=str)


def test_odd_sketch_bounds_the_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (0, 5, 100, 3000):
        u = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        x, y = u[rng.random(n) < 0.8], u[rng.random(n) < 0.8]
        bits = minhash.odd_sketch(x) ^ minhash.odd_sketch(y)
        assert len(bits) == len(minhash.ODD)
        assert sum(int(b & (2**64 - 1)).bit_count() for b in bits.tolist()) <= len(np.setxor1d(x, y))


def test_near_without_broadcasts(spark, monkeypatch):
    from gridpull.llm import common

    monkeypatch.setattr(minhash, "NAMES_BROADCAST", -1)
    monkeypatch.setattr(minhash, "broadcast_below", lambda df, rows: df)
    monkeypatch.setattr(common, "ROWS_A_PART", 1)
    got = rows_of(minhash.near_duplicates(documents(spark)).select("doc_id", "n_shingles", "component_id", "kept"))
    assert got == sorted(brute.near(odd_rows()), key=str)


def test_sets_that_can_link_with_nothing_leave_the_lists(spark, monkeypatch):
    """Texts that share 70 % of their words and reach 0.85 with none: no pair
    of theirs is even compared; near copies in the same lists are found."""
    kept, stored = {}, minhash.stored

    def watch(df, name, *a):
        out = stored(df, name, *a)
        kept.setdefault(name, out)
        return out

    monkeypatch.setattr(minhash, "stored", watch)
    common = " ".join(f"c{i}" for i in range(700))
    text = lambda k: common + " " + " ".join(f"own{k}x{i}" for i in range(300))
    rows = [(k, text(k)) for k in range(20)] + [(100, text(100)), (101, text(100).replace("own100x7 ", "y "))]
    got = rows_of(minhash.near_duplicates(documents(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept"))
    assert got == sorted(brute.near(rows), key=str)
    assert kept["shared-lists"].agg(F.max("size")).first()[0] > 2
    assert kept["entries"].select("x.node").distinct().count() == 2
