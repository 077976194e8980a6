"""BPE and token counts against the public library's encoder."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from gridpull.llm import bpe, queries, token_counts

from .brute import sha
from .cases import SF, documents, odd_rows, rows_of

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def model():
    return bpe.BpeModel(queries.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(queries.vocabulary_path())


def texts() -> list[str]:
    rows = duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    odd = ["", "a" * 5001, "aaa<|endoftext|>b <|endoftext|><|endoftext|>", " \n\n x  ", "日本語 😀😀", "I'll've '' 's", "\t\r\n  x", "x²½ ٣٤", "<|endo"]
    return [t for (t,) in rows] + odd + [t or "" for _, t in odd_rows()]


def test_ids_equal_the_library(model, library):
    every = texts()
    want = library.encode_batch(every, add_special_tokens=False)
    for t, got, ref in zip(every, bpe.encode_texts(model, every), want):
        assert got.tolist() == ref.ids
        assert bpe.decode_ids(model, ref.ids) == library.decode(ref.ids, skip_special_tokens=False) == t


def test_decode_of_broken_bytes(model, library):
    ids = bpe.encode_texts(model, ["😀"])[0].tolist()
    assert bpe.decode_ids(model, ids[:1]) == library.decode(ids[:1], skip_special_tokens=False)


def test_overlapping_pairs(model, library):
    runs = ["a" * n for n in range(1, 70)] + ["ab" * n for n in range(1, 40)] + [" " * n + "x" for n in range(1, 70)]
    want = library.encode_batch(runs, add_special_tokens=False)
    assert [x.tolist() for x in bpe.encode_texts(model, runs)] == [x.ids for x in want]


def test_digests(spark, model, library):
    got = rows_of(bpe.bpe_digests(documents(spark), model))
    want = []
    for d, t in odd_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)


def test_column_and_empty_table(spark, model, library):
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode_column(documents(spark, [(1, "a b"), (2, None)]), model, keep=("doc_id", "row")).collect()}
    assert got == {1: library.encode("a b").ids, 2: []}
    assert bpe.bpe_digests(documents(spark, []), model).count() == 0


def test_whole_table(spark, library):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = []
    for d, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows_of(queries.q_bpe(spark, SF)) == sorted(want, key=str)


# ------------------------------------------------------------- token counts
def test_edited_trees_equal_full_encoding(model):
    rnd, split = random.Random(3), bpe.splitter(model)
    known: dict[str, int] = {}

    def count(w):
        if w not in known:
            known.update(token_counts.count_tokens(model, [w]))
        return known[w]

    bits = ["", "'", "'re", " ", "  ", "\n", "x", "<|endoftext|>", "<|endo", "ftext|>", "12", "é !!", "\t\n a", "hello wor"]
    for text in texts()[-60:]:
        now = text[:2000]
        toks = split(now)
        tree = token_counts.TokenTree(toks, np.array([count(w) for w in toks], np.int64), split, 17)
        for _ in range(12):
            a = rnd.randint(0, len(now))
            b = min(len(now), a + rnd.choice([0, 0, 1, 2, 5, 60]))
            new = rnd.choice(bits)
            tree.edit(a, b, new)
            now = now[:a] + new + now[b:]
            assert [t for leaf in tree.leaves for t in leaf] == split(now)
        tree.settle(count)
        assert tree.n_tokens() == sum(map(count, split(now)))


def test_edit_reencodes_a_region(model):
    split = bpe.splitter(model)
    text = " ".join(f"word{i}" for i in range(20_000))
    toks = split(text)
    counts = token_counts.count_tokens(model, list(set(toks)))
    tree = token_counts.TokenTree(toks, np.array([counts[t] for t in toks]), split, 17)
    tree.edit(70_000, 70_005, "changed")
    assert 0 < tree.reencoded < 2_000
    assert tree.text() == text[:70_000] + "changed" + text[70_005:]


def test_large_insertions_split_leaves(model):
    """A long insertion is dealt to new leaves; later edits stay local."""
    split = bpe.splitter(model)
    count = lambda w: token_counts.count_tokens(model, [w])[w]
    toks = split("a short text of some words")
    tree = token_counts.TokenTree(toks, np.array([count(t) for t in toks]), split, 17)
    long = " ".join(f"w{i % 50}" for i in range(20_000))
    tree.edit(2, 2, long + " ")
    tree.edit(len(long) // 2, len(long) // 2, long[:3000])
    now = "a " + long + " short text of some words"
    now = now[: len(long) // 2] + long[:3000] + now[len(long) // 2 :]
    assert max(map(len, tree.leaves)) <= token_counts.FULL + token_counts.LEAF
    before = tree.reencoded
    for k in range(20):
        at = 4000 * k + 11
        tree.edit(at, at + 1, "é")
        now = now[:at] + "é" + now[at + 1 :]
    assert tree.reencoded - before < 20 * 6_000
    assert [t for leaf in tree.leaves for t in leaf] == split(now)
    known = token_counts.count_tokens(model, sorted(set(split(now))))
    tree.settle(known.__getitem__)
    assert tree.n_tokens() == sum(known[w] for w in split(now)) and tree.text() == now


def test_counts_of_an_empty_table(spark, model):
    kind = "doc_id long, text string, e array<struct<start:int,end:int,text:string>>"
    assert token_counts.count_after_edits(spark.createDataFrame([], kind), model, "e").count() == 0


def test_counts_with_an_edit_column(spark, model, library):
    kind = "doc_id long, text string, e array<struct<start:int,end:int,text:string>>, k int"
    rows = [
        (1, "hello world", [(0, 5, "bye"), (3, 3, " cruel")], 0),
        (2, None, [(0, 9, "x y")], 0),
        (3, "same", None, 0),
        (4, "", [], 0),
        (None, "abc", [(-5, 99, None)], 0),
        (5, "abc", [(9, 2, "!")], 0),
    ]
    got = rows_of(token_counts.count_after_edits(spark.createDataFrame(rows, kind), model, "e").drop("n_reencoded"))
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    after = {1: "bye cruel world", 2: "x y", 3: "same", 4: "", None: "", 5: "abc!"}
    assert got == sorted([(d, n(t or ""), len(e or []), n(after[d])) for d, t, e, _ in rows], key=str)


def test_query_counts(spark, library):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want, n = [], lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for d, t in rows:
        now = t
        edits = queries.contact_edits(t)
        for a, b, new in edits:
            now = now[:a] + new + now[b:]
        want.append((d, n(t), len(edits), n(now)))
    assert rows_of(queries.q_token_counts(spark, SF).drop("n_reencoded")) == sorted(want, key=str)
    assert sum(w[2] for w in want)
