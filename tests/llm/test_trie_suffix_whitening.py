"""The prefix trie, suffix arrays and whitening against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpull.llm import prefix_trie, queries_more, suffix_dedup, whitening
from gridpull.llm.common import read_table

from .cases import SF, documents, odd_rows, rows_of

EMPTY = hashlib.sha256(b"").hexdigest()


# --- prefix trie -------------------------------------------------------------


def brute_trie(rows, rebuild: bool) -> list[tuple]:
    """rows: (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    seq = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda v: v[:2])] for c, v in own.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in seq}
        seq = {c: seq.get(c - int(np.fmod(c, 5)), [])[: h[c]] + v[h[c] :] for c, v in seq.items()}
    members = defaultdict(list)
    for c, v in seq.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(set)
    for k in members:
        if k:
            kids[k[:-1]].add(k)
    out = []
    for k, m in members.items():
        below = [v for v in members if v[: len(k)] == k]
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in below if v)
        ends = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(k))))
        leaves = sum(not kids[v] for v in below)
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


KINDS = "conv_id long, turn long, role string, text string, conv long, k long, n long, `id` string"


def turns(spark, rows):
    """With more columns, whose names clash with internal ones."""
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], KINDS).repartition(3)


def odd_turns() -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for c in [*range(-7, 40), 1000]:
        if c % 11 == 3:
            continue
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t if t else None, rng.choice(["user", "", None]), rng.choice(["a", "bé", None, "a long text " * 9])))
    rows += [(2, 3, "user", "again"), (2, 3, "user", "again")]  # repeated rows
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(60, 0, "1:", "x"), (61, 0, "1", ":x"), (65, 0, "user", "y" * 300_000)]
    return rows


@pytest.mark.parametrize("piece", [1024, 3])
def test_trie_matches_brute(spark, piece, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "ENDS_ROW", 2)
    rows = [r for r in odd_turns()]
    c = F.col("conv")
    got = prefix_trie.conversation_trie(turns(spark, rows), base=c - c % 5, head=F.crc32(c.cast("string").cast("binary")) % 9)
    # turns of one place follow by digest; here they are equal
    assert rows_of(got) == brute_trie(rows, True)


def test_trie_without_rebuilding(spark):
    rows = odd_turns()
    assert rows_of(prefix_trie.conversation_trie(turns(spark, rows))) == brute_trie(rows, False)


def test_trie_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 16)
    rows = [(c, t, "user", f"t{t if t < 90 + c else -t}") for c in range(3) for t in range(120)]
    assert rows_of(prefix_trie.conversation_trie(turns(spark, rows))) == brute_trie(rows, False)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(turns(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(turns(spark, [(None, 1, "a", "b")])).count() == 0


def test_trie_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries_more.q_prefix_trie(spark, SF)) == brute_trie(rows, True)


def test_radix_tree_grows_through_all_layouts():
    rng = random.Random(1)
    keys = {bytes(rng.randrange(256) for _ in range(rng.randrange(4))) for _ in range(3000)}
    keys |= {bytes([7, i]) for i in range(30)}
    tree = prefix_trie.RadixTree(lambda a, b: a + b)
    for k in [*keys, *keys]:
        tree.insert(k, 1)
    stack, kinds, found = [(tree.root, b"")], set(), {}
    while stack:
        node, key = stack.pop()
        key += node.path
        kinds.add(node.kind)
        if node.here is not None:
            found[key] = node.here
        for kid in node.children():
            assert node.child(kid.path[0]) is kid
            stack.append((kid, key))
    assert found == dict.fromkeys(keys, 2)
    assert kinds == {4, 16, 48, 256}
    *_, (_, _, total) = tree.walk()
    assert total == 2 * len(keys)


# --- suffix arrays -----------------------------------------------------------


def brute_repeats(rows, size: int, keep: str) -> list[tuple]:
    """(doc, kept, spans) of rows (doc, text); for keep="first" with distinct
    ids."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    order = sorted(range(len(raw)), key=lambda i: (raw[i][0] is None, raw[i][0] or 0))
    n, seen = defaultdict(int), set()
    for _, x in raw:
        for i in range(len(x) - size + 1):
            n[x[i : i + size]] += 1
    out = []
    for i in order:
        d, x = raw[i]
        gone = np.zeros(len(x), bool)
        for j in range(len(x) - size + 1):
            w = x[j : j + size]
            if n[w] > 1 and (keep == "none" or w in seen):
                gone[j : j + size] = True
            seen.add(w)
        edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        out.append((d, bytes(np.frombuffer(x, np.uint8)[~gone]), list(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    return sorted(out, key=str)


def cut(df, **how) -> list[tuple]:
    got = suffix_dedup.remove_repeats(df, ["doc_id", "a.b", "key"], **how).select("row.doc_id", "kept", "n_bytes", "spans").collect()
    assert all(r["n_bytes"] == len(r["kept"]) + sum(s["end"] - s["start"] for s in r["spans"]) for r in got)
    return sorted([(r["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in got], key=str)


def passages(seed: int) -> list[tuple]:
    """Texts made of shared and changed passages, some periodic."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé ", k=rng.randrange(1, 7))) for _ in range(40)]
    pool = ["".join(rng.choices(words, k=rng.randrange(10, 90))) for _ in range(8)] + ["ab" * 150, "z" * 250]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = list(rng.choice(pool)) if rng.random() < 0.7 else rng.choices(words, k=30)
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "#"
            parts.append("".join(p))
        rows.append((d, "".join(parts)))
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("limits", [{}, {"GROUP_FRAGMENTS": 1}, {"PENDING_ROWS": 3, "PIECE_BYTES": 64, "BLOCK_BYTES": 600}])
def test_repeats_match_brute(spark, keep, limits, monkeypatch):
    for k, v in limits.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = passages(len(limits))
    assert cut(documents(spark, rows), min_bytes=90, keep=keep) == brute_repeats(rows, 90, keep)


def test_repeats_of_odd_rows(spark):
    rows = odd_rows()
    assert cut(documents(spark, rows), keep="none") == brute_repeats(rows, 200, "none")


def test_repeats_of_an_empty_table(spark):
    assert cut(documents(spark, []).limit(0)) == []
    assert cut(documents(spark, [(1, None), (2, ""), (None, None)])) == sorted([(1, b"", []), (2, b"", []), (None, b"", [])], key=str)


def test_repeats_refuse_short_strings(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, []), ["doc_id"], min_bytes=20)


def test_suffix_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = [(d, len((t or "").encode())) for d, t in rows]
    sizes = dict(want)
    brute = [(d, sizes[d], sizes[d] - len(k), len(s), hashlib.sha256(k).hexdigest()) for d, k, s in brute_repeats(rows, 200, "none")]
    assert rows_of(queries_more.q_suffix_dedup(spark, SF)) == sorted(brute, key=str)


def test_longest_previous_factors():
    rng = random.Random(3)
    for _ in range(30):
        data = bytes(rng.choices(b"ab", k=rng.randrange(2, 120)))
        order = suffix_dedup.SuffixOrder(data, 24)
        at = np.arange(len(data))
        sa = np.argsort(order.ranks(at), kind="stable")
        got = dict(zip(sa.tolist(), suffix_dedup.previous_factors(order, sa, sa).tolist()))
        for i in at:
            best = max((next((k for k in range(24) if data[i + k : i + k + 1] != data[j + k : j + k + 1] or i + k >= len(data)), 24) for j in range(i)), default=0)
            # behind the end stand zero bytes, which no text of this test holds
            assert min(got[i], len(data) - i) == best, (data, i)


# --- whitening ---------------------------------------------------------------


def vectors(spark, rows):
    kinds = "vec_id long, embedding array<double>, label int, id long, x string, d int, n int, component string"
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 3, "c") for i, v in rows], kinds).repartition(3)


def check_whitened(rows, got, scale=256.0):
    keep = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(scale * np.array([v for _, v in keep])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    assert len(got) == len(keep) * len(values)
    deviation = sorted((i is None, i or 0, int(v)) for (i, _), v in zip(keep, ((n * x - s) ** 2).sum(axis=1)))
    for k, e in enumerate(values):
        mine = [r for r in got if r["component"] == k + 1]
        assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]) for r in mine) == deviation
        assert all(r["n"] == n and abs(r["explained"] - e / np.trace(cov)) < 1e-9 and r["identity_error"] < 1e-9 for r in mine)
        want = ((x - s / n) @ axes[:, k]) / np.sqrt(e)
        have = {r["vec_id"]: r["whitened"] for r in mine}
        pairs = np.array([(have[i], w) for (i, _), w in zip(keep, want) if i is not None])
        sign = np.sign((pairs[:, 0] * pairs[:, 1]).sum())
        assert np.abs(pairs[:, 0] * sign - pairs[:, 1]).max() < 1e-9


def test_whitening_matches_eigh(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[1][1]), (301, None), (302, [None] * 6), (303, [float("nan")] + [1.0] * 5)]
    rows += [(304, [float("inf")] + [1.0] * 5), (305, [])]
    check_whitened(rows, whitening.whiten(vectors(spark, rows)).collect())


def test_whitening_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    check_whitened(rows, queries_more.q_whitening(spark, SF).collect())


def test_whitening_degenerate(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in sorted(one)] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, [4.0])])).collect()
    by = {(r["vec_id"], r["component"]): r for r in flat}
    assert set(by) == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)}  # dimensions are whitened apart
    assert by[1, 2]["whitened"] is None and by[1, 2]["explained"] == 0 and by[1, 1]["identity_error"] < 1e-12
    assert abs(by[1, 1]["whitened"]) == pytest.approx(1)
    far = whitening.whiten(vectors(spark, [(1, [1e300]), (2, [3e15]), (3, [-3e15])])).collect()
    assert [(r["vec_id"], r["deviation"]) for r in sorted(far)] == [(2, None), (3, None)]  # beyond a long


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 2, 2, 1], [3, 3 - 1e-9, 2, 2 + 1e-12, 1], [1] * 5, [1e6, 1e-3, 1e-3, 1e-3 * (1 + 1e-7), 0]])
def test_refinement_of_clusters(values):
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(5, 5)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.eigen(a)
    assert np.abs(v.T @ v - np.eye(5)).max() < 1e-14
    assert np.abs(a @ v - v * e).max() < 1e-14 * max(values)
    assert (np.diff(e) <= 0).all()
