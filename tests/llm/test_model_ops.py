"""Classifiers (held-out accuracy), embeddings and URL filters."""

from __future__ import annotations

import tempfile
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpull.llm import quality, queries, toxicity, url_filter, vector_dedup
from gridpull.llm.common import read_table

from . import brute
from .cases import SF, documents, odd_rows, rows_of

SF_LARGE = "/root/testdata/sf0.1"


# ------------------------------------------------------------- classifiers
def labelled(column):
    q = f"SELECT d.doc_id, d.text, l.{column} FROM '{SF_LARGE}/documents.parquet' d JOIN '{SF_LARGE}/labels.parquet' l USING (doc_id) ORDER BY 1"
    return duckdb.connect().execute(q).fetchall()


def held_out_rates(fit, column, held, scores):
    rows = labelled(column)
    train = [r for r in rows if not held(r[0])]
    test = [r for r in rows if held(r[0])]
    model = fit([r[1] for r in train], np.array([r[2] for r in train], float))
    said = scores(model, [r[1] for r in test]) >= 0.3
    y = np.array([r[2] for r in test]) == 1
    return said[y].mean(), said[~y].mean(), model


def test_toxicity_held_out():
    caught, wrong, model = held_out_rates(toxicity.fit, "toxic", lambda d: zlib.crc32(str(d).encode()) % 4 == 2, lambda m, t: m.scores(t, m.gate()))
    assert caught > 0.88 and wrong < 0.02
    # the whole text counts: an insult at the end of a long clean text, and pieces
    clean = "the quiet river runs along the old mill and over the stones " * 30_000
    bad = "you worthless idiot, pathetic stupid loser and moron, disgusting trash clown "
    s = model.scores([clean, clean + bad, bad + clean, ""], model.gate())
    assert s[0] < 0.3 and s[1] > 0.5 and s[1] == pytest.approx(s[2], abs=0.2)


def test_pieces_do_not_change_scores(monkeypatch):
    rows = labelled("toxic")[:300]
    model = toxicity.fit([r[1] for r in rows], np.array([r[2] for r in rows], float))
    texts = [r[1] for r in rows[:40]] + ["", "x"]
    whole = model.scores(texts, model.gate())
    monkeypatch.setattr(toxicity, "PIECE", 37)
    assert np.allclose(whole, model.scores(texts, model.gate()))


def test_scores_hold_few_texts_as_codes():
    import tracemalloc

    rows = labelled("toxic")[:300]
    model = toxicity.fit([r[1] for r in rows], np.array([r[2] for r in rows], float))
    text = " ".join(r[1] for r in rows).encode("ascii", "replace").decode()
    for texts in ([r[1] for r in rows] * (8_000_000 // len(text)), [text * (8_000_000 // len(text))]):
        tracemalloc.start()
        model.scores(texts, model.gate())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 50e6  # as codes, all are 64 MB


def test_training_sample_reads_texts_thrice(spark):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(400)] + [(5, None), (None, "x")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 400, 2)], "doc_id long, toxic int")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    schema = "doc_id long, text string"
    docs = spark.createDataFrame(rows, schema).mapInArrow(count, schema)
    held = toxicity.bucket(F.col("id"), 4) == 2
    texts, y, share = toxicity.training_sample(docs, labels, "toxic", held, 30, 60, max_total_chars=900)
    assert 0 < read.value <= 3 * len(rows)  # lengths, and each label's texts
    ok = {i: t for i, t in rows[:400] if len(t) <= 60 and zlib.crc32(str(i).encode()) % 4 != 2}
    for label in (0, 1):
        own = [t for t, k in zip(texts, y) if k == label]
        assert 0 < len(own) <= 30 and sum(map(len, own)) <= 900 and set(own) <= {t for i, t in ok.items() if i % 2 == 0 and (i % 3 == 0) == label}
    every = [i for i in range(0, 400, 2) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert share == pytest.approx(sum(i % 3 == 0 for i in every) / len(every))


def test_quality_held_out(monkeypatch):
    caught, wrong, model = held_out_rates(quality.fit, "quality", lambda d: zlib.crc32(str(d).encode()) % 5 == 0, lambda m, t: m.scores(t))
    assert caught > 0.97 and wrong < 0.15
    texts = [r[1] for r in labelled("quality")[:60]] + ["", "x"]
    whole = model.scores(texts)
    monkeypatch.setattr(quality, "PIECE", quality.HALF * 4)
    assert np.allclose(whole, model.scores(texts), atol=1e-5)


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    raw = [rng.integers(32, 122, n).astype(np.uint8).tobytes() for n in (5, 300, 900, 0)]
    y = np.array([1.0, 0, 1, 0])
    m = quality.ConvModel(rng.normal(size=(128, 4)), rng.normal(size=4), rng.normal(size=8), 0.1)

    def loss():
        halves, n = quality.half_maxima(m, raw)
        mean, top, _ = quality.pool(halves, n)
        z = m.logit(mean, top)
        return (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y).mean() + 5e-4 * (m.dense**2).sum()

    grads = quality._gradients(m, raw, y)
    for p, g in ((m.filters, grads[0]), (m.shift, grads[1]), (m.dense, grads[2])):
        flat, want = p.reshape(-1), np.asarray(g).reshape(-1)
        for i in rng.choice(len(flat), 4, replace=False):
            old, step = flat[i], 1e-4
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert (up - down) / (2 * step) == pytest.approx(want[i], abs=2e-3)


@pytest.mark.parametrize("op", [toxicity.toxicity, quality.quality])
def test_classifier_rows(spark, op):
    column = "toxic" if op is toxicity.toxicity else "quality"
    rows = odd_rows()
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (6, 0), (None, 1), (9, None), (14, 1), (15, 0), (99, 1)], f"doc_id long, {column} int")
    got = op(documents(spark), labels.withColumn("y", F.lit(3)))
    assert got.schema["score"].dataType.simpleString() == "double"
    out = got.select("row.doc_id", "t", "held_out", "score", "predicted").collect()
    assert sorted([(r[0], r[1]) for r in out], key=str) == sorted(rows, key=str)
    n, k = (4, 2) if column == "toxic" else (5, 0)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % n == k)
    none = spark.createDataFrame([], f"doc_id long, {column} int")
    assert op(documents(spark), none).where("predicted = 1").count() == 0
    assert op(documents(spark, []), labels).count() == 0


def test_labels_never_leak(spark):
    """Held-out labels do not change the model."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = toxicity.bucket(F.col("doc_id"), 4) == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = rows_of(toxicity.toxicity(docs, labels).select("row.doc_id", "score"))
    assert a == rows_of(toxicity.toxicity(docs, turned).select("row.doc_id", "score"))


# -------------------------------------------------------------- embeddings
def vectors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 64))
    label = rng.integers(0, 3, 900).tolist()
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(150):  # near copies around the threshold
        x[i + 300] = x[i] + rng.normal(size=64) * rng.uniform(0.02, 0.07)
        label[i + 300] = label[i]
    for i in range(80):
        x[i + 600], label[i + 600] = x[599] + rng.normal(size=64) * 0.03, 1
    for i in range(60):
        x[i + 750], label[i + 750] = x[749], 2
    e = [v.tolist() for v in x]
    e += [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [1.0, None], [1.0, 2.0], [2.0, 4.0], e[0], e[0], [1e-200] * 64, [2e200] * 64]
    label += [1, 1, 1, 1, 1, 1, 1, 1, None, label[0], 0, 0]
    return list(range(len(e))), e, label


def brute_links(ids, e, label, cosine=0.93):
    groups, links, n = {}, [], dict.fromkeys(ids, 0)
    for i in ids:
        if label[i] is not None and e[i] and all(v is not None and np.isfinite(v) for v in e[i]) and any(e[i]):
            groups.setdefault((label[i], len(e[i])), []).append(i)
    for own in groups.values():
        a = np.array([np.array(e[i]) / max(map(abs, e[i])) for i in own])
        a /= np.linalg.norm(a, axis=1)[:, None]
        for p, q in zip(*np.nonzero(np.triu(a @ a.T >= cosine, 1))):
            links.append((own[p], own[q]))
            n[own[p]] += 1
            n[own[q]] += 1
    comp = brute.components(ids, links)
    return sorted(((i, n[i], comp[i], comp[i] == i) for i in ids), key=str)


@pytest.mark.parametrize("homes,grid,block", [(4096, 1, 16), (10, 2, 16), (4096, 3, 8)])
def test_embeddings_match_brute(spark, monkeypatch, homes, grid, block):
    monkeypatch.setattr(vector_dedup, "CELL_HOMES", homes)
    ids, e, label = vectors()
    df = spark.createDataFrame(list(zip(ids, e, label)), "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("id", F.lit(2))
    got = rows_of(vector_dedup.embedding_duplicates(df, grid_dims=grid, block_dims=block))
    assert got == brute_links(ids, e, label)


def test_embeddings_of_repeated_ids(spark):
    """An id under two labels, near vectors under one id, copies of one row."""
    rng = np.random.default_rng(9)
    ids, e, label = vectors()
    ids = [i if rng.random() < 0.5 else int(rng.integers(0, 40)) for i in ids]
    rows = brute_links(list(range(len(ids))), e, label)
    by_row = {r[0]: r for r in rows}
    low: dict[int, int] = {}
    for k, i in enumerate(ids):
        c = by_row[k][2]
        low[c] = min(i, low.get(c, i))
    want = sorted(((i, by_row[k][1], low[by_row[k][2]], low[by_row[k][2]] == i) for k, i in enumerate(ids)), key=str)
    df = spark.createDataFrame(list(zip(ids, e, label)), "vec_id long, embedding array<double>, label int")
    assert rows_of(vector_dedup.embedding_duplicates(df)) == want
    a, b = [1.0, 0.0], [0.0, 1.0]
    few = [(10, a, 1), (10, b, 2), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 2), (7, a, 3), (7, [1.0, 0.02], 3)]
    got = rows_of(vector_dedup.embedding_duplicates(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int")))
    assert got == sorted([(10, 1, 2, False), (10, 1, 3, False), (2, 1, 2, True), (3, 1, 3, True), (7, 1, 7, True), (7, 1, 7, True)], key=str)


def test_embedding_query(spark):
    """The query, over a table with planted copies."""
    rows = [tuple(r) for r in read_table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    near = [(10_000 + i, [x * 1.5 + 0.001 * (j % 3) for j, x in enumerate(v)], lab) for i, v, lab in rows[::5]]
    folder = tempfile.mkdtemp(prefix="gridpull-test-", dir="/tmp")
    every = rows + near
    spark.createDataFrame(every, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    every = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, e, label = map(list, zip(*every))
    by_row = brute_links(list(range(len(ids))), e, label)
    name = {c: min(ids[k] for k, _, own, _ in by_row if own == c) for c in {r[2] for r in by_row}}
    want = sorted(((ids[k], n, name[c], name[c] == ids[k]) for k, n, c, _ in by_row), key=str)
    assert sum(r[1] for r in want) >= 2 * len(near)
    assert rows_of(queries.q_embedding_dedup(spark, folder)) == want


def test_embedding_rows(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]
    got = rows_of(vector_dedup.embedding_duplicates(spark.createDataFrame(rows, kind)))
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)], key=str)
    assert vector_dedup.embedding_duplicates(spark.createDataFrame([], kind)).count() == 0


# -------------------------------------------------------------- URL filters
def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("host"), F.col("id")).alias("key"))
    listed = universe.where("pmod(xxhash64(key), 7) = 0")
    c = url_filter.build_cascade(universe, listed.unionByName(listed), bits_per_key=3, hashes=2)
    assert len(c.levels) > 3
    got = url_filter.listed_column(universe.withColumn("h", F.lit(1)), F.col("key"), c)
    assert got.where("listed <> (pmod(xxhash64(row.key), 7) = 0)").count() == 0
    with pytest.raises(ValueError):
        url_filter.build_cascade(universe, listed, max_bytes=8)


def test_cascades_of_a_long_list(spark):
    """Beyond ``max_bytes`` the keys are dealt to shards; membership stays exact."""
    universe = spark.range(5000).select(F.concat(F.lit("host"), F.col("id")).alias("key"))
    listed = universe.where("pmod(xxhash64(key), 3) = 0")
    cascades = url_filter.build_cascades(universe, listed, max_bytes=700)
    assert len(cascades) > 3
    got = url_filter.listed_column(universe.unionByName(universe), F.col("key"), cascades)
    assert got.count() == 10_000
    assert got.where("listed <> (pmod(xxhash64(row.key), 3) = 0)").count() == 0


def test_urls(spark):
    urls = {
        1: "HTTP://WWW.Example.ORG/es/1?x=://y/",
        2: "https://example.org/en/17#a",
        3: "http://badexample.org/es/",
        4: "x://COM/fr/é",
        5: "http://a.com/de",
        6: "//nothing",
        7: None,
        8: "",
        9: "http://?q",
        10: "http://spam-farm.net/a\nb?c",
        11: "http://spam-farm.net/A",
    }
    pages = spark.createDataFrame(list(urls.items()) + [(None, urls[5]), (2, urls[2])], "page_id long, url string").withColumn("host", F.lit("x"))
    listed = spark.createDataFrame([("spam-farm.net/a\nb",), (None,), ("",)], "key string")
    got = {r[0]: tuple(r)[1:] for r in url_filter.judge_urls(pages, listed).collect()}
    assert got[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[3] == ("badexample.org", "/es/", "org/", "allow")
    assert got[4] == ("com", "/fr/é", "com/fr/", "allow")
    assert got[5] == ("a.com", "/de", None, "allow")
    assert got[6] == got[7] == got[8] == got[9] == ("", "", None, "block")
    assert got[10] == ("spam-farm.net", "/a\nb", None, "block")
    assert got[11] == ("spam-farm.net", "/A", None, "allow")
    assert url_filter.judge_urls(pages, listed).count() == 13
    none = spark.createDataFrame([], "key string")
    assert url_filter.judge_urls(pages, none).where("verdict = 'block'").count() == 3
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0
