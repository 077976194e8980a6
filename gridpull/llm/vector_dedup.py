"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine >= c are at most sqrt(2 - 2c) apart. Rotated by a
fixed random orthogonal matrix and split into blocks of ``block_dims``, such a
pair is within its share of the squared distance, in proportion to the block's
dimensions, in at least one block. So each block is range-joined by itself: a
grid over its first ``grid_dims`` coordinates deals vectors to cells, every
vector stays in its home cell and visits the neighbouring cells that its range
touches, and a cell compares homes with homes and visitors in blocks. A pair
counts only in the first block that finds it, and only after its cosine is
computed exactly.

Equal vectors are one class with a count. Cells with many homes are split by
salt, visitors going to every part, so no task holds more than about
``CELL_HOMES`` homes. Cells send back link counts and a spanning forest of
their links, never the pairs.

Defined cases: rows with a null id, a null label, a null or empty vector, a
null or non-finite component or length zero link with nothing, and neither do
vectors of different dimensions; such a row is its own component (null for a
null id) and is kept. Rows that repeat an id are vectors of their own: with
one vector and label they are copies, and n_links counts rows; with others
they may lie in different components, which are named by their smallest id.
An empty table gives no rows. Other columns are not read, so their names may
be anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, stored
from .graph import connected_components

CELL_HOMES = 4096
SLACK = 1e-9  # of squared distance, against rounding of the rotation


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def blocks_of(d: int, cosine: float, block_dims: int) -> list[tuple[int, int, float]]:
    """(first, end, squared range) of each block."""
    k = max(1, round(d / block_dims))
    cuts = np.linspace(0, d, k + 1).astype(int).tolist()
    return [(a, b, (2 - 2 * cosine) * (b - a) / d + SLACK) for a, b in zip(cuts, cuts[1:])]


def _unit_rows(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(id, digest, label, u): digest and the rotated unit vector are null
    where the row links with nothing."""
    base = vectors.select(
        vectors[vec_id].cast("long").alias("id"), vectors[label].cast("string").alias("label"), vectors[embedding].cast("array<double>").alias("e")
    )

    def run(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa

        turn: dict[int, np.ndarray] = {}
        for b in batches:
            digest, unit = [], []
            e = b.column("e")
            for i, (key, lab) in enumerate(zip(b.column("id").to_pylist(), b.column("label").to_pylist())):
                v = e[i].values
                x = None if v is None or v.null_count or not len(v) else v.to_numpy()
                big = 0.0 if x is None else np.abs(x).max()
                if key is None or lab is None or not 0 < big < np.inf:  # NaN fails too
                    digest.append(None)
                    unit.append(None)
                    continue
                x = x / big  # no overflow, no underflow
                d = len(x)
                if d not in turn:
                    turn[d] = rotation(d)
                digest.append(blake2b(f"{lab}\0{d}\0".encode() + v.to_numpy().tobytes(), digest_size=16).digest())
                unit.append((turn[d] @ (x / np.sqrt((x * x).sum()))).tobytes())
            cols = [b.column("id"), pa.array(digest, pa.binary()), b.column("label"), pa.array(unit, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "digest", "label", "u"])

    return base.mapInArrow(run, "id long, digest binary, label string, u binary")


def _cell_rows(nodes: DataFrame, cosine: float, block_dims: int, grid_dims: int) -> DataFrame:
    """(key, block, home, node, copies, u): the home row and the visits."""

    def run(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa

        for batch in batches:
            dims = np.array([len(x) for x in batch.column("u").to_pylist()]) // 8
            for d in np.unique(dims).tolist():
                b = batch.filter(pa.array(dims == d))
                u = np.frombuffer(b"".join(b.column("u").to_pylist())).reshape(-1, d)
                labels = [int.from_bytes(blake2b(f"{x}\0{d}".encode(), digest_size=8).digest(), "little") for x in b.column("label").to_pylist()]
                label = np.array(labels, np.uint64)
                for m, (lo, hi, r2) in enumerate(blocks_of(d, cosine, block_dims)):
                    r = np.sqrt(r2)
                    x = u[:, lo : min(hi, lo + grid_dims)] / (2 * r)
                    cell = np.floor(x).astype(np.int64)
                    part = x - cell  # in widths of 2 r
                    step = np.where(part < 0.5, -1, 1)
                    far = np.minimum(part, 1 - part) * 2  # to the nearer border, in r
                    for mask in range(1 << x.shape[1]):
                        pick = np.array([mask >> k & 1 for k in range(x.shape[1])])
                        at = np.flatnonzero((far * far * pick).sum(axis=1) <= 1 + SLACK)
                        if not len(at):
                            continue
                        key = label[at] + np.array([m + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                        for k in range(x.shape[1]):
                            c = (cell[at, k] + step[at, k] * pick[k]).astype(np.uint64)
                            key = (key ^ c) * np.uint64(0xBF58476D1CE4E5B9)
                            key ^= key >> np.uint64(29)
                        some = b.take(pa.array(at))
                        cols = [
                            pa.array(key.view(np.int64)),
                            pa.array(np.full(len(at), m, np.int32)),
                            pa.array(np.full(len(at), mask == 0)),
                            some.column("node"),
                            some.column("copies"),
                            some.column("u"),
                        ]
                        yield pa.RecordBatch.from_arrays(cols, ["key", "block", "home", "node", "copies", "u"])

    return nodes.mapInArrow(run, "key long, block int, home boolean, node long, copies long, u binary")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the edges a-b, for 0..n-1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links_in_cells(cells: DataFrame, cosine: float, block_dims: int) -> DataFrame:
    """(node, links, root): link counts, and a forest of the links found.
    ``cells`` is sorted by key and salt, homes first."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def compare(m: int, home, visit):
            """Links of homes with visitors of smaller id, or among homes."""
            hn, hc, hu = home
            vn, vc, vu = visit
            d = hu.shape[1]
            if vu.shape[1] != d:
                return
            blocks = blocks_of(d, cosine, block_dims)
            lo, hi, r2 = blocks[m]
            hx, vx = hu[:, lo:hi], vu[:, lo:hi]
            hs = (hx * hx).sum(axis=1)
            for at in range(0, len(vn), 1024):
                x = vx[at : at + 1024]
                near = (x * x).sum(axis=1)[:, None] + hs - 2 * (x @ hx.T) <= r2 + SLACK
                near &= vn[at : at + 1024, None] < hn
                i, j = np.nonzero(near)
                i += at
                for k in range(0, len(i), 1 << 16):
                    p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                    a, b = vu[p], hu[q]
                    ok = (a * b).sum(axis=1) >= cosine
                    p, q = p[ok], q[ok]
                    diff = a[ok] - b[ok]
                    diff *= diff
                    first = np.ones(len(p), bool)
                    for s, e, rr in blocks[:m]:
                        first &= diff[:, s:e].sum(axis=1) > rr
                    # the block's own range, by the same sums as above
                    first &= diff[:, lo:hi].sum(axis=1) <= r2
                    p, q = p[first], q[first]
                    if not len(p):
                        continue
                    ids, back = np.unique(np.concatenate((vn[p], hn[q])), return_inverse=True)
                    s, t = back[: len(p)], back[len(p) :]
                    count = np.bincount(s, hc[q], len(ids)) + np.bincount(t, vc[p], len(ids))
                    root = ids[_roots(len(ids), s, t)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count.astype(np.int64)), pa.array(root)], ["node", "links", "root"])

        def joined(parts):
            return tuple(np.concatenate(x) for x in zip(*parts))

        at, homes, done = None, [], False
        for b in batches:
            key, salt, block = (b.column(c).to_numpy() for c in ("key", "salt", "block"))
            home = b.column("home").to_numpy(zero_copy_only=False)
            node, copies = b.column("node").to_numpy(), b.column("copies").to_numpy()
            raw = b.column("u").to_pylist()
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            new = np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (home[1:] != home[:-1]) | (block[1:] != block[:-1]) | (size[1:] != size[:-1])]
            starts = np.flatnonzero(new).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(key)]):
                rows = (node[lo:hi], copies[lo:hi], np.frombuffer(b"".join(raw[lo:hi])).reshape(hi - lo, -1))
                now = (key[lo], salt[lo], block[lo], size[lo])
                if now != at:
                    if homes and not done:
                        whole = joined(homes)
                        yield from compare(int(at[2]), whole, whole)
                    at, homes, done = now, [], False
                if home[lo]:
                    homes.append(rows)
                elif homes:
                    if not done:
                        homes = [joined(homes)]
                        yield from compare(int(at[2]), homes[0], homes[0])
                        done = True
                    yield from compare(int(at[2]), homes[0], rows)
        if homes and not done:
            whole = joined(homes)
            yield from compare(int(at[2]), whole, whole)

    return cells.mapInArrow(run, "node long, links long, root long")


def embedding_duplicates(
    vectors: DataFrame,
    cosine: float = 0.93,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    block_dims: int = 16,
    grid_dims: int = 1,
) -> DataFrame:
    """(vec_id long, n_links long, component_id long, kept boolean), one row
    per input row. With one grid dimension a vector is two rows a block; take
    more where a block's coordinates spread over many ranges."""
    rows = stored(_unit_rows(vectors, vec_id, embedding, label), "unit-vectors")
    classes = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("low"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("u").alias("u"))
    )
    # A class has a number of its own, fixed by the table: one id may carry
    # several vectors.
    nodes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    cells = stored(_cell_rows(nodes, cosine, block_dims, grid_dims), "cells")
    large = cells.where("home").groupBy("key").agg(F.ceil(F.count("*") / CELL_HOMES).cast("int").alias("salts")).where("salts > 1")
    dealt = cells.join(broadcast_below(large, 100_000), "key", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")
    dealt = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("home", F.col("home") & (F.col("salt") == own))
    dealt = dealt.drop("salts").repartition("key", "salt").sortWithinPartitions("key", "salt", "block", F.octet_length("u"), F.desc("home"))
    found = stored(_links_in_cells(dealt, cosine, block_dims), "cell-links")
    comps = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = stored(
        nodes.select("digest", "node", "low", "copies")
        .join(links, "node", "left")
        .join(comps, "node", "left")
        .select("digest", "low", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "node").alias("comp")),
        "classes",
    )
    classes = classes.join(classes.groupBy("comp").agg(F.min("low").alias("c")), "comp").select("digest", "n", "c")
    return (
        rows.select("id", "digest")
        .join(classes, "digest", "left")
        .select(
            F.col("id").alias(vec_id),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("c", "id").alias("component_id"),
            (F.col("id").isNull() | (F.coalesce("c", "id") == F.col("id"))).alias("kept"),
        )
    )
