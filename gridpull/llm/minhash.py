"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Every document's distinct word shingles are hashed once; the ``SKETCH``
   smallest hashes are its sketch. Documents with equal shingle sets form one
   class, and only class representatives go on.
2. Inverted lists of retained values generate the overlaps. Similar sets
   share at least ``least_overlap`` values of their sketches (the chance to
   share fewer at the threshold is below 1e-5), so it is enough to list each
   set under the first size - overlap + 1 of its values in one order, the
   globally rarest first (prefix filter). Values of one class need no list:
   most sets, and sets that share only a passage, drop out here.
3. Each set in a list carries how many of its members another listed set
   has (a set that shares too little of its own with all others together
   leaves the lists), and an odd sketch: ``ODD_BITS`` parity bits of its members. Both bound
   a pair exactly (``may_link``): it shares no more than the former, and
   differs in at least as many members as the parities differ in bits. So
   sets that all differ from one another by a little too much meet nowhere.
4. A list's members are paired with its leader first, the one with the fewest
   members of its own (the text that copies were made from). What is linked
   is contracted into components; then members outside their list's main
   component meet the others. So a group of near copies costs a multiple of
   its size instead of its square, and no pair that could join two components
   is left out. No list is capped.
5. Pairs are estimated by the union sketch, and those that remain are
   verified exactly on the full sets of shingle hashes (64 bit).

Defined cases: null or empty texts and texts without words have no shingles,
link with nothing and are their own component. Texts with fewer words than a
shingle are one shingle. Rows with a null id are compared with nothing: their
component is null and they are kept. Rows that repeat an id are each compared
by their own text. Texts of any length are one set each; an empty table gives
no rows; ties do not arise, as components are named by their smallest id.
Other columns are not read, so their names may be anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, in_blocks, stored, text_hash
from .graph import connected_components

WORDS = 5
SKETCH = 64
ODD_BITS = 1024
ODD = [f"o{i}" for i in range(ODD_BITS // 64)]
BLOCK_BYTES = 1 << 20
NAMES_BROADCAST = 500_000

_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


_POWERS = np.cumprod(np.full(1 << 16, _STEP))


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; words are runs of
    anything but blanks, A-Z lower-cased."""
    raw = [t.encode().lower() for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    word = ~blank
    start = np.flatnonzero(word & np.r_[True, blank[:-1]])
    none = np.zeros(0, np.uint64)
    if not len(start):
        return [none] * len(texts)
    end = np.flatnonzero(word & np.r_[blank[1:], True]) + 1
    # a word's hash: its bytes' values times the powers of one odd factor
    within = np.arange(len(buf)) - np.repeat(start, np.diff(np.r_[start, len(buf)]), axis=0) if start[0] == 0 else None
    if within is None:
        within = np.arange(len(buf)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(buf)]))
    value = _TABLE[buf] * _POWERS[within & 0xFFFF]
    far = within > 0xFFFF
    if far.any():  # bytes of a very long word: another factor for each 64 K
        value[far] *= _mix((within[far] >> 16).astype(np.uint64)) | np.uint64(1)
    value[blank] = 0
    wh = _mix(np.add.reduceat(value, start) + (end - start).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    first = np.searchsorted(start, np.r_[0, ends])  # words of text i: first[i]:first[i+1]
    n = len(wh) - words + 1
    sh = np.zeros(max(n, 0), np.uint64)
    for j in range(words):
        sh = sh * _NEXT + wh[j : j + max(n, 0)]
    sh = _mix(sh)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(sh[a : b - words + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in wh[a:b]:
                    h = h * _NEXT + x
            out.append(_mix(np.array([h])))
        else:
            out.append(none)
    return out


def estimates(x: list[bytes], y: list[bytes], k: int = SKETCH) -> np.ndarray:
    """Jaccard estimates from pairs of sorted bottom-k sketches: the share of
    the union's k smallest values that both hold."""
    rows = len(x)
    size = np.array([[len(p) // 8, len(q) // 8] for p, q in zip(x, y)]).reshape(rows, 2)
    v = np.full((rows, 2 * k), np.uint64(2**64 - 1))
    both = np.frombuffer(b"".join([p + q for p, q in zip(x, y)]), np.uint64)
    total = size.sum(axis=1)
    at = np.arange(len(both)) - np.repeat(np.cumsum(total) - total, total)
    v[np.repeat(np.arange(rows), total), at] = both
    v.sort(axis=1)
    real = np.arange(2 * k) < total[:, None]
    again = np.zeros_like(real)
    again[:, 1:] = (v[:, 1:] == v[:, :-1]) & real[:, 1:]
    taken = real & (np.cumsum(real & ~again, axis=1) <= k)
    # a value that both hold stands twice; its second copy is of the same rank
    return (again & taken).sum(axis=1) / np.maximum((taken & ~again).sum(axis=1), 1)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa

        for t in in_blocks(batches, BLOCK_BYTES):
            sets = shingle_sets(t.column("t").fill_null("").to_pylist(), words)
            cols = [
                t.column("d").combine_chunks(),
                t.column("h").combine_chunks(),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()),
            ]
            yield from pa.Table.from_arrays(cols, ["d", "h", "n", "digest", "sketch"]).to_batches()

    return docs.mapInArrow(run, "d long, h long, n long, digest binary, sketch binary")


def least_overlap(m: int, similarity: float) -> int:
    """Shared sketch values that similar sets have at least, for a sketch of
    ``m`` values: exact while both sets are their own sketches, else 4.5
    standard errors below the mean of the worst case, a set and its subset."""
    if m <= similarity * SKETCH:
        return int(np.ceil(similarity * m - 1e-9))
    share = similarity - 4.5 * (similarity * (1 - similarity) / SKETCH) ** 0.5
    return max(1, int(np.floor(share * m)))


def _list_entries(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, node, n): each node under the prefix of its shared values."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            sketch = [np.frombuffer(x, np.int64) for x in b.column("sketch").to_pylist()]
            if not sketch:
                continue
            m = np.array([len(x) for x in sketch])
            prefix = m - np.array([least_overlap(x, similarity) for x in m.tolist()]) + 1
            cols = [np.concatenate(sketch)] + [np.repeat(x, m) for x in (b.column("node").to_numpy(), b.column("n").to_numpy(), m, prefix)]
            yield from pa.Table.from_arrays(list(map(pa.array, cols)), ["value", "node", "n", "m", "prefix"]).to_batches(max_chunksize=50_000)

    # Sets of fewer members cannot reach the similarity without being equal.
    least = int(np.floor(similarity / (1 - similarity) + 1e-9))
    values = nodes.where(F.col("n") >= least).mapInArrow(run, "value long, node long, n long, m long, prefix long")
    shared = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared-values")
    mine = values.join(shared, "value").groupBy("node", "n", "m", "prefix").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))  # a sketch at most
    # values of this node alone come first in the order
    listed = mine.withColumn("take", F.col("prefix") - (F.col("m") - F.size("v"))).where("take > 0")
    return listed.select(F.explode(F.slice("v", F.lit(1), F.col("take").cast("int"))).alias("v"), "node", "n").select(F.col("v.value").alias("key"), "node", "n")


def _pairs_with(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b; a stored table) with ``column`` of both ends. Only the
    rows of ``side`` that some pair names are shuffled, while the names can be
    broadcast."""
    s = side.select(F.col("node"), F.col(column))
    names = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    if pairs.count() <= NAMES_BROADCAST:
        s = s.join(F.broadcast(names), "node", "left_semi")
    return pairs.join(s.toDF("a", "x"), "a").join(s.toDF("b", "y"), "b")


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity: first by the union
    sketch (five standard errors below), then exactly."""
    j = percent / 100
    least = j - 5 * (j * (1 - j) / SKETCH) ** 0.5

    def likely(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                keep = estimates(b.column("x").to_pylist(), b.column("y").to_pylist()) >= least
                yield b.select(["a", "b"]).filter(pa.array(keep))

    def exact(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            keep = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    some = stored(_pairs_with(pairs, nodes, "sketch").mapInArrow(likely, "a long, b long"), "likely-pairs")
    return stored(_pairs_with(some, sets, "members").mapInArrow(exact, "a long, b long"), "links")


def odd_sketch(members: np.ndarray) -> np.ndarray:
    """Parity bits of a set's members, as 64-bit numbers. The sketches of two
    sets differ in at most as many bits as the sets differ in members."""
    at = (_mix(members + _NEXT) >> np.uint64(54)).astype(np.int64)  # 10 bits: ODD_BITS
    return np.packbits((np.bincount(at, minlength=ODD_BITS) & 1).astype(np.uint8)).view(np.int64)


def _member_sets(words: int):
    """A task's rows (node, members) of the texts that are their class's."""

    def run(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa

        for t in in_blocks(batches, BLOCK_BYTES):
            sets = shingle_sets(t.column("t").fill_null("").to_pylist(), words)
            own = [blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, t.column("digest").to_pylist())]
            odd = np.array([odd_sketch(s) for s in sets])
            cols = [t.column("node"), pa.array([s.tobytes() for s in sets], pa.binary()), *map(pa.array, odd.T)]
            got = pa.Table.from_arrays(cols, ["node", "members", *ODD])
            yield from got.filter(pa.array(own, pa.bool_())).to_batches(max_chunksize=500)

    return run


def _each_member(batches: Iterator) -> Iterator:
    """(value, node) of every member of every set."""
    import pyarrow as pa

    for b in batches:
        for at in range(0, b.num_rows, 200):
            part = b.slice(at, 200)
            sets = [np.frombuffer(x, np.int64) for x in part.column("members").to_pylist()]
            node = np.repeat(part.column("node").to_numpy(), [len(x) for x in sets])
            yield from pa.Table.from_arrays([pa.array(np.concatenate(sets)), pa.array(node)], ["value", "node"]).to_batches(max_chunksize=50_000)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, words: int = WORDS
) -> DataFrame:
    """(doc_id long, text_hash long, n_shingles long, component_id long, kept
    boolean), one row per input row. Documents link where 100 * intersection
    >= ``percent`` * union of their shingle sets."""
    base = docs.select(docs[doc_id].cast("long").alias("d"), docs[text].alias("t"), text_hash(docs[text]).alias("h"))
    rows = stored(_signatures(base, words), "signatures")
    usable = rows.where("digest is not null and d is not null")
    classes = usable.groupBy("digest").agg(F.min("d").alias("low"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # a class's number is fixed by the table
    nodes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "low", "n", "sketch"), "classes")

    listed = stored(_list_entries(nodes, percent / 100), "lists")
    lists = stored(listed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared-lists")
    entries = listed.join(lists.select("key"), "key", "left_semi")

    in_lists = broadcast_below(entries.select("node").distinct(), 1_000_000)
    wanted = nodes.join(in_lists, "node", "left_semi").select("node", "digest", "low")
    texts = base.join(broadcast_below(wanted, 1_000_000), F.col("d") == F.col("low")).select("node", "digest", "t")
    kinds = "node long, members binary, " + ", ".join(f"{o} long" for o in ODD)
    sets = stored(texts.mapInArrow(_member_sets(words), kinds).dropDuplicates(["node"]), "sets")
    values = sets.mapInArrow(_each_member, "value long, node long")
    common = stored(values.groupBy("value").agg(F.count("*").alias("c")).where("c > 1"), "common-members")
    shared = values.join(common.select("value"), "value").groupBy("node").agg(F.count("*").alias("shared"))
    # s: how many members another listed set has; n: all of them
    facts = shared.join(sets.select("node", *ODD), "node")
    entries = entries.join(facts, "node").select("key", F.struct("node", "n", F.col("shared").alias("s"), *ODD).alias("x"))
    # a member that shares less with all others together reaches it with none
    entries = stored(entries.where(100 * F.col("x.s") >= percent * F.col("x.n")), "entries")

    def may_link(x, y):
        """Both hold at least 85/185 (for 85 %) of the two sizes together, and
        they differ in at most 15/185 of them."""
        total = F.col(f"{x}.n") + F.col(f"{y}.n")
        bits = sum((F.bit_count(F.col(f"{x}.{o}").bitwiseXOR(F.col(f"{y}.{o}"))) for o in ODD), F.lit(0))
        enough = (100 + percent) * F.least(f"{x}.s", f"{y}.s") >= percent * total
        return enough & ((100 + percent) * bits <= (100 - percent) * total)

    def ends(x, y):
        return F.least(f"{x}.node", f"{y}.node").alias("a"), F.greatest(f"{x}.node", f"{y}.node").alias("b")

    own = (F.col("x.n") - F.col("x.s")) / F.col("x.n")
    heads = stored(entries.groupBy("key").agg(F.min_by("x", F.struct(own.alias("own"), "x.node")).alias("y")), "leaders")
    pairs = entries.join(heads, "key").where("x.node <> y.node").where(may_link("x", "y"))
    pairs = stored(pairs.select(*ends("x", "y")).distinct(), "pairs")
    links = _verified(pairs, nodes, sets, percent)
    comps = stored(connected_components(links), "components")

    now = entries.join(comps, entries["x.node"] == comps["node"], "left")
    now = stored(now.select("key", "x", F.coalesce("component", "x.node").alias("comp")), "entries-now")
    per = now.groupBy("key", "comp").agg(F.count("*").alias("c"))
    main = per.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    rest = now.join(stored(main, "main-components"), "key").where("comp <> main").drop("main", "parts")
    rest = stored(rest, "outside-main")  # so that a hot key's join below can be split
    other = now.select("key", F.col("x").alias("y"), F.col("comp").alias("comp2"))
    left = rest.join(other, "key").where("comp <> comp2").where(may_link("x", "y"))
    left = left.select(*ends("x", "y")).distinct()
    left = stored(left.join(pairs, ["a", "b"], "left_anti"), "pairs-left")
    links = links.unionByName(_verified(left, nodes, sets, percent))
    comps = stored(connected_components(links), "components")

    of = nodes.select("digest", "node", "low").join(comps, "node", "left").select("digest", "low", F.coalesce("component", "node").alias("comp"))
    of = stored(of, "classed")
    classed = of.join(of.groupBy("comp").agg(F.min("low").alias("c")), "comp").select("digest", "c")
    return (
        rows.select("d", "h", "n", "digest")
        .join(classed, "digest", "left")
        .select(
            F.col("d").alias(doc_id),
            F.col("h").alias("text_hash"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("d").isNotNull(), F.coalesce("c", "d")).alias("component_id"),
            (F.col("d").isNull() | (F.coalesce("c", "d") == F.col("d"))).alias("kept"),
        )
    )
