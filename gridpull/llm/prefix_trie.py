"""Conversation prefix trie from adaptive radix trees.

Turns become fixed-width ids (``ID_BYTES`` bytes of a digest of role and
text, big-endian); texts are never shuffled. A sequence of turns is the byte
string of its ids.

1. Turns get their place in their conversation by one range sort and the
   places' distance to the conversation's first (a conversation of any length
   spans tasks), and are dealt to sequences: a rebuilt conversation is the
   first turns of one conversation and the later turns of another.
2. Sequences are cut into pieces of ``PIECE`` turns. A piece's key is its
   number, the digest of all turns before it, and its own ids, so a very long
   conversation is many short keys.
3. Pieces are range-partitioned by their first ids and by conversation, so
   that neighbours meet and a prefix that very many share is spread over
   tasks. Each task inserts its keys into adaptive radix trees: nodes of 4,
   16, 48 or 256 children that grow as needed, with compressed paths. Only
   byte depths on a turn's border emit trie nodes, each with the sums over its
   subtree (members, their smallest conversation). Parts of one node that
   several tasks hold are added up by its digest.
4. A conversation is the smallest member of the nodes at the lower end of its
   path, from some depth on. So what a subtree holds once for each distinct
   node follows from additive numbers of its members: the bytes above that
   depth, and whether the path ends in a childless node. A second pass through
   the trees adds these up.

A node's digest is the xor of one 128-bit hash for each (depth, id) above it.

Defined cases: turns are ordered by turn, null first; rows of one turn by the
digest of role and text, so repeated rows follow each other. A null role or
text is empty. Rows with a null conversation belong to none and are left out.
An empty table has no nodes. Other columns are not read, so their names may
be anything; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_position
from .common import pick, stored

ID_BYTES = 16
HEAD_BYTES = 4 + 16  # a piece's number and the digest before it
PIECE = 1024
BLOCK_BYTES = 16 << 20
ENDS_ROW = 500

KINDS = (4, 16, 48, 256)


class RadixNode:
    """A node of an adaptive radix tree. ``path`` are the compressed bytes
    above it, ``here`` the values of the key that ends at it, if one does."""

    __slots__ = ("path", "kind", "index", "kids", "here")

    def __init__(self, path: bytes, here=None):
        self.path, self.here = path, here
        self.kind, self.index, self.kids = 4, bytearray(), []

    def child(self, byte: int):
        """The child for ``byte``, or None."""
        if self.kind <= 16:  # sorted bytes beside their children
            at = self.index.find(byte)
            return None if at < 0 else self.kids[at]
        if self.kind == 48:  # 256 places that number the children from 1
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def replace(self, byte: int, node: "RadixNode") -> None:
        if self.kind <= 16:
            self.kids[self.index.find(byte)] = node
        elif self.kind == 48:
            self.kids[self.index[byte] - 1] = node
        else:
            self.kids[byte] = node

    def add(self, byte: int, node: "RadixNode") -> None:
        """Add a child; a full node takes the next layout first."""
        if self.kind <= 48 and len(self.kids) == self.kind:
            self._grow()
        if self.kind <= 16:
            at = sum(b < byte for b in self.index)
            self.index.insert(at, byte)
            self.kids.insert(at, node)
        elif self.kind == 48:
            self.kids.append(node)
            self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = node

    def _grow(self) -> None:
        if self.kind == 16:
            index = bytearray(256)
            for place, byte in enumerate(self.index):
                index[byte] = place + 1
            self.index = index
        elif self.kind == 48:
            self.kids = [self.kids[at - 1] if at else None for at in self.index]
            self.index = bytearray()
        self.kind = KINDS[KINDS.index(self.kind) + 1]

    def children(self) -> list["RadixNode"]:
        return self.kids if self.kind <= 48 else [k for k in self.kids if k is not None]


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    both = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (both.bit_length() + 7) // 8


class RadixTree:
    """Byte-string keys with values that ``join(old, new)`` combines."""

    def __init__(self, join):
        self.root, self.join = RadixNode(b""), join

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.here = value if node.here is None else self.join(node.here, value)
                return
            below = node.child(key[at])
            if below is None:
                node.add(key[at], RadixNode(key[at:], value))
                return
            same = _shared(below.path, key[at : at + len(below.path)])
            if same < len(below.path):  # cut the compressed path
                upper = RadixNode(below.path[:same])
                node.replace(key[at], upper)
                below.path = below.path[same:]
                upper.add(below.path[0], below)
                below = upper
            node, at = below, at + same

    def walk(self) -> Iterator[tuple[int, int, object]]:
        """(first byte depth, last byte depth, values of all keys below) of
        every node's path, children before parents."""
        stack: list[list] = [[self.root, 0, 0, None]]  # node, end, next child, sum
        lists = [self.root.children()]
        stack[0][3] = self.root.here
        while stack:
            top = stack[-1]
            kids = lists[-1]
            if top[2] < len(kids):
                kid = kids[top[2]]
                top[2] += 1
                stack.append([kid, top[1] + len(kid.path), 0, kid.here])
                lists.append(kid.children())
                continue
            stack.pop()
            lists.pop()
            node, end, _, total = top
            yield end - len(node.path) + 1, end, total
            if stack and total is not None:
                up = stack[-1]
                up[3] = total if up[3] is None else self.join(up[3], total)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def turn_hashes(ids: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each (id, depth); ids are n x 2 numbers."""
    d = depth.astype(np.uint64)
    a = _mix(ids[:, 0] ^ _mix(d * np.uint64(0x9E3779B97F4A7C15)))
    b = _mix(ids[:, 1] ^ _mix(d * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)))
    return a, b


def turn_ids(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv long, turn, id binary, size long); a row's conv may be null."""
    r, t = (F.coalesce(pick(turns, c), F.lit("")) for c in (role, text))
    # the role's length keeps (role, text) apart from any other split
    both = F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)
    return turns.select(
        pick(turns, conv).cast("long").alias("conv"),
        pick(turns, turn).alias("turn"),
        F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, ID_BYTES).alias("id"),
        F.octet_length(t).cast("long").alias("size"),
    )


def placed_turns(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, k, id, size): k is the turn's place in its conversation, from 0;
    and (conv, n)."""
    rows = ids.where("conv is not null")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("id"), F.col("size")]
    rows = stored(with_position(rows, order).select("conv", "id", "size", "pos"), "turns")
    convs = stored(rows.groupBy("conv").agg(F.min("pos").alias("first"), F.count("*").alias("n")), "conversations")
    # stored, so that a hot conversation in this join can be split
    rows = rows.join(convs.select("conv", "first"), "conv").select("conv", (F.col("pos") - F.col("first")).alias("k"), "id", "size")
    return stored(rows, "placed-turns"), convs.select("conv", "n")


def rebuilt_turns(turns: DataFrame, convs: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """(conv, p, id, size) and all conversations (conv, n): each conversation's
    first ``head`` turns are those of conversation ``base`` (all if it has
    fewer, none if it is absent), then follow its own after the first ``head``.
    Both are columns of ``conv``; ``head`` is small."""
    plan = convs.select("conv", "n", base.alias("base"), head.cast("long").alias("head"))
    found = plan.join(convs.select(F.col("conv").alias("base"), F.col("n").alias("m")), "base", "left")
    lead = F.least("head", F.coalesce("m", F.lit(0)))
    tail = F.greatest(F.col("n") - F.col("head"), F.lit(0))
    plan = stored(found.select("conv", "base", "head", lead.cast("long").alias("lead"), (lead + tail).cast("long").alias("n")), "rebuilt")
    own = turns.join(plan.select("conv", "head", "lead"), "conv").where("k >= head")
    own = own.select("conv", (F.col("k") - F.col("head") + F.col("lead")).alias("p"), "id", "size")
    most = plan.agg(F.max("lead")).first()[0] or 0
    other = turns.where(F.col("k") < most).withColumnRenamed("conv", "base").join(plan.select("conv", "base", "lead"), "base").where("k < lead")
    return own.unionByName(other.select("conv", F.col("k").alias("p"), "id", "size")), plan.select("conv", "n")


def key_pieces(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, part int, x1, x2, above, ids binary, sizes binary, n): pieces of
    up to ``PIECE`` turns, the digest of all turns before each and their
    bytes. A conversation without turns is one empty piece."""
    part = F.floor(F.col("p") / PIECE).cast("int").alias("part")
    grouped = turns.groupBy("conv", part).agg(F.sort_array(F.collect_list(F.struct("p", "id", "size"))).alias("x"))  # a piece at most

    def digests(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for c, k, x in zip(*(b.column(name).to_pylist() for name in ("conv", "part", "x"))):
                ids = b"".join(t["id"] for t in x)
                sizes = np.array([t["size"] for t in x], np.int64)
                h1, h2 = turn_hashes(np.frombuffer(ids, ">u8").astype(np.uint64).reshape(-1, 2), k * PIECE + 1 + np.arange(len(x)))
                own = (int(np.bitwise_xor.reduce(h.view(np.int64))) for h in (h1, h2))
                rows.append((c, k, *own, int(sizes.sum()), ids, sizes.tobytes()))
            if rows:
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, ["conv", "part", "h1", "h2", "bytes", "ids", "sizes"])

    kinds = "conv long, part int, h1 long, h2 long, bytes long, ids binary, sizes binary"
    pieces = stored(grouped.mapInArrow(digests, kinds), "pieces")
    # What stands before a piece: sums over the pieces, a PIECE-th of the turns.
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    late = pieces.where("part > 0").select("conv").distinct()
    long = pieces.select("conv", "part", "h1", "h2", "bytes").join(late, "conv", "left_semi")
    zero = F.lit(0).cast("long")
    heads = long.select(
        "conv",
        "part",
        F.coalesce(F.expr("bit_xor(h1)").over(before), zero).alias("x1"),
        F.coalesce(F.expr("bit_xor(h2)").over(before), zero).alias("x2"),
        F.coalesce(F.sum("bytes").over(before), zero).alias("above"),
    )
    one = pieces.join(late, "conv", "left_anti").select("conv", "part", zero.alias("x1"), zero.alias("x2"), zero.alias("above"), "ids", "sizes")
    many = heads.join(pieces.select("conv", "part", "ids", "sizes"), ["conv", "part"])
    void = F.lit(b"").cast("binary")
    none = convs.where("n = 0").select("conv", F.lit(0).cast("int").alias("part"), zero.alias("x1"), zero.alias("x2"), zero.alias("above"), void.alias("ids"), void.alias("sizes"))
    return one.unionByName(many.select(*one.columns)).unionByName(none)


def tree_sums(pieces: DataFrame, sums: list[str]) -> DataFrame:
    """(k1, k2, depth, p1, p2, above, conv, n, *sums): parts of the trie's
    nodes, one for each task's tree that holds a node: its digest and its
    parent's, bytes above its own turn, smallest member, members, and the sums
    of their columns ``sums``."""
    names = ["k1", "k2", "depth", "p1", "p2", "above", "conv", "n", *sums]

    def join(a, b):
        # smallest member, one of the rows below, members, sums
        return (a[0] if a[0] < b[0] else b[0], a[1], *[x + y for x, y in zip(a[2:], b[2:])])

    def emit(block: list[tuple]) -> Iterator:
        import pyarrow as pa

        tree = RadixTree(join)
        for i, (conv, part, x1, x2, _, ids, _, *more) in enumerate(block):
            head = part.to_bytes(4, "big") + x1.to_bytes(8, "big", signed=True) + x2.to_bytes(8, "big", signed=True)
            tree.insert(head + ids, (conv, i, 1, *more))
        rows, depths, values = [], [], []
        for low, high, total in tree.walk():
            # turn-aligned byte depths of this path; a later piece's top is
            # the last node of the piece before
            first = max(0, -(-(low - HEAD_BYTES) // ID_BYTES))
            for depth in range(first, (high - HEAD_BYTES) // ID_BYTES + 1 if high >= HEAD_BYTES else 0):
                if depth or block[total[1]][1] == 0:
                    rows.append(total[1])
                    depths.append(depth)
                    values.append(total)
        # digests and bytes along every key of the block
        n = np.array([len(r[5]) // ID_BYTES for r in block])
        start = np.cumsum(n) - n
        part = np.array([r[1] for r in block])
        ids = np.frombuffer(b"".join(r[5] for r in block), ">u8").astype(np.uint64).reshape(-1, 2)
        size = np.frombuffer(b"".join(r[6] for r in block), np.int64)
        own = np.repeat(np.arange(len(block)), n)
        place = np.arange(len(ids)) - start[own]
        at, depth = np.array(rows, np.int64), np.array(depths, np.int64)
        cols = []
        for h, x in zip(turn_hashes(ids, part[own] * PIECE + 1 + place), (2, 3)):
            run = np.r_[np.uint64(0), np.bitwise_xor.accumulate(h)].view(np.int64)
            begin = np.array([r[x] for r in block], np.int64)
            upto = lambda d: run[start[at] + d] ^ run[start[at]] ^ begin[at]  # noqa: E731, B023
            cols.append((upto(depth), upto(np.maximum(depth - 1, 0))))
        run = np.r_[0, np.cumsum(size)]
        above = np.array([r[4] for r in block], np.int64)[at] + run[start[at] + np.maximum(depth - 1, 0)] - run[start[at]]
        (k1, p1), (k2, p2) = cols
        conv, _, *rest = zip(*values)
        got = [k1, k2, part[at] * PIECE + depth, p1, p2, above, np.array(conv, np.int64), *[np.array(v, np.int64) for v in rest]]
        yield from pa.Table.from_arrays(list(map(pa.array, got)), names).to_batches(max_chunksize=50_000)

    def run(batches: Iterator) -> Iterator:
        block, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                block.append(row)
                size += len(row[5]) + 64
                if size >= BLOCK_BYTES:
                    yield from emit(block)
                    block, size = [], 0
        if block:
            yield from emit(block)

    near = F.substring("ids", 1, 8 * ID_BYTES)
    dealt = pieces.select("conv", "part", "x1", "x2", "above", "ids", "sizes", *sums).repartitionByRange("part", "x1", near, "conv")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))


NODE = ["k1", "k2", "depth"]


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) from (k1, k2, depth, conv): the digest of
    the ascending ids, comma-joined. Ids are sorted by range, so those of one
    node may span tasks; each sends chunks of text, and only these meet."""

    def chunks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, held = None, []

        def out():
            return (*key, held[0], ",".join(map(str, held)))

        for b in batches:
            rows = []
            for *k, c in zip(*(b.column(n).to_pylist() for n in (*NODE, "conv"))):
                if k != key or len(held) == ENDS_ROW:
                    if held:
                        rows.append(out())
                    key, held = k, []
                held.append(c)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*NODE, "first", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in out()], [*NODE, "first", "ids"])

    def digests(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        key, h = None, None
        for b in batches:
            rows = []
            for *k, text in zip(*(b.column(n).to_pylist() for n in (*NODE, "ids"))):
                if k != key:
                    if key is not None:
                        rows.append((*key, h.hexdigest()))
                    key, h = k, sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*NODE, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, h.hexdigest())], [*NODE, "ends_sha256"])

    kinds = "k1 long, k2 long, depth long"
    order = [*NODE, "conv"]
    parts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, f"{kinds}, first long, ids string")
    parts = parts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return parts.select(*NODE, "ids").mapInArrow(digests, f"{kinds}, ends_sha256 string")


def prefix_trie(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of (conv, p, id, size) turns, p from 0 without gaps, and of
    all conversations (conv, n turns). One row per node: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    pieces = stored(key_pieces(sequences, convs), "keys")
    whole = tree_sums(pieces, []).groupBy(*NODE)
    nodes = stored(
        whole.agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("p1", "p2", "above")]), "nodes"
    )
    up = [F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")]
    kids = stored(nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("kids")), "children")
    # A conversation is the smallest member of the lower end of its path.
    known = nodes.select(*NODE, "conv", "above").join(kids, NODE, "left")
    chain = known.groupBy("conv").agg(F.min_by("above", "depth").alias("top"), F.max_by(F.col("kids").isNull(), "depth").alias("leaf"))

    ends = pieces.join(convs, "conv").where(F.col("part") == F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / PIECE))

    def final(batches: Iterator) -> Iterator:
        """(conv, k1, k2, depth, bytes) of a conversation's last piece."""
        import pyarrow as pa

        for b in batches:
            rows = []
            for c, k, x1, x2, above, ids, sizes in zip(*(c.to_pylist() for c in b.columns)):
                n = len(ids) // ID_BYTES
                own = turn_hashes(np.frombuffer(ids, ">u8").astype(np.uint64).reshape(-1, 2), k * PIECE + 1 + np.arange(n))
                a, q = (int(np.bitwise_xor.reduce(h.view(np.int64))) if n else 0 for h in own)
                rows.append((c, x1 ^ a, x2 ^ q, k * PIECE + n, above + int(np.frombuffer(sizes, np.int64).sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["conv", *NODE, "bytes"])

    ends = ends.select("conv", "part", "x1", "x2", "above", "ids", "sizes")
    ends = stored(ends.mapInArrow(final, "conv long, k1 long, k2 long, depth long, bytes long"), "path-ends")
    facts = ends.select("conv", "bytes").join(chain, "conv", "left")
    facts = facts.select("conv", F.coalesce("top", "bytes").alias("spare"), F.coalesce(F.col("leaf").cast("long"), F.lit(0)).cast("long").alias("leaf"))
    facts = stored(facts, "path-facts")
    # All members but the smallest repeat every node of their path above
    # ``spare``; of that, the bytes above this node are not this subtree's.
    added = tree_sums(pieces.join(facts, "conv"), ["spare", "leaf"]).groupBy(*NODE)
    added = added.agg(F.sum("spare").alias("spare"), F.sum("leaf").alias("n_leaves"))
    own = facts.select("conv", F.col("spare").alias("own"))
    rows = nodes.join(added, NODE).join(own, "conv").join(kids, NODE, "left").join(end_digests(ends.select(*NODE, "conv")), NODE, "left")
    parents = nodes.select(*[F.col(c).alias(p) for c, p in zip(NODE, ("p1", "p2", "up"))], F.col("conv").alias("parent_conv_id"))
    rows = stored(rows.withColumn("up", F.col("depth") - 1), "node-rows")  # the root has very many children
    return rows.join(parents, ["p1", "p2", "up"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("kids", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("spare") - F.col("own") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b"").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, base: Column | None = None, head: Column | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The prefix trie of all conversations, as :func:`prefix_trie` returns
    it. With ``base`` and ``head`` (columns of ``conv``, the conversation's
    id) they are rebuilt first."""
    turns, convs = placed_turns(turn_ids(conversations, conv, turn, role, text))
    if base is None:
        return prefix_trie(turns.withColumnRenamed("k", "p"), convs)
    turns, convs = rebuilt_turns(turns, convs, base, F.lit(0) if head is None else head)
    return prefix_trie(turns, convs)
