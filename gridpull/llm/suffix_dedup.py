"""Suffix-array dedup of repeated byte strings.

A string of ``min_bytes`` bytes (200) that also starts elsewhere is a repeat.
A suffix array of the whole collection cannot be one task's, so equal strings
are first brought together, and only what may repeat in part is sorted.

1. Windows of ``min_bytes`` bytes are dealt by their anchor, the ``GRAM``
   bytes in them with the smallest hash (leftmost if tied): equal windows have
   equal anchors. Neighbouring windows of one anchor form a fragment, so a
   text becomes some fragment for each 70 bytes. Only the fragment's place
   and 128 bits (hash of the anchor, digest of the whole) are shuffled.
2. Places are range-partitioned and sorted by (anchor, digest, document,
   start), so even one anchor or fragment that a third of all texts hold is
   spread over tasks. A task streams its sorted places: equal fragments are
   copies as a whole; fragments that are alone with their anchor repeat
   nothing and end here. Anchors at a task's two ends, which may go on in the
   next task, are counted by aggregates instead.
3. Different fragments of one anchor may share windows. One copy of each is
   cut from its text. A task puts whole anchors side by side, sorts the
   suffixes of all window starts (prefix doubling), and takes the longest
   previous factor of each: the longer of the common prefixes with the
   previous and the next smaller position in suffix order. It is at least
   ``min_bytes`` where the window has an earlier copy. The same with larger
   positions finds later copies. Anchors with more than ``GROUP_FRAGMENTS``
   different fragments are compared by the windows' own 128-bit digests,
   which aggregates count, so no anchor is too large for a task.
4. Spans meet their texts once, and each text is cut.

Texts travel compressed. ``keep="first"`` removes later copies and keeps each
string where it starts first, in the order of (document, start);
``keep="none"`` removes every copy of what repeats.

Defined cases: a null text is empty; texts shorter than ``min_bytes`` bytes
are kept whole; texts of any length are cut by pieces of ``PIECE_BYTES``
windows. Matches never cross texts, but may overlap in one text. Every row is
a text of its own: repeated rows are copies of each other. ``keep="first"``
cannot tell rows apart that repeat an id and its text and keeps both. Rows
with a null id stand, in the order, by a hash of their text. An empty table
gives no rows. Other columns are carried as one struct, so their names may
clash with anything here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_below, in_blocks, pick, stored

GRAM = 64
BLOCK_BYTES = 1 << 19
PIECE_BYTES = 1 << 20
PLACE_BITS = 24  # places in a block; the rest of a window's key is hash
PENDING_ROWS = 1_000_000
OPEN_FRAGMENTS = 200_000  # broadcast up to so many
GROUP_FRAGMENTS = 4096

_TABLE = np.random.default_rng(20250611).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on (a power of two)."""
    h, n, k = _TABLE[buf], 1, 0x9E3779B97F4A7C15
    while n < size:
        h = h[:-n] * np.uint64(k) + h[n:]
        n, k = 2 * n, k * k % (1 << 64)
    return _mix(h)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    rest = width - n
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def fragments(raw: list[bytes], min_bytes: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor) of every fragment of some short texts."""
    size = np.array([len(x) for x in raw], np.int64)
    end = np.cumsum(size)
    none = np.zeros(0, np.int64)
    if not len(raw) or end[-1] < min_bytes:
        return none, none, none, none
    buf = np.frombuffer(b"".join(raw), np.uint8)
    h = _gram_hashes(buf, GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_min(h & ~low | np.arange(len(h), dtype=np.uint64), min_bytes - GRAM + 1)
    own = np.repeat(np.arange(len(raw)), size)[: len(least)]
    inside = np.arange(len(least)) + min_bytes <= end[own]
    at = (least & low).astype(np.int64)
    change = np.r_[True, (at[1:] != at[:-1]) | ~inside[:-1]]
    first = np.flatnonzero(inside & change)
    last = np.flatnonzero(inside & np.r_[change[1:] | ~inside[1:], True])
    text = own[first]
    return text, first - (end - size)[text], last - first + 1, h[at[first]].view(np.int64)


def _digest(data: bytes, size: int = 8) -> bytes:
    from hashlib import blake2b

    return blake2b(data, digest_size=size).digest()


def _identified(docs: DataFrame, doc_id: str, text: str) -> list:
    """Columns d, h (which tell different texts apart) and t."""
    t = F.coalesce(pick(docs, text).cast("string"), F.lit(""))
    low = F.lit(1 << 31)
    return [
        F.coalesce(pick(docs, doc_id).cast("long"), F.xxhash64(t)).alias("d"),
        (F.crc32(t.cast("binary")) - low).cast("int").alias("h"),
        t.alias("t"),
    ]


def _places(texts: DataFrame, min_bytes: int) -> DataFrame:
    """(a, g, d, h, s, n): anchor, digest, text, start and windows of every
    fragment."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(rows: list[tuple[int, int, int, bytes]]):
            own, start, n, anchor = fragments([r[3] for r in rows], min_bytes)
            raw = [r[3] for r in rows]
            cuts = zip(own.tolist(), start.tolist(), (start + n + min_bytes - 1).tolist())
            digest = np.frombuffer(b"".join([_digest(raw[i][a:b]) for i, a, b in cuts]), np.int64)
            d, h, base = (np.array([r[k] for r in rows], np.int64)[own] for k in range(3))
            cols = [anchor, digest, d, h.astype(np.int32), (start + base).astype(np.int64), n.astype(np.int32)]
            return pa.Table.from_arrays(list(map(pa.array, cols)), ["a", "g", "d", "h", "s", "n"]).to_batches(max_chunksize=20_000)

        for block in in_blocks(batches, BLOCK_BYTES):
            rows, size = [], 0
            for d, h, t in zip(*(block.column(c).to_pylist() for c in ("d", "h", "t"))):
                raw = t.encode()
                for base in range(0, max(1, len(raw) - min_bytes + 1), PIECE_BYTES):
                    part = raw[base : base + PIECE_BYTES + min_bytes - 1] if len(raw) > PIECE_BYTES else raw
                    if size and size + len(part) > 2 * PIECE_BYTES:
                        yield from emit(rows)
                        rows, size = [], 0
                    rows.append((d, h, base, part))
                    size += len(part)
            if rows:
                yield from emit(rows)

    return texts.mapInArrow(run, "a long, g long, d long, h int, s long, n int")


PLACE = ["a", "g", "d", "h", "s", "n"]


def _classified(places: DataFrame) -> DataFrame:
    """Places of fragments that may repeat something, with cnt (copies of the
    fragment), lead (it is the first copy) and mixed (the anchor has other
    fragments)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(cols, cnt, lead, mixed, open_):
            n = len(cols[0])
            more = [x if isinstance(x, np.ndarray) else np.full(n, x) for x in (cnt, lead, mixed, open_)]
            return pa.Table.from_arrays(list(map(pa.array, [*cols, *more])), [*PLACE, "cnt", "lead", "mixed", "open"]).to_batches(max_chunksize=20_000)

        def whole(cols):
            """Rows of anchors that are all here."""
            a, g, d, h, s, _ = cols
            new_a = np.r_[True, a[1:] != a[:-1]]
            new_g = new_a | np.r_[True, g[1:] != g[:-1]]
            kind, group = np.cumsum(new_g) - 1, np.cumsum(new_a) - 1
            cnt = np.bincount(kind)[kind]
            mixed = (np.bincount(group[new_g]) > 1)[group]
            top = np.flatnonzero(new_g)[kind]
            lead = (d == d[top]) & (h == h[top]) & (s == s[top])
            use = (cnt > 1) | mixed
            return out([c[use] for c in cols], cnt[use].astype(np.int64), lead[use], mixed[use], False)

        def as_open(cols):
            return out(cols, np.zeros(len(cols[0]), np.int64), False, False, True)

        held, opened = None, []
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in PLACE]
            if not opened:
                opened = [cols[0][0]]  # the first anchor: it may begin before
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            a = cols[0]
            cut = np.searchsorted(a, a[-1])
            held = [c[cut:] for c in cols]
            if a[-1] in opened or len(held[0]) > PENDING_ROWS:
                opened = [opened[0], a[-1]]
                cut, held = len(a), None
            done = [c[:cut] for c in cols]
            is_open = np.isin(done[0], opened)
            if is_open.any():
                yield from as_open([c[is_open] for c in done])
            if not is_open.all():
                yield from whole([c[~is_open] for c in done])
        if held is not None:
            yield from as_open(held)  # the last anchor: it may go on

    kinds = "a long, g long, d long, h int, s long, n int, cnt long, lead boolean, mixed boolean, open boolean"
    order = PLACE[:5]
    found = stored(places.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, kinds), "places")
    # One join gives the rows of open anchors their counts; whole anchors have them.
    first = F.struct("d", "h", "s")
    per = stored(found.where("open").groupBy("a", "g").agg(F.count("*").alias("all"), F.min(first).alias("top")), "open-fragments")
    facts = per.join(per.groupBy("a").agg((F.count("*") > 1).alias("several")), "a").where("all > 1 or several")
    rows = found.join(broadcast_below(facts, OPEN_FRAGMENTS), ["a", "g"], "left").where("not open or all is not null")
    return rows.select(
        *PLACE,
        F.coalesce("all", "cnt").alias("cnt"),
        F.when(F.col("open"), F.col("top") == first).otherwise(F.col("lead")).alias("lead"),
        F.coalesce("several", "mixed").alias("mixed"),
    )


def _packed(texts: DataFrame) -> DataFrame:
    """The texts t as zstd frames z with their size."""
    schema = T.StructType([f for f in texts.schema if f.name != "t"] + [T.StructField("z", T.BinaryType()), T.StructField("size", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = pa.Codec("zstd", 1)
        for b in in_blocks(batches, 2 * BLOCK_BYTES):
            raw = [t.encode() for t in b.column("t").to_pylist()]
            cols = [b.column(c) for c in schema.names[:-2]]
            z = pa.array([codec.compress(x, asbytes=True) for x in raw], pa.binary())
            yield from pa.Table.from_arrays([*cols, z, pa.array([len(x) for x in raw], pa.int64())], schema.names).to_batches()

    return texts.mapInArrow(run, schema)


def _unpacked(z: list[bytes], size: list[int]) -> Iterator[bytes]:
    import pyarrow as pa

    codec = pa.Codec("zstd")
    for x, n in zip(z, size):
        yield codec.decompress(x, n, asbytes=True)


def _rank(key: np.ndarray) -> np.ndarray:
    """The dense ranks of numbers."""
    order = np.argsort(key)
    sorted_key = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(np.r_[False, sorted_key[1:] != sorted_key[:-1]]).astype(np.uint64)
    return rank


class SuffixOrder:
    """Ranks of the suffixes of ``data`` by their first 8, 16, 32, ... bytes,
    up to ``depth`` bytes, by prefix doubling."""

    def __init__(self, data: bytes, depth: int):
        self.depth, self.n = depth, len(data)
        buf = np.frombuffer(data + bytes(2 * depth + 8), np.uint8)
        word, width = buf.astype(np.uint64), 1
        while width < 8:
            word = word[:-width] << np.uint64(8 * width) | word[width:]
            width *= 2
        self.words = word[: self.n + 2 * depth]
        self.levels = [(8, _rank(self.words))]
        while 2 * self.levels[-1][0] <= depth:
            width, r = self.levels[-1]
            self.levels.append((2 * width, _rank(self._pairs(r, width))))

    @staticmethod
    def _pairs(rank: np.ndarray, step: int) -> np.ndarray:
        right = np.r_[rank[step:], np.zeros(step, np.uint64)]
        return rank << np.uint64(32) | right

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes at ``at`` by exactly ``depth`` bytes."""
        width, r = self.levels[-1]
        return _rank(r[at] << np.uint64(32) | r[at + self.depth - width])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, at most ``depth``."""
        n = np.zeros(len(i), np.int64)
        for width, r in reversed(self.levels):
            for _ in range(2 if width == self.levels[-1][0] else 1):
                n += width * ((r[i + n] == r[j + n]) & (n + width <= self.depth))
        differ = self.words[i + n] ^ self.words[j + n]
        for bits in (32, 16, 8):
            same = differ >> np.uint64(64 - bits) == 0
            n += np.where(same, bits // 8, 0)
            differ = np.where(same, differ << np.uint64(bits), differ)
        return np.minimum(n, self.depth)


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the previous and the next smaller value, -1 for none."""

    def previous(v: np.ndarray) -> np.ndarray:
        at = np.arange(-1, len(v) - 1)
        wrong = np.flatnonzero((at >= 0) & (v[at] > v))
        while len(wrong):
            at[wrong] = at[at[wrong]]
            wrong = wrong[(at[wrong] >= 0) & (v[at[wrong]] > v[wrong])]
        return at

    back = previous(values[::-1])[::-1]
    return previous(values), np.where(back < 0, -1, len(values) - 1 - back)


def previous_factors(order: SuffixOrder, suffixes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each of ``suffixes`` (in suffix order) the length of its longest
    common prefix with one that stands earlier by ``place``: that with the
    previous or the next smaller place in suffix order."""
    best = np.zeros(len(suffixes), np.int64)
    for near in nearest_smaller(place):
        has = np.flatnonzero(near >= 0)
        best[has] = np.maximum(best[has], order.common(suffixes[has], suffixes[near[has]]))
    return best


def repeated_windows(pieces: list[bytes], windows: np.ndarray, min_bytes: int, later_too: bool) -> np.ndarray:
    """For every window start of ``pieces`` (``windows`` of each, one after
    the other, in the order of their places) whether the window has an earlier
    copy, or, with ``later_too``, any other."""
    order = SuffixOrder(b"".join(pieces), min_bytes)
    size = np.array([len(p) for p in pieces])
    total = int(windows.sum())
    start = np.repeat(np.cumsum(size) - size, windows) + np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    rank = order.ranks(start)
    # factors of full length are among suffixes that share all these bytes
    some = np.flatnonzero(np.bincount(rank.astype(np.int64))[rank.astype(np.int64)] > 1)
    some = some[np.argsort(rank[some], kind="stable")]
    best = previous_factors(order, start[some], some)
    if later_too:
        best = np.maximum(best, previous_factors(order, start[some], -some))
    out = np.zeros(total, bool)
    out[some] = best >= min_bytes
    return out


FRAGMENT = "a long, g long, d long, h int, s long, n int, cnt long, f binary"


def _cut_fragments(mixed: DataFrame, packed: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes f of one copy of each fragment in ``mixed``. All columns of
    ``packed`` are read, so that its exchange serves the last join too."""
    refs = mixed.groupBy("d", "h").agg(F.collect_list(F.struct("a", "g", "s", "n", "cnt")).alias("x"))  # one text's own

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in in_blocks(batches, BLOCK_BYTES):
            rows, size = [], 0
            cols = [b.column(c).to_pylist() for c in ("d", "h", "x")]
            for d, h, x, raw in zip(*cols, _unpacked(b.column("z").to_pylist(), b.column("size").to_pylist())):
                for r in x:
                    rows.append((r["a"], r["g"], d, h, r["s"], r["n"], r["cnt"], raw[r["s"] : r["s"] + r["n"] + min_bytes - 1]))
                    size += len(rows[-1][-1]) + 64
                    if size >= BLOCK_BYTES:
                        yield table(rows)
                        rows, size = [], 0
            if rows:
                yield table(rows)

    def table(rows):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [*PLACE, "cnt", "f"])

    return packed.join(refs, ["d", "h"]).mapInArrow(run, FRAGMENT)


def _spans_by_suffixes(cut: DataFrame, min_bytes: int, first: bool) -> DataFrame:
    """(d, h, start, end) of the windows that fragments of one anchor share."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(rows):
            n = np.array([r[5] for r in rows])
            hit = repeated_windows([r[7] for r in rows], n, min_bytes, not first)
            # a fragment with copies goes as a whole, but for the first one
            hit &= np.repeat([first or r[6] == 1 for r in rows], n)
            own = np.repeat(np.arange(len(rows)), n)
            place = np.arange(len(own)) - (np.cumsum(n) - n)[own]
            joined = hit[1:] & hit[:-1] & (own[1:] == own[:-1])
            begin = np.flatnonzero(hit & np.r_[True, ~joined])
            end = np.flatnonzero(hit & np.r_[~joined, True])
            d, h, s = (np.array([r[k] for r in rows])[own[begin]] for k in (2, 3, 4))
            cols = [d, h.astype(np.int32), s + place[begin], s + place[end] + min_bytes]
            yield from pa.Table.from_arrays(list(map(pa.array, cols)), ["d", "h", "start", "end"]).to_batches(max_chunksize=50_000)

        rows, size, seen = [], 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:2] == seen:
                    continue  # of a text that stands in several rows
                if size >= BLOCK_BYTES and row[0] != seen[0]:
                    yield from emit(rows)
                    rows, size = [], 0
                seen = row[:2]
                rows.append(row)
                size += len(row[7])
        if rows:
            yield from emit(rows)

    # within an anchor by place
    dealt = cut.repartition("a").sortWithinPartitions("a", "d", "h", "s", "g")
    return dealt.mapInArrow(run, "d long, h int, start long, end long")


def _spans_by_digests(cut: DataFrame, min_bytes: int, first: bool) -> DataFrame:
    """The same for anchors with very many fragments."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for a, g, d, h, s, n, cnt, f in zip(*(c.to_pylist() for c in b.columns)):
                rows += [(_digest(f[i : i + min_bytes], 16), d, h, s + i, cnt) for i in range(n)]
            if rows:
                kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield from pa.Table.from_arrays(cols, ["w", "d", "h", "start", "cnt"]).to_batches(max_chunksize=20_000)

    windows = stored(cut.mapInArrow(run, "w binary, d long, h int, start long, cnt long").dropDuplicates(["w", "d", "h", "start"]), "windows")
    place = F.struct("d", "h", "start")
    shared = stored(windows.groupBy("w").agg(F.count("*").alias("k"), F.min(place).alias("top")).where("k > 1"), "shared-windows")
    goes = (place != F.col("top")) if first else (F.col("cnt") == 1)
    return windows.join(shared, "w").where(goes).select("d", "h", "start", (F.col("start") + min_bytes).alias("end"))


def repeat_spans(texts: DataFrame, min_bytes: int = 200, keep: str = "first", packed: DataFrame | None = None) -> DataFrame:
    """(d, h, spans array<struct<start, end>>): the bytes to remove of each
    text that has some, for ``texts`` of the columns of :func:`_identified`.
    Spans may overlap. ``packed`` are the same texts compressed."""
    if min_bytes < GRAM:
        raise ValueError(f"at least {GRAM} bytes are needed")
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    first = keep == "first"
    packed = _packed(texts) if packed is None else packed
    found = _classified(_places(texts, min_bytes))
    copies = found.where("cnt > 1" + (" and not lead" if first else ""))
    spans = copies.select("d", "h", F.col("s").alias("start"), (F.col("s") + F.col("n") + (min_bytes - 1)).alias("end"))
    mixed = stored(found.where("mixed and lead").select(*PLACE, "cnt").dropDuplicates(["a", "g"]), "mixed")
    large = stored(mixed.groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > GROUP_FRAGMENTS).select("a"), "large-anchors")
    if large.isEmpty():
        spans = spans.unionByName(_spans_by_suffixes(_cut_fragments(mixed, packed, min_bytes), min_bytes, first))
    else:
        side = broadcast_below(large, 100_000)
        some = _cut_fragments(mixed.join(side, "a", "left_anti"), packed, min_bytes)
        rest = _cut_fragments(mixed.join(side, "a", "left_semi"), packed, min_bytes)
        spans = spans.unionByName(_spans_by_suffixes(some, min_bytes, first)).unionByName(_spans_by_digests(rest, min_bytes, first))
    return spans.groupBy("d", "h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # one text's own


def merged_spans(spans: list) -> list[tuple[int, int]]:
    """Disjoint maximal spans, ascending."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(
    docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text", min_bytes: int = 200, keep: str = "first"
) -> DataFrame:
    """(row struct<carry>, kept binary, n_bytes long, spans
    array<struct<start long, end long>>), one row per input row: the bytes
    left, and the removed runs in the input's bytes."""
    base = docs.select(F.struct(*[pick(docs, c) for c in carry]).alias("row"), *_identified(docs, doc_id, text))
    packed = _packed(base)
    spans = repeat_spans(base.select("d", "h", "t"), min_bytes, keep, packed)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        [base.schema["row"], T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", span)]
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in in_blocks(batches, 2 * BLOCK_BYTES):
            kept, gone = [], []
            size = b.column("size").to_pylist()
            for raw, own in zip(_unpacked(b.column("z").to_pylist(), size), b.column("spans").to_pylist()):
                runs = merged_spans([(x["start"], x["end"]) for x in own or []])
                edges = [0, *(p for r in runs for p in r), len(raw)]
                kept.append(b"".join([raw[i:j] for i, j in zip(edges[::2], edges[1::2])]))
                gone.append([{"start": s, "end": e} for s, e in runs])
            cols = [b.column("row").combine_chunks(), pa.array(kept, pa.binary()), b.column("size"), pa.array(gone, kind)]
            table = pa.Table.from_arrays(cols, ["row", "kept", "n_bytes", "spans"])
            yield from table.to_batches(max_chunksize=2000)

    joined = packed.join(spans, ["d", "h"], "left")
    return joined.mapInArrow(run, schema)
