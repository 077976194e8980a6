"""Line dedup with a once-seen and a twice-seen Bloom filter.

1. Each task hashes the line keys of its documents (once per document) and
   sends the set bits of its once-seen and twice-seen filters, by shard.
2. A shard merges its pieces as they stream in: bits that another piece had
   set already are twice-seen. Every key in two documents keeps all its bits
   in the twice-seen filter, whichever tasks saw it.
3. Only lines in the twice-seen filter shuffle, with their whole key, for the
   exact document count and the largest document id (partial aggregates, so a
   line of a third of all documents is summed before the shuffle).
4. The confirmed keys (128-bit digest and last holder) go to every task, where
   each document drops its lines of these keys unless it is the last holder;
   no text is shuffled. Beyond ``BROADCAST_KEYS`` counted keys, the documents
   that drop lines are joined with their own keys instead.

The filter is sized by a count of the lines, ``BITS_A_LINE`` for each, up to
``filter_bits``: what reaches the driver and each executor is at most
``filter_bits / 8`` bytes and ``BROADCAST_KEYS`` keys, whatever the data. A
fuller filter only sends more lines to the exact step.

Defined cases: a null or empty text is one empty line. Texts of any length
are read whole. An empty table gives no rows. Every row counts as a
document; rows of the same id hold the same line together (all keep it if
theirs is the largest id). A null id is smaller than any other; where only
null ids hold a key, all of them keep it. Other columns are carried as one
struct, so their names may clash with anything here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_blocks, pick, stored, text_hash

BLANKS = b"\t\n\x0b\x0c\r "
BLOCK_BYTES = 1 << 20
PENDING_HASHES = 1 << 20  # of a task, before it sends them
SHARDS = 256
BITS_A_LINE = 16
LEAST_BITS = 1 << 20
BROADCAST_KEYS = 1_000_000  # of 24 bytes


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """The key of every line, None where it is too short to count."""
    out: list[bytes | None] = []
    for line in text.encode().lower().split(b"\n"):
        k = line.strip(BLANKS)
        n = len(k)
        short = n < min_chars or (n < 4 * min_chars and not k.isascii() and len(k.decode()) < min_chars)
        out.append(None if short else k)
    return out


def _hashes(keys: list[bytes]) -> np.ndarray:
    from hashlib import blake2b

    return np.frombuffer(b"".join([blake2b(k, digest_size=8).digest() for k in keys]), np.uint64)


def _bits(h: np.ndarray, filter_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each hash."""
    m = np.uint64(filter_bits - 1)
    return (h & m).astype(np.int64), ((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & m).astype(np.int64)


def _marks(keys: list[bytes]) -> np.ndarray:
    """128-bit digests, sortable."""
    from hashlib import blake2b

    return np.frombuffer(b"".join([blake2b(k, digest_size=16).digest() for k in keys]), np.dtype([("a", "<u8"), ("b", "<u8")]))


def _suspected(bits: np.ndarray, keys: list[bytes]) -> np.ndarray:
    """Whether the filter has all bits of each key."""
    p, q = _bits(_hashes(keys), 8 * len(bits))
    return (bits[p >> 3] >> (7 - (p & 7)) & bits[q >> 3] >> (7 - (q & 7)) & 1).astype(bool)


def bits_for(docs: DataFrame, text: str, min_chars: int, most: int) -> int:
    """A power of two of some ``BITS_A_LINE`` bits for each line that is long
    enough to count, from one count of the whole table."""
    t = docs[text]
    # a line's key has min_chars characters at least, and a line break
    lines = F.least(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1, F.ceil(F.length(t) / min_chars))
    n = docs.agg(F.sum(lines)).first()[0] or 0
    bits = min(most, LEAST_BITS)
    while bits < min(most, BITS_A_LINE * n):
        bits *= 2
    return bits


def twice_seen_filter(docs: DataFrame, text: str, min_chars: int, filter_bits: int) -> np.ndarray:
    """Packed bits of the filter of all keys that two documents hold."""
    span = filter_bits // SHARDS

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flush(h: np.ndarray) -> Iterator:
            keys, n = np.unique(h, return_counts=True)
            parts = []
            for some in (keys, keys[n > 1]):
                p = np.unique(np.concatenate(_bits(some, filter_bits)))
                parts.append((p, np.searchsorted(p, np.arange(SHARDS + 1) * span)))
            (once, c1), (twice, c2) = parts
            cut = lambda p, c, s: (p[c[s] : c[s + 1]] - s * span).astype(np.uint32).tobytes()
            rows = [(s, cut(once, c1, s), cut(twice, c2, s)) for s in range(SHARDS) if c1[s + 1] > c1[s]]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                    ["shard", "once", "twice"],
                )

        held, size = [], 0
        for t in in_blocks(batches, BLOCK_BYTES):
            for text in t.column(0).fill_null("").to_pylist():
                h = _hashes(list({k for k in line_keys(text, min_chars) if k is not None}))
                held.append(h)
                size += len(h)
            if size >= PENDING_HASHES:
                yield from flush(np.concatenate(held))
                held, size = [], 0
        if size:
            yield from flush(np.concatenate(held))

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(s: int, twice: np.ndarray):
            return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(twice).tobytes()])], ["shard", "bits"])

        at, once, twice = None, None, None
        for b in batches:
            for s, o, w in zip(*(c.to_pylist() for c in b.columns)):
                if s != at:
                    if at is not None:
                        yield out(at, twice)
                    at, once, twice = s, np.zeros(span, bool), np.zeros(span, bool)
                o = np.frombuffer(o, np.uint32)
                twice[np.frombuffer(w, np.uint32)] = True
                twice[o[once[o]]] = True
                once[o] = True
        if at is not None:
            yield out(at, twice)

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = (
        docs.select(docs[text].alias("t"))
        .mapInArrow(pieces, "shard int, once binary, twice binary")
        .repartition(min(n, SHARDS), "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(merge, "shard int, bits binary")
    )
    bits = np.zeros(filter_bits // 8, np.uint8)
    for r in merged.collect():  # filter_bits / 8 bytes in all
        bits[r["shard"] * span // 8 :][: span // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def drop_repeated_lines(
    docs: DataFrame,
    carry: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 5,
    min_chars: int = 40,
    filter_bits: int = 1 << 28,
) -> DataFrame:
    """(row struct<carry>, kept string, n_lines long, n_dropped long), one row
    per input row. ``filter_bits`` is a power of two, the most that the filter
    may take (by default 32 MB)."""
    spark = docs.sparkSession
    base = docs.select(
        F.struct(*[pick(docs, c) for c in carry]).alias("row"),
        docs[text].alias("t"),
        docs[doc_id].alias("d"),
        text_hash(docs[text]).alias("h"),
    )
    d_type = base.schema["d"].dataType
    shared = spark.sparkContext.broadcast(twice_seen_filter(docs, text, min_chars, bits_for(docs, text, min_chars, filter_bits)))

    def suspects(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = shared.value
        for t in in_blocks(batches, BLOCK_BYTES):
            keys, who = [], []
            for i, text in enumerate(t.column("t").fill_null("").to_pylist()):
                own = {k for k in line_keys(text, min_chars) if k is not None}
                keys.extend(own)
                who.extend([i] * len(own))
            if not keys:
                continue
            at = np.flatnonzero(_suspected(bits, keys))
            who = pa.array(np.array(who)[at])
            got = pa.Table.from_arrays(
                [t.column("d").take(who), t.column("h").take(who), pa.array([keys[i] for i in at], pa.binary())], ["d", "h", "key"]
            )
            yield from got.to_batches(max_chunksize=20_000)

    kinds = T.StructType([T.StructField("d", d_type), T.StructField("h", T.LongType()), T.StructField("key", T.BinaryType())])
    said = base.select("t", "d", "h").mapInArrow(suspects, kinds)
    counts = said.groupBy("key").agg(F.count("*").alias("n"), F.max("d").alias("last")).where(F.col("n") >= min_docs)
    # stored, so that a hot key in a join below can be split
    confirmed = stored(counts.select("key", "last"), "confirmed")
    if confirmed.count() <= BROADCAST_KEYS:
        return _without_lines(base, confirmed, shared, min_chars)
    drops = (
        said.join(confirmed, "key")
        .where(~F.col("d").eqNullSafe(F.col("last")))
        .groupBy("d", "h")
        .agg(F.collect_set("key").alias("gone"))  # a document's own keys
        .select(F.col("d").alias("d2"), F.col("h").alias("h2"), "gone")
    )
    joined = base.join(drops, base["d"].eqNullSafe(drops["d2"]) & (base["h"] == drops["h2"]), "left").select("row", "t", "gone")

    def apply(batches: Iterator) -> Iterator:
        for t in in_blocks(batches, BLOCK_BYTES):
            yield from _cut(t, min_chars, [set(g or ()) for g in t.column("gone").to_pylist()])

    return joined.mapInArrow(apply, _kept_schema(base))


def _kept_schema(base: DataFrame) -> T.StructType:
    return T.StructType(
        [base.schema["row"], T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )


def _cut(t, min_chars: int, gone: list[set]) -> Iterator:
    """The rows of a block without the lines of the keys ``gone``."""
    import pyarrow as pa

    kept, lines, dropped = [], [], []
    for text, keys in zip(t.column("t").fill_null("").to_pylist(), gone):
        own = text.split("\n") if keys else None
        stay = [x for x, k in zip(own, line_keys(text, min_chars)) if k not in keys] if keys else None
        kept.append("\n".join(stay) if keys else text)
        lines.append(len(own) if keys else text.count("\n") + 1)
        dropped.append(len(own) - len(stay) if keys else 0)
    cols = [t.column("row").combine_chunks(), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
    yield from pa.Table.from_arrays(cols, ["row", "kept", "n_lines", "n_dropped"]).to_batches(max_chunksize=2000)


def _without_lines(base: DataFrame, confirmed: DataFrame, filter_: object, min_chars: int) -> DataFrame:
    """``base`` without the lines of confirmed keys, but in their last holder:
    a map over the texts."""

    def marks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            m = _marks(b.column("key").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in m], pa.binary()), b.column("last")], ["mark", "last"])

    last_type = confirmed.schema["last"].dataType
    got = confirmed.mapInArrow(marks, T.StructType([T.StructField("mark", T.BinaryType()), T.StructField("last", last_type)])).toArrow()
    mark = np.frombuffer(b"".join(got.column("mark").to_pylist()), _marks([]).dtype)
    order = np.lexsort((mark["b"], mark["a"]))
    known = base.sparkSession.sparkContext.broadcast((mark[order], got.column("last").combine_chunks().take(order)))

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        bits, (mark, last) = filter_.value, known.value
        for t in in_blocks(batches, BLOCK_BYTES):
            keys, who = [], []
            for i, text in enumerate(t.column("t").fill_null("").to_pylist()):
                own = {k for k in line_keys(text, min_chars) if k is not None}
                keys.extend(own)
                who.extend([i] * len(own))
            gone: list[set] = [set() for _ in range(t.num_rows)]
            at = np.flatnonzero(_suspected(bits, keys)) if keys and len(mark) else np.zeros(0, np.int64)
            if len(at):
                own = _marks([keys[i] for i in at])
                spot = np.searchsorted(mark["a"], own["a"])  # first parts are all but unique
                for _ in range(_longest_run(mark)):
                    here = np.minimum(spot, len(mark) - 1)
                    spot = np.where((mark["a"][here] == own["a"]) & (mark["b"][here] < own["b"]), spot + 1, spot)
                spot = np.minimum(spot, len(mark) - 1)
                found = mark[spot] == own
                d = t.column("d").combine_chunks().take(pa.array([who[i] for i in at]))
                holder = last.take(pa.array(spot))
                same = pc.fill_null(pc.equal(d, holder), False).to_numpy(zero_copy_only=False) | (
                    pc.is_null(d).to_numpy(zero_copy_only=False) & pc.is_null(holder).to_numpy(zero_copy_only=False)
                )
                for i in at[found & ~same].tolist():
                    gone[who[i]].add(keys[i])
            yield from _cut(t, min_chars, gone)

    return base.select("row", "t", "d").mapInArrow(apply, _kept_schema(base))


def _longest_run(mark: np.ndarray) -> int:
    """How many digests share their first half, at most."""
    a = mark["a"]
    runs = np.diff(np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])) if len(a) else np.zeros(0, np.int64)
    return int(runs.max(initial=1)) - 1
