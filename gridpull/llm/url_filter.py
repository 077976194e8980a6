"""URL filter by a cascade of Bloom filters.

Over a complete universe U of keys with listed keys S: level 1 encodes S;
level 2 encodes the keys of U outside S that level 1 accepts; level 3 the
listed keys that level 2 accepts; and so on, until a level accepts no wrong
key. The first level that refuses a key decides it, so membership is exact
for every key of U and needs no join: tasks only test bits.

The universe is the corpus's own distinct keys. Levels shrink by the false
positive rate; their bits go to the executors as one broadcast whose size is
known from the count of listed keys and checked against ``max_bytes``. Keys
of a longer list are dealt by hash to shards, each with a cascade of its own
within that bound; a row is judged by its shard's. Keys stand for themselves
by two 64-bit hashes.

Defined cases: a null url, or one without ``://``, has an empty host and path,
which is a key like any other. Null keys in the list are ignored; repeated
keys and rows count once each as keys, and every row is judged. An empty list
has no levels and lists nothing; an empty table gives no rows. Urls of any
length are read whole. Extra columns are not read by ``judge_urls`` and are
carried as one struct by ``listed_column``, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, pick, ship, shipped, stored

#: Fixed values: (verdict, host, path) rules of the query; the longest wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z
    lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; null without one.
    Length counts the host's and the path's characters; on a tie the first
    listed wins."""
    order = sorted(rules, key=lambda r: -(len(r[1]) + len(r[2])))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(order):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _positions(keys: tuple[np.ndarray, np.ndarray], bits: int, level: int, hashes: int) -> np.ndarray:
    """``hashes`` bit positions of each key's two hashes at a level."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (keys[0] ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    y = (keys[1] ^ x) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
    return np.stack([(x + np.uint64(i) * y >> np.uint64(11)) % np.uint64(bits) for i in range(hashes)]).astype(np.int64)


@dataclass
class Cascade:
    """Levels of packed bits; ``hashes`` positions of each."""

    levels: list[tuple[int, np.ndarray]]
    hashes: int

    def passes(self, keys: tuple[np.ndarray, np.ndarray], level: int) -> np.ndarray:
        bits, data = self.levels[level]
        p = _positions(keys, bits, level, self.hashes)
        return ((data[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(axis=0)

    def contains(self, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Membership, exact for the keys of the universe: the first level
        that refuses decides; a key that passes all is of the last kind."""
        out = np.full(len(keys[0]), len(self.levels) % 2 == 1)
        open_ = np.arange(len(out))
        for k in range(len(self.levels)):
            ok = self.passes((keys[0][open_], keys[1][open_]), k)
            out[open_[~ok]] = k % 2 == 1
            open_ = open_[ok]
        return out


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit("second"), key).alias("g")]


def _taken(batch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy().view(np.uint64) for c in ("h", "g"))


def _level(keys: DataFrame, n: int, level: int, bits_per_key: int, hashes: int) -> tuple[int, np.ndarray]:
    """One filter of ``n`` keys (column h): tasks send their distinct bit
    positions by shard; the bits of a shard come back packed."""
    shard = 1 << 16
    bits = max(8, -(-n * bits_per_key // 8) * 8)

    def set_bits(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            p = np.unique(_positions(_taken(b), bits, level, hashes))
            yield pa.RecordBatch.from_arrays([pa.array(p // shard), pa.array(p % shard)], ["shard", "bit"])

    data = np.zeros(bits // 8, np.uint8)
    rows = keys.mapInArrow(set_bits, "shard long, bit long").groupBy("shard").agg(F.sort_array(F.collect_set("bit")).alias("set"))

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            packed = []
            for s in b.column("set").to_pylist():
                one = np.zeros(shard, np.uint8)
                one[s] = 1
                packed.append(np.packbits(one, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("shard"), pa.array(packed, pa.binary())], ["shard", "bits"])

    for r in rows.mapInArrow(pack, "shard long, bits binary").collect():  # bits / 8 bytes in all
        at = r["shard"] * shard // 8
        part = np.frombuffer(r["bits"], np.uint8)[: len(data) - at]
        data[at : at + len(part)] = part
    return bits, data


def _sides(universe: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hashes of the listed keys, and of all others."""
    members = stored(listed.where("key is not null").select(*key_hashes(F.col("key"))).distinct(), "listed")
    return members, stored(universe.select(*key_hashes(F.col("key"))).distinct().join(members, ["h", "g"], "left_anti"), "unlisted")


def _cascade(members: DataFrame, others: DataFrame, bits_per_key: int, hashes: int, max_bytes: int) -> Cascade:
    spark = members.sparkSession
    cascade = Cascade([], hashes)
    sides, n = [members, others], members.count()
    while n:
        if n * bits_per_key > 8 * max_bytes:
            raise ValueError(f"a level of {n} keys needs more than max_bytes={max_bytes}")
        level = len(cascade.levels)
        cascade.levels.append(_level(sides[level % 2], n, level, bits_per_key, hashes))
        shared = ship(spark, cascade)

        def wrong(batches: Iterator, shared=shared, level=level) -> Iterator:
            import pyarrow as pa

            so_far: Cascade = shipped(shared)
            for b in batches:
                yield b.filter(pa.array(so_far.passes(_taken(b), level)))

        other = (level + 1) % 2
        sides[other] = stored(sides[other].mapInArrow(wrong, "h long, g long"), "false-positives")
        n = sides[other].count()
    return cascade


def build_cascade(universe: DataFrame, listed: DataFrame, bits_per_key: int = 10, hashes: int = 5, max_bytes: int = 256 << 20) -> Cascade:
    """A cascade for ``universe`` (key, every key once) with the keys of
    ``listed`` (key) as members.

    The first level decides the size: ``bits_per_key`` bits for each listed
    key, refused beyond ``max_bytes`` (no key is ever left out)."""
    return _cascade(*_sides(universe, listed), bits_per_key, hashes, max_bytes)


def build_cascades(universe: DataFrame, listed: DataFrame, bits_per_key: int = 10, hashes: int = 5, max_bytes: int = 256 << 20) -> list[Cascade]:
    """The same for a list of any length: one cascade, or one for each shard
    of the keys, none larger than ``max_bytes`` a level."""
    members, others = _sides(universe, listed)
    shards = -(-members.count() * bits_per_key // (8 * max_bytes))
    if shards <= 1:
        return [_cascade(members, others, bits_per_key, hashes, max_bytes)]
    shards += shards // 8 + 1  # as hashing deals unevenly
    return [_cascade(members.where(_shard(shards) == k), others.where(_shard(shards) == k), bits_per_key, hashes, max_bytes) for k in range(shards)]


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("h", "g"), F.lit(shards))


def listed_column(df: DataFrame, key: Column, cascade: Cascade | list[Cascade]) -> DataFrame:
    """(row struct of all columns, listed boolean) of every row, no join.
    Several cascades (``build_cascades``) are each a pass over their shard."""
    base = df.select(F.struct(*[pick(df, c) for c in df.columns]).alias("row"), *key_hashes(key))
    if isinstance(cascade, Cascade):
        return _listed(base, cascade)
    if len(cascade) == 1:
        return _listed(base, cascade[0])
    parts = [_listed(base.where(_shard(len(cascade)) == k), c) for k, c in enumerate(cascade)]
    return reduce(DataFrame.unionByName, parts)


def _listed(base: DataFrame, cascade: Cascade) -> DataFrame:
    shared = ship(base.sparkSession, cascade)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        levels: Cascade = shipped(shared)
        for b in batches:
            got = pa.array(levels.contains(_taken(b)))
            yield pa.RecordBatch.from_arrays([b.column("row"), got], ["row", "listed"])

    from pyspark.sql import types as T

    return base.mapInArrow(run, T.StructType([base.schema["row"], T.StructField("listed", T.BooleanType())]))


def judge_urls(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, max_bytes: int = 256 << 20) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page: the rule's verdict,
    else block where the page's address (host and path) is a key of
    ``listed`` (key), else allow."""
    base = pages.select(pages[page_id].alias("page_id"), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
    address = F.concat("host", "path")
    cascades = build_cascades(base.select(address.alias("key")).distinct(), listed, max_bytes=max_bytes)
    got = listed_column(base, address, cascades).select("row.*", "listed")
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return got.select(F.col("page_id").alias(page_id), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
