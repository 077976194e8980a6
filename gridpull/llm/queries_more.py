"""The registered queries of the prefix trie, the suffix arrays and the
whitening, as in ``queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .prefix_trie import conversation_trie
from .suffix_dedup import remove_repeats
from .whitening import whiten


def q_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations rebuilt on the first turns of their group of five's
    first, then their trie."""
    c = F.col("conv")
    head = F.crc32(c.cast("string").cast("binary")) % 9
    return conversation_trie(read_table(spark, sf, "conversations"), base=c - c % 5, head=head)


# crc32 bit by bit: a byte is xored in, then follow eight shifts (-1).
_CRC_SQL = """xor(list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform(
  range(1, length({0}) + 1), lambda i: [ascii({0}[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END), 4294967295::BIGINT)"""

SQL_PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(text, '') AS text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT c, count(*) AS n, c - c % 5 AS base, {_CRC_SQL.format('CAST(c AS VARCHAR)')} % 9 AS h FROM t GROUP BY c),
r AS (
  SELECT g.c, k + (least(h, coalesce((SELECT count(*) FROM t b WHERE b.c = g.base), 0)) - h) AS p, id, text FROM g JOIN t ON t.c = g.c AND k >= h
  UNION ALL
  SELECT g.c, k, id, text FROM g JOIN t ON t.c = g.base AND k < h),
s AS (
  SELECT g.c, list(id ORDER BY p) FILTER (id IS NOT NULL) AS ids, list(strlen(text) ORDER BY p) FILTER (id IS NOT NULL) AS sizes
  FROM g LEFT JOIN r ON r.c = g.c GROUP BY g.c),
path AS (
  SELECT c, d, len(coalesce(ids, [])) AS n, array_to_string(coalesce(ids, [])[1:d], ',') AS key, array_to_string(coalesce(ids, [])[1:d - 1], ',') AS up, coalesce(sizes[d], 0) AS size
  FROM (SELECT c, ids, sizes, unnest(range(0, len(coalesce(ids, [])) + 1)) AS d FROM s)),
node AS (
  SELECT d, key, min(c) AS c, count(*) AS m, min(up) AS up, min(size) AS size,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM path GROUP BY d, key),
kids AS (SELECT d - 1 AS d, up AS key, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1, 2),
full_node AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (d, key)),
sub AS (
  SELECT a.d, a.key, sum(CASE WHEN v.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((v.m - 1) * v.size) AS saved
  FROM full_node v JOIN path a ON a.c = v.c AND a.d <= v.d GROUP BY 1, 2)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, p.c AS parent_conv_id, f.m AS n_convs, CAST(f.kids AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN sub USING (d, key) LEFT JOIN node p ON f.d > 0 AND p.d = f.d - 1 AND p.key = f.up
"""


def q_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy of a string of 200 bytes that starts twice goes."""
    got = remove_repeats(read_table(spark, sf, "documents"), ["doc_id"], min_bytes=200, keep="none")
    return got.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def q_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read_table(spark, sf, "embeddings"), scale=256.0, components=4)


QUERIES = {
    "op11_prefix_trie": q_prefix_trie,
    "op12_suffix_dedup": q_suffix_dedup,
    "op13_whitening": q_whitening,
}
SQL: dict[str, str] = {"op11_prefix_trie": SQL_PREFIX_TRIE}
