"""The registered ``opN_<name>`` queries: each operator with production
parameters over its whole table, reduced to digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries_more
from .bpe import BpeModel, bpe_digests
from .common import read_table, sha256_hex
from .decontam import contamination, digests
from .license_scan import scan_licenses, summary
from .line_dedup import drop_repeated_lines
from .minhash import near_duplicates
from .quality import quality
from .token_counts import count_after_edits
from .toxicity import toxicity
from .url_filter import RULES, judge_urls, url_host, url_path
from .vector_dedup import embedding_duplicates


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf, "documents"), BpeModel(vocabulary_path()))


def q_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    got = drop_repeated_lines(read_table(spark, sf, "documents"), ["doc_id"])
    return got.select("row.doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))


def q_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf, "documents"), percent=85).drop("text_hash")


def q_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return digests(contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")))


def _scored(got: DataFrame) -> DataFrame:
    return got.select("row.doc_id", "held_out", "score", "predicted")


def q_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(toxicity(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), max_per_class=1500, threshold=0.3))


def q_quality(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(quality(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), max_per_class=1500, threshold=0.3))


def contact_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace mail addresses, and numbers of seven or more digits
    and separators, from the last to the first."""
    import re

    found = re.finditer(r"([\w.+-]+@[\w-]+\.[\w.-]+)|\+?\d[\d ().-]{5,}\d", text)
    return [(m.start(), m.end(), "<mail>" if m[1] else "<number>") for m in found][::-1]


def q_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document before and after its contact data are
    replaced."""
    return count_after_edits(read_table(spark, sf, "documents"), BpeModel(vocabulary_path()), contact_edits)


def q_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_duplicates(read_table(spark, sf, "embeddings"), cosine=0.93)


_LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = "regexp_extract_all(" + _LOWER_SQL.format("coalesce({0}, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL.format('text')} AS w FROM benchmark),
bw AS (
  SELECT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def q_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """The list: addresses of thin pages, whose html is shorter than half the
    mean of all pages."""
    pages = read_table(spark, sf, "pages")
    size = F.coalesce(F.length("html"), F.lit(0))
    total, n = pages.agg(F.sum(size), F.count("*")).first()
    thin = pages.where(2 * size.cast("long") * n < F.lit(total))
    return judge_urls(pages, thin.select(F.concat(url_host(F.col("url")), url_path(F.col("url"))).alias("key")))


def _rule_sql(column: int) -> str:
    order = sorted(RULES, key=lambda r: -(len(r[1]) + len(r[2])))
    whens = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[column]}'" for v, h, p in order
    ]
    return "CASE " + " ".join(whens) + " END"


_HOST_SQL = _LOWER_SQL.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")
SQL_URL_FILTERS = f"""
WITH p AS (
  SELECT page_id, coalesce(length(html), 0) AS size, {_HOST_SQL} AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
thin AS (SELECT DISTINCT host || path AS key FROM p, (SELECT sum(size) AS total, count(*) AS n FROM p) WHERE 2 * size * n < total)
SELECT page_id, host, path, {_rule_sql(0)} AS rule,
       coalesce({_rule_sql(1)}, CASE WHEN host || path IN (SELECT key FROM thin) THEN 'block' ELSE 'allow' END) AS verdict
FROM p
"""


def q_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return summary(scan_licenses(read_table(spark, sf, "documents"), threshold=0.8))


QUERIES = {
    "op1_toxicity": q_toxicity,
    "op2_decontamination": q_decontamination,
    "op3_token_counts": q_token_counts,
    "op4_quality": q_quality,
    "op5_embedding_dedup": q_embedding_dedup,
    "op6_url_filters": q_url_filters,
    "op7_line_dedup": q_line_dedup,
    "op8_bpe": q_bpe,
    "op9_minhash": q_minhash,
    "op10_license_scan": q_license_scan,
    **queries_more.QUERIES,
}
SQL: dict[str, str] = {
    "op2_decontamination": SQL_DECONTAMINATION,
    "op6_url_filters": SQL_URL_FILTERS,
    **queries_more.SQL,
}
