"""Benchmark decontamination over a distributed positional inverted index.

The index holds (row, pos, term) postings of the training documents for every
term of the benchmark, and each document's length as a posting of the end
term; it is written once and serves every lookup. A phrase is found by
intersecting offset-adjusted lists, its rarest terms first; the remaining
terms are intersected only in documents that are left. Only DataFrame
operations, no Python on the executors.

Defined cases: null and empty texts have no words; items without words have
no windows, items with fewer words than a window are one window. Repeated
rows are indexed each on their own (by a row number that is fixed when the
index is written), so ids may repeat or be null. Items that repeat an id
count once; a null item id is left out of the counts and of the list of ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_below, sha256_hex, stored, text_hash

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""  # the term that marks a document's end
VOCABULARY_BROADCAST = 500_000
ROWS_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def query_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """(item string, window array<string>): every run of ``size`` words, or
    all words of a shorter item."""
    w = items.select(items[item_id].cast("string").alias("item"), words_of(items[text]).alias("w")).where("size(w) > 0")
    last = F.greatest(F.size("w") - size, F.lit(0))
    at = w.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return at.select("item", F.slice("w", F.col("at") + 1, F.lit(size)).alias("window"))


@dataclass
class Index:
    postings: DataFrame  # row long, pos int, term long
    vocabulary: DataFrame  # word string, term long
    ids: DataFrame  # row long, doc_id, text_hash, n_words int
    counts: DataFrame  # term long, n long


def build_index(docs: DataFrame, words: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Postings of the words in ``words`` (one column) over all documents."""
    end = docs.sparkSession.range(1).select(F.lit(END).alias("word"))
    vocabulary = words.toDF("word").where(F.col("word") != END).unionByName(end).distinct()
    vocabulary = stored(vocabulary.coalesce(1).select("word", F.monotonically_increasing_id().alias("term")), "vocabulary")
    terms = broadcast_below(vocabulary, VOCABULARY_BROADCAST)
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[doc_id].alias("doc_id"),
        text_hash(docs[text]).alias("text_hash"),
        F.concat(words_of(docs[text]), F.array(F.lit(END))).alias("w"),
    )
    hits = base.select("row", "doc_id", "text_hash", F.posexplode("w").alias("pos", "word")).join(terms, "word")
    at_end = F.col("word") == END
    of_doc = [F.when(at_end, F.col(c)).alias(c) for c in ("doc_id", "text_hash")]
    postings = stored(hits.select("row", "pos", "term", *of_doc, at_end.alias("is_end")), "postings")
    ids = postings.where("is_end").select("row", "doc_id", "text_hash", F.col("pos").alias("n_words"))
    postings = postings.where("not is_end").select("row", "pos", "term")
    return Index(postings, vocabulary, ids, stored(postings.groupBy("term").agg(F.count("*").alias("n")), "term-counts"))


def _query_terms(index: Index, windows: DataFrame) -> DataFrame:
    """(q, len, off, term, rank): each window's terms, rarest first. Windows
    with a term that no document holds are left out."""
    by_rarity = Window.partitionBy("q").orderBy("n", "term", "off")
    t = windows.select("q", F.size("window").alias("len"), F.posexplode("window").alias("off", "word"))
    t = t.join(index.vocabulary, "word").join(index.counts, "term")
    return t.select(
        "q",
        "len",
        "off",
        "term",
        F.row_number().over(by_rarity).alias("rank"),
        F.count("*").over(Window.partitionBy("q")).alias("known"),
    ).where("known = len").drop("known")


def phrase_matches(index: Index, windows: DataFrame, first: int = 3) -> DataFrame:
    """(q, row, start, len): every place where the words of ``windows`` (q,
    window array<string>, few against the documents) stand consecutively.

    The ``first`` rarest terms' lists are intersected over the whole index;
    the others only at the places left."""
    terms = stored(_query_terms(index, windows), "query-terms")
    rare = broadcast_below(terms.where(F.col("rank") <= first), VOCABULARY_BROADCAST)
    near = (
        index.postings.join(rare, "term")
        .select("q", "row", (F.col("pos") - F.col("off")).alias("start"), "len")
        .where("start >= 0")
        .groupBy("q", "row", "start", "len")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == F.least(F.col("len"), F.lit(first)))
        .drop("n")
    )
    near = stored(near, "places")
    rows = broadcast_below(near.select("row").distinct(), ROWS_BROADCAST)
    other = broadcast_below(terms.where(F.col("rank") > first).select("q", "off", "term"), VOCABULARY_BROADCAST)
    asked = near.join(other, "q").select("q", "row", "start", "len", "term", (F.col("start") + F.col("off")).alias("pos"))
    lists = index.postings.join(rows, "row", "left_semi")
    full = (
        asked.join(lists, ["row", "pos", "term"])
        .groupBy("q", "row", "start", "len")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == F.col("len") - first)
        .drop("n")
    )
    return near.where(F.col("len") <= first).unionByName(full)


def proximity_matches(index: Index, windows: DataFrame, span: int) -> DataFrame:
    """(q, row, start): places from which all words of a window, in any
    order, stand within ``span`` consecutive words; start is one of them."""
    terms = _query_terms(index, windows).select("q", "term", "rank").groupBy("q", "term").agg(F.min("rank").alias("rank"))
    terms = stored(terms.withColumn("need", F.count("*").over(Window.partitionBy("q"))), "near-terms")
    rare = broadcast_below(terms.where("rank = 1"), VOCABULARY_BROADCAST)
    rows = index.postings.join(rare, "term").select("q", "row").distinct()
    hits = index.postings.join(broadcast_below(terms, VOCABULARY_BROADCAST), "term").join(rows, ["q", "row"])
    ahead = Window.partitionBy("q", "row").orderBy("pos").rangeBetween(0, span - 1)
    return hits.select("q", "row", "pos", "need", F.size(F.collect_set("term").over(ahead)).alias("have")).where("have = need").select("q", "row", F.col("pos").alias("start"))


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 10
) -> DataFrame:
    """(doc_id, text_hash long, n_words long, n_hit long, n_items long, item_ids
    array<string>, contaminated boolean), one row per input row. A word is
    hit that stands in any occurrence of an item's window."""
    windows = query_windows(items, item_id, item_text, size)
    # equal windows are looked up once
    distinct = stored(windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(F.monotonically_increasing_id().alias("q"), "window", "items"), "windows")
    index = build_index(docs, distinct.select(F.explode("window")), doc_id, text)
    found = stored(phrase_matches(index, distinct.select("q", "window")), "matches")
    covered = (
        found.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    named = found.select("q", "row").distinct().join(distinct.select("q", F.explode_outer("items").alias("item")), "q")
    named = named.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    # found rows are few against all documents, and the index holds no text
    return (
        index.ids.join(covered.join(named, "row"), "row", "left")
        .select(
            F.col("doc_id").alias(doc_id),
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("item_ids", F.array().cast("array<string>"))).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def digests(result: DataFrame) -> DataFrame:
    return result.withColumn("items_sha256", sha256_hex(F.array_join("item_ids", ","))).drop("item_ids", "text_hash")
