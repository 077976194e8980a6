"""Corpus cleaning pipeline over ``documents``, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``docs``, whatever these are beside doc_id and text.

What a stage decides takes effect: toxic documents go; repeated lines go from
all but the last document that holds them (n_chars, where there, follows the
text); of each group of near duplicates the document with the smallest id
stays; documents with a benchmark window go; the rest is encoded. Rows with a
null id are scored, cleaned and encoded like any other and take no part in
groups. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpull.llm.bpe import BpeModel, bpe_digests
from gridpull.llm.common import fresh, read_table, stored, text_hash
from gridpull.llm.decontam import contamination
from gridpull.llm.line_dedup import drop_repeated_lines
from gridpull.llm.minhash import near_duplicates
from gridpull.llm.queries import vocabulary_path
from gridpull.llm.toxicity import toxicity
from gridpull.operators.sizing import drop_tables, table_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic verdict (score below 0.3)."""
    got = toxicity(docs, read_table(spark, sf_dir, "labels"), threshold=0.3).where("predicted = 0")
    return got.select(*[F.col("t").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of five or more documents except in
    the last holder. A document keeps its row even if no line is left; a text
    without a dropped line is kept as it was."""
    # the text goes to the tasks and comes back once, as the kept lines; what
    # these don't tell is whether it was null
    none = fresh(docs, "no_text")
    others = [c for c in docs.columns if c != "text"]
    got = drop_repeated_lines(docs.withColumn(none, docs["text"].isNull()), [*others, none], min_docs=5, min_chars=40)

    row, changed = F.col("row"), F.col("n_dropped") > 0

    def column(c: str) -> Column:
        if c == "text":
            return F.when(~row[none], F.col("kept")).alias(c)
        if c == "n_chars":
            return F.when(changed, F.length("kept").cast(docs.schema[c].dataType)).otherwise(row[c]).alias(c)
        return row[c].alias(c)

    return got.select(*map(column, docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest
    id. Rows that repeat an id and its text are one document; one stays."""
    found = near_duplicates(docs, percent=85).where("kept and doc_id is not null")
    kept = found.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h")).distinct()
    h = fresh(docs, "text_hash")
    named = docs.where(docs["doc_id"].isNotNull()).withColumn(h, text_hash(docs["text"]))
    rows = named.join(kept, (named["doc_id"] == kept["k"]) & (named[h] == kept["h"]), "left_semi")
    return rows.dropDuplicates(["doc_id", h]).drop(h).unionByName(docs.where(docs["doc_id"].isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = found.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["k"]) & (text_hash(docs["text"]) == bad["h"]), "left_anti")


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document kept."""
    return bpe_digests(docs, BpeModel(vocabulary_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", drop_contaminated),
    ("bpe", encode_bpe),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage wrote on its way goes when its
    result is written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with table_scope() as scratch:
            got = stage(spark, docs, sf_dir)
        docs = stored(got, f"stage-{name}")
        drop_tables(spark, scratch)
    return STAGES[-1][1](spark, docs, sf_dir)
