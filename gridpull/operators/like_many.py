"""Very many LIKE patterns at once.

A pattern can match only values that hold all its literal pieces. Each pattern
is filed under one n-gram of its pieces (three characters, fewer where its
pieces are shorter), the one that the fewest values hold. A value meets only
the patterns filed under one of its own n-grams, and ``LIKE`` verifies them.
Patterns without any literal meet values by length. So the work follows the
candidates, not patterns times values, and no OR chain is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import broadcast_if_small, materialize

GRAM = 3
MAX_BROADCAST_PATTERNS = 200_000


def _grams(text: Column, n: Column | int) -> Column:
    """All n-grams of a text (none if it is shorter)."""
    n = F.lit(n) if isinstance(n, int) else n
    at = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.when(F.length(text) >= n, F.transform(at, lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>"))


def _filed(patterns: DataFrame) -> DataFrame:
    """(pattern, n, grams): n-gram length and n-grams of the literal pieces;
    n is 0 without literals. An escaped character only ends a piece."""
    pieces = F.split(F.regexp_replace("pattern", r"(?s)\\.", "%"), "[%_]")
    longest = F.array_max(F.transform(pieces, F.length))
    x = patterns.select("pattern", pieces.alias("pieces"), F.least(longest, F.lit(GRAM)).alias("n"))
    grams = F.array_distinct(F.flatten(F.transform("pieces", lambda p: _grams(p, F.col("n")))))
    return x.select("pattern", "n", F.when(F.col("n") > 0, grams).alias("grams"))


def like_pairs(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, pattern): every distinct value of the one-column frame
    ``values`` with every distinct pattern of ``patterns`` that it matches.
    Nulls match nothing."""
    values = materialize(values.toDF("value").where("value is not null").distinct())
    patterns = materialize(_filed(patterns.toDF("pattern").where("pattern is not null").distinct()))
    lengths = [r["n"] for r in patterns.select("n").distinct().collect()]  # 0 to GRAM
    found = []
    if any(lengths):
        own = F.array_distinct(F.concat(*[_grams(F.col("value"), n) for n in lengths if n]))
        held = values.select("value", F.explode(own).alias("gram"))
        asked, _ = broadcast_if_small(patterns.select(F.explode("grams").alias("gram")).distinct(), MAX_BROADCAST_PATTERNS)
        counts = materialize(held.join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("df")))
        # grams that no value holds leave their pattern without a match
        of = patterns.where("n > 0").select("pattern", F.size("grams").alias("k"), F.explode("grams").alias("gram")).join(counts, "gram")
        rarest = of.groupBy("pattern").agg(F.min_by("gram", F.struct("df", "gram")).alias("gram"), F.count("*").alias("have"), F.max("k").alias("k"))
        rarest = materialize(rarest.where("have = k").select("pattern", "gram"))
        side, _ = broadcast_if_small(rarest, MAX_BROADCAST_PATTERNS)
        found.append(held.join(side, "gram").where(F.like(F.col("value"), F.col("pattern"))).select("value", "pattern"))
    if 0 in lengths:
        rest = patterns.where("n = 0").select("pattern", F.regexp_replace("pattern", r"(?s)\\.", "_").alias("shape"))
        rest = rest.select("pattern", F.contains("shape", F.lit("%")).alias("open"), F.length(F.regexp_replace("shape", "%", "")).alias("length"))
        rest, _ = broadcast_if_small(rest, MAX_BROADCAST_PATTERNS)
        size = F.length("value")
        open_too = values.select("value", size.alias("size"), F.explode(F.sequence(F.lit(0), size)).alias("length"))
        met = open_too.join(rest, "length").where(F.col("open") | (F.col("size") == F.col("length")))
        found.append(met.where(F.like(F.col("value"), F.col("pattern"))).select("value", "pattern"))
    if not found:
        return values.limit(0).select("value", F.lit("").alias("pattern"))
    return reduce(DataFrame.unionByName, found)


def like_any(df: DataFrame, column: str, patterns: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` matches at least one pattern."""
    hits = materialize(like_pairs(df.select(F.col(column).cast("string")), patterns).select(F.col("value").alias("_like")).distinct())
    side, _ = broadcast_if_small(hits, MAX_BROADCAST_PATTERNS)
    return df.join(side, F.col(column).cast("string") == F.col("_like"), "left_semi")
