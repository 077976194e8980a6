"""Tables with every kind of odd row, for all operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .brute import words  # noqa: F401

SF = "/root/testdata/sf0.001"

LINE = "this very line stands in more than five documents of the table"
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def odd_rows() -> list[tuple]:
    base = " ".join(f"w{i}" for i in range(200))
    rows = [
        (1, base),
        (2, base),  # a copy
        (3, base.replace("w7 ", "x ")),  # a near copy
        (4, base.replace("w7 ", "y ").replace("w90 ", "z ")),
        (5, " ".join(f"v{i}" for i in range(30))),
        (6, None),
        (7, ""),
        (8, " \n\t\n"),
        (None, base),
        (None, None),
        (None, LINE),
        (9, "One two THREE"),
        (10, "one TWO three"),  # fewer words than a shingle
        (11, ("long word " * 20000) + "end"),
        (12, "y" * 300_000),
        (13, base),
        (13, base),  # a repeated row
        (13, "another text under the same id"),
        (14, f"Ärger ÉÈ {PASSAGE.upper()}; und so weiter"),
        (15, f"{PASSAGE} {PASSAGE}"),
        (16, "nbsp\u00a0joined <|endoftext|> it's 12're \U0001f600\U0001f600 \r\n  x"),
        (17, "Released under the MIT License.\nGNU general public LICENSE\nlicensed under the Apache License Version 2.0"),
    ]
    rows += [(100 + i, f"own words number {i}\n  {LINE.upper() if i % 2 else LINE}\t\nlast {i}") for i in range(8)]
    rows += [(120, f"{LINE}\n{LINE}")]
    return rows


def documents(spark, rows=None):
    """Documents with extra columns whose names clash with internal ones."""
    df = spark.createDataFrame(odd_rows() if rows is None else rows, "doc_id long, text string").repartition(3)
    extra = ("row", "t", "d", "h", "k", "n", "key", "kept", "score", "digest", "n_lines", "a.b", "text_hash", "node")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(extra)})


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)
