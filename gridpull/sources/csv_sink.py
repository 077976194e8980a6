"""CSV sink with the result-file conventions of the sheet workflow.

* header line; values written verbatim (no trimming), NULL and '' as
  nothing, quotes doubled, backslash literal;
* UTF-8 with a byte-order mark (so spreadsheets detect the encoding): the
  BOM is the first character of the first column name;
* timestamps as ``YYYY-MM-DDTHH:MM:SS`` plus a fraction only when non-zero,
  decimals without padding zeros (``1234.5``, ``12.0``), doubles as
  Python prints them (``10000000.0``, ``1e-05``), booleans as ``True`` /
  ``False``.

Rows are formatted to lines by position, so a header name may repeat. A result
is one named file (``single_file``) or a folder of parts that each start with
the BOM and the header; which of them is the caller's choice. Either is
written to a fresh folder beside the target first and then swapped in by
renames, so a failed write leaves the old result in place.
"""

from __future__ import annotations

import glob
import os
import shutil
import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import iso_text_fraction

BOM = "\ufeff"


_JAVA_SCI = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"


def python_float_text(c) -> F.Column:
    """double -> the text Python's ``repr`` gives (what a pandas CSV holds).

    Spark prints doubles like Java: scientific from 1e7 and below 1e-3.
    Python prints plainly from 1e-4 up to 1e16 and writes exponents as
    ``e+16`` / ``e-05``; NaN and infinities are ``nan`` / ``inf``.
    """
    s = c.cast("string")
    sign = F.regexp_extract(s, _JAVA_SCI, 1)
    d0 = F.regexp_extract(s, _JAVA_SCI, 2)
    frac = F.regexp_extract(s, _JAVA_SCI, 3)
    e = F.regexp_extract(s, _JAVA_SCI, 4).try_cast("int")
    frac = F.when(frac == F.lit("0"), F.lit("")).otherwise(frac)
    digits = F.concat(d0, frac)
    width = e + F.lit(1)
    big = F.when(
        F.length(digits) <= width, F.concat(sign, F.rpad(digits, width, "0"), F.lit(".0"))
    ).otherwise(F.concat(sign, F.substring(digits, F.lit(1), width), F.lit("."), F.substring(digits, width + 1, F.lit(400))))
    tiny = F.concat(sign, F.lit("0.000"), digits)
    sci = F.concat(
        sign,
        d0,
        F.when(frac != F.lit(""), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("e"),
        F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")),  # at least two exponent digits
        F.abs(e).cast("string"),
    )
    return (
        F.when(s == F.lit("NaN"), F.lit("nan"))
        .when(s == F.lit("Infinity"), F.lit("inf"))
        .when(s == F.lit("-Infinity"), F.lit("-inf"))
        .when(~s.rlike(_JAVA_SCI), s)
        .when((e >= 7) & (e < 16), big)
        .when(e == -4, tiny)
        .otherwise(sci)
    )


def csv_text(c: Column, dtype: T.DataType) -> Column:
    """A value's text in the file, before quoting."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text_fraction(c)
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        return F.regexp_replace(c.cast("string"), r"(\.[0-9]*?[0-9])0+$", "$1")
    if isinstance(dtype, T.DoubleType):
        return python_float_text(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def quoted(text: Column) -> Column:
    """NULL as nothing; quotes around a text with a delimiter, quote or line
    break, quotes inside doubled."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


def header_line(names: list[str], bom: bool = True) -> Column:
    return F.concat(F.lit(BOM if bom else ""), F.array_join(F.array(*[quoted(F.lit(n)) for n in names]), ","))


def csv_lines(df: DataFrame) -> DataFrame:
    """(line): the rows of ``df`` as CSV lines, in its order; columns are
    taken by position."""
    kinds = [f.dataType for f in df.schema.fields]
    by_position = df.toDF(*[f"_{i}" for i in range(len(kinds))])
    values = [quoted(csv_text(F.col(f"_{i}"), k)) for i, k in enumerate(kinds)]
    return by_position.select(F.array_join(F.array(*values), ",").alias("line"))


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark, new: str, target: str) -> None:
    """Put the finished ``new`` (file or folder) in ``target``'s place; the
    old result goes only after the new one stands there, and comes back if
    the swap fails."""
    src, fs = _fs(spark, new)
    dst, _ = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    old = _fs(spark, f"{target}.old-{uuid.uuid4().hex}")[0] if fs.exists(dst) else None
    if old is not None and not fs.rename(dst, old):
        raise OSError(f"cannot move the old result {target}")
    if not fs.rename(src, dst):
        if old is not None:
            fs.rename(old, dst)
        raise OSError(f"cannot move the new result to {target}")
    if old is not None:
        fs.delete(old, True)


def can_concat(spark, path: str) -> bool:
    """Whether ``path``'s file system joins files without copying them."""
    p, fs = _fs(spark, path)
    return fs.hasPathCapability(p.getParent(), "fs.capability.paths.concat")


def concat(spark, first: str, rest: list[str]) -> None:
    """Have the file system append the files ``rest`` to ``first``, in order."""
    p, fs = _fs(spark, first)
    gateway = spark.sparkContext._gateway
    paths = gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
    for i, r in enumerate(rest):
        paths[i] = _fs(spark, r)[0]
    fs.concat(p, paths)


def is_mounted(spark, path: str) -> bool:
    """Whether ``path`` is a mounted disk's, on which tasks write their own
    byte ranges of one file."""
    return _fs(spark, path)[1].getUri().getScheme() == "file"


def join_mounted(spark, parts: list[str], head_bytes: int, target: str) -> None:
    """The parts' bytes as the one file ``target``, in order, the header (the
    first ``head_bytes`` of each part) once. Every part's place is known from
    the sizes, so tasks copy them side by side, a buffer at a time; a task that
    runs again writes the same bytes to the same place."""
    local = lambda path: _fs(spark, path)[0].toUri().getPath()
    end, spans = 0, []
    for path in parts:
        p, fs = _fs(spark, path)
        skip = head_bytes if spans else 0
        size = fs.getFileStatus(p).getLen() - skip
        spans.append((local(path), skip, end, size))
        end += size
    out = local(target)

    def copy(span):
        source, skip, at, size = span
        with open(source, "rb") as src, os.fdopen(os.open(out, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as dst:
            src.seek(skip)
            dst.seek(at)
            shutil.copyfileobj(src, dst, 1 << 20)
            if dst.tell() != at + size:
                raise OSError(f"{source} has changed")

    spark.sparkContext.parallelize(spans, len(spans)).foreach(copy)
    p, fs = _fs(spark, target)
    if fs.getFileStatus(p).getLen() != end:
        raise OSError(f"{target} is not whole")


def _parts(spark, folder: str) -> list[str]:
    """Written files below a folder, in part order, without empty ones."""
    p, fs = _fs(spark, folder)
    found = [f for f in fs.listStatus(p) if f.getPath().getName().startswith("part-") and f.getLen()]
    return sorted(f.getPath().toString() for f in found)


def _with_header(lines: DataFrame, head: Column) -> DataFrame:
    """The first line of each part brings the header with it."""
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select("line", low.alias("i")).select(
        F.explode(F.when(F.col("i") == 0, F.array(head, "line")).otherwise(F.array("line"))).alias("line")
    )


def _merged(spark, folder: str, head_lines: int, line_sep: str) -> DataFrame:
    """The lines of a folder's parts as one ordered part, the header once."""
    text = spark.read.option("lineSep", line_sep).text(_parts(spark, folder))
    at = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("k")]
    lines = text.select("value", *at).select("*", F.row_number().over(Window.partitionBy("f").orderBy("b", "k")).alias("n"))
    first = lines.agg(F.min("f")).first()[0]
    kept = lines.where((F.col("n") > head_lines) | (F.col("f") == F.lit(first)))
    return kept.coalesce(1).sortWithinPartitions("f", "b", "k").select("value")


def write_csv(df: DataFrame, path: str, bom: bool = True, line_sep: str = "\n", single_file: bool | int = False) -> str:
    """Write ``df`` as CSV, in its row order; returns ``path``.

    By default ``path`` is a folder of parts in order, each a CSV of its own;
    an empty frame gives one part with the header.

    ``single_file``: ``path`` is one file, with True always, with a number for
    results of at most so many rows; larger ones stay a folder of parts. Where
    the file system can join files, all tasks write and it joins their parts
    behind the header's, at any size. On a mounted disk all tasks write, and
    then copy their parts into the one file. Elsewhere one task merges."""
    spark = df.sparkSession
    head = header_line(df.columns, bom)
    obs = Observation()
    lines = csv_lines(df).observe(obs, F.count(F.lit(1)).alias("n"))
    path = path.rstrip("/")
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    only_head = spark.range(1).select(head.alias("line")).coalesce(1)
    save = lambda out, to: out.write.mode("overwrite").option("lineSep", line_sep).text(to)
    scratch = [fresh]
    try:
        if single_file and can_concat(spark, fresh):
            save(lines, fresh)
            scratch.append(f"{fresh}-head")
            save(only_head, scratch[-1])
            new = _parts(spark, scratch[-1])[0]
            rest = _parts(spark, fresh)
            if rest:
                concat(spark, new, rest)
        elif single_file is True and not is_mounted(spark, fresh):
            save(_with_header(lines.coalesce(1), head), fresh)
            if obs.get["n"] == 0:
                save(only_head, fresh)
            new = _parts(spark, fresh)[0]
        else:
            save(_with_header(lines, head), fresh)
            if obs.get["n"] == 0:
                save(only_head, fresh)
            new = fresh
            if single_file is True or (single_file and obs.get["n"] <= single_file):
                parts = _parts(spark, fresh)
                new = parts[0]
                if len(parts) > 1 and is_mounted(spark, fresh):
                    head_bytes = len((spark.range(1).select(head).first()[0] + line_sep).encode())
                    new = f"{fresh}-one"
                    scratch.append(new)
                    join_mounted(spark, parts, head_bytes, new)
                elif len(parts) > 1:
                    scratch.append(f"{fresh}-one")
                    names = sum(name.count(line_sep) for name in df.columns)
                    save(_merged(spark, fresh, 1 + names, line_sep), scratch[-1])
                    new = _parts(spark, scratch[-1])[0]
        publish(spark, new, path)
    finally:
        for folder in scratch:
            p, fs = _fs(spark, folder)
            if fs.exists(p):
                fs.delete(p, True)
    return path


def part_files(path: str) -> list[str]:
    """The CSV part files of a written folder, in part order (local paths)."""
    return sorted(glob.glob(os.path.join(path, "**", "part-*"), recursive=True))
