"""Unicode NFKC as a Column expression, without a Python worker.

The tables come from Python's own Unicode data where the expression is built.
Most text needs one step: ``translate`` maps the characters whose compatibility
form is one character (full-width digits, no-break blanks). Only text that
then still holds a character that may change in context takes the three steps
of the standard: decomposition, canonical order of combining marks, and
composition (pairs by table, Hangul by arithmetic).
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_ENTRY, _TO = "\x01", "\x02"
# Hangul syllables are computed: first code point and number of each part.
_S, _L, _V, _T = (0xAC00, 11172), (0x1100, 19), (0x1161, 21), (0x11A7, 28)


@cache
def _data() -> tuple[dict, dict, dict, dict, str]:
    """(one-character forms, longer forms, combining classes, pairs, pattern
    of the characters that need the long way)."""
    one, many, ccc, pairs, hard = {}, {}, {}, {}, set()
    for n in range(sys.maxunicode + 1):
        c = chr(n)
        if 0xD800 <= n < 0xE000 or _S[0] <= n < _S[0] + _S[1]:
            continue
        form = unicodedata.normalize("NFKD", c)
        if form != c:
            (one if len(form) == 1 else many)[c] = form
            if len(form) > 1 and unicodedata.normalize("NFKC", c) != c:
                hard.add(n)
        if unicodedata.combining(c):
            ccc[c] = unicodedata.combining(c)
            hard.add(n)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and "<" not in parts[0]:
            pair = "".join(chr(int(p, 16)) for p in parts)
            if unicodedata.normalize("NFC", pair) == c:
                pairs[pair] = c
                hard.add(ord(pair[1]))
    hard.update(range(_V[0], _V[0] + _V[1]), range(_T[0] + 1, _T[0] + _T[1]))
    ranges, start = [], None
    for n in sorted(hard):
        if n - 1 not in hard:
            start = n
        if n + 1 not in hard:
            ranges.append(rf"\x{{{start:x}}}-\x{{{n:x}}}")
    return one, many, ccc, pairs, f"[{''.join(ranges)}]"


def _table(entries: dict) -> Column:
    text = _ENTRY.join(f"{k}{_TO}{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_TO))  # folded to a constant


def _char(code: Column) -> Column:
    """The character of a code point below 2^16."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _offset(c: Column, part: tuple[int, int]) -> Column:
    return F.ascii(c) - part[0]


def _within(offset: Column, part: tuple[int, int], low: int = 0) -> Column:
    return (offset >= low) & (offset < part[1])


def _composed(first: Column, second: Column, pairs: Column) -> Column:
    """The primary composite of two characters, or NULL."""
    lead, vowel = _offset(first, _L), _offset(second, _V)
    syllable, tail = _offset(first, _S), _offset(second, _T)
    return (
        F.when(_within(lead, _L) & _within(vowel, _V), _char((lead * _V[1] + vowel) * _T[1] + _S[0]))
        .when(_within(syllable, _S) & (syllable % _T[1] == 0) & _within(tail, _T, 1), _char(syllable + tail + _S[0]))
        .otherwise(F.try_element_at(pairs, F.concat(first, second)))
    )


def _long_way(s: Column) -> Column:
    _, many, ccc, pairs, _ = _data()
    forms, classes, composites = _table(many), _table(ccc), _table(pairs)
    chars = F.flatten(F.transform(F.split(s, ""), lambda c: F.split(F.coalesce(F.try_element_at(forms, c), c), "")))
    marked = F.transform(chars, lambda c: F.struct(c.alias("c"), F.coalesce(F.try_element_at(classes, c).cast("int"), F.lit(0)).alias("k")))
    # marks are ordered by class within the run after their starter
    placed = F.transform(
        marked,
        lambda x, i: F.struct(F.size(F.filter(F.slice(marked, F.lit(1), i + 1), lambda y: y["k"] == 0)).alias("run"), x["k"].alias("k"), i.alias("i"), x["c"].alias("c")),
    )
    begin = F.struct(F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("tail"), F.lit(0).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        blocked = (acc["tail"] != "") & (acc["last"] >= x["k"])
        whole = F.when(~blocked & (acc["starter"] != ""), _composed(acc["starter"], x["c"], composites))
        taken = whole.isNotNull()
        new = (x["k"] == 0) & ~taken
        return F.struct(
            F.when(new, F.concat(acc["done"], acc["starter"], acc["tail"])).otherwise(acc["done"]).alias("done"),
            F.when(taken, whole).when(new, x["c"]).otherwise(acc["starter"]).alias("starter"),
            F.when(new, F.lit("")).when(taken, acc["tail"]).otherwise(F.concat(acc["tail"], x["c"])).alias("tail"),
            F.when(new, F.lit(0)).when(taken, acc["last"]).otherwise(x["k"]).alias("last"),
        )

    return F.aggregate(F.array_sort(placed), begin, step, lambda acc: F.concat(acc["done"], acc["starter"], acc["tail"]))


def nfkc_text(c: Column) -> Column:
    """NFKC of a text column; NULL stays NULL."""
    one, *_, hard = _data()
    mapped = F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, "".join(one), "".join(one.values()))).otherwise(c)
    return F.when(mapped.rlike(hard), _long_way(mapped)).otherwise(mapped)
