"""Answering parameter sets against a fact table.

A parameter set is ``(id, start, end)``: fact rows with ``id_col = id`` and
``start <= date_col <= end``, a NULL bound being open. Answering N sets is one
relational operator, not N queries:

* ``param_join``   inner join – one output row per (fact row, matching set);
  this is the concatenation of per-set results (multiplicity kept).
* ``param_match``  fact rows matching at least one set (per ``by`` group such
  as the sheet). Because a set's predicate only reads (id, date) and the
  result is later de-duplicated on exactly (id, date), this semi join gives
  the same final rows as join + dedup, without the blow-up of overlapping
  sets.

Physical strategy, chosen behind counted bounds:

1. few sets (<= ``pushdown_max_sets``): one literal OR-of-sets filter on the
   fact scan; it reaches Parquet as pushed filters (row-group skipping) and
   needs no join at all;
2. sets counted <= ``broadcast_max_sets``: the sets are written once to the
   checkpoint folder, broadcast and probed by a hash join on id with the
   range as residual (per-group sets are first merged into disjoint ranges,
   so the inner join is a per-group semi join); the fact side never
   shuffles. Ids with many sets become one row each, the sorted array of
   their disjoint ranges, which a fact row probes by binary search
   (``range_index``), so a hot id costs a row the logarithm of its sets. A distinct-id envelope (``id IN …``, up to
   ``broadcast_max_ids``) and the overall date envelope are added as scan
   filters;
3. otherwise: a shuffled equi join on (id, time bucket) – see
   ``bucketed_range_join`` – so that neither a hot id's fact rows nor its
   many ranges pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ExtractConfig
from ..functions.dates import day_start
from .ordering import fetch_order, with_position
from .projection import column_type
from .sizing import broadcast_if_small, materialize, take_at_most

MAX_SUMMARY_ROWS = 100_000
_FAR_PAST = "0001-01-01 00:00:00"
_FAR_FUTURE = "9999-12-31 23:59:59.999999"


def typed_id(id_text: Column, dtype: T.DataType) -> Column:
    """Parameter id text in the fact id column's type (the literal is
    coerced to the column type, like a database coerces a typed literal)."""
    if isinstance(dtype, T.StringType):
        return id_text
    return id_text.try_cast(dtype)


def range_ok(d: Column, start: Column, end: Column) -> Column:
    """start <= d <= end with NULL bounds open; a NULL d passes only an
    all-open set."""
    return (start.isNull() | (d >= start)) & (end.isNull() | (d <= end))


def prepared_sets(fact: DataFrame, params: DataFrame, cfg: ExtractConfig, by: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """params -> (*by, *keep, _pid, _ps, _pe) typed for the fact columns."""
    dtype = column_type(fact, cfg.id_col)
    ps, pe = F.col("start"), F.col("end")
    if cfg.date_only:
        ps, pe = day_start(ps), day_start(pe)
    return params.select(
        *by,
        *[k for k in keep if k not in by],
        typed_id(F.col("id"), dtype).alias("_pid"),
        ps.cast("timestamp_ntz").alias("_ps"),
        pe.cast("timestamp_ntz").alias("_pe"),
    ).where(F.col("_pid").isNotNull())


def merge_ranges(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union overlapping ranges per key; output ranges are disjoint.

    Ranges are ordered by start (open first); a range starts a new group
    when its start is after every end seen so far. Open ends count as +inf.
    Exact for semi-join use: the union of the merged ranges equals the union
    of the inputs.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("_ps").asc_nulls_first(), F.col("_pe").asc_nulls_last())
    far = F.lit(_FAR_FUTURE).cast("timestamp_ntz")
    prev_end = F.max(F.coalesce("_pe", far)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts_group = prev_end.isNull() | (F.col("_ps").isNotNull() & (F.col("_ps") > prev_end))
    g = sets.withColumn("_new", starts_group.cast("int")).withColumn(
        "_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    n = F.count(F.lit(1))
    return g.groupBy(*keys, "_g").agg(
        F.when(F.count("_ps") < n, F.lit(None)).otherwise(F.min("_ps")).cast("timestamp_ntz").alias("_ps"),
        F.when(F.count("_pe") < n, F.lit(None)).otherwise(F.max("_pe")).cast("timestamp_ntz").alias("_pe"),
    ).drop("_g")


def range_index(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint ranges -> one row per key: (*keys, _starts, _ends, _all).
    ``_starts`` ascends; open bounds are the far past and future; ``_all``
    says that a range open on both sides takes rows without a date."""
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (_FAR_PAST, _FAR_FUTURE))
    ranges = F.sort_array(F.collect_list(F.struct(F.coalesce("_ps", lo).alias("s"), F.coalesce("_pe", hi).alias("e"))))
    x = merged.groupBy(*keys).agg(ranges.alias("x"), F.max(F.col("_ps").isNull() & F.col("_pe").isNull()).alias("_all"))
    return x.select(*keys, F.col("x")["s"].alias("_starts"), F.col("x")["e"].alias("_ends"), "_all")


def in_ranges(d: Column, starts: Column, ends: Column, any_date: Column, longest: int) -> Column:
    """Whether ``d`` is in one of the disjoint ranges: a binary search for the
    last start at or before it. ``longest`` bounds the arrays' length."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, longest.bit_length())))])
    # ``get`` gives NULL beyond the end, which is no hit
    last = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(starts, at + step - 1) <= d, at + step).otherwise(at))
    return (d.isNull() & any_date) | F.coalesce(F.get(ends, last - 1) >= d, F.lit(False))


def merge_ranges_balanced(sets: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """:func:`merge_ranges` for set tables where one key may hold a large
    share of all ranges.

    The ranges are range-partitioned on (key, start, end), so a hot key is
    spread over many tasks in global order. Each task computes the running
    maximum end and the group starts of its own slice; what a slice needs
    from earlier slices of the same key (the maximum end so far and the last
    group start) comes from a carry table with at most two rows per
    partition (the first and the last key of each partition), which is
    broadcast. No key is ever gathered into one task.
    """
    keys = list(keys)
    far = F.lit(_FAR_FUTURE).cast("timestamp_ntz")
    kstruct = F.struct(*[F.col(k) for k in keys])
    order = [F.col("_ps").asc_nulls_first(), F.col("_pei").asc()]
    base = sets.select(*keys, "_ps", "_pe", F.coalesce("_pe", far).alias("_pei"))
    rp = base.repartitionByRange(partitions, *keys, *order) if partitions else base.repartitionByRange(*keys, *order)
    ordered = materialize(rp.withColumn("_part", F.spark_partition_id()))

    w = Window.partitionBy(*keys, "_part").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    ks_w = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)

    spark = sets.sparkSession

    def local(df: DataFrame) -> DataFrame:
        # per-partition summaries, two rows per partition: a local table
        # (free to broadcast) behind a count, else a table of their own
        rows = take_at_most(df, MAX_SUMMARY_ROWS)
        return materialize(df) if rows is None else F.broadcast(spark.createDataFrame(rows, df.schema))

    bounds = local(ordered.groupBy("_part").agg(F.min(kstruct).alias("_fk"), F.max(kstruct).alias("_lk")))

    def boundary(df: DataFrame) -> DataFrame:
        # (part, key) rows whose key is the first or last key of the partition
        return df.join(bounds, "_part").where((kstruct == F.col("_fk")) | (kstruct == F.col("_lk")))

    def first_key_only(df: DataFrame) -> DataFrame:
        return df.join(bounds, "_part").where(kstruct == F.col("_fk")).drop("_fk", "_lk")

    # 1. maximum end over earlier partitions of the same key
    t1 = boundary(ordered.groupBy("_part", *keys).agg(F.max("_pei").alias("_kmax")))
    c1 = local(first_key_only(t1.select("_part", *keys, F.max("_kmax").over(ks_w).alias("_cend"))))
    x = ordered.withColumn("_lprev", F.max("_pei").over(before)).join(c1, ["_part", *keys], "left")
    prev = F.greatest(F.col("_lprev"), F.col("_cend"))
    x = x.withColumn("_new", prev.isNull() | (F.col("_ps").isNotNull() & (F.col("_ps") > prev)))

    # 2. group start: the start of the last range that opened a group
    opener = F.when(F.col("_new"), F.struct(F.col("_ps").alias("s")))
    x = x.withColumn("_lgs", F.last(opener, ignorenulls=True).over(upto))
    t2 = boundary(x.groupBy("_part", *keys).agg(F.max(opener).alias("_pgs")))
    c2 = local(first_key_only(t2.select("_part", *keys, F.last("_pgs", ignorenulls=True).over(ks_w).alias("_cgs"))))
    y = x.join(c2, ["_part", *keys], "left").withColumn("_gs", F.coalesce("_lgs", "_cgs"))

    n = F.count(F.lit(1))
    return y.groupBy(*keys, "_gs").agg(
        F.when(F.count("_ps") < n, F.lit(None)).otherwise(F.min("_ps")).cast("timestamp_ntz").alias("_ps"),
        F.when(F.count("_pe") < n, F.lit(None)).otherwise(F.max("_pe")).cast("timestamp_ntz").alias("_pe"),
    ).drop("_gs")


def _lit_ts(text: str | None) -> Column | None:
    return None if text is None else F.lit(text).cast("timestamp_ntz")


def literal_sets_predicate(rows: Sequence, id_col: str, date_col: str, dtype: T.DataType) -> Column:
    """OR over sets of (id = v AND date >= s AND date <= e) with literals only,
    so the whole predicate is pushed to the scan."""
    d = F.col(date_col)
    terms = []
    for r in rows:
        t = F.col(id_col) == F.lit(r["_pid"]).cast(dtype)
        s, e = _lit_ts(r["_ps_text"]), _lit_ts(r["_pe_text"])
        if s is not None:
            t = t & (d >= s)
        if e is not None:
            t = t & (d <= e)
        terms.append(t)
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def _with_texts(sets: DataFrame) -> DataFrame:
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return sets.select(
        "*",
        F.date_format("_ps", fmt).alias("_ps_text"),
        F.date_format("_pe", fmt).alias("_pe_text"),
    )


def _set_stats(sets: DataFrame):
    """One small job over the (materialised) sets: how many, how many ids,
    and the overall date envelope."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return sets.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("_pid").alias("n_ids"),
        F.count("_ps").alias("n_s"),
        F.count("_pe").alias("n_e"),
        F.date_format(F.min("_ps"), fmt).alias("lo"),
        F.date_format(F.max("_pe"), fmt).alias("hi"),
    ).first()


def _envelope(fact: DataFrame, sets: DataFrame, stats, cfg: ExtractConfig) -> DataFrame:
    """Add scan-level filters implied by all sets together: id IN (ids) when
    the distinct ids are few, and the overall [min start, max end] when every
    set is bounded on that side. Pure pre-filters: the join stays exact."""
    dtype = column_type(fact, cfg.id_col)
    out = fact
    if stats["n_ids"] <= cfg.broadcast_max_ids:
        vals = [r["_pid"] for r in sets.select("_pid").distinct().collect()]
        out = out.where(F.col(cfg.id_col).isin([F.lit(v).cast(dtype) for v in vals]) if vals else F.lit(False))
    if stats["n"] and stats["n_s"] == stats["n"] and stats["lo"] is not None:
        out = out.where(F.col(cfg.date_col) >= _lit_ts(stats["lo"]))
    if stats["n"] and stats["n_e"] == stats["n"] and stats["hi"] is not None:
        out = out.where(F.col(cfg.date_col) <= _lit_ts(stats["hi"]))
    return out


def _asked_rows(fact: DataFrame, sets: DataFrame, stats, cfg: ExtractConfig) -> DataFrame:
    """Before a shuffled join: only rows inside the overall envelope, of ids
    that some set asks for (a semi join while the ids can be broadcast)."""
    out = _envelope(fact, sets, stats, cfg)
    if cfg.broadcast_max_ids < stats["n_ids"] <= cfg.broadcast_max_sets:
        ids = sets.select(F.col("_pid").alias(cfg.id_col)).distinct()
        out = out.join(F.broadcast(ids), cfg.id_col, "left_semi").select(*fact.columns)
    return out


def param_match(
    fact: DataFrame,
    params: DataFrame,
    cfg: ExtractConfig,
    by: Sequence[str] = (),
    strategy: str = "auto",
) -> DataFrame:
    """Fact rows matching at least one set (per ``by`` group).

    Output: fact columns (+ ``by`` columns when given), each fact row at most
    once per group. ``strategy`` is 'auto', 'literal', 'broadcast' or
    'shuffle' (forcing is for tests and plan inspection).
    """
    by = list(by)
    cfg = cfg.with_(tie_break=()).resolved(fact.columns)
    dtype = column_type(fact, cfg.id_col)
    cond_cols = fact.columns
    typed = prepared_sets(fact, params, cfg, by).select(*by, "_pid", "_ps", "_pe")

    if not by and strategy in ("auto", "literal"):
        # Few sets (the usual sheet): one job reads at most
        # pushdown_max_sets + 1 of them (no shuffle, stops early); nothing
        # is written. Repeated sets collapse on the driver.
        rows = take_at_most(_with_texts(typed), cfg.pushdown_max_sets)
        if rows is not None:
            unique = list({(r["_pid"], r["_ps_text"], r["_pe_text"]): r for r in rows}.values())
            return fact.where(literal_sets_predicate(unique, cfg.id_col, cfg.date_col, dtype))
        if strategy == "literal":
            raise ValueError("more sets than pushdown_max_sets for the literal strategy")
    typed = typed.distinct()

    # The distinct typed sets are read by the decisions below and by the
    # join: write them once, then one small aggregate tells how many there
    # are and their envelope.
    raw = materialize(typed)
    stats = _set_stats(raw)

    # a forced broadcast is still held to the counted bound
    small = strategy in ("auto", "broadcast") and stats["n"] <= cfg.broadcast_max_sets
    keys = [*by, "_pid"]
    per_key = raw.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if not small:
        # Many sets: merge (a per-key window unless one key holds more than
        # window_merge_max_per_key ranges, then without gathering a key) and
        # join on (id, time bucket).
        merge = merge_ranges if per_key <= cfg.window_merge_max_per_key else merge_ranges_balanced
        merged = materialize(merge(raw, keys))
        return bucketed_range_join(_asked_rows(fact, raw, stats, cfg), merged, cfg, by)
    if per_key > cfg.probe_max_sets:
        # One row per (group, id): the inner join keeps a fact row at most
        # once per group, and it searches the id's ranges.
        index = F.broadcast(materialize(range_index(merge_ranges(raw, keys), keys)))
        f, s = _envelope(fact, raw, stats, cfg).alias("f"), index.alias("s")
        d = F.col("f." + cfg.date_col)
        d = d.try_cast("timestamp_ntz") if isinstance(column_type(fact, cfg.date_col), T.StringType) else d
        cond = (F.col("f." + cfg.id_col) == F.col("s._pid")) & in_ranges(d, F.col("s._starts"), F.col("s._ends"), F.col("s._all"), per_key)
        return f.join(s, cond, "inner").select(*[F.col("s." + b).alias(b) for b in by], *[F.col("f." + c).alias(c) for c in cond_cols])
    if by:
        # Per-group inner join: disjoint ranges per (group, id) make it a
        # per-group semi join. At most broadcast_max_sets ranges, so a
        # per-key window is cheap.
        side = F.broadcast(materialize(merge_ranges(raw, [*by, "_pid"])))
    else:
        # A semi join stops at the first matching set: no merge needed.
        side = F.broadcast(raw)
    probe = _envelope(fact, raw, stats, cfg)
    f = probe.alias("f")
    s = side.alias("s")
    cond = (F.col("f." + cfg.id_col) == F.col("s._pid")) & range_ok(
        F.col("f." + cfg.date_col), F.col("s._ps"), F.col("s._pe")
    )
    if not by:
        return f.join(s, cond, "left_semi").select(*[F.col("f." + c).alias(c) for c in cond_cols])
    # Ranges are disjoint per (group, id), so each fact row meets at most one
    # merged set per group: the inner join is the per-group semi join.
    return f.join(s, cond, "inner").select(
        *[F.col("s." + b).alias(b) for b in by], *[F.col("f." + c).alias(c) for c in cond_cols]
    )


# Bucket keys of the shuffled range join. Non-negative keys are time buckets
# of a hot id; the negative ones are sentinels.
_COLD, _LOW, _HIGH, _NULLD = -1, -2, -3, -4


def time_key(c: Column, dtype: T.DataType) -> Column | None:
    """Monotone whole-second key of a date/time value (None: unsupported type).

    timestamp_ntz uses its calendar fields (time-zone free), timestamp its
    instant, date its day number.
    """
    epoch = F.lit("1970-01-01").cast("date")
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(F.to_date(c), epoch).cast("long")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(dtype, T.DateType):
        return F.datediff(c, epoch).cast("long") * 86400
    return None


def bucketed_range_join(fact: DataFrame, merged: DataFrame, cfg: ExtractConfig, by: Sequence[str] = (), small: bool = False) -> DataFrame:
    """Shuffled set join that stays balanced when one id is hot.

    ``merged`` holds disjoint ranges per (by, id). Ids with more than
    ``cfg.hot_id_sets`` ranges get a bucket domain of at most
    ``cfg.buckets_per_hot_id`` time buckets spanning their finite bounds;
    each range expands to the buckets it covers (open ends add a low / high
    sentinel bucket, an all-open range the NULL-date bucket) and each fact
    row of such an id computes its one bucket. The join is then an equi join
    on (id, bucket) with the range as residual: a hot id's fact rows spread
    over thousands of keys, each key meets only the few ranges of its time
    slice, and no range is compared with rows outside its slice. Other ids
    keep a single key, and AQE splits a fact-side hot partition. Exact: a
    range containing a date always covers that date's bucket.
    """
    by = list(by)
    dtype = column_type(fact, cfg.date_col)
    # Keys are computed in the type the range check compares in: a date
    # column is compared with the (timestamp_ntz) bounds as a timestamp.
    # Text dates are read leniently: unreadable ones count as NULL.
    text = isinstance(dtype, T.StringType)
    ctype = T.TimestampNTZType() if text or isinstance(dtype, T.DateType) else dtype
    date = F.col(cfg.date_col).try_cast(ctype) if text else F.col(cfg.date_col)
    ps, pe = F.col("_ps").cast(ctype), F.col("_pe").cast(ctype)
    key = time_key(ps, ctype)
    if key is None:
        raise ValueError(f"column {cfg.date_col!r} of type {dtype.simpleString()} holds no dates")

    m = merged.select(*by, "_pid", "_ps", "_pe", time_key(ps, ctype).alias("_ks"), time_key(pe, ctype).alias("_ke"))
    stats = m.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"),
        F.least(F.min("_ks"), F.min("_ke")).alias("_lo"),
        F.greatest(F.max("_ks"), F.max("_ke")).alias("_hi"),
        F.max(F.col("_ks").isNull()).alias("_from_low"),
        F.max(F.col("_ke").isNull()).alias("_to_high"),
        F.max(F.col("_ks").isNull() & F.col("_ke").isNull()).alias("_any"),
    )
    # An id is hot by its ranges or by its rows (a partial count of one column).
    many = fact.groupBy(F.col(cfg.id_col).alias("_pid")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > cfg.hot_id_rows)
    stats = stats.join(many, "_pid", "left")
    width = F.greatest(F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.lit(cfg.buckets_per_hot_id)), F.lit(1)).cast("long")
    hot = (F.col("_n") > cfg.hot_id_sets) | F.col("_rows").isNotNull()
    hot_q = stats.where(hot & F.col("_lo").isNotNull()).select(
        "_pid", "_lo", "_hi", width.alias("_w"), "_from_low", "_to_high", "_any"
    )
    # Few hot ids (the usual case) come back in one job as a local table;
    # more are written once and broadcast only behind a counted bound.
    rows = take_at_most(hot_q, cfg.broadcast_max_ids)
    if rows is not None:
        hot_side = F.broadcast(fact.sparkSession.createDataFrame(rows, hot_q.schema))
    else:
        hot_side, _ = broadcast_if_small(materialize(hot_q), cfg.broadcast_max_sets)

    # Parameter side: one row per (range, bucket it covers).
    nb = F.floor((F.col("_hi") - F.col("_lo")) / F.col("_w")).cast("long")
    first = F.when(F.col("_ks").isNull(), F.lit(0)).otherwise(F.floor((F.col("_ks") - F.col("_lo")) / F.col("_w"))).cast("long")
    last = F.when(F.col("_ke").isNull(), nb).otherwise(F.floor((F.col("_ke") - F.col("_lo")) / F.col("_w"))).cast("long")
    empty = F.array().cast("array<long>")
    lows = F.when(F.col("_ks").isNull(), F.array(F.lit(_LOW).cast("long"))).otherwise(empty)
    highs = F.when(F.col("_ke").isNull(), F.array(F.lit(_HIGH).cast("long"))).otherwise(empty)
    nulls = F.when(F.col("_ks").isNull() & F.col("_ke").isNull(), F.array(F.lit(_NULLD).cast("long"))).otherwise(empty)
    keys = F.when(F.col("_lo").isNull(), F.array(F.lit(_COLD).cast("long"))).otherwise(
        F.concat(lows, F.sequence(first, last), highs, nulls)
    )
    pk = m.join(hot_side, "_pid", "left").select(*by, "_pid", "_ps", "_pe", F.explode(keys).alias("_bk"))
    if small:  # few sets with a hot id: broadcast by bucket while the buckets' rows are few
        pk, _ = broadcast_if_small(materialize(pk), cfg.broadcast_max_sets)

    # Fact side: the one bucket of each row.
    h = hot_side.select(F.col("_pid").alias("_hid"), "_lo", "_hi", "_w", "_from_low", "_to_high", "_any")
    d = date
    dk = time_key(d.cast(ctype), ctype)
    bucket = (
        F.when(F.col("_lo").isNull(), F.lit(_COLD))
        .when(d.isNull(), F.lit(_NULLD))
        .when(dk < F.col("_lo"), F.lit(_LOW))
        .when(dk > F.col("_hi"), F.lit(_HIGH))
        .otherwise(F.floor((dk - F.col("_lo")) / F.col("_w")))
        .cast("long")
    )
    # Rows of a hot id beyond all its bounds go nowhere unless a range is open.
    b = F.col("_fbk")
    met = ((b != _LOW) | F.col("_from_low")) & ((b != _HIGH) | F.col("_to_high")) & ((b != _NULLD) | F.col("_any"))
    fk = fact.join(h, fact[cfg.id_col] == h["_hid"], "left").withColumn("_fbk", bucket).where(b.eqNullSafe(F.lit(_COLD)) | met)
    fk = fk.select(*fact.columns, "_fbk", date.alias("_fd"))

    f, s = fk.alias("f"), pk.alias("s")
    cond = (
        (F.col("f." + cfg.id_col) == F.col("s._pid"))
        & (F.col("f._fbk") == F.col("s._bk"))
        & range_ok(F.col("f._fd"), F.col("s._ps"), F.col("s._pe"))
    )
    if not by:
        return f.join(s, cond, "left_semi").select(*[F.col("f." + c).alias(c) for c in fact.columns])
    return f.join(s, cond, "inner").select(*[F.col("s." + b).alias(b) for b in by], *[F.col("f." + c).alias(c) for c in fact.columns])


def param_join(fact: DataFrame, params: DataFrame, cfg: ExtractConfig, set_key: Sequence[str] = ("sheet", "c"), broadcast: bool | None = None) -> DataFrame:
    """Inner join of fact rows with every set they satisfy (multiplicity kept).

    Output: set key columns + fact columns. The sets are written once to the
    checkpoint folder and broadcast only behind a counted bound; beyond it
    the join runs on (id, time bucket) like the semi join, so a hot id does
    not compare all its rows with all its sets in one task.
    """
    keys = [k for k in set_key if k in params.columns]
    cfg = cfg.with_(tie_break=()).resolved(fact.columns)
    sets = prepared_sets(fact, params, cfg, keep=keys)
    rows = take_at_most(_with_texts(sets), cfg.pushdown_max_sets) if broadcast is None else None
    if rows is not None:
        # a few sets: their literals reach the scan, and they are a local table
        fact = fact.where(literal_sets_predicate(rows, cfg.id_col, cfg.date_col, column_type(fact, cfg.id_col)))
        sets = fact.sparkSession.createDataFrame([tuple(r)[:-2] for r in rows], sets.schema)
    else:
        sets = materialize(sets)
        stats = _set_stats(sets)
        # a forced broadcast is still held to the counted bound
        if (broadcast is None or broadcast) and stats["n"] <= cfg.broadcast_max_sets:
            per_id = sets.groupBy("_pid").count().agg(F.max("count")).first()[0] or 0
            if per_id > cfg.hot_id_sets:  # not every set of the id for every row
                return bucketed_range_join(_envelope(fact, sets, stats, cfg), sets, cfg, by=keys, small=True)
            fact = _envelope(fact, sets, stats, cfg)
        else:
            return bucketed_range_join(_asked_rows(fact, sets, stats, cfg), sets, cfg, by=keys)
    f, s = fact.alias("f"), F.broadcast(sets).alias("s")
    cond = (F.col("f." + cfg.id_col) == F.col("s._pid")) & range_ok(
        F.col("f." + cfg.date_col), F.col("s._ps"), F.col("s._pe")
    )
    return f.join(s, cond, "inner").select(
        *[F.col("s." + k).alias(k) for k in keys], *[F.col("f." + c).alias(c) for c in fact.columns]
    )


def set_counts(fact: DataFrame, params: DataFrame, cfg: ExtractConfig, set_key: Sequence[str] = ("sheet", "c")) -> DataFrame:
    """Rows fetched per set, zero for sets without rows.

    Counting happens on the join output with a partial aggregate before the
    shuffle; the zero-filling join is between two set-sized tables.
    """
    keys = [k for k in set_key if k in params.columns]
    cfg = cfg.with_(tie_break=()).resolved(fact.columns)
    only_keys = fact.select(cfg.id_col, cfg.date_col)
    counted = param_join(only_keys, params, cfg, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return params.join(counted, keys, "left").select(
        *params.columns, F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )


def union_sets(fact: DataFrame, params_rows: Sequence[dict], cfg: ExtractConfig) -> DataFrame:
    """Literal form of the per-set loop for a handful of literal sets: the
    bag union of one filter per set, numbered by set order (``ord``).

    Computed in one scan: the OR of all sets is pushed to the scan, and each
    surviving row is emitted once per set it satisfies."""
    dtype = column_type(fact, cfg.id_col)
    d = F.col(cfg.date_col)
    conds = []
    for p in params_rows:
        cond = F.col(cfg.id_col) == F.lit(p["id"]).try_cast(dtype)
        if p.get("start") is not None:
            cond = cond & (d >= _lit_ts(p["start"]))
        if p.get("end") is not None:
            cond = cond & (d <= _lit_ts(p["end"]))
        conds.append(cond)
    if not conds:
        return fact.limit(0).select(F.lit(0).alias("ord"), *fact.columns)
    hits = F.array(*[F.when(c, F.lit(i + 1)) for i, c in enumerate(conds)])
    ords = F.filter(hits, lambda x: x.isNotNull())
    return fact.where(reduce(lambda a, b: a | b, conds)).select(F.explode(ords).alias("ord"), *fact.columns)


def union_sets_ordered(
    fact: DataFrame, params: DataFrame, cfg: ExtractConfig, set_key: Sequence[str] = ("sheet", "c"), tie: Sequence[str] = ()
) -> DataFrame:
    """The per-set results one after the other: set key and fact columns with
    ``pos`` (place in the whole, from 1) and ``rank`` (place in the set). Sets
    in the order of their key, rows by date descending (no date last), then by
    ``tie``. One range sort places all rows, however many a set has; a set's
    first place comes from an aggregate, so no window runs over a set."""
    keys = [k for k in set_key if k in params.columns]
    cfg = cfg.with_(tie_break=()).resolved(fact.columns)
    joined = param_join(fact, params, cfg, keys)
    order = [*[F.col(k).asc_nulls_first() for k in keys], *fetch_order(cfg.date_col, tie)]
    placed = with_position(joined, order)
    first = placed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min("pos").alias("_first"))
    first, _ = broadcast_if_small(first, cfg.broadcast_max_sets)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return placed.join(first, cond).select("pos", (F.col("pos") - F.col("_first") + 1).alias("rank"), *joined.columns)


def ids_present(fact: DataFrame, params: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Distinct requested ids that have at least one fact row (any date).

    The fact scan is semi-joined with the (broadcast, counted) id list and
    de-duplicated with a partial aggregate, so only <= #ids rows shuffle.
    """
    dtype = column_type(fact, cfg.id_col)
    ids = params.select(F.col("id"), typed_id(F.col("id"), dtype).alias("_pid")).where(F.col("_pid").isNotNull()).distinct()
    asked = ids.select("_pid").distinct()
    rows = take_at_most(asked, cfg.broadcast_max_ids)
    if rows is not None:  # few ids: literals that reach the scan
        vals = [F.lit(r["_pid"]).cast(dtype) for r in rows]
        found = fact.where(F.col(cfg.id_col).isin(vals) if vals else F.lit(False)).select(F.col(cfg.id_col).alias("_pid")).distinct()
    else:
        side, _ = broadcast_if_small(asked, cfg.broadcast_max_sets)
        found = fact.select(F.col(cfg.id_col).alias("_pid")).join(side, "_pid", "left_semi").distinct()
    return ids.join(found, "_pid", "left_semi").select("id")


def ids_missing(fact: DataFrame, params: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Distinct requested ids without any fact row (the smoke probe at scale)."""
    all_ids = params.select("id").distinct()
    return all_ids.join(ids_present(fact, params, cfg), "id", "left_anti")
