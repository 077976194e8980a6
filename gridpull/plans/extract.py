"""The extraction as one Spark job graph.

    sheet CSV(s) -> cells (stored once) -> markers -> header names
                                                   -> parameter sets
    fact -> prune to needed columns, filter groups -> semi join with the sets
         -> de-duplicate on (id, date) with a deterministic survivor
         -> sort (date, id) -> project to the header -> CSV

What reaches the driver is counted: marker rows (one per sheet, up to
``broadcast_max_sheets``), the header names of the one sheet of a single run,
the fact columns that a batch asks for, and, when the sets are few, the sets
themselves as literals for scan pushdown.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractConfig, Labels
from ..operators.dedup import dedup_first, orderable_columns
from ..operators.filters import filter_atoms, filter_columns, filter_errors, filter_groups, filter_index, filter_rows
from ..operators.joins import param_match, set_counts
from ..operators.markers import header_names, lacks, marker_errors, marker_table, no_names
from ..operators.ordering import result_order, sort_result
from ..operators.params import param_errors, param_sets
from ..operators.predicates import or_groups
from ..operators.projection import project, read_columns, select_list
from ..operators.sizing import broadcast_if_small, drop_tables, materialize, table_scope, take_at_most
from ..sources.csv_sink import BOM, csv_text, publish, quoted, write_csv
from ..sources.sheet import read_sheet_cells

Groups = Sequence[Sequence[tuple[str, str, object]]]


#: Up to so many rows a run's result is one file on any file system.
SINGLE_FILE_ROWS = 5_000_000
#: Columns of one result frame; more cannot be planned in reason.
MAX_RESULT_COLUMNS = 20_000


class SheetError(ValueError):
    """A sheet lacks a required marker or header names."""


@dataclass
class SheetPlan:
    cells: DataFrame
    markers: DataFrame
    header: list[str]
    params: DataFrame
    ascii_only: bool = False
    labels: Labels = field(default_factory=Labels)

    @property
    def filters(self) -> DataFrame:
        """(sheet, g, name, op, value): conditions of the sheet's filter rows."""
        return filter_atoms(self.cells, self.markers, self.labels, True, self.ascii_only)

    @property
    def errors(self) -> DataFrame:
        """(sheet, r, c, v) of filled bound cells that could not be read."""
        return param_errors(self.cells, self.markers, self.ascii_only, broadcast_mk=True)


@dataclass
class ExtractRun:
    """A run's plan and result. ``release`` deletes the tables written for
    it (else they go when the application ends); the result is then unusable,
    the output stays."""

    plan: SheetPlan
    result: DataFrame
    observation: Observation
    output: str | None = None
    metrics: dict = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)

    def release(self) -> None:
        drop_tables(self.result.sparkSession, self.tables)


@dataclass
class BatchRun:
    """``result``: sheet and the fact columns that any sheet asks for, in
    (sheet, date, id) order; ``errors`` (sheet, error) of sheets without an
    answer; ``headers`` (sheet, names) of the others; ``rows`` (sheet,
    n_rows)."""

    result: DataFrame
    errors: DataFrame
    headers: DataFrame
    rows: DataFrame
    output: str | None = None
    tables: list[str] = field(default_factory=list)

    def release(self) -> None:
        drop_tables(self.result.sparkSession, self.tables)


def plan_sheet(cells: DataFrame, cfg: ExtractConfig) -> SheetPlan:
    """Markers, header list and parameter sets of one sheet's cells, which
    are stored once."""
    cells = materialize(cells)
    mk = marker_table(cells, cfg.labels)
    rows = take_at_most(mk, 1)
    if rows is None:
        raise SheetError("this run takes one sheet, and there are several")
    if not rows or rows[0]["header_r"] is None:
        raise SheetError(lacks(cfg.labels.header))
    if rows[0]["id_r"] is None:
        raise SheetError(lacks(cfg.labels.id))
    # the fetched marker row becomes a local table: not recomputed below
    ascii_only = not rows[0]["non_ascii"]
    mk = cells.sparkSession.createDataFrame(rows, mk.schema)
    names = header_names(cells, mk, cfg.labels, cfg.omit_bound_headers, broadcast_mk=True, ascii_only=ascii_only)
    # The names of one sheet row, which become the result's columns.
    named = take_at_most(names, MAX_RESULT_COLUMNS)
    if named is None:
        raise SheetError(f"the header row has more than {MAX_RESULT_COLUMNS} names")
    header = [r["name"] for r in sorted(named, key=lambda r: r["c"])]
    if not header:
        raise SheetError(no_names(cfg.labels.header))
    params = param_sets(cells, mk, ascii_only, broadcast_mk=True)
    plan = SheetPlan(cells, mk, header, params, ascii_only, cfg.labels)
    if cfg.on_bad_bound == "error":
        bad = plan.errors.agg(F.count("*").alias("n"), F.min(F.struct("r", "c", "v")).alias("first")).first()
        if bad["n"]:
            raise SheetError(f"unreadable date bounds: {bad['n']}, the first in row {bad['first']['r']}, column {bad['first']['c']}: {bad['first']['v']!r}")
    return plan


def survivor_order(fact: DataFrame, cfg: ExtractConfig, keys: Sequence[str]) -> list[str]:
    """Tie-break among rows sharing a dedup key: the configured columns, or
    every other (orderable) column of the pruned frame."""
    if cfg.tie_break:
        return list(cfg.tie_break)
    return orderable_columns(fact, keys)


def match_dedup(
    fact: DataFrame,
    params: DataFrame,
    cfg: ExtractConfig,
    header: Sequence[str],
    by: Sequence[str] = (),
    strategy: str = "auto",
    where: Groups = (),
    filters: DataFrame | None = None,
) -> DataFrame:
    """Semi join -> de-dup: one row per (by, id, date), unordered, with the
    header columns the table has plus the keys. ``where`` are filter groups
    (ANDed inside, ORed together) that fact rows must meet as well; so are
    ``filters``, each sheet's own conditions (``filter_atoms``)."""
    cfg = cfg.resolved(fact.columns)
    if where:
        fact = fact.where(or_groups(where, df=fact))
    wanted = select_list(header, cfg.id_col, cfg.date_col) + list(cfg.tie_break)
    pruned = read_columns(fact, wanted)
    keys = [*by, cfg.id_col, cfg.date_col]
    if filters is None:
        matched = param_match(pruned, params, cfg, by=by, strategy=strategy)
    else:
        asked = filter_columns(filters, fact)
        matched = param_match(read_columns(fact, [*wanted, *asked]), params, cfg, by=by, strategy=strategy)
        if "sheet" not in by:  # one sheet: its name is its conditions'
            matched = matched.withColumn("sheet", F.lit(filters.select("sheet").first()[0]))
        matched = filter_rows(matched, filter_index(filters, fact, asked), asked, cfg.broadcast_max_sheets)
        matched = matched.select(*by, *pruned.columns)
    # Sorted by id and date first: paths of sheets begin alike.
    return dedup_first(matched, [cfg.id_col, cfg.date_col, *by], survivor_order(pruned, cfg, keys))


def order_project(deduped: DataFrame, cfg: ExtractConfig, header: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Final order (by, date, id) and projection to the header."""
    if by:
        ordered = deduped.orderBy(*[F.col(b) for b in by], *result_order(cfg.date_col, cfg.id_col))
    else:
        ordered = sort_result(deduped, cfg.date_col, cfg.id_col)
    return project(ordered, header, keep=by)


def extract_rows(
    fact: DataFrame,
    params: DataFrame,
    cfg: ExtractConfig,
    header: Sequence[str],
    by: Sequence[str] = (),
    strategy: str = "auto",
    where: Groups = (),
    filters: DataFrame | None = None,
) -> DataFrame:
    """Semi join -> dedup -> sort -> project for already-built sets."""
    cfg = cfg.resolved(fact.columns)
    return order_project(match_dedup(fact, params, cfg, header, by, strategy, where, filters), cfg, header, by)


def run(
    spark: SparkSession,
    sheet_path: str,
    fact: DataFrame,
    cfg: ExtractConfig = ExtractConfig(),
    out_path: str | None = None,
    single_file: bool | int = SINGLE_FILE_ROWS,
    count_fetched: bool = False,
    where: Groups = (),
) -> ExtractRun:
    """Read one parameter sheet, answer its sets against ``fact`` and (when
    ``out_path`` is given) write the CSV result: one file of that name, or a
    folder of parts where the result has more rows than ``single_file`` and
    the file system cannot join files (``write_csv``). The sheet's own
    filter rows and ``where`` both hold.

    The rows are counted while they are written. ``count_fetched`` adds the
    number of rows all sets fetch before de-duplication (one extra pass over
    the id and date columns).
    """
    with table_scope() as tables:
        cfg = cfg.resolved(fact.columns)
        plan = plan_sheet(read_sheet_cells(spark, sheet_path), cfg)
        metrics = {}
        fact, filters = sheet_filters(plan, fact)
        if count_fetched:
            asked = fact.where(or_groups(where, df=fact)) if where else fact
            if filters is not None:
                named = asked.withColumn("sheet", F.lit(filters.select("sheet").first()[0]))
                columns = filter_columns(filters, fact)
                asked = filter_rows(named, filter_index(filters, fact, columns), columns, cfg.broadcast_max_sheets)
            metrics["fetched_rows"] = set_counts(asked, plan.params, cfg).agg(F.sum("n_rows")).first()[0] or 0
        obs = Observation("extract")
        result = extract_rows(fact, plan.params, cfg, plan.header, where=where, filters=filters).observe(obs, F.count(F.lit(1)).alias("rows"))
        if out_path is not None:
            write_csv(result, out_path, single_file=single_file)
            metrics["rows"] = obs.get["rows"]
    return ExtractRun(plan, result, obs, out_path, metrics, tables)


def sheet_filters(plan: SheetPlan, fact: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``fact`` under the conditions of one sheet's filter rows, which are
    literals that reach the scan; with very many, ``fact`` and the conditions."""
    if not plan.markers.first()["has_filter"]:
        return fact, None
    atoms = materialize(plan.filters)
    bad = filter_errors(atoms, fact).first()
    if bad is not None:
        raise SheetError(bad["error"])
    groups = filter_groups(atoms)
    if groups is None:
        return fact, atoms
    return (fact.where(or_groups(groups, df=fact)) if groups else fact), None


def plan_sheets(cells: DataFrame, cfg: ExtractConfig, cells_stored: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Batch form for many sheets in one job: (marker rows, header names,
    params, sheet errors), all distributed and keyed by ``sheet``. Sheets with
    an error are in none of the others. The cells are stored once."""
    cells = cells if cells_stored else materialize(cells)
    mk = marker_table(cells, cfg.labels)
    # One row per sheet, written once and broadcast up to broadcast_max_sheets.
    mk = materialize(mk)
    seen = mk.agg(F.count("*").alias("n"), F.max("non_ascii").alias("wide")).first()
    few = seen["n"] <= cfg.broadcast_max_sheets
    # NFKC only when some sheet holds non-ASCII text
    ascii_only = few and not seen["wide"]
    errs = marker_errors(mk, cfg.labels)
    ok = mk.where(F.col("header_r").isNotNull() & F.col("id_r").isNotNull())
    names = materialize(header_names(cells, ok, cfg.labels, cfg.omit_bound_headers, broadcast_mk=few, ascii_only=ascii_only))
    empty = ok.join(names, "sheet", "left_anti").select("sheet", F.lit(no_names(cfg.labels.header)).alias("error"))
    errs = errs.unionByName(empty)
    if cfg.on_bad_bound == "error":
        bad = param_errors(cells, ok, ascii_only, broadcast_mk=few).groupBy("sheet").agg(F.count("*").alias("n"), F.min(F.struct("r", "c", "v")).alias("f"))
        said = F.format_string("unreadable date bounds: %d, the first in row %d, column %d: '%s'", "n", "f.r", "f.c", "f.v")
        errs = errs.unionByName(bad.select("sheet", said.alias("error"))).groupBy("sheet").agg(F.min("error").alias("error"))
    errs = materialize(errs)
    ok = ok.join(errs, "sheet", "left_anti")
    params = param_sets(cells, ok, ascii_only, broadcast_mk=few)
    return ok, names.join(errs, "sheet", "left_anti"), params, errs


def batch_filters(cells: DataFrame, ok: DataFrame, cfg: ExtractConfig) -> DataFrame | None:
    """The conditions of all sheets' filter rows, or None if there are none."""
    seen = ok.where("has_filter").agg(F.count("*").alias("n"), F.max("non_ascii").alias("wide")).first()
    if not seen["n"]:
        return None
    atoms = materialize(filter_atoms(cells, ok, cfg.labels, seen["n"] <= cfg.broadcast_max_sheets, not seen["wide"]))
    return None if atoms.isEmpty() else atoms


def batch_header(names: DataFrame) -> list[str]:
    """All sheets' header names, ordered by first column position: the
    columns of one frame for all sheets."""
    rows = take_at_most(names.groupBy("name").agg(F.min("c").alias("c")), MAX_RESULT_COLUMNS)
    if rows is None:
        raise SheetError(f"the sheets together ask for more than {MAX_RESULT_COLUMNS} columns; a frame for each sheet takes its own")
    return [r["name"] for r in sorted(rows, key=lambda r: (r["c"], r["name"]))]


def run_batch(
    spark: SparkSession,
    sheet_paths: str | Sequence[str],
    fact: DataFrame,
    cfg: ExtractConfig = ExtractConfig(),
    out_path: str | None = None,
    where: Groups = (),
) -> BatchRun:
    """Many sheets in one job; each gets what a run of its own would write.

    The output folder holds ``sheet=<path below the common folder>`` for every
    sheet without an error: the BOM and the sheet's own header, then its rows
    in (date, id) order. A sheet without rows has its header only; a very
    large one continues in further parts, by name order."""
    with table_scope() as tables:
        cfg = cfg.resolved(fact.columns)
        cells = materialize(read_sheet_cells(spark, sheet_paths))
        ok, names, params, errs = plan_sheets(cells, cfg, cells_stored=True)
        filters = batch_filters(cells, ok, cfg)
        if filters is not None:
            bad = materialize(filter_errors(filters, fact))
            errs = errs.unionByName(bad)
            names, params, filters = (x.join(bad, "sheet", "left_anti") for x in (names, params, filters))
        headers = names.groupBy("sheet").agg(F.transform(F.sort_array(F.collect_list(F.struct("c", "name"))), lambda x: x["name"]).alias("names"))
        # fact columns that some sheet asks for: at most the table's
        lower = [c.lower() for c in fact.columns]
        asked = {r[0] for r in names.select(F.lower("name").alias("n")).where(F.col("n").isin(lower)).distinct().collect()}
        columns = [c for c in fact.columns if c.lower() in asked]
        deduped = match_dedup(fact, params, cfg, columns, by=["sheet"], where=where, filters=filters)
        if out_path is not None:
            deduped = materialize(deduped)
            write_sheets(deduped, headers, cfg, out_path)
        shown = select_list(columns, cfg.id_col, cfg.date_col)
        result = order_project(deduped, cfg, shown, by=["sheet"])
        counted = deduped.groupBy("sheet").agg(F.count("*").alias("n"))
        rows = headers.join(counted, "sheet", "left").select("sheet", F.coalesce("n", F.lit(0)).alias("n_rows"))
    return BatchRun(result, errs, headers, rows, out_path, tables)


def write_sheets(deduped: DataFrame, headers: DataFrame, cfg: ExtractConfig, out_path: str) -> None:
    """Every sheet's header line and rows as text, partitioned by sheet."""
    spark = deduped.sparkSession
    headers = materialize(headers)
    ends = headers.agg(F.min("sheet"), F.max("sheet")).first()
    # what all paths share up to a folder: so do the first and the last
    low, high = ends[0] or "", ends[1] or ""
    n = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    root = low[: low[:n].rfind("/") + 1]

    texts = F.map_from_arrays(
        F.array(*[F.lit(f.name.lower()) for f in deduped.schema.fields]),
        F.array(*[quoted(csv_text(F.col(f"`{f.name}`"), f.dataType)) for f in deduped.schema.fields]),
    )
    side, _ = broadcast_if_small(headers, cfg.broadcast_max_sheets)
    line = F.array_join(F.transform("names", lambda x: F.coalesce(F.try_element_at(F.col("texts"), F.lower(x)), F.lit(""))), ",")
    keys = {"d": cfg.date_col, "i": cfg.id_col}
    data = deduped.select("sheet", F.lit(1).alias("o"), *[F.col(c).alias(k) for k, c in keys.items()], texts.alias("texts")).join(side, "sheet")
    types = {k: deduped.schema[c].dataType for k, c in keys.items()}
    head = headers.select(
        "sheet",
        F.lit(0).alias("o"),
        *[F.lit(None).cast(t).alias(k) for k, t in types.items()],
        F.concat(F.lit(BOM), F.array_join(F.transform("names", quoted), ",")).alias("line"),
    )
    lines = head.unionByName(data.select("sheet", "o", "d", "i", line.alias("line")))
    lines = lines.withColumn("sheet", F.substring("sheet", F.lit(len(root) + 1), F.length("sheet")))
    fresh = f"{out_path.rstrip('/')}.new-{uuid.uuid4().hex}"
    ordered = lines.orderBy("sheet", "o", F.col("d").asc_nulls_last(), F.col("i").asc_nulls_last())
    ordered.select("sheet", "line").write.partitionBy("sheet").text(fresh)
    publish(spark, fresh, out_path.rstrip("/"))
