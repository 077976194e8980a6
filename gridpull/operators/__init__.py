"""Relational operators of the extraction, all DataFrame -> DataFrame."""

from .dedup import dedup_first, dedup_keys, distinct_rows
from .joins import (
    ids_missing,
    ids_present,
    literal_sets_predicate,
    merge_ranges,
    param_join,
    param_match,
    range_ok,
    set_counts,
    typed_id,
    union_sets,
)
from .markers import find_markers, header_names, marker_errors, marker_scan, marker_table
from .params import param_errors, param_sets, raw_param_cells
from .predicates import or_groups
from .projection import conform, project, read_columns, schema_for, select_list
from .ordering import page, probe_limit, result_order, sort_desc_nulls_last, sort_result, with_position

__all__ = [
    "conform",
    "dedup_first",
    "dedup_keys",
    "distinct_rows",
    "find_markers",
    "header_names",
    "ids_missing",
    "ids_present",
    "literal_sets_predicate",
    "marker_errors",
    "marker_scan",
    "marker_table",
    "merge_ranges",
    "or_groups",
    "page",
    "param_errors",
    "param_join",
    "param_match",
    "param_sets",
    "probe_limit",
    "project",
    "range_ok",
    "raw_param_cells",
    "read_columns",
    "result_order",
    "schema_for",
    "select_list",
    "set_counts",
    "sort_desc_nulls_last",
    "sort_result",
    "typed_id",
    "union_sets",
    "with_position",
]
