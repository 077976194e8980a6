"""Sources (parameter sheets, fact tables) and the CSV sink."""

from .csv_sink import csv_lines, part_files, write_csv
from .fact import read_jdbc, read_jdbc_for_sets, read_parquet, read_table, set_predicates_sql
from .layout import save_bucketed, write_clustered
from .sheet import grid_to_cells, read_sheet_cells, read_sheet_grid, sheet_shape

__all__ = [
    "csv_lines",
    "grid_to_cells",
    "part_files",
    "read_jdbc",
    "read_jdbc_for_sets",
    "read_parquet",
    "read_sheet_cells",
    "read_sheet_grid",
    "read_table",
    "save_bucketed",
    "set_predicates_sql",
    "sheet_shape",
    "write_clustered",
    "write_csv",
]
