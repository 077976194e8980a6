"""Run configuration.

Everything the extraction needs to know about the fact table and the sheet
layout lives in one frozen dataclass so a run is reproducible from its
config alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values -----------------------------------------------------------
# Sheet labels, default fact columns and sink conventions that a user of the
# original sheet workflow relies on. They must stay exactly as written.
DEFAULT_HEADER_LABEL = "Header"
DEFAULT_START_LABEL = "StartDate"
DEFAULT_END_LABEL = "EndDate"
DEFAULT_ID_LABEL = "Voyage ID"
DEFAULT_FILTER_LABEL = "Filter"
DEFAULT_ANCHOR_LABELS = ("Header", "StartDate")
DEFAULT_ID_COL = "voyage_id"
DEFAULT_DATE_COL = "voyage_date_voyagestart"
PAGE_SIZE = 2000
PROBE_LIMIT = 3
# The declared summary table, in its natural column order.
SUMMARY_TABLE_DDL = (
    "updated_at TIMESTAMP_NTZ, "
    "id INT NOT NULL, "
    "voyage_bcr_usd DECIMAL(18,2), "
    "voyage_date_voyagestart TIMESTAMP_NTZ, "
    "voyage_id STRING, "
    "voyage_duration_days DECIMAL(10,4), "
    "voyage_rate_usd_24hrgross DECIMAL(18,2), "
    "voyage_oh_usd DECIMAL(18,2), "
    "voyage_hac_usd DECIMAL(18,2), "
    "voyage_cve_usd DECIMAL(18,2), "
    "voyage_bnkr_usd DECIMAL(18,2), "
    "voyage_bnkr_desc STRING, "
    "voyage_chtr_usd_bal DECIMAL(18,2), "
    "voyage_expense_usd DECIMAL(18,2), "
    "voyage_expense_desc STRING, "
    "voyage_bnkr_usd_deduc DECIMAL(18,2), "
    "created_by STRING, "
    "created_at TIMESTAMP_NTZ, "
    "updated_by STRING"
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Labels:
    """Marker texts looked up in the sheet (compared after ``norm_label``)."""

    header: str = DEFAULT_HEADER_LABEL
    start: str = DEFAULT_START_LABEL
    end: str = DEFAULT_END_LABEL
    id: str = DEFAULT_ID_LABEL
    # Rows with this label hold filter conditions (any number of rows).
    filter: str = DEFAULT_FILTER_LABEL
    # Labels whose columns become the candidate label columns.
    anchors: tuple[str, ...] = DEFAULT_ANCHOR_LABELS

    def as_dict(self) -> dict[str, str]:
        return {"header": self.header, "start": self.start, "end": self.end, "id": self.id}


@dataclass(frozen=True)
class ExtractConfig:
    """How parameter sets are answered against a fact table.

    id_col / date_col   fact columns the sets filter on (equality / range).
    tie_break           columns giving a total order among rows sharing a
                        dedup key; the smallest survives. Empty = every
                        column of the fact frame (always a total order when
                        full rows are unique; exact duplicates are then
                        interchangeable anyway).
    date_only           compare at day granularity: both bounds become
                        midnight of their day (end included only at 00:00).
    on_bad_bound        'open' (unreadable date widens the set, as the sheet
                        workflow always did) or 'error'.
    pushdown_max_sets   up to this many sets are applied as one literal OR
                        filter that reaches the Parquet scan (no join).
    broadcast_max_sets  parameter sets are broadcast only when their counted
                        number is at most this; beyond it the join shuffles.
    broadcast_max_ids   distinct-id envelope pushed to the scan only up to
                        this many ids.
    window_merge_max_per_key  ranges of one key merged by a per-key window up
                        to this many (counted); beyond it the balanced merge.
    probe_max_sets      broadcast sets of ids with more sets than this are
                        probed by binary search.
    hot_id_sets         in the shuffled set join, ids with more merged ranges
                        than this are joined on (id, time bucket).
    hot_id_rows         so are ids with more fact rows than this.
    buckets_per_hot_id  at most this many time buckets per hot id.
    broadcast_max_sheets  per-sheet marker rows are broadcast up to this many
                        sheets (counted).
    omit_bound_headers  drop StartDate/EndDate names from the header list.
    """

    id_col: str = DEFAULT_ID_COL
    date_col: str = DEFAULT_DATE_COL
    tie_break: tuple[str, ...] = ()
    labels: Labels = field(default_factory=Labels)
    date_only: bool = False
    on_bad_bound: str = "open"
    pushdown_max_sets: int = 50
    broadcast_max_sets: int = 200_000
    broadcast_max_ids: int = 1_000
    window_merge_max_per_key: int = 1_000_000
    probe_max_sets: int = 16
    hot_id_sets: int = 64
    hot_id_rows: int = 5_000_000
    buckets_per_hot_id: int = 4096
    broadcast_max_sheets: int = 100_000
    omit_bound_headers: bool = True

    def resolved(self, columns) -> "ExtractConfig":
        """This configuration with every column name in the table's own
        spelling (names match without regard to case, as in Spark); names
        that the table lacks are refused."""
        have = {c.lower(): c for c in columns}
        asked = (self.id_col, self.date_col, *self.tie_break)
        missing = [c for c in asked if c.lower() not in have]
        if missing:
            raise ValueError(f"fact table lacks configured column(s) {missing}; it has {list(columns)}")
        id_col, date_col, *tie = [have[c.lower()] for c in asked]
        return replace(self, id_col=id_col, date_col=date_col, tie_break=tuple(tie))

    def with_(self, **kw) -> "ExtractConfig":
        return replace(self, **kw)
