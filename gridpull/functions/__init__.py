"""Column -> Column functions: text cleaning and date reading rules."""

from .dates import (
    coerce_ts,
    day_start,
    iso_text,
    iso_text_fraction,
    parse_bound,
)
from .text import (
    clean_id,
    is_missing,
    label_keys,
    nfkc,
    norm_label,
    sanitize_name,
    strip_ws,
)

__all__ = [
    "clean_id",
    "coerce_ts",
    "day_start",
    "is_missing",
    "iso_text",
    "iso_text_fraction",
    "label_keys",
    "nfkc",
    "norm_label",
    "parse_bound",
    "sanitize_name",
    "strip_ws",
]
