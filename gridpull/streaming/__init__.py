"""Streaming entry: sheets arriving in a folder (no new operators)."""

from .folder import answer_sheet_stream

__all__ = ["answer_sheet_stream"]
