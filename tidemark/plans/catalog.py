"""All registered queries with their SQL."""

from __future__ import annotations

from . import q_checks, q_dates, q_documents, q_history, q_joins, q_metrics, q_records, q_rows, q_select, q_seq, q_stream, q_text  # noqa: F401
from .registry import ORACLES, QUERIES

FLAGSHIP = "asof_close_on_or_before"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
