"""The jobs, composed from operators."""

from .conform import conform_accidents, conform_flow
from .ingest import Subject, ingest_subject
from .month import LakePaths, MonthReport, compact_month, run_month, shared_flow_ids
from .rollup import DayLayer, refresh_days, roll_up
from .stage import BOOK_SPEC, build_book, build_stage

__all__ = [
    "BOOK_SPEC", "DayLayer", "LakePaths", "MonthReport", "Subject", "build_book", "build_stage",
    "compact_month", "conform_accidents", "conform_flow", "ingest_subject", "refresh_days",
    "roll_up", "run_month", "shared_flow_ids",
]
