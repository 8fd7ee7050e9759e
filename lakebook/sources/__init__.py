"""Readers of the lake layers."""

from .delimited import read_delimited
from .layers import read_layer, read_refs
from .records import Records, scan_records
from .state import committed_loads, get_hwm, latest_marks, read_raw, read_state

__all__ = [
    "Records", "committed_loads", "get_hwm", "latest_marks", "read_delimited", "read_layer",
    "read_raw", "read_refs", "read_state", "scan_records",
]
