"""Writers of the lake layers and of the audit and state tables."""

from .layers import Written, append_by_ref, write_counted, write_folder, write_month, write_raw
from .tables import commit_load, put_control, put_hwm, roll_forward

__all__ = [
    "Written", "append_by_ref", "commit_load", "put_control", "put_hwm", "roll_forward",
    "write_counted", "write_folder", "write_month", "write_raw",
]
