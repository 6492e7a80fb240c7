"""Column-level building blocks."""

from changelake.functions.event_time import event_seq, event_time, parse_event_time
from changelake.functions.rows import detect_table, is_truthy, operation_name
from changelake.functions.sized import top_k

__all__ = [
    "detect_table",
    "event_seq",
    "event_time",
    "is_truthy",
    "operation_name",
    "parse_event_time",
    "top_k",
]
