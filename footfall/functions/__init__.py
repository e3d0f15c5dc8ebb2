from footfall.functions.hashing import poly_offset
from footfall.functions.reports import ITEM_REPORT, PAGE_REPORT, ranking_report
from footfall.functions.times import bound_text, duration_us, event_time, micros, micros_to_ts

__all__ = [
    "ITEM_REPORT",
    "PAGE_REPORT",
    "bound_text",
    "duration_us",
    "event_time",
    "micros",
    "micros_to_ts",
    "poly_offset",
    "ranking_report",
]
