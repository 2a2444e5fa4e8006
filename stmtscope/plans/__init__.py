from stmtscope.plans.load import LoadOptions, load, report, series, summarize
from stmtscope.plans.reports import metric_report, minute_report, minute_series

__all__ = [
    "LoadOptions",
    "load",
    "metric_report",
    "minute_report",
    "minute_series",
    "report",
    "series",
    "summarize",
]
