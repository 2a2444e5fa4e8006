from stmtscope.functions.ids import norm_id, stable_id, text_id
from stmtscope.functions.normalize import (
    fingerprint_text,
    is_balanced,
    normalize_sql,
    qualified_name,
    statement_text,
)
from stmtscope.functions.timebounds import parse_offset, to_instant

__all__ = [
    "fingerprint_text",
    "is_balanced",
    "norm_id",
    "normalize_sql",
    "parse_offset",
    "qualified_name",
    "stable_id",
    "statement_text",
    "text_id",
    "to_instant",
]
