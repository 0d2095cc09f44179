"""Column expressions used by the operators."""

from starloom.functions.columns import band_expr, col, is_missing, present, replace_expr
from starloom.functions.dates import local_date, resolve_process_date, slash_timestamp

__all__ = [
    "band_expr",
    "col",
    "is_missing",
    "local_date",
    "present",
    "replace_expr",
    "resolve_process_date",
    "slash_timestamp",
]
