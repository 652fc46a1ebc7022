"""Column expressions shared by the operators; all of them stay inside the JVM."""

from .dates import month_index, month_start, parse_date
from .hashing import hash_bucket, row_hash, unit_hash
from .text import human_format

__all__ = [
    "hash_bucket", "human_format", "month_index", "month_start", "parse_date", "row_hash", "unit_hash",
]
