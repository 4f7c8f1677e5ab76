"""Deterministic pseudo-random draws that SQL engines reproduce exactly.

The first 32 bits of ``md5(key)`` as an unsigned integer over 2^32: a uniform
value in [0, 1) that depends only on the key, never on partitioning or retry,
so a re-executed task after an executor loss draws the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_draw(*parts) -> Column:
    key = F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def sql_uniform_draw(key_sql: str) -> str:
    """DuckDB text of the same draw (for oracle queries)."""
    return f"(('0x' || substr(md5({key_sql}), 1, 8))::BIGINT / 4294967296.0)"
