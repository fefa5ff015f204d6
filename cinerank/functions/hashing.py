"""Deterministic, partitioning-independent pseudo-randomness from md5.

md5 gives identical hex digests in Spark and DuckDB, so every sampling and
split decision can be re-derived by the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column | str) -> Column:
    """md5 hex of the parts joined with '_' (each cast to string)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("_", *[c.cast("string") for c in cols]))


def md5_int32(*parts: Column | str) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of ``md5_key``."""
    return F.conv(F.substring(md5_key(*parts), 1, 8), 16, 10).cast("long")
