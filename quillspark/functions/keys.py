"""Keyed draws.

Python's RNG order cannot be reproduced in parallel, so every random choice is a
pure function of (seed, purpose, ids): the first 15 hex digits of the md5 of the
'|'-joined parts, read as a 60-bit integer. The value is the same after a
repartition, a retry, or in DuckDB (``key_sql`` writes the twin expression).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 60
KEY_RANGE = 1 << KEY_BITS


def _part(p) -> Column:
    if isinstance(p, Column):
        return p.cast("string")
    return F.lit(str(p))


def key(seed, *parts) -> Column:
    """60-bit non-negative draw for (seed, *parts); parts are Columns or constants."""
    joined = F.concat_ws("|", _part(seed), *[_part(p) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def unit(seed, *parts) -> Column:
    """Uniform double in [0, 1) from the same draw."""
    return key(seed, *parts) / F.lit(float(KEY_RANGE))


def _sql_part(p) -> str:
    if isinstance(p, str) and p.startswith("@"):
        return f"CAST({p[1:]} AS VARCHAR)"
    return "'" + str(p).replace("'", "''") + "'"


def key_sql(seed, *parts) -> str:
    """DuckDB twin of ``key``. Column references are written as '@expr'."""
    joined = ", ".join(_sql_part(p) for p in (seed, *parts))
    return f"CAST(('0x' || substr(md5(concat_ws('|', {joined})), 1, 15)) AS BIGINT)"


def unit_sql(seed, *parts) -> str:
    return f"(CAST({key_sql(seed, *parts)} AS DOUBLE) / CAST({KEY_RANGE} AS DOUBLE))"
