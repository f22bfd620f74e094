"""Deterministic, partitioning-independent draws.

Every random choice is a pure function of its keys, so a retried task (after
an executor loss) or a different partitioning reproduces the same rows.

``hash60(k...)``: the first 15 hex digits of md5 over the keys joined by
``|``, as a non-negative BIGINT.  ``unit(k...)``: the first 13 hex digits as a
double in [0, 1).  DuckDB forms of both are in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(*keys: Column | str | int) -> Column:
    parts = [k if isinstance(k, Column) else F.lit(str(k)) for k in keys]
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def hash60(*keys: Column | str | int) -> Column:
    return F.conv(F.substring(F.md5(_key(*keys)), 1, 15), 16, 10).cast("bigint")


def unit(*keys: Column | str | int) -> Column:
    """Uniform double in [0, 1) from 52 bits of md5."""
    bits = F.conv(F.substring(F.md5(_key(*keys)), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(2**52))
