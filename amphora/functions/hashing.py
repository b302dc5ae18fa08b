"""Deterministic, partition-independent pseudo-randomness.

``rand()`` depends on partitioning and task order, so a recomputed partition
after an executor loss could draw different numbers. Everything random in
this package is instead a pure function of row content and a seed:
the first 32 bits of ``md5(key || '|' || seed)``. DuckDB replays it as
``('0x' || substr(md5(x), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(*parts: Column | str) -> Column:
    """Unsigned 32-bit integer (as BIGINT) from md5 of '|'-joined parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform_int(n: int | Column, *parts: Column | str) -> Column:
    """Integer uniform in [0, n)."""
    return F.pmod(hash32(*parts), n if isinstance(n, Column) else F.lit(n))


def uniform01(*parts: Column | str) -> Column:
    """Double uniform in [0, 1)."""
    return hash32(*parts) / F.lit(float(1 << 32))
