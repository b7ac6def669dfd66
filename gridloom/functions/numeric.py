"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(x, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(x * 10^d) / 10^d`` (half away from zero).

    Unlike ``F.round`` (exact decimal expansion of the double) this rounds the
    scaled binary value, the way most SQL engines do; results that sit on a
    decimal tie (frequent after weights such as 0.25) then agree across engines.
    """
    c = x if isinstance(x, Column) else F.col(x)
    m = float(10 ** digits)
    return F.round(c * F.lit(m)) / F.lit(m)
