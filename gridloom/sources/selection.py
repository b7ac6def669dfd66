"""Selection-spec expansion (SRC-13).

A retrieval spec holds values such as ``1979-01-01/to/1979-01-31``,
``00/to/23/by/6``, ``1/to/137`` or ``d/vo``.  Expansion turns the spec rows
into one task row per combination of the partition keys; the other keys stay
lists.  Everything is ``split`` / ``sequence`` / ``explode`` on columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_values(spec) -> Column:
    """``a/to/b[/by/s]`` -> every value (dates or integers, zero padding kept);
    ``x/y/z`` -> the items; returned as ARRAY<STRING>."""
    s = spec if isinstance(spec, Column) else F.col(spec)
    parts = F.split(s, "/")
    is_range = (F.size(parts) >= 3) & (F.lower(parts.getItem(1)) == "to")
    step = F.when((F.size(parts) == 5) & (F.lower(parts.getItem(3)) == "by"), parts.getItem(4).cast("int")) \
        .otherwise(F.lit(1))
    lo, hi = parts.getItem(0), parts.getItem(2)
    is_date = lo.rlike(r"^\d{4}-\d{2}-\d{2}$")
    dates = F.transform(F.sequence(F.to_date(lo), F.to_date(hi), F.make_dt_interval(step)),
                        lambda d: F.date_format(d, "yyyy-MM-dd"))
    # zero padding only when the bound is written with it ("00/to/23")
    width = F.when(lo.startswith("0") & (F.length(lo) > 1), F.length(lo)).otherwise(F.lit(0))
    ints = F.transform(F.sequence(lo.cast("int"), hi.cast("int"), step),
                       lambda i: F.when(F.length(i.cast("string")) < width, F.lpad(i.cast("string"), width, "0"))
                       .otherwise(i.cast("string")))
    return F.when(is_range & is_date, dates).when(is_range, ints).otherwise(parts)


def expand_spec(spec: DataFrame, keys: Sequence[str], partition_keys: Sequence[str],
                id_col: str = "spec_id") -> DataFrame:
    """One row per spec and combination of ``partition_keys``; the other keys as lists."""
    out = spec.select(id_col, *[expand_values(k).alias(k) for k in keys])
    for k in partition_keys:
        out = out.withColumn(k, F.explode(k))
    return out
