"""Vertical interpolation, hodograph bins (MET-14..16, MET-18, WN-3, WN-5, JN-13).

A column of the atmosphere is one window partition (keys = time + horizontal
position).  Bracketing pairs (k, k+1) come from ``lead``; the target levels
are a small literal array filtered inside each bracket row and exploded — no
join, no nested loop, the cost is linear in rows x targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _f(x: Column, log: bool) -> Column:
    return F.log(x) if log else x


def interpolate_to_targets(df: DataFrame, keys: Sequence[str], coord: str, targets: Sequence[float],
                           values: Sequence[str], log: bool = False,
                           extrapolate: Sequence[str] = (), target_name: str = "target") -> DataFrame:
    """Interpolate ``values`` from model levels to fixed ``targets`` of ``coord``.

    Linear in ``coord`` (or in ln(coord) with ``log``).  Targets outside the
    column are NULL, except the columns listed in ``extrapolate`` which take
    the nearest level's value (constant extrapolation).

    One window pass: each level row gets its upper neighbour (``lead``), then
    explodes the targets it is responsible for — those inside its bracket,
    plus, when extrapolating, those below the first level (first row) or
    above the last one (last row).  No union, no second scan of the column.
    """
    tgt = F.array(*[F.lit(float(t)) for t in sorted(targets)])
    w = Window.partitionBy(*keys).orderBy("_c0")
    b = df.select(*keys, F.col(coord).alias("_c0"), *[F.col(v).alias(f"_v0_{v}") for v in values])
    b = b.where(F.col("_c0").isNotNull())
    b = b.select("*", F.lead("_c0").over(w).alias("_c1"),
                 *[F.lead(f"_v0_{v}").over(w).alias(f"_v1_{v}") for v in values],
                 F.lead("_c0", 2).over(w).isNull().alias("_last"),
                 F.lag("_c0").over(w).isNull().alias("_first"))
    c0, c1 = F.col("_c0"), F.col("_c1")
    inside = F.filter(tgt, lambda t: c1.isNotNull() & (t >= c0) & ((t < c1) | ((t == c1) & F.col("_last"))))
    picks = inside
    if extrapolate:
        below = F.filter(tgt, lambda t: F.col("_first") & (t < c0))
        above = F.filter(tgt, lambda t: c1.isNull() & (t > c0))
        picks = F.concat(below, inside, above)
    rows = b.select("*", F.explode(picks).alias(target_name))
    t = F.col(target_name)
    outside = c1.isNull() | (t < c0)
    span = _f(c1, log) - _f(c0, log)
    frac = F.when(span != 0, (_f(t, log) - _f(c0, log)) / span).otherwise(F.lit(0.0))
    cols = []
    for v in values:
        interp = F.col(f"_v0_{v}") + (F.col(f"_v1_{v}") - F.col(f"_v0_{v}")) * frac
        const = F.col(f"_v0_{v}") if v in extrapolate else F.lit(None).cast("double")
        cols.append(F.when(outside, const).otherwise(interp).alias(v))
    return rows.select(*keys, target_name, *cols)


def hodograph_bins(df: DataFrame, keys: Sequence[str], level: str, p: str, u: str, v: str,
                   bins: Sequence[float], top: float | None = None) -> DataFrame:
    """MET-15 / WN-3: wind points per pressure bin, plus the next level's point
    appended once at the bin's lower edge so consecutive segments connect.

    A level belongs to bin i when bins[i] >= p >= bins[i+1] (both edges
    inclusive, so a level on an edge is in both bins) and p >= top, with p,
    u, v all present.
    """
    top = bins[-1] if top is None else top
    w = Window.partitionBy(*keys).orderBy(level)
    nb = len(bins) - 1
    idx = F.array(*[F.lit(i) for i in range(nb)])
    hi_arr = F.array(*[F.lit(float(x)) for x in bins[:-1]])
    lo_arr = F.array(*[F.lit(float(x)) for x in bins[1:]])
    base = df.select(*keys, level, p, u, v,
                     F.lead(F.struct(F.col(level).alias("k"), F.col(u).alias("u"), F.col(v).alias("v"),
                                     F.col(p).alias("p"))).over(w).alias("_next"))
    ok = F.col(p).isNotNull() & F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(p) >= F.lit(float(top)))
    inbin = base.where(ok).select("*", F.explode(F.filter(idx, lambda i: (F.col(p) <= F.element_at(hi_arr, i + 1))
                                                           & (F.col(p) >= F.element_at(lo_arr, i + 1)))).alias("bin"))
    wb = Window.partitionBy(*keys, "bin")
    inbin = inbin.withColumn("_kmax", F.max(level).over(wb))
    # a row gives its point and, where it is the bin's last, the next level's: one pass
    own = F.struct(F.col(level).alias("k"), F.col(u).alias("u"), F.col(v).alias("v"), F.col(p).alias("p"), F.lit(False).alias("is_edge"))
    last = (F.col(level) == F.col("_kmax")) & F.col("_next").isNotNull()
    edge = F.when(last, F.struct("_next.k", "_next.u", "_next.v", "_next.p", F.lit(True).alias("is_edge")))
    out = inbin.select(*keys, "bin", F.inline(F.array_compact(F.array(own, edge))))
    return out.select(*keys, F.element_at(hi_arr, F.col("bin") + 1).alias("bin_bottom"),
                      F.element_at(lo_arr, F.col("bin") + 1).alias("bin_top"), "k", "u", "v", "p", "is_edge")


def lcl(t, td, p) -> tuple[Column, Column]:
    """Lifting condensation level (temperature K, pressure) of a parcel (Bolton 1980)."""
    from ..functions import fixed
    t, td, p = (F.col(x) if isinstance(x, str) else x for x in (t, td, p))
    t_lcl = F.lit(1.0) / (F.lit(1.0) / (td - F.lit(56.0)) + F.log(t / td) / F.lit(800.0)) + F.lit(56.0)
    p_lcl = p * F.pow(t_lcl / t, F.lit(fixed.CP_DRY / fixed.R_DRY))
    return t_lcl, p_lcl
