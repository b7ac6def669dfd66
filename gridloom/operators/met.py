"""Thermodynamics and vertical integration on model levels (MET-1 .. MET-8, WN-1, WN-2).

Point formulas are column expressions (whole-stage codegen).  Vertical
operators are windows partitioned by the grid column (time, cell) and
ordered by level: a partition holds one column of the atmosphere (137 rows
at full resolution), so the window never grows with the data volume.

Hybrid coefficients are an input table ``(half_level, a, b)``; full levels
k = 1..N sit between half levels k-1 (above) and k (below).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def wind_speed(u, v) -> Column:
    """MET-1."""
    return F.sqrt(_c(u) * _c(u) + _c(v) * _c(v))


def virtual_temperature(t, q) -> Column:
    """MET-3: Tv = (1 + (Rv/Rd - 1) q) T."""
    return (F.lit(1.0) + F.lit(fixed.R_VAP / fixed.R_DRY - 1.0) * _c(q)) * _c(t)


def vapour_pressure(q, p) -> Column:
    """e = q p / (eps + (1 - eps) q)."""
    eps = fixed.EPSILON
    return _c(q) * _c(p) / (F.lit(eps) + F.lit(1.0 - eps) * _c(q))


def saturation_vapour_pressure(t, phase: str = "mixed") -> Column:
    """Tetens form with IFS constants; mixed phase blends water and ice
    quadratically between T_ICE and T0."""
    t = _c(t)
    water = F.lit(fixed.ES_A1) * F.exp(F.lit(fixed.ES_A3_WATER) * (t - F.lit(fixed.T_ZERO))
                                       / (t - F.lit(fixed.ES_A4_WATER)))
    if phase == "water":
        return water
    ice = F.lit(fixed.ES_A1) * F.exp(F.lit(fixed.ES_A3_ICE) * (t - F.lit(fixed.T_ZERO))
                                     / (t - F.lit(fixed.ES_A4_ICE)))
    if phase == "ice":
        return ice
    frac = (t - F.lit(fixed.T_ICE)) / F.lit(fixed.T_ZERO - fixed.T_ICE)
    alpha = F.when(t >= F.lit(fixed.T_ZERO), F.lit(1.0)).when(t <= F.lit(fixed.T_ICE), F.lit(0.0)) \
        .otherwise(frac * frac)
    return alpha * water + (F.lit(1.0) - alpha) * ice


def relative_humidity(t, q, p) -> Column:
    """MET-4: RH (%) from temperature, specific humidity and pressure."""
    return F.lit(100.0) * vapour_pressure(q, p) / saturation_vapour_pressure(t)


def dewpoint(q, p) -> Column:
    """MET-5: invert saturation pressure over water at the vapour pressure."""
    e = vapour_pressure(q, p)
    ln = F.log(e / F.lit(fixed.ES_A1))
    td = (F.lit(fixed.ES_A3_WATER * fixed.T_ZERO) - F.lit(fixed.ES_A4_WATER) * ln) / (F.lit(fixed.ES_A3_WATER) - ln)
    return F.when(e > F.lit(0.0), td)  # no vapour: dewpoint undefined (NULL)


def geopotential_height(z) -> Column:
    """MET-7."""
    return _c(z) / F.lit(fixed.G_HEIGHT)


def w_from_omega(omega, t, p) -> Column:
    """MET-8: w = -omega Rd T / (p g)."""
    return -_c(omega) * F.lit(fixed.R_DRY) * _c(t) / (_c(p) * F.lit(fixed.G0))


def hybrid_coefficients(spark, n_levels: int) -> DataFrame:
    """Synthetic monotone hybrid coefficients (a, b) for half levels 0..N.

    The archive carries these in file metadata; tests and stand-ins use this
    rule: b = eta^2, a = 20000 eta (1 - eta) with eta = k / N, so the top half
    level has p = 0 and the bottom one p = surface pressure.
    """
    hl = spark.range(n_levels + 1).select(F.col("id").cast("int").alias("half_level"))
    eta = F.col("half_level") / F.lit(float(n_levels))
    return F.broadcast(hl.select("half_level", (F.lit(20000.0) * eta * (F.lit(1.0) - eta)).alias("a"),
                                 (eta * eta).alias("b")))


def full_level_pressure(levels: DataFrame, surface: DataFrame, coef: DataFrame,
                        keys: Sequence[str] = ("time", "cell"), k: str = "k") -> DataFrame:
    """MET-2 / WN-2: attach p_above (k-1/2), p_below (k+1/2) and p (their mean).

    The coefficient table is tiny and broadcast; the adjacent-pair lookup is
    two equi-join columns (a and b of half levels k-1 and k), no window.  Levels of a
    column without surface fields, and levels outside the table, stay with NULL pressures.
    """
    c = coef
    up = c.select(F.col("half_level").alias("_hu"), F.col("a").alias("_au"), F.col("b").alias("_bu"))
    dn = c.select(F.col("half_level").alias("_hd"), F.col("a").alias("_ad"), F.col("b").alias("_bd"))
    j = levels.join(surface, list(keys), "left")
    j = j.join(F.broadcast(up), F.col(k) - 1 == F.col("_hu"), "left").join(F.broadcast(dn), F.col(k) == F.col("_hd"), "left")
    ps = F.exp(F.col("lnsp"))
    j = j.withColumn("p_above", F.col("_au") + F.col("_bu") * ps) \
        .withColumn("p_below", F.col("_ad") + F.col("_bd") * ps)
    j = j.withColumn("p", (F.col("p_above") + F.col("p_below")) / F.lit(2.0))
    return j.drop("_hu", "_au", "_bu", "_hd", "_ad", "_bd")


def geopotential_on_levels(levels: DataFrame, keys: Sequence[str] = ("time", "cell"), k: str = "k",
                           t: str = "t", q: str = "q", zs: str = "zs") -> DataFrame:
    """MET-6 / WN-1: geopotential on full levels by hydrostatic integration.

    Needs p_above, p_below (from :func:`full_level_pressure`) and surface
    geopotential ``zs``.  phi at half level k+1/2 is zs plus the sum over the
    levels below k of Rd Tv ln(p_below / p_above) — a window sum from the
    surface up, excluding the current row.  Then phi_k = phi_{k+1/2} + alpha_k Rd Tv_k,
    alpha_1 = ln 2, else 1 - p_above / dp ln(p_below / p_above).

    Only whole columns are integrated: where a level between k and the surface is missing
    or has no value, z_half and z are NULL from there up.  The lowest level is the one whose
    p_below is the surface pressure.
    """
    rd = F.lit(fixed.R_DRY)
    tv = virtual_temperature(t, q)
    top = F.col("p_above") <= F.lit(0.0)
    dlogp = F.when(top, F.lit(None)).otherwise(F.log(F.col("p_below") / F.col("p_above")))
    alpha = F.when(top, F.lit(0.6931471805599453)).otherwise(
        F.lit(1.0) - F.col("p_above") / (F.col("p_below") - F.col("p_above")) * dlogp)
    w = Window.partitionBy(*keys).orderBy(F.col(k).desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = levels.withColumn("_tv", tv).withColumn("_term", rd * F.col("_tv") * dlogp)
    lower = F.lag(k).over(Window.partitionBy(*keys).orderBy(F.col(k).desc()))
    out = out.withColumn("_next", F.coalesce(F.when(lower.isNull(), F.col("p_below") == F.exp(F.col("lnsp")))
                                             .otherwise(lower == F.col(k) + 1), F.lit(False)))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.bool_and("_next").over(upto) & F.coalesce(F.bool_and(F.col("_term").isNotNull()).over(w), F.lit(True))
    out = out.withColumn("z_half", F.when(whole, F.col(zs) + F.coalesce(F.sum("_term").over(w), F.lit(0.0))))
    return out.withColumn("z", F.col("z_half") + alpha * rd * F.col("_tv")).drop("_tv", "_term", "_next")
