"""Release logic: preliminary vs final data (JN-4, JN-7, JN-8, JN-9, AG-1, AG-2, AG-6).

The archive first publishes a preliminary release (expver 5) and replaces it
months later with the final one (expver 1).  Everything here is one grouped
pass or one equi-join on the grid key:

* combine   — per cell, the final value if present else the preliminary one:
              ``max_by(value, priority)`` in a single aggregation (partial
              aggregation map-side, no join).
* gaps      — per time and release, whether any expected cell is missing.
* equality  — order-free digests per block and side; one row a block meets, no cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def _priority(expver: str = "expver") -> Column:
    return F.when(F.col(expver) == fixed.RELEASE_FINAL, F.lit(2)).otherwise(F.lit(1))


def combine_releases(df: DataFrame, keys: Sequence[str], value: str = "value",
                     expver: str = "expver", arrival: str | None = None) -> DataFrame:
    """JN-4: final first, else preliminary; a missing (NULL) value gives way to the other
    release, and a cell missing in both stays, as missing.  Of two deliveries of one
    release the later ``arrival`` wins, without one (or at a tie) the larger value."""
    rank = [_priority(expver), *([F.col(arrival)] if arrival else []), F.col(value)]
    order = F.when(F.col(value).isNotNull(), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)]))
    return df.groupBy(*keys).agg(F.max_by(F.col(value), order).alias(value),
                                 F.max_by(F.col(expver), order).alias("expver_used"))


def release_gaps(df: DataFrame, time_keys: Sequence[str], n_cells: int, cell: str = "cell",
                 value: str = "value", expver: str = "expver", expected: DataFrame | None = None) -> DataFrame:
    """AG-1: per time, does each release lack any of the ``n_cells`` cells?

    ``expected`` has one row for each step that the axis asks for (the ``time_keys`` columns): a
    step without any row is a gap in both releases.  Without it only steps that have rows
    are judged."""
    ok = F.col(value).isNotNull()
    n_final = F.count_distinct(F.when(ok & (F.col(expver) == fixed.RELEASE_FINAL), F.col(cell)))
    n_prelim = F.count_distinct(F.when(ok & (F.col(expver) == fixed.RELEASE_PRELIMINARY), F.col(cell)))
    counts = df.groupBy(*time_keys).agg(n_final.alias("_f"), n_prelim.alias("_p"))
    if expected is not None:
        counts = expected.select(*time_keys).join(counts, list(time_keys), "left").na.fill(0, ["_f", "_p"])
    return counts.select(*time_keys, (F.col("_f") < n_cells).alias("gap_final"), (F.col("_p") < n_cells).alias("gap_prelim"))


def release_disjoint(gaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-2: exactly one release is gappy at every time (else the merge is ambiguous)."""
    xor = F.col("gap_final") != F.col("gap_prelim")
    return gaps.groupBy(*keys).agg(F.bool_and(xor).alias("disjoint"),
                                   F.count_if(F.col("gap_final") & F.col("gap_prelim")).alias("n_both_gappy"),
                                   F.count(F.lit(1)).alias("n_times"))


def pair_releases(old: DataFrame, staged: DataFrame, rel: str = "relpath") -> DataFrame:
    """JN-7: pair current and staged files by relative path, only where the staged one exists."""
    return old.join(staged, rel, "inner")


def block_digest(df: DataFrame, block: Sequence[str], cell_keys: Sequence[str], value: str = "value") -> DataFrame:
    """Order-free digest of each block's cells: their number, two sums of 32 bits of a hash, and
    the exclusive-or of a second hash.  Missing cells are as if absent.  One row a block and task
    is exchanged, however many cells it has."""
    some = F.col(value).isNotNull()
    number = dict(df.dtypes)[value] in ("float", "double", "int", "bigint", "smallint", "tinyint")
    v = F.col(value).cast("double") if number else F.col(value)
    parts = [x for k in cell_keys for x in (F.col(k).isNull(), F.col(k))] + [v]
    first = F.when(some, F.xxhash64(F.lit(1), *parts))
    second = F.when(some, F.xxhash64(F.lit(2), *parts))
    low, high = first.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(first, 32)
    zero = F.lit(0).cast("long")
    return df.groupBy(*block).agg(F.struct(
        F.count_if(some).alias("n"), F.coalesce(F.sum(low), zero).alias("low"), F.coalesce(F.sum(high), zero).alias("high"),
        F.coalesce(F.bit_xor(second), zero).alias("x")).alias("digest"))


def compare_blocks(a: DataFrame, b: DataFrame, block: Sequence[str], cell_keys: Sequence[str],
                   value: str = "value") -> DataFrame:
    """Per block of either side: ``in_a``, ``in_b``, and whether both hold the same cells (``equal``).

    Digests of both sides meet, never cells; they are equal for unlike blocks with a chance
    of about 2^-128.  A missing value in ``block`` is a value like any other.  Columns of
    ``b`` take the types of ``a``."""
    b = b.select(*[F.col(k).cast(a.schema[k].dataType).alias(k) for k in [*block, *cell_keys]], value)
    sides = block_digest(a, block, cell_keys, value).withColumn("_a", F.lit(True)).unionByName(
        block_digest(b, block, cell_keys, value).withColumn("_a", F.lit(False)))
    zero = F.lit(0).cast("long")
    none = F.struct(*[zero.alias(n) for n in ("n", "low", "high", "x")])
    of = lambda mine: F.max(F.when(F.col("_a") == F.lit(mine), F.col("digest")))
    return sides.groupBy(*block).agg(F.bool_or("_a").alias("in_a"), F.bool_or(~F.col("_a")).alias("in_b"),
                                     of(True).alias("_x"), of(False).alias("_y")).select(
        *block, "in_a", "in_b", (F.coalesce("_x", none) == F.coalesce("_y", none)).alias("equal"))


def blocks_equal(a: DataFrame, b: DataFrame, block: Sequence[str], cell_keys: Sequence[str],
                 value: str = "value") -> DataFrame:
    """JN-8: whole-block equality by digests; missing equals missing, present vs absent differs."""
    return compare_blocks(a, b, block, cell_keys, value).select(*block, "equal")


def block_audit(current: DataFrame, staged: DataFrame, block: Sequence[str], cell_keys: Sequence[str],
                value: str = "value") -> DataFrame:
    """SNK-13 / D8: per block ratified (staged copy equal), data_changed (different), absent (no
    staged copy) or added (only staged)."""
    status = (F.when(~F.col("in_b"), F.lit("absent")).when(~F.col("in_a"), F.lit("added"))
              .when(F.col("equal"), F.lit("ratified")).otherwise(F.lit("data_changed")))
    return compare_blocks(current, staged, block, cell_keys, value).select(*block, status.alias("status"))


def audit_counts(equal: DataFrame) -> DataFrame:
    """AG-6: run counters — blocks unchanged vs changed."""
    return equal.agg(F.count_if(F.col("equal")).alias("n_equal"),
                     F.count_if(~F.col("equal")).alias("n_different"))


def merge_conflicts(a: DataFrame, b: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """JN-9: same-named variables must agree where both sides have a value."""
    aa = a.select(*keys, *[F.col(v).alias(f"_a_{v}") for v in variables])
    bb = b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in variables])
    j = aa.join(bb, list(keys), "inner")
    aggs = []
    for v in variables:
        both = F.col(f"_a_{v}").isNotNull() & F.col(f"_b_{v}").isNotNull()
        aggs += [F.count_if(both).alias(f"{v}_both"),
                 F.count_if(both & (F.col(f"_a_{v}") != F.col(f"_b_{v}"))).alias(f"{v}_conflicts")]
    return j.agg(*aggs)


def merge_stores(a: DataFrame, b: DataFrame, keys: Sequence[str], on_conflict: str = "raise") -> DataFrame:
    """JN-2 with JN-9: full outer merge on ``keys`` (a missing key equals a missing key).  A variable
    that both sides have takes the value that is there; where both have one they must agree.

    ``on_conflict="raise"`` fails the job at the first row that does not, while it is merged;
    ``"count"`` keeps the value of ``a`` and adds ``n_conflicts``, the number of such variables in a
    row.  One join either way, no pass before it."""
    if on_conflict not in ("raise", "count"):
        raise ValueError(f"on_conflict must be 'raise' or 'count', not {on_conflict!r}")
    x = a.select(*[F.col(c).alias(f"_a_{c}") for c in a.columns])
    y = b.select(*[F.col(c).alias(f"_b_{c}") for c in b.columns])
    on = [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    j = x.join(y, on, "full_outer")
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    unlike = {v: F.coalesce(F.col(f"_a_{v}") != F.col(f"_b_{v}"), F.lit(False)) for v in shared}
    out = [F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in keys]
    for v in [*a.columns, *[c for c in b.columns if c not in a.columns]]:
        if v in keys:
            continue
        one = F.coalesce(*[F.col(f"_{s}_{v}") for s, df in (("a", a), ("b", b)) if v in df.columns])
        if v in unlike and on_conflict == "raise":
            where = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(f"_a_{k}").cast("string"), F.lit("missing"))) for k in keys])
            one = F.when(unlike[v], F.raise_error(F.concat(F.lit(f"conflicting values of {v} at "), where))).otherwise(one)
        out.append(one.alias(v))
    if on_conflict == "count":
        n = F.lit(0)
        for c in unlike.values():
            n = n + c.cast("int")
        out.append(n.alias("n_conflicts"))
    return j.select(*out)


def assert_no_conflicts(conflicts: DataFrame, variables: Sequence[str]) -> None:
    row = conflicts.first()
    bad = [v for v in variables if row[f"{v}_conflicts"]]
    if bad:
        raise ValueError(f"conflicting values for {bad}")
