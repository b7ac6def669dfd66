"""A store's axis: which steps, arrays and cells it has, apart from its rows (SNK-1, SNK-2, SNK-4, SNK-9).

Two small tables stand beside the rows, in folders that Spark's readers pass over:

* ``_axis``: one row a version: start, hours between steps, number of steps, forecast steps,
  cell dimensions, value type.  Growing the axis appends a version, so it is never half written.
* ``_arrays``: one row for each array: its variable and, where it has them, level or hybrid.

A skeleton is these tables and nothing else: no missing cell is stored.  ``read_filled`` makes
the missing cells of a selection, from the axis, when it is read.  Every region write checks its
rows against the axis.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store as ST

_SCHEMA = ("version int, start timestamp_ntz, step_hours int, n_steps bigint, forecast_steps int, "
           "dims array<struct<name: string, size: int>>, value_type string")


@dataclass(frozen=True)
class Axis:
    start: datetime
    step_hours: int
    n_steps: int
    forecast_steps: int | None
    dims: tuple[tuple[str, int], ...]
    value_type: str
    version: int = 0

    @property
    def end(self) -> datetime:
        """The first step that the axis does not have."""
        return self.start + timedelta(hours=self.step_hours) * self.n_steps


def _moment(x) -> datetime:
    if isinstance(x, datetime):
        return x
    return datetime.combine(x, datetime.min.time()) if isinstance(x, date) else datetime.fromisoformat(str(x))


def read_axis(spark: SparkSession, path: str) -> Axis | None:
    """The newest version of a store's axis; None where the store has none."""
    if not ST.store_exists(spark, f"{path}/_axis"):
        return None
    r = spark.read.schema(_SCHEMA).parquet(f"{path}/_axis").orderBy(F.desc("version")).first()
    return r and Axis(r["start"], r["step_hours"], r["n_steps"], r["forecast_steps"],
                      tuple((d["name"], d["size"]) for d in r["dims"]), r["value_type"], r["version"])


def _write(spark: SparkSession, path: str, axis: Axis) -> None:
    row = (axis.version, axis.start, axis.step_hours, axis.n_steps, axis.forecast_steps, list(axis.dims), axis.value_type)
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/_axis")


def arrays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/_arrays")


def row_schema(spark: SparkSession, path: str) -> str | None:
    """Columns of the rows of a store with an axis, partition columns last; None without one."""
    axis = read_axis(spark, path)
    if axis is None:
        return None
    columns = [("time", "timestamp_ntz"), *([("step", "int")] if axis.forecast_steps else [])]
    columns += [(f.name, f.dataType.simpleString()) for f in arrays(spark, path).schema if f.name != "variable"]
    columns += [(name, "int") for name, _ in axis.dims]
    columns += [("value" if axis.dims else "values", axis.value_type), ("variable", "string"), ("date", "date")]
    return ", ".join(f"`{n}` {t}" for n, t in columns)


def create_store(spark: SparkSession, path: str, start, end, arrays: DataFrame, dims: Mapping[str, int],
                 value_type: str = "float", step_hours: int = 1, forecast_steps: int | None = None) -> Axis:
    """SNK-4: a store of steps [start, end) x ``arrays`` (variable and further keys) x the cells
    of ``dims`` (name -> size), all missing.  Only axis and arrays are written.  Without
    ``dims`` a row holds a whole array, in ``values``.  A folder that has an axis or rows is
    refused; one in which an earlier call did not get as far as the axis is not."""
    if ST.store_exists(spark, path):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if any(f.getPath().getName() != "_arrays" for f in fs.listStatus(target)):
            raise ValueError(f"{path} exists")
    t0, t1 = _moment(start), _moment(end)
    steps = -(-(t1 - t0) // timedelta(hours=step_hours))
    if steps < 0:
        raise ValueError(f"the axis ends at {t1}, before its start {t0}")
    axis = Axis(t0, step_hours, steps, forecast_steps, tuple(dims.items()), value_type)
    arrays.coalesce(1).write.mode("overwrite").parquet(f"{path}/_arrays")
    _write(spark, path, axis)
    return axis


def extend_axis(spark: SparkSession, path: str, end_date) -> Axis:
    """SNK-9: let the axis reach through the whole day ``end_date``.  An axis that already does
    stays as it is, so a second run changes nothing.  No row is written: the new steps are
    missing until a region write brings them."""
    axis = read_axis(spark, path)
    if axis is None:
        raise ValueError(f"{path} has no axis")
    days = (_moment(end_date).date() - axis.start.date()).days + 1
    steps = days * (24 // axis.step_hours)
    if steps <= axis.n_steps:
        return axis
    longer = replace(axis, n_steps=steps, version=axis.version + 1)
    _write(spark, path, longer)
    return longer


def check_rows(axis: Axis | None, rows: DataFrame) -> None:
    """Raise where rows have a step, forecast step or cell that the axis does not have: one
    aggregation of one row.  Without an axis there is nothing to check."""
    if axis is None:
        return
    hours = F.timestamp_diff("SECOND", F.lit(axis.start), F.col("time")) / 3600 if "time" in rows.columns else None
    wrong: dict[str, Column] = {}
    if hours is not None:
        wrong["time"] = (F.col("time").isNull() | (hours < 0) | (hours >= axis.n_steps * axis.step_hours)
                         | (hours % axis.step_hours != 0))
    if axis.forecast_steps and "step" in rows.columns:
        wrong["step"] = F.col("step").isNull() | ~F.col("step").between(0, axis.forecast_steps - 1)
    for name, size in axis.dims:
        if name in rows.columns:
            wrong[name] = F.col(name).isNull() | ~F.col(name).between(0, size - 1)
    if not wrong:
        return
    found = rows.agg(*[F.count_if(c).alias(f"n_{k}") for k, c in wrong.items()],
                     *[F.min(F.when(c, F.col(k).cast("string"))).alias(f"at_{k}") for k, c in wrong.items()]).first()
    bad = [f"{k} {found[f'at_{k}']} ({found[f'n_{k}']} rows)" for k in wrong if found[f"n_{k}"]]
    if bad:
        raise ValueError(f"outside the store's axis ({axis.start} to {axis.end}, every {axis.step_hours} h): " + ", ".join(bad))


def read_filled(spark: SparkSession, path: str, start=None, end=None, where: Column | None = None) -> DataFrame:
    """Every cell of steps [start, end) and of the arrays that ``where`` selects (a condition on
    the columns of ``_arrays``); a cell without a row is missing (NULL).

    The steps are a distributed range, the cells of a step are made where it is; the store is
    read with literal filters on its partitions.  Steps outside the axis are not
    there.  Forecast stores also give ``valid_time``."""
    axis = read_axis(spark, path)
    if axis is None:
        raise ValueError(f"{path} has no axis")
    step = timedelta(hours=axis.step_hours)
    t0 = axis.start if start is None else max(axis.start, _moment(start))
    t1 = axis.end if end is None else min(axis.end, _moment(end))
    i0, i1 = -(-(t0 - axis.start) // step), -(-(t1 - axis.start) // step)
    times = spark.range(i0, max(i0, i1)).select(
        F.timestamp_add("HOUR", F.col("id") * axis.step_hours, F.lit(axis.start)).alias("time"))
    which = arrays(spark, path)
    rows = ST.read_store(spark, path).where(F.col("date").between(F.lit(t0.date()), F.lit(max(t0, t1).date())))
    if where is not None:
        which, rows = which.where(where), rows.where(where)
    cells = times.crossJoin(which)
    keys = ["time", *which.columns]
    if axis.forecast_steps:
        cells = cells.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(axis.forecast_steps - 1))))
        cells = cells.withColumn("valid_time", F.timestamp_add("HOUR", F.col("step"), F.col("time")))
        keys.append("step")
    for name, size in axis.dims:
        cells = cells.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
        keys.append(name)
    value = "values" if not axis.dims else "value"
    rows = rows.select(*keys, value)
    out = cells.join(rows, ST.same(cells, rows, keys), "left")
    return out.select(*[cells[c] for c in cells.columns], rows[value], cells["time"].cast("date").alias("date"))
