"""Cutting and resampling timelines: rows of (track, t) with t in seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordinals import with_ordinals


def drop_head(rows: DataFrame, start: float, t: str = "t") -> DataFrame:
    """Rows from ``start`` on, counted from there."""
    return rows.where(F.col(t) >= start).withColumn(t, F.col(t) - start)


def keep_head(rows: DataFrame, end: float, t: str = "t") -> DataFrame:
    return rows.where(F.col(t) < end)


def cut_tail(rows: DataFrame, tail: float, track: str, t: str = "t", durations: DataFrame | None = None) -> DataFrame:
    """Rows before the last ``tail`` seconds of their track. Tracks that are not longer raise an error when they are read.

    ``durations``: track and duration; without it a track ends with its last row.
    """
    ends = durations if durations is not None else rows.groupBy(track).agg(F.max(t).alias("duration"))
    keep = F.when(F.col("duration") > tail, F.col("duration") - tail).otherwise(F.raise_error(F.concat(F.lit(f"the tail of {tail} s is not shorter than track "), F.col(track).cast("string"))).cast("double"))
    return rows.join(ends, track).where(F.col(t) < keep).drop("duration")


def remove_range(rows: DataFrame, start: float, end: float, t: str = "t") -> DataFrame:
    """Rows outside [start, end), with the gap closed."""
    if end <= start:
        raise ValueError("the range must end after its start")
    return rows.where((F.col(t) < start) | (F.col(t) >= end)).withColumn(t, F.when(F.col(t) >= end, F.col(t) - (end - start)).otherwise(F.col(t)))


def resample(rows: DataFrame, rate: float, track: str, value: str, t: str = "t") -> DataFrame:
    """A grid of ``rate`` points a second over each track, each with the last value at or before it; track, t, value.

    One pass over the union of rows and grid: no join of each grid point with earlier rows. The grid starts at the first row.
    """
    ends = rows.groupBy(track).agg(F.min(t).alias("a"), F.max(t).alias("b"))
    grid = ends.select(track, F.explode(F.sequence(F.lit(0), F.floor((F.col("b") - F.col("a")) * rate).cast("int"))).alias("i"), "a").select(track, (F.col("a") + F.col("i") / F.lit(float(rate))).alias(t), F.lit(None).cast(rows.schema[value].dataType).alias(value), F.lit(1).alias("__grid"))
    both = rows.select(track, t, value, F.lit(0).alias("__grid")).union(grid)
    spot = Window.partitionBy(track).orderBy(t, "__grid").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("__v", F.last(F.when(F.col("__grid") == 0, F.col(value)), ignorenulls=True).over(spot)).where("__grid = 1").select(track, t, F.col("__v").alias(value))


def number_frames(rows: DataFrame, track: str, t: str = "t", start: int = 0) -> DataFrame:
    """Output numbers of each track's rows, from ``start``."""
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(track).orderBy(t)) - 1 + start)


def synthetic_time(rows: DataFrame, order: str, rate: float, partition: list[str] | None = None) -> DataFrame:
    """Milliseconds of each row at a fixed rate, in order: within a partition, or over the whole table in ranges of the order."""
    if not partition:
        return with_ordinals(rows, [order], "__ordinal").withColumn("ms", (F.col("__ordinal") - 1) * (1000.0 / rate)).drop("__ordinal")
    spot = Window.partitionBy(*partition).orderBy(order)
    return rows.withColumn("ms", (F.row_number().over(spot) - 1) * (1000.0 / rate))


def stride(rows: DataFrame, source_rate: float | None, rate: float, index: str) -> DataFrame:
    """Every n-th frame, n = max(1, round(source rate / rate)) (half to even); a source without a rate counts as 30."""
    step = max(1, round((source_rate or 30.0) / rate))
    return rows.where(F.col(index) % step == 0)
