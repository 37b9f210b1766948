"""Live signals as streams: landed files, ordinals kept in state, and windows over event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.readers import log_fields


def landed(spark: SparkSession, folder: str, schema: str, files: int = 100, kind: str = "parquet") -> DataFrame:
    """A stream of the files that land in a folder, at most ``files`` in a batch. Files must appear whole (renamed in)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(folder)


def each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, interval: str = "500 milliseconds"):
    """Starts a query that hands each batch to ``action``; either what is there now, or every interval."""
    writer = stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def first_seen(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key once; keys are forgotten when the watermark has passed them."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, late: str, size: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Counts and sums of ``value`` by window of event time and keys. Rows later than ``late`` are left out. (An extension.)"""
    return stream.withWatermark(time, late).groupBy(F.window(time, size, slide), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, time: str, late: str, gap: str, keys: list[str]) -> DataFrame:
    """Counts by session of activity with at most ``gap`` between rows. (An extension.)"""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def ordinals(stream: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """``stream`` with ``ordinal``: each row's place among the rows of its key so far, kept in state.

    The position that a packet fills is the next one of its stream, whatever batch it comes in. Within a batch rows count
    in ``order``.
    """
    types = dict(stream.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in [key, order, *columns]] + ["ordinal long"])

    def number(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        rows["ordinal"] = range(n + 1, n + 1 + len(rows))
        state.update((n + len(rows),))
        yield rows[[key, order, *columns, "ordinal"]]

    return stream.select(key, order, *columns).groupBy(key).applyInPandasWithState(number, schema, "n long", "append", GroupStateTimeout.NoTimeout)


def tracker_lines_batch(lines: DataFrame) -> DataFrame:
    """stream, frame_no, confidence, fit_error, proc_ms of whole logs (stream, line_no, line): a confidence line takes the last timing line since the confidence line before. ``merge.merged`` does so for a stream."""
    parsed = lines.select("stream", "line_no", *(c.alias(n) for n, c in log_fields(F.col("line")).items() if n in ("kind", "proc_ms", "confidence", "fit_error"))).where("kind is not null")
    spot = Window.partitionBy("stream").orderBy("line_no")
    before = F.coalesce(F.sum((F.col("kind") == "confidence").cast("int")).over(spot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grouped = parsed.withColumn("frame_no", before + 1)
    inside = Window.partitionBy("stream", "frame_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return grouped.withColumn("proc_ms", F.last("proc_ms", ignorenulls=True).over(inside)).where("kind = 'confidence'").select("stream", F.col("frame_no").cast("long"), "confidence", "fit_error", "proc_ms")
