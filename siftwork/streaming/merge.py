"""A stream of a tracker's packets and a stream of its log, merged by their ordinals.

The n-th packet of a tracker and the n-th confidence line of its log speak of the same frame; a timing line belongs to the
next confidence line. Both sides come as one tagged stream into one stateful processor for each tracker, with a counter
for each side. What has no other side yet waits in state; a timer of event time lets go of what has waited too long (it
comes out with the other side empty), so state stays bounded when a side falls silent.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.readers import log_fields

#: The state store that the processor needs, for Spark's setting spark.sql.streaming.stateStore.providerClass.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TAGGED = ["stream", "side", "seq", "ts", "packet", "kind", "proc_ms", "confidence", "fit_error"]
MERGED = "stream string, frame_no long, packet binary, confidence double, fit_error double, proc_ms double"


def tagged(packets: DataFrame, lines: DataFrame) -> DataFrame:
    """``packets`` (stream, seq, ts, packet) and ``lines`` (stream, seq, ts, line) as one table.

    seq orders each side of a stream; ts is when something was captured.
    """
    a = packets.select(F.col("stream").cast("string"), F.lit("packet").alias("side"), F.col("seq").cast("long"), "ts", "packet", F.lit("packet").alias("kind"), *(F.lit(None).cast("double").alias(c) for c in TAGGED[6:]))
    fields = log_fields(F.col("line"))
    b = lines.select(F.col("stream").cast("string"), F.lit("line").alias("side"), F.col("seq").cast("long"), "ts", F.lit(None).cast("binary").alias("packet"), *(fields[c].alias(c) for c in TAGGED[5:])).where("kind is not null")
    return a.unionByName(b)


class Merge(StatefulProcessor):
    """Counters, the carried timing, and what waits: by ordinal, with its side."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counters = handle.getValueState("counters", "packets long, lines long, ms double")
        self.packets = handle.getMapState("packets", "frame_no long", "packet binary, until long")
        self.lines = handle.getMapState("lines", "frame_no long", "confidence double, fit_error double, proc_ms double, until long")

    def handleInputRows(self, key, rows, timerValues):
        packets, lines, ms = self.counters.get() if self.counters.exists() else (0, 0, None)
        out, due = [], set()
        # Within a batch each side comes in its order; the sides do not wait for each other.
        for r in pd.concat(list(rows)).sort_values(["side", "seq"], kind="stable").itertuples():
            if r.kind == "took":
                ms = float(r.proc_ms)
                continue
            if r.kind == "packet":
                packets += 1
                n, own, other = packets, self.packets, self.lines
                value = (bytes(r.packet) if r.packet is not None else None,)
            else:
                lines += 1
                n, own, other = lines, self.lines, self.packets
                value = (float(r.confidence), float(r.fit_error), ms)
                ms = None
            if other.containsKey((n,)):
                waiting = other.getValue((n,))[:-1]
                other.removeKey((n,))
                out.append((key[0], n, *(value if r.kind == "packet" else waiting), *(waiting if r.kind == "packet" else value)))
            else:
                until = int(r.ts.value // 1_000_000) + self.patience_ms
                own.updateValue((n,), (*value, until))
                due.add(until)
        self.counters.update((packets, lines, ms))
        for until in due:
            self.handle.registerTimer(until)
        yield frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Lets go of what has waited until now."""
        limit, out = expiredTimerInfo.getExpiryTimeInMs(), []
        for held, side in ((self.packets, "packet"), (self.lines, "line")):
            old = [(k[0], v) for k, v in held.iterator() if v[-1] <= limit]
            for n, v in old:
                held.removeKey((n,))
                out.append((key[0], n, v[0], None, None, None) if side == "packet" else (key[0], n, None, *v[:-1]))
        yield frame(out)

    def close(self) -> None:
        pass


def frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["stream", "frame_no", "packet", "confidence", "fit_error", "proc_ms"])
    return out.astype({"frame_no": "int64", "confidence": "float64", "fit_error": "float64", "proc_ms": "float64"})


def merged(packets: DataFrame, lines: DataFrame, patience: float = 60.0, late: str = "10 seconds") -> DataFrame:
    """stream, frame_no, packet, confidence, fit_error, proc_ms of two streams (see ``tagged``).

    A frame comes out when both of its sides have come, in whatever batches, or alone when the watermark, ``late`` behind
    the latest ts of either side, is ``patience`` seconds past what came of it. (Should its other side come after that,
    it comes out alone as well.) Rows that come behind the watermark are left out. Needs Spark's RocksDB state store.
    """
    both = tagged(packets, lines).withWatermark("ts", late)  # of both together: a silent side does not hold it back
    return both.groupBy("stream").transformWithStateInPandas(Merge(int(patience * 1000)), MERGED, "Append", "EventTime")


def merged_batch(packets: DataFrame, lines: DataFrame) -> DataFrame:
    """The same of whole tables: all frames, with null where a side has none."""
    both = tagged(packets, lines)
    spot = Window.partitionBy("stream").orderBy("seq")
    a = both.where("side = 'packet'").withColumn("frame_no", F.row_number().over(spot).cast("long")).select("stream", "frame_no", "packet", F.lit(True).alias("__a"))
    earlier = F.coalesce(F.sum((F.col("kind") == "confidence").cast("long")).over(spot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    b = both.where("side = 'line'").withColumn("frame_no", earlier + 1)
    inside = Window.partitionBy("stream", "frame_no").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("proc_ms", F.last("proc_ms", ignorenulls=True).over(inside)).where("kind = 'confidence'").select("stream", "frame_no", "confidence", "fit_error", "proc_ms")
    return a.join(b, ["stream", "frame_no"], "full_outer").select("stream", "frame_no", "packet", "confidence", "fit_error", "proc_ms")
