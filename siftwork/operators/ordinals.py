"""Numbers of rows in one order over a whole table, without a task that orders all rows.

Rows are dealt to ranges of the order by Spark's sampled borders, sorted within their range and written down. What the
borders were is then a fact of the written table: each row carries its range and its place in it, whatever runs again
later. Counts per range (a row each) give what lies before a range, and place plus that is the row's ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

#: Rows of a range at least, and most ranges of a table.
RANGE_ROWS, RANGES = 50_000, 10_000
#: Bits of a written row's number that hold its place in its range (Spark's division of monotonically increasing ids).
PLACE_BITS = 33


def _unhashable(kind: T.DataType) -> bool:
    """Whether a type holds maps or variants, of which there is no hash."""
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    return isinstance(kind, T.StructType) and any(_unhashable(f.dataType) for f in kind.fields)


def spread(rows: DataFrame) -> Column:
    """A hash of the whole row: it orders rows that the order leaves equal, so that their ranges can be cut anywhere."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in rows.schema.fields if not _unhashable(f.dataType)))


def ranged(rows: DataFrame, order: list[str | Column], size: int = RANGE_ROWS) -> DataFrame:
    """``rows``, written in ``order``, with __range (from 0, rising with the order) and __place (from 0 in its range)."""
    count = rows.count()
    ranges = max(1, min(RANGES, count // size + (count % size > 0)))
    keys = [*(F.col(c) if isinstance(c, str) else c for c in order), spread(rows).asc()]
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    table = staged(dealt.withColumn("__number", F.monotonically_increasing_id()), "ranges")
    return table.withColumns({"__range": F.shiftright("__number", PLACE_BITS), "__place": F.col("__number").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("__number")


def offsets(table: DataFrame) -> DataFrame:
    """__range and __before, the number of rows in earlier ranges; a row for each range that has rows (RANGES at most)."""
    counts = table.groupBy("__range").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))


def with_ordinals(rows: DataFrame, order: list[str | Column], alias: str = "ordinal", size: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``alias``: 1, 2, ... in ``order``, over the whole table.

    One shuffle of the rows and one write. Rows that the order leaves equal come in an order of their own (by a hash of
    the row); rows that are equal in all columns are interchangeable and share a range. Nulls come first in ascending
    order. An empty table stays empty.
    """
    table = ranged(rows, order, size)
    # At most RANGES rows of two numbers.
    met = table.join(F.broadcast(offsets(table)), "__range")
    return met.withColumn(alias, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__before")


def with_ranks(rows: DataFrame, by: list[str], order: list[str | Column], alias: str = "rank", size: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``alias``: 1, 2, ... in ``order`` within each key ``by``.

    Keys of any size: all rows are ordered by key and ``order`` together, so a key that has a third of all rows lies in
    a third of the ranges, and a key's ranks count from its first row. Each range tells how many rows of the key it ends
    with have come before; no key is gathered in a task.
    """
    table = ranged(rows, [*by, *order], size)
    key = [F.col(f"`{c}`") for c in by]
    # Where each key starts: its first place in its first range. A row per key and range.
    starts = table.groupBy("__range", *key).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    # A key's count in earlier ranges. Keys that lie in one range only have one row here.
    earlier = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("__had", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    keyed = starts.select(F.col("__range").alias("__r"), *(k.alias(f"__k{i}") for i, k in enumerate(key)), (F.col("__had") - F.col("__first")).alias("__shift"))
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(key):
        same = same & k.eqNullSafe(F.col(f"__k{i}"))
    met = table.join(keyed, same)
    return met.withColumn(alias, F.col("__place") + F.col("__shift") + 1).drop("__range", "__place", "__r", "__shift", *(f"__k{i}" for i in range(len(key))))
