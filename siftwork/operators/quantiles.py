"""Exact quantiles by narrowing: no task holds a group's values.

A wanted rank lies between two values; at first between a group's least and largest. In each round the values between
them are counted in a grid of cells, the cell that holds the rank is found from the counts, and its least and largest
values are the next two. A few rounds leave intervals of one value, or of so few values that they are ordered at once.
All columns, groups and ranks are narrowed together, in one pass over the values for each round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

#: Values that are ordered in one task at most, but for tables of which there would be more than GROUPS such groups.
LEAF, GROUPS = 10_000, 10_000
#: Cells of the grid over an interval.
CELLS = 1_024


def _long(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """by..., __c (number of the column), __v: the values that are there."""
    pairs = ", ".join(f"{i}, cast(`{c}` as double)" for i, c in enumerate(columns))
    keys = [F.col(f"`{b}`") for b in by]
    return rows.select(*keys, F.expr(f"stack({len(columns)}, {pairs}) as (__c, __v)")).where("__v is not null")


def _same(a: str, b: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
    return out


def _wanted(points: dict[str, float]) -> Column:
    """The ranks (from 0) below and above the place of each quantile among ``__n`` values."""
    both = [x for p in points.values() for x in (F.floor(F.lit(float(p)) * (F.col("__n") - 1)), F.ceil(F.lit(float(p)) * (F.col("__n") - 1)))]
    return F.array_distinct(F.array(*(x.cast("long") for x in both)))


def _finite(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def _cell(v: Column, low: Column, high: Column, cells: int) -> Column:
    """The cell of a value between ``low`` and ``high``; these two never share one, so each round gets further."""
    span = high / 2 - low / 2
    share = F.floor(F.try_divide(v / 2 - low / 2, span) * cells)
    return F.when(v == low, 0).when(v == high, cells - 1).when(span > 0, F.greatest(F.lit(0), F.least(share, F.lit(cells - 1))).cast("int")).otherwise(0)


def _narrowed(values: DataFrame, ranks: DataFrame, keys: list[str], leaf: int, cells: int) -> DataFrame:
    """keys..., __k, __value: the values at the ranks ``ranks``: keys..., __k, and the interval that holds it.

    An interval: __low, __high, __before (values below it), __inside (values in it). ``values`` are finite.
    """
    every = lambda t: [F.col(f"{t}.`{k}`") for k in keys]
    done = (F.col("__low") == F.col("__high")) | (F.col("__inside") <= leaf)
    held = staged(ranks, "ranks")
    while not held.where(~done).isEmpty():
        # Intervals of ranks that are still open: a few for each large group, and of these there are GROUPS at most.
        spans = held.where(~done).select(*keys, "__low", "__high").distinct()
        met = values.alias("v").join(F.broadcast(spans.alias("s")), _same("v", "s", keys) & F.col("v.__v").between(F.col("s.__low"), F.col("s.__high")))
        cell = _cell(F.col("v.__v"), F.col("s.__low"), F.col("s.__high"), cells)
        counts = met.select(*every("v"), "s.__low", "s.__high", cell.alias("__cell"), "v.__v").groupBy(*keys, "__low", "__high", "__cell").agg(F.count("*").alias("__m"), F.min("__v").alias("__cl"), F.max("__v").alias("__ch"))
        earlier = Window.partitionBy(*keys, "__low", "__high").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__p", F.coalesce(F.sum("__m").over(earlier), F.lit(0)))
        place = F.col("h.__k") - F.col("h.__before")
        here = _same("h", "c", [*keys, "__low", "__high"]) & (place >= F.col("c.__p")) & (place < F.col("c.__p") + F.col("c.__m"))
        found = held.where(~done).alias("h").join(counts.alias("c"), here)
        new = found.select(*every("h"), "h.__k", F.col("c.__cl").alias("__low"), F.col("c.__ch").alias("__high"), (F.col("h.__before") + F.col("c.__p")).alias("__before"), F.col("c.__m").alias("__inside"))
        held = staged(held.where(done).unionByName(new), "ranks")
    known = held.where("__low = __high").select(*keys, "__k", F.col("__low").alias("__value"))
    short = held.where("__low < __high")
    spans = short.select(*keys, "__low", "__high", "__before").distinct()
    met = values.alias("v").join(F.broadcast(spans.alias("s")), _same("v", "s", keys) & F.col("v.__v").between(F.col("s.__low"), F.col("s.__high")))
    spot = Window.partitionBy(*keys, "__low").orderBy("__v")
    ordered = met.select(*every("v"), "s.__low", "s.__before", "v.__v").withColumn("__at", F.col("__before") + F.row_number().over(spot) - 1)
    read = ordered.alias("o").join(F.broadcast(short.select(*keys, "__low", "__k").alias("h")), _same("o", "h", [*keys, "__low"]) & (F.col("o.__at") == F.col("h.__k")))
    return known.union(read.select(*every("o"), "h.__k", F.col("o.__v").alias("__value")))


def _large(values: DataFrame, sizes: DataFrame, keys: list[str], points: dict[str, float], leaf: int, cells: int) -> DataFrame:
    """keys..., __k, __value of large groups: ranks among infinities and NaN follow from their counts, the others are narrowed."""
    k, first, upto = F.col("__k"), F.col("__least"), F.col("__least") + F.col("__inside")
    ranks = sizes.select(*keys, "__low", "__high", "__least", "__inside", "__most", F.explode(_wanted(points)).alias("__k"))
    value = F.when(k < first, float("-inf")).when(k < upto + F.col("__most"), float("inf")).otherwise(float("nan"))
    outer = ranks.where((k < first) | (k >= upto)).select(*keys, "__k", value.alias("__value"))
    inner = ranks.where((k >= first) & (k < upto)).select(*keys, "__k", "__low", "__high", first.alias("__before"), "__inside")
    return outer.union(_narrowed(values.where(_finite(F.col("__v")).isNotNull()), inner, keys, leaf, cells))


def exact_quantiles(rows: DataFrame, columns: list[str], points: dict[str, float], by: list[str] | None = None, leaf: int | None = None, cells: int = CELLS) -> DataFrame:
    """by..., column, n, and a column for each of ``points`` (name: share): quantiles by linear interpolation.

    A row for each group and column that has values. Groups of up to ``leaf`` values are ordered whole, larger ones are
    narrowed. Null groups are groups; null values are left out; NaN counts as larger than all others, infinities are
    values; an empty table gives no rows.
    """
    by = by or []
    keys = [*by, "__c"]
    values = staged(_long(rows, columns, by), "values")
    every = [F.col(f"`{k}`") for k in keys]
    v = F.col("__v")
    of = {"__low": F.min(_finite(v)), "__high": F.max(_finite(v)), "__inside": F.count(_finite(v)), "__least": F.count_if(v == float("-inf")), "__most": F.count_if(v == float("inf"))}
    sizes = staged(values.groupBy(*every).agg(F.count("*").alias("__n"), *(c.alias(name) for name, c in of.items())), "sizes")
    total, largest = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.max("__n"), F.lit(0))).first()
    leaf = leaf or max(LEAF, math.ceil(total / GROUPS))
    small, found = values, None
    if largest > leaf:
        large = sizes.where(F.col("__n") > leaf)
        found = _large(values, large, keys, points, leaf, cells)
        # At most GROUPS rows, as each stands for more than a part of GROUPS of all values.
        small = values.alias("v").join(F.broadcast(large.select(*every).alias("s")), _same("v", "s", keys), "left_anti")
    spot = Window.partitionBy(*every)
    ranked = small.withColumns({"__k": F.row_number().over(spot.orderBy("__v")).cast("long") - 1, "__n": F.count("*").over(spot)})
    ranked = ranked.where(F.array_contains(_wanted(points), F.col("__k"))).select(*every, "__k", F.col("__v").alias("__value"))
    found = ranked if found is None else ranked.union(found)
    met = found.alias("f").join(sizes.select(*every, "__n").alias("s"), _same("f", "s", keys)).select(*(F.col(f"f.`{k}`") for k in keys), "f.__k", "f.__value", "s.__n")

    def quantile(p: float) -> Column:
        place = F.lit(float(p)) * (F.col("__n") - 1)
        below, above = F.floor(place).cast("long"), F.ceil(place).cast("long")
        a, b = (F.max(F.when(F.col("__k") == k, F.col("__value"))) for k in (below, above))
        share = F.max(place - below)
        return F.when((share == 0) | (a == b), a).otherwise((1 - share) * a + share * b)

    out = met.groupBy(*every).agg(F.max("__n").alias("n"), *(quantile(p).alias(name) for name, p in points.items()))
    names = F.array(*map(F.lit, columns))
    return out.select(*(F.col(f"`{b}`") for b in by), F.get(names, F.col("__c")).alias("column"), "n", *(F.col(f"`{name}`") for name in points))
