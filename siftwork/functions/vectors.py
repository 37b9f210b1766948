"""Arithmetic on arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalised(v: Column, eps: float = 1e-8) -> Column:
    # The norm is bound outside the inner function, so it is computed once for a vector.
    return F.transform(F.array(norm(v) + eps), lambda n: F.transform(v, lambda x: x.cast("double") / n))[0]


def softmax(v: Column) -> Column:
    e = F.transform(F.array(F.array_max(v)), lambda top: F.transform(v, lambda x: F.exp(x - top)))[0]
    return F.transform(F.array(F.struct(e.alias("e"), total(e).alias("sum"))), lambda s: F.transform(s["e"], lambda x: x / s["sum"]))[0]


def arg_max(v: Column) -> Column:
    """The index (from 0) of the first largest entry."""
    return F.array_position(v, F.array_max(v)) - 1


def top_labels(labels: Column, probabilities: Column, k: int) -> Column:
    """label:probability of the k largest, separated by commas; equal ones in their order."""
    rows = F.transform(F.arrays_zip(labels.alias("l"), probabilities.alias("p"), F.sequence(F.lit(1), F.size(labels)).alias("i")), lambda x: F.struct((-x["p"]).alias("q"), x["i"].alias("i"), x["l"].alias("l")))
    return F.array_join(F.transform(F.slice(F.array_sort(rows), 1, k), lambda x: F.concat(x["l"], F.lit(":"), F.format_number(-x["q"], 4))), ",")


def matrix_pose(m: Column) -> Column:
    """yaw, pitch, roll in degrees of the rotation in a 4 x 4 matrix (array of rows)."""
    cell = lambda i, j: F.get(F.get(m, i), j).cast("double")
    yaw = F.atan2(cell(1, 0), cell(0, 0))
    pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -cell(2, 0))))
    roll = F.atan2(cell(2, 1), cell(2, 2))
    return F.struct(F.degrees(yaw).alias("yaw"), F.degrees(pitch).alias("pitch"), F.degrees(roll).alias("roll"))
