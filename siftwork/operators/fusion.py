"""Fusing feature tables by key, calibrating thresholds, and tagging items with categories and scores."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.parsing import base_name, first_filled, maybe_degrees, to_float
from .ordinals import RANGE_ROWS, ranged
from .quantiles import exact_quantiles

KEY_COLUMNS = ("file", "path", "name", "input", "filename")
# The names under which sources write the same value, in order of precedence.
IDENTITY_NAMES = ("id_score", "cos_ref", "id_conf", "cos_sim", "similarity", "cosine")
QUALITY_NAMES = ("quality", "mag", "mag_norm", "mag_quality")


def key_column(columns: list[str]) -> str:
    """The column that names the item: the first known name, else the first column."""
    return next((c for c in KEY_COLUMNS if c in columns), columns[0])


def pick(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    spot = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(spot)).where("__rank = 1").drop("__rank")


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return pick(rows, keys, [F.col(order).asc()])


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return pick(rows, keys, [F.col(order).desc()])


def by_base_name(rows: DataFrame, order: str, key: str | None = None) -> DataFrame:
    """``rows`` by the base name of their key column, as ``file``; of equal names the last row in ``order`` stays, empty ones go."""
    key = key or key_column([c for c in rows.columns if c != order])
    named = rows.withColumn("__file", base_name(F.col(key))).where(F.coalesce("__file", F.lit("")) != "")
    named = named.drop("file").withColumnRenamed("__file", "file")
    return last_wins(named, ["file"], order).drop(order)


def overlay(under: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Union of the keys; where ``over`` has a row its cells win, empty ones too; columns that it lacks come from ``under``."""
    a = under.select(F.col(key), *(F.col(c).alias(f"__a_{c}") for c in under.columns if c != key), F.lit(True).alias("__a"))
    b = over.select(F.col(key), *(F.col(c).alias(f"__b_{c}") for c in over.columns if c != key), F.lit(True).alias("__b"))
    names = [c for c in dict.fromkeys(under.columns + over.columns) if c != key]

    def cell(c: str) -> Column:
        if c not in over.columns:
            return F.col(f"__a_{c}").alias(c)
        if c not in under.columns:
            return F.col(f"__b_{c}").alias(c)
        return F.when(F.col("__b"), F.col(f"__b_{c}")).otherwise(F.col(f"__a_{c}")).alias(c)

    return a.join(b, key, "full_outer").select(key, *map(cell, names))


def fuse(items: DataFrame, sources: dict[str, DataFrame], key: str) -> DataFrame:
    """``items`` left-joined with each source by ``key``; a source's columns get its name in front, and ``<name>_present`` tells whether it has the item.

    Sources that are not given cost nothing: there is no join for them. Each must have one row for a key.
    """

    def add(left: DataFrame, named: tuple[str, DataFrame]) -> DataFrame:
        name, source = named
        right = source.select(F.col(key), *(F.col(c).alias(f"{name}_{c}") for c in source.columns if c != key), F.lit(True).alias(f"{name}_present"))
        return left.join(right, key, "left").withColumn(f"{name}_present", F.coalesce(f"{name}_present", F.lit(False)))

    return reduce(add, sources.items(), items)


def quantiles(values: DataFrame, column: str, points: dict[str, float], defaults: dict[str, float]) -> DataFrame:
    """One row of exact quantiles (linear interpolation), or the defaults where there are no values."""
    found = exact_quantiles(values, [column], points)
    return found.agg(*(F.coalesce(F.max(name), F.lit(defaults[name])).alias(name) for name in points))


def moments(values: DataFrame, column: str) -> DataFrame:
    """One row: mean and population deviation plus 1e-6; 0 and 1 where there are no values."""
    return values.agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_pop(column) + 1e-6, F.lit(1.0)).alias("std"))


def both_signs(column: Column) -> Column:
    """Aggregate: whether values reach below -1 and above 1."""
    return F.coalesce((F.min(column) < -1.0) & (F.max(column) > 1.0), F.lit(False))


def yaw_preference(first: Column, second: Column) -> Column:
    """Aggregate: whether ``first`` is the better source of an angle: it alone has both signs, or it has as many values."""
    a, b = both_signs(first), both_signs(second)
    return F.when(a & ~b, True).when(b & ~a, False).otherwise(F.count(first) >= F.count(second))


def running_score(rows: DataFrame, value: str, order: str, alias: str = "z", partition: list[str] | None = None) -> DataFrame:
    """z-score of each value against earlier rows only.

    The deviation counts from two earlier rows on, and as 1 if it is at most 1e-6; the first row scores 0.
    Without ``partition`` it runs over ranges of all rows (``running_score_at_scale``).
    """
    if not partition:
        return running_score_at_scale(rows, value, order, alias)
    spot = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    n, mean, std = F.count(value).over(spot), F.avg(value).over(spot), F.stddev_pop(value).over(spot)
    return rows.withColumn(alias, z_score(F.col(value), n, mean, std))


def z_score(x: Column, n: Column, mean: Column, std: Column) -> Column:
    spread = F.when((n > 1) & (std > 1e-6), std).otherwise(1.0)
    return F.when(n > 0, (x - mean) / spread).otherwise(0.0)


def running_score_at_scale(rows: DataFrame, value: str, order: str, alias: str = "z", size: int = RANGE_ROWS) -> DataFrame:
    """``running_score`` over all rows without one ordered pass.

    Rows are dealt to ranges of ``order`` that are written down. Count, sum and squares of each range, of values less
    their mean (so that squares do not cancel), are combined in a window over the ranges (a row each), and give every
    range what came before it.
    """
    pivot = rows.agg(F.coalesce(F.avg(value), F.lit(0.0))).first()[0]
    x = F.col("__x")
    dealt = ranged(rows, [order], size).withColumn("__x", F.col(value) - F.lit(pivot))
    sums = dealt.groupBy("__range").agg(F.count(x).alias("bn"), F.sum(x).alias("bs"), F.sum(x * x).alias("bq"))
    run = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__range", *(F.coalesce(F.sum(c).over(run), F.lit(0)).alias(f"__p{c}") for c in ("bn", "bs", "bq")))
    inside = Window.partitionBy("__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    count = F.col("__pbn") + F.count(x).over(inside)
    s = F.col("__pbs") + F.coalesce(F.sum(x).over(inside), F.lit(0.0))
    q = F.col("__pbq") + F.coalesce(F.sum(x * x).over(inside), F.lit(0.0))
    mean = F.try_divide(s, count)
    std = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(q, count) - mean * mean))
    # A row of numbers for each range, of which there are few (see ``ranged``).
    out = dealt.join(F.broadcast(before), "__range").withColumn(alias, z_score(x, count, mean, std))
    return out.drop("__range", "__place", "__x", "__pbn", "__pbs", "__pbq")


def source_cell(rows: DataFrame, source: str, *names: str) -> Column:
    """The first filled cell among ``names`` of a fused source; null if it has none of these columns."""
    there = [F.col(f"{source}_{n}") for n in names if f"{source}_{n}" in rows.columns]
    return first_filled(*there) if there else F.lit(None).cast("string")


def calibration(sources: dict[str, DataFrame]) -> DataFrame:
    """One row of what the tagging rules need from whole tables: jaw_lo, jaw_hi, id_threshold, mag_mean, mag_std, prefer_of3.

    ``sources`` may have mp, of3, af and mf (tables of string cells); each is read once, by an aggregate of its own.
    """
    def cells(name: str, *names: str) -> Column:
        table = sources.get(name)
        there = [F.col(n) for n in names if table is not None and n in table.columns]
        return to_float(first_filled(*there)) if there else F.lit(None).cast("double")

    def one(name: str, build: Callable[[DataFrame], DataFrame], empty: DataFrame) -> DataFrame:
        return build(sources[name] if name in sources else empty)

    any_table = next(iter(sources.values()))
    empty = any_table.limit(0)
    jaw = one("mp", lambda t: quantiles(t.select(cells("mp", "jawOpen", "blend::jawOpen").alias("v")), "v", {"jaw_lo": 0.30, "jaw_hi": 0.60}, {"jaw_lo": 0.20, "jaw_hi": 0.35}), empty)
    identity = one("af", lambda t: quantiles(t.select(cells("af", *IDENTITY_NAMES).alias("v")), "v", {"id_threshold": 0.20}, {"id_threshold": 0.50}), empty)
    magnitude = one("mf", lambda t: moments(t.select(cells("mf", *QUALITY_NAMES).alias("v")), "v").select(F.col("mean").alias("mag_mean"), F.col("std").alias("mag_std")), empty)
    a = one("of3", lambda t: t.select(F.lit(0).alias("of"), maybe_degrees(cells("of3", "pose_yaw", "yaw")).alias("v")), empty.select(F.lit(0).alias("of"), F.lit(None).cast("double").alias("v")))
    b = one("mp", lambda t: t.select(F.lit(1).alias("of"), maybe_degrees(cells("mp", "yaw")).alias("v")), empty.select(F.lit(1).alias("of"), F.lit(None).cast("double").alias("v")))
    of = lambda i: F.when(F.col("of") == i, F.col("v"))
    prefer = a.union(b).agg(yaw_preference(of(0), of(1)).alias("prefer_of3"))
    # Tables of one row each.
    return reduce(lambda x, y: x.crossJoin(F.broadcast(y)), (jaw, identity, magnitude, prefer))


def fused_pose(rows: DataFrame) -> dict[str, Column]:
    """yaw, pitch, roll, gaze_x and gaze_y in degrees by the precedence of the sources; needs ``prefer_of3`` in ``rows``."""
    cell = lambda s, *names: to_float(source_cell(rows, s, *names))
    of2 = {"yaw": F.coalesce(cell("of2", "yaw_deg"), maybe_degrees(cell("of2", "pose_Ry"))), "pitch": F.coalesce(cell("of2", "pitch_deg"), maybe_degrees(cell("of2", "pose_Rx"))), "roll": F.coalesce(cell("of2", "roll_deg"), maybe_degrees(cell("of2", "pose_Rz")))}
    of3 = {a: maybe_degrees(cell("of3", f"pose_{a}", a)) for a in of2}
    mp = {a: maybe_degrees(cell("mp", a)) for a in of2}
    osf = {a: cell("osf", a) for a in of2}
    return {
        "yaw": F.coalesce(of2["yaw"], F.when(F.col("prefer_of3"), of3["yaw"]), mp["yaw"], osf["yaw"], of3["yaw"]),
        "pitch": F.coalesce(of2["pitch"], mp["pitch"], of3["pitch"], osf["pitch"]),
        "roll": F.coalesce(of2["roll"], mp["roll"], of3["roll"], osf["roll"]),
        "gaze_x": maybe_degrees(cell("of2", "gaze_angle_x")),
        "gaze_y": maybe_degrees(cell("of2", "gaze_angle_y")),
    }


def tag(fused: DataFrame, with_identity: bool = True, with_quality: bool = True) -> DataFrame:
    """Bins and scores of fused items.

    ``fused`` has the sources' columns (see ``fuse``), the calibration's, ``file`` (the order), ``focus``, and optionally
    temp_bin and exposure_bin. Returns file, bins (map), scores and pose_deg (structs).
    """
    rows = running_score_at_scale(fused, "focus", "file", "__q")
    pose = fused_pose(rows)
    rows = rows.withColumns({f"__{k}": v for k, v in pose.items()})
    c = F.col
    of2 = lambda n: source_cell(rows, "of2", n)
    has = lambda s: c(f"{s}_present") if f"{s}_present" in rows.columns else F.lit(False)
    identity = to_float(source_cell(rows, "af", *IDENTITY_NAMES))
    smile = F.when(has("of2"), F.coalesce(to_float(of2("AU12_r")), F.lit(0.0))).otherwise(0.0)
    error = F.coalesce(to_float(source_cell(rows, "osf", "pnp_error")), F.lit(0.0))
    own = lambda name, other: c(name) if name in rows.columns else F.lit(other)
    labels = {
        "GAZE": bins.gaze_bin(c("__gaze_x"), c("__gaze_y")),
        "EYES": F.when(has("of2"), bins.eyes_bin(of2("AU45_r"), of2("AU05_r"), of2("AU07_r"))).otherwise("OPEN"),
        "MOUTH": F.when(has("of2"), bins.mouth_bin(of2("AU25_r"), of2("AU26_r"))).otherwise("CLOSE"),
        "SMILE": F.when(has("of2"), bins.smile_bin(of2("AU12_r"), of2("AU25_r"))).otherwise("NONE"),
        "EMOTION": bins.emotion_bin(source_cell(rows, "of3", "emotion")),
        "YAW": bins.yaw_bin(c("__yaw")),
        "PITCH": bins.pitch_bin(c("__pitch")),
        "TEMP": own("temp_bin", "NEUTRAL"),
        "EXPOSURE": own("exposure_bin", "NORMAL"),
    }
    if with_identity:
        labels["IDENTITY"] = bins.identity_bin(identity, c("id_threshold"))
    if with_quality:
        labels["QUALITY"] = bins.quality_bin(c("__q"))
    centering = bins.pose_centering(c("__yaw"), c("__pitch"))
    score_id = identity if with_identity else F.lit(None).cast("double")
    scores = F.struct(score_id.alias("id_score"), c("__q").alias("q_score"), centering.alias("pose_centering"), smile.alias("expr_strength"), error.alias("pnp_error"), bins.bin_score(score_id, c("__q"), centering, smile, error).alias("bin_score"))
    pairs = [x for k, v in labels.items() for x in (F.lit(k), v)]
    return rows.select("file", F.create_map(*pairs).alias("bins"), scores.alias("scores"), F.struct(*(c(f"__{a}").alias(a) for a in ("yaw", "pitch", "roll"))).alias("pose_deg"))
