"""Whole workflows from the operators: tagging, matching and building, crops, compiling.

Each is a function from tables to tables; nothing runs until a result is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import flag_unset, maybe_degrees, to_float
from ..operators import dataset, fusion, gates, profile, selection


def tagging(items: DataFrame, sources: dict[str, DataFrame], order: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tagged items, their histogram, and the calibration (one row).

    ``items``: file and focus (and temp_bin, exposure_bin if pixels were measured). ``sources``: any of of2, of3, mp, osf,
    af, mf, tables of string cells with a key column; of2, of3 and mp may also be given as pairs (base, overlay). ``order``: a
    column that orders a source's rows, so that the last of equal keys wins; without it keys must be unique.
    """
    def keyed(table: DataFrame) -> DataFrame:
        if order and order in table.columns:
            return fusion.by_base_name(table, order)
        key = fusion.key_column(table.columns)
        return table if key == "file" else table.withColumnRenamed(key, "file")

    tables = {name: fusion.overlay(*map(keyed, t), "file") if isinstance(t, tuple) else keyed(t) for name, t in sources.items()}
    limits = fusion.calibration(tables) if tables else items.sparkSession.createDataFrame([(0.2, 0.35, 0.5, 0.0, 1.0, True)], "jaw_lo double, jaw_hi double, id_threshold double, mag_mean double, mag_std double, prefer_of3 boolean")
    fused = fusion.fuse(items, tables, "file").crossJoin(F.broadcast(limits))
    tagged = fusion.tag(fused, with_identity="af" in tables, with_quality="mf" in tables)
    return tagged, profile.map_histogram(tagged), limits


def typed_pose(table: DataFrame) -> DataFrame:
    """A pose extractor's cells as numbers: frame and success as integers, angles in degrees, and its action units."""
    integer = lambda c: F.floor(to_float(F.col(c))).cast("long").alias(c)
    out = [F.col("file")]
    out += [integer(c) for c in ("frame", "success") if c in table.columns]
    out += [to_float(F.col(c)).alias(c) for c in ("timestamp", "confidence") if c in table.columns]
    for angle, axis in (("yaw", "pose_Ry"), ("pitch", "pose_Rx"), ("roll", "pose_Rz")):
        if axis in table.columns:
            out.append((to_float(F.col(axis)) * 180.0 / F.pi()).alias(f"{angle}_deg"))
    out += [to_float(F.col(c)).alias(c) for c in table.columns if c.startswith(("AU", "gaze_"))]
    return table.select(*out)


def pose_spread(table: DataFrame, column: str) -> DataFrame:
    """One row: smallest and largest angle, their number, and whether both signs occur."""
    angle = maybe_degrees(to_float(F.col(column)))
    return table.select(angle.alias("a")).agg(F.min("a").alias("low"), F.max("a").alias("high"), F.count("a").alias("n"), fusion.both_signs(F.col("a")).alias("both_signs"))


def matching(source: DataFrame, target: DataFrame, listing: DataFrame | None, logs: DataFrame | None, names: DataFrame | None, minimum: int, budget: int = 0, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The selected rows (path, is_upscaled) and the coverage report.

    ``source`` and ``target``: src_ord, path, the six keys, cleanup_flag, id_score, quality. Source rows that are flagged,
    or whose file is not in ``listing``, are left out. Without ``cap`` the first rule is used, with it the second one.
    """
    rows = source.where(flag_unset(F.col("cleanup_flag")))
    if listing is not None:
        rows = dataset.existing(rows, listing)
    upscaled = selection.upscaled_names(logs, names) if logs is not None and names is not None else source.sparkSession.createDataFrame([], "dst_name string")
    rows = selection.mark_upscaled(rows, upscaled)
    wanted = target.where(flag_unset(F.col("cleanup_flag"))) if "cleanup_flag" in target.columns else target
    chosen = selection.select_v1(rows, wanted, minimum, budget) if cap is None else selection.select_v2(rows, wanted, minimum, cap, budget)
    demand = selection.demand_of(wanted).select("key.*", "n")
    report = profile.coverage_report(demand, chosen, selection.KEYS, minimum)
    return chosen.select("path", F.col("upscaled").cast("int").alias("is_upscaled")), report


def building(matched: DataFrame, source_tags: DataFrame, target_files: DataFrame, target_tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index lists of both sides: matched paths and target files that their tags do not flag."""
    return dataset.source_index(matched, source_tags), dataset.target_index(target_files, target_tags)


def cropping(frames: DataFrame, references: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept frames with their crops, the numbers of rejects by reason, and percentiles of what was kept."""
    gated = gates.gate_frames(frames, references, **options)
    kept = gated.where("reject_reason is null")
    return kept, gates.reject_counts(gated.where("reject_reason is not null")), gates.spread(kept, ["sim", "orig_side", "up", "face_frac"])


def compiling(inputs: list[tuple[str, DataFrame]], have: DataFrame | None, logs: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """The map of new names over all inputs (each once, in order) and the union of their logs.

    ``inputs``: (root, listing with path). ``have``: names in the target (dst_name).
    """
    once = list(dict(inputs).items())
    files = reduce(DataFrame.union, (t.select(F.lit(i).alias("input_ord"), F.lit(root).alias("src_root"), F.col("path").alias("src_path")) for i, (root, t) in enumerate(once)))
    return dataset.compile_map(files, have), dataset.union_logs(logs) if logs else None
