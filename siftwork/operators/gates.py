"""Ordered quality gates: the first one that fails names the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from .quantiles import exact_quantiles
from .vectors import SENT

# Defaults of the gates.
DEFAULTS = {
    "size": 512, "sim": 0.55, "bbox_pad": 0.34, "edge_policy": "skip", "max_pad": 0.18, "min_crop_px": 512, "max_upscale": 1.5,
    "min_face_frac": 0.30, "solo_mode": "reject", "solo_min_other": 0.25, "solo_shrink": 0.18, "min_bbox_frac": 0.0, "min_brightness": 0.0,
    "min_focus": 0.0, "dark_relax": 1.0, "anchor": "auto", "offset_y": 0.0, "max_per_frame": 1,
}


def first_failing(gates: dict[str, Column]) -> Column:
    """The name of the first gate whose condition holds, or null: one CASE, so later gates are not evaluated."""
    out = None
    for reason, fails in gates.items():
        failing = F.coalesce(fails, F.lit(False))
        out = F.when(failing, reason) if out is None else out.when(failing, reason)
    return out


def reject_counts(rows: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return rows.groupBy(reason).agg(F.count("*").alias("n"))


def shares(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition, and which share of all."""
    counts = [F.count_if(c).alias(f"{name}_n") for name, c in conditions.items()]
    parts = [(F.count_if(c) / F.greatest(F.count("*"), F.lit(1))).alias(f"{name}_share") for name, c in conditions.items()]
    return rows.agg(F.count("*").alias("n"), *counts, *parts)


#: The percentiles of ``spread``.
SPREAD = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def spreads(rows: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """by..., column, n, p10, p50, p90: exact percentiles of each column and group that has values."""
    return exact_quantiles(rows, columns, SPREAD, by)


def spread(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row of the 10th, 50th and 90th percentiles of each column, null without values."""
    found = spreads(rows, columns)
    return found.agg(*(F.max(F.when(F.col("column") == c, F.array(*(F.col(p) for p in SPREAD)))).alias(c) for c in columns))


def gate_frames(frames: DataFrame, references: DataFrame | None = None, **options) -> DataFrame:
    """Chooses a face in each frame and gates it.

    ``frames``: frame_idx, width, height (double), faces (array of box, kps, det_score, embedding), and optionally
    brightness and focus of the crop. ``references``: embedding, vectors of SENT bytes at most. Adds face, sim, cx, cy, side, crop,
    face_frac, up and reject_reason (null: kept).
    """
    o = DEFAULTS | options
    w, h, faces = F.col("width"), F.col("height"), F.col("faces")
    if references is not None:
        # Reference images of one identity: a few rows, which is checked.
        if (size := references.agg(F.sum(F.size("embedding") * 8 + 16)).first()[0] or 0) > SENT:
            raise ValueError(f"references take {size} bytes, {SENT} at most go with each frame; score faces against more of them by best_reference first")
        vectors = references.agg(F.collect_list("embedding").alias("__refs"))
        rows = frames.crossJoin(F.broadcast(vectors))
        on = (F.size("__refs") > 0) & F.lit(o["sim"] > 0)
        known = F.filter(faces, lambda f: f["embedding"].isNotNull())
        similar = geometry.first_best(known, lambda f: geometry.best_similarity(f["embedding"], F.col("__refs")))
        rows = rows.withColumn("face", F.when(on, similar).otherwise(geometry.best_face(faces, w, h)))
        rows = rows.withColumn("sim", F.when(on, geometry.best_similarity(F.col("face.embedding"), F.col("__refs"))).otherwise(-1.0))
        below = on & (F.col("face").isNull() | (F.col("sim") < o["sim"]))
        rows = rows.withColumn("__below", below).drop("__refs")
    else:
        rows = frames.withColumns({"face": geometry.best_face(faces, w, h), "sim": F.lit(-1.0), "__below": F.lit(False)})
    face = F.col("face")
    rows = rows.withColumn("__a", geometry.anchor(face, o["anchor"], o["offset_y"], w, h)).select("*", "__a.*").drop("__a")
    cx, cy, side = F.col("cx"), F.col("cy"), F.col("side")
    wide, narrow = side * (1 + 2 * o["bbox_pad"]), side * (1 + 2 * o["solo_shrink"])
    crowded = lambda s: geometry.others_inside(faces, face, cx, cy, s, o["solo_min_other"])
    used = F.when(crowded(wide), narrow).otherwise(wide) if o["solo_mode"] == "shrink" else wide
    crowd = {"off": F.lit(False), "reject": crowded(wide), "shrink": crowded(wide) & crowded(narrow)}[o["solo_mode"]]
    rows = rows.withColumns({"__crowd": crowd, "__used": used})
    rows = rows.withColumn("crop", geometry.crop(cx, cy, F.col("__used"), w.cast("long"), h.cast("long"), o["edge_policy"], o["max_pad"]))
    c = F.col("crop")
    longest = F.greatest(c["x2"] - c["x1"], c["y2"] - c["y1"])
    rows = rows.withColumns({"face_frac": side / F.greatest(F.lit(1e-6), F.col("__used")), "orig_side": longest, "up": F.try_divide(F.lit(float(o["size"])), longest)})
    share = geometry.width(face["box"]) * geometry.height(face["box"]) / (w * h)
    dark = o["min_brightness"] if o["min_brightness"] > 1 else o["min_brightness"] * 255
    brightness = F.col("brightness") if "brightness" in frames.columns else F.lit(None).cast("double")
    focus = F.col("focus") if "focus" in frames.columns else F.lit(None).cast("double")
    blur = focus < F.when(brightness < 60, o["min_focus"] * o["dark_relax"]).otherwise(o["min_focus"])
    reason = first_failing({
        "no_faces": F.coalesce(F.size(faces), F.lit(0)) == 0,
        "below_sim": F.col("__below"),
        "bbox_frac_reject": F.lit(o["min_bbox_frac"] > 0) & (share < o["min_bbox_frac"]),
        "crowd": F.col("__crowd"),
        "edge_skip": c["reason"] == "skip_edge",
        "pad_exceed_skip": c["reason"] == "pad_exceed",
        "extract_fail": c["reason"] == "oob",
        "face_small_frac": F.lit(o["min_face_frac"] > 0) & (F.col("face_frac") < o["min_face_frac"]),
        "too_dark": F.lit(dark > 0) & (brightness < dark),
        "too_blur": F.lit(o["min_focus"] > 0) & blur,
        "native_too_small": F.col("orig_side") < o["min_crop_px"],
        "upscale_too_high": F.col("up") > o["max_upscale"],
    })
    return rows.withColumn("reject_reason", reason).drop("__below", "__crowd", "__used")


def confident(faces: Column, threshold: float) -> Column:
    """The detections with at least a score."""
    return F.filter(faces, lambda f: f["det_score"] >= threshold)


def best_per_frame(faces: Column, frame_w: Column, frame_h: Column, k: int = 1) -> Column:
    """The k faces with the highest scores, best first, equal ones in their order."""
    ranked = F.transform(faces, lambda f, i: F.struct((-geometry.best_score(f, frame_w, frame_h)).alias("s"), i.alias("i"), f.alias("f")))
    ordered = F.array_sort(ranked, lambda a, b: F.when(a["s"] < b["s"], -1).when(a["s"] > b["s"], 1).otherwise(a["i"] - b["i"]))
    return F.transform(F.slice(ordered, 1, k), lambda x: x["f"])
