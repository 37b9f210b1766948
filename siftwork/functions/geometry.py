"""Boxes, anchors and crops of detections.

A detection is a struct of box (array x1, y1, x2, y2), kps (array of points: left eye, right eye, nose, ...), det_score and embedding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bins import clip
from .vectors import dot, normalised


def width(box: Column) -> Column:
    return F.greatest(F.lit(1.0), F.get(box, 2) - F.get(box, 0))


def height(box: Column) -> Column:
    return F.greatest(F.lit(1.0), F.get(box, 3) - F.get(box, 1))


def best_score(face: Column, frame_w: Column, frame_h: Column) -> Column:
    """0.60 area + 0.25 nearness to the centre + 0.15 detection score."""
    box = face["box"]
    dx = F.abs((F.get(box, 0) + F.get(box, 2)) * 0.5 - frame_w / 2) / (frame_w / 2)
    dy = F.abs((F.get(box, 1) + F.get(box, 3)) * 0.5 - frame_h / 2) / (frame_h / 2)
    centre = 1.0 - F.least(F.lit(1.0), (dx + dy) * 0.5)
    return 0.60 * (width(box) * height(box)) / (frame_w * frame_h) + 0.25 * centre + 0.15 * F.coalesce(face["det_score"], F.lit(0.0))


def first_best(faces: Column, score) -> Column:
    """The face with the highest ``score(face)``; the first of equal ones; null without faces."""
    ranked = F.transform(faces, lambda f, i: F.struct((-score(f)).alias("s"), i.alias("i"), f.alias("f")))
    return F.get(F.array_sort(ranked, lambda a, b: F.when(a["s"] < b["s"], -1).when(a["s"] > b["s"], 1).otherwise(a["i"] - b["i"])), 0)["f"]


def best_face(faces: Column, frame_w: Column, frame_h: Column) -> Column:
    return first_best(faces, lambda f: best_score(f, frame_w, frame_h))


def best_similarity(embedding: Column, references: Column) -> Column:
    """The largest dot product of the normalised embedding with reference vectors (array of arrays); null without either."""
    unit = normalised(embedding)
    return F.array_max(F.transform(references, lambda r: dot(r, unit)))


def anchor(face: Column, mode: str, offset_y: float, frame_w: Column, frame_h: Column) -> Column:
    """Struct of cx, cy and side: the box's centre, or between the eyes, or the nose; moved down by offset_y sides, inside the frame."""
    box, kps = face["box"], face["kps"]
    side = F.greatest(width(box), height(box))
    cx, cy = F.get(box, 0) + 0.5 * width(box), F.get(box, 1) + 0.5 * height(box)
    point = lambda i, j: F.get(F.get(kps, i), j)
    if mode in ("eyes", "auto", "nose"):
        eyes = lambda j: F.when(F.size(kps) >= 2, 0.5 * (point(0, j) + point(1, j)))
        nose = lambda j: F.when(F.size(kps) >= 3, point(2, j)) if mode == "nose" else F.lit(None)
        cx, cy = F.coalesce(nose(0), eyes(0), cx), F.coalesce(nose(1), eyes(1), cy)
    inside = lambda v, n: F.greatest(F.lit(0.0), F.least(v, n - 1.0))
    return F.struct(inside(cx, frame_w).alias("cx"), inside(cy + F.lit(offset_y) * side, frame_h).alias("cy"), side.alias("side"))


def yaw_from_points(kps: Column) -> Column:
    """Degrees to the right from eyes and nose; 0 without them."""
    x, y = (lambda i: F.get(F.get(kps, i), 0)), (lambda i: F.get(F.get(kps, i), 1))
    between = F.hypot(x(1) - x(0), y(1) - y(0)) + 1e-6
    yaw = F.degrees(F.atan(1.8 * (x(2) - (x(0) + x(1)) * 0.5) / between))
    return F.when(F.size(kps) >= 3, clip(yaw, -90.0, 90.0)).otherwise(0.0)


def crop(cx: Column, cy: Column, side: Column, frame_w: Column, frame_h: Column, policy: str = "pad", max_pad: float = 0.20) -> Column:
    """Struct of x1, y1, x2, y2 (inside the frame) and reason (null, skip_edge, pad_exceed or oob) of a square crop.

    Corners are rounded half to even. Squares over the edge are shifted, skipped, or padded up to a share of the side.
    """
    half = side / 2
    x1, y1, x2, y2 = (F.bround(v).cast("long") for v in (cx - half, cy - half, cx + half, cy + half))
    zero = F.lit(0).cast("long")
    left, top, right, low = F.greatest(zero, -x1), F.greatest(zero, -y1), F.greatest(zero, x2 - frame_w), F.greatest(zero, y2 - frame_h)
    within = (left == 0) & (top == 0) & (right == 0) & (low == 0)
    if policy == "shift":
        x1, x2, y1, y2 = x1 + left - right, x2 + left - right, y1 + top - low, y2 + top - low
    bx1, by1, bx2, by2 = F.greatest(zero, x1), F.greatest(zero, y1), F.least(frame_w, x2), F.least(frame_h, y2)
    empty = F.when((bx2 <= bx1) | (by2 <= by1), F.lit("oob"))
    if policy == "shift":
        reason = empty
    elif policy == "skip":
        reason = F.when(within, empty).otherwise(F.lit("skip_edge"))
    else:
        missing = F.greatest((left + right) / F.greatest(F.lit(1.0), side), (top + low) / F.greatest(F.lit(1.0), side))
        reason = F.when(~within & (missing > max_pad), F.lit("pad_exceed")).otherwise(empty)
    return F.struct(bx1.alias("x1"), by1.alias("y1"), bx2.alias("x2"), by2.alias("y2"), reason.alias("reason"))


def others_inside(faces: Column, main: Column, cx: Column, cy: Column, side: Column, min_share: float = 0.25) -> Column:
    """Whether another face's centre lies in the square and its side is at least ``min_share`` of the main face's."""
    longest = lambda b: F.greatest(F.get(b, 2) - F.get(b, 0), F.get(b, 3) - F.get(b, 1))
    main_side = F.greatest(F.lit(1.0), longest(main["box"]))

    def other(f: Column) -> Column:
        x, y = (F.get(f["box"], 0) + F.get(f["box"], 2)) * 0.5, (F.get(f["box"], 1) + F.get(f["box"], 3)) * 0.5
        return (f != main) & x.between(cx - side / 2, cx + side / 2) & y.between(cy - side / 2, cy + side / 2) & (longest(f["box"]) >= min_share * main_side)

    return F.exists(faces, other)
