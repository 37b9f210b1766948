"""From signals to categories and scores. NaN compares as false everywhere, as in the rules that are reproduced here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import scalar

# The domains of the sections, in their order.
DOMAINS = {
    "GAZE": ["FRONT", "LEFT", "RIGHT", "UP", "DOWN"],
    "EYES": ["OPEN", "HALF", "CLOSED", "W-LEFT", "W-RIGHT"],
    "MOUTH": ["OPEN", "SLIGHT", "CLOSE"],
    "SMILE": ["TEETH", "CLOSED", "NONE"],
    "EMOTION": ["NEUTRAL", "HAPPY", "SAD", "SURPRISE", "FEAR", "DISGUST", "ANGER", "CONTEMPT"],
    "YAW": ["FRONT", "LEFT", "RIGHT", "3/4 LEFT", "3/4 RIGHT", "PROF LEFT", "PROF RIGHT"],
    "PITCH": ["LEVEL", "CHIN UP", "CHIN DOWN"],
    "IDENTITY": ["MATCH", "MISMATCH"],
    "QUALITY": ["HIGH", "MID", "LOW"],
    "TEMP": ["WARM", "NEUTRAL", "COOL"],
    "EXPOSURE": ["UNDER", "NORMAL", "OVER"],
}
# Linear sRGB to XYZ.
RGB_TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))


def at_least(x: Column, limit: float) -> Column:
    """x >= limit, false for null and NaN."""
    return F.coalesce((x >= limit) & ~F.isnan(x), F.lit(False))


def at_most(x: Column, limit: float) -> Column:
    return F.coalesce(x <= limit, F.lit(False))


def side(x: Column, below: str, other: str) -> Column:
    return F.when(x < 0, below).otherwise(other)


def yaw_bin(yaw: Column) -> Column:
    a = F.abs(yaw)
    far = F.when(yaw < 0, "PROF LEFT").otherwise("PROF RIGHT")
    return F.when(yaw.isNull() | (a < 8), "FRONT").when(a < 25, side(yaw, "LEFT", "RIGHT")).when(a < 45, side(yaw, "3/4 LEFT", "3/4 RIGHT")).otherwise(far)


def pitch_bin(pitch: Column) -> Column:
    return F.when(at_least(pitch, 10), "CHIN UP").when(at_most(pitch, -10), "CHIN DOWN").otherwise("LEVEL")


def quality_bin(score: Column) -> Column:
    return F.when(at_least(score, 0.75), "HIGH").when(at_most(score, -0.75), "LOW").otherwise("MID")


def gaze_bin(across: Column, up: Column) -> Column:
    """Front within 12 degrees; else the larger component decides, across on a tie. A missing one is left out."""
    a, u = F.coalesce(F.abs(across), F.lit(0.0)), F.coalesce(F.abs(up), F.lit(0.0))
    lateral, vertical = side(across, "LEFT", "RIGHT"), F.when((up > 0) & ~F.isnan(up), "UP").otherwise("DOWN")
    return F.when((a <= 12) & (u <= 12), "FRONT").when(up.isNull(), lateral).when(across.isNull(), vertical).when(a >= u, lateral).otherwise(vertical)


def eyes_bin(au45: Column, au05: Column, au07: Column) -> Column:
    """Cells of the closing, opening and tightening signals; missing ones are 0, so a missing opening is HALF."""
    shut = scalar(au45) + 0.5 * scalar(au07)
    return F.when(at_least(shut, 1.2), "CLOSED").when(at_least(shut, 0.6) | (scalar(au05) < 0.3), "HALF").otherwise("OPEN")


def mouth_bin(au25: Column, au26: Column) -> Column:
    return F.when(at_least(scalar(au26), 1.0) | at_least(scalar(au25), 1.3), "OPEN").when(at_least(scalar(au25), 0.5), "SLIGHT").otherwise("CLOSE")


def smile_bin(au12: Column, au25: Column) -> Column:
    return F.when(at_least(scalar(au12), 1.2) & at_least(scalar(au25), 0.8), "TEETH").when(at_least(scalar(au12), 0.7), "CLOSED").otherwise("NONE")


def emotion_bin(label: Column) -> Column:
    upper = F.upper(F.trim(label))
    return F.when(upper.isin(*DOMAINS["EMOTION"]), upper).otherwise("NEUTRAL")


def identity_bin(score: Column, threshold: Column) -> Column:
    return F.when(F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False)), "MATCH").otherwise("MISMATCH")


def linear(srgb: Column) -> Column:
    """An sRGB component in 0..1 as linear light."""
    return F.when(srgb <= 0.04045, srgb / 12.92).otherwise(F.pow((srgb + 0.055) / 1.055, F.lit(2.4)))


# McCamy's cubic (1992) of the inverse slope n from the epicentre (0.3320, 0.1858), and its range.
CCT_EPICENTRE, CCT_CUBIC, CCT_RANGE = (0.3320, 0.1858), (-449.0, 3525.0, -6823.3, 5520.33), (1000.0, 25000.0)


def colour_temperature(r: Column, g: Column, b: Column) -> Column:
    """Kelvin of a mean linear colour by the cubic of its chromaticity."""
    x, y, z = (reduce(lambda s, t: s + t, (F.lit(m) * c for m, c in zip(row, (r, g, b), strict=True))) for row in RGB_TO_XYZ)
    whole = x + y + z + 1e-12
    n = (x / whole - CCT_EPICENTRE[0]) / (y / whole - CCT_EPICENTRE[1] + 1e-9)
    c3, c2, c1, c0 = CCT_CUBIC
    return clip(c3 * n * n * n + c2 * n * n + c1 * n + c0, *CCT_RANGE)


def temperature_bin(cct: Column) -> Column:
    return F.when(cct < 4200, "WARM").when(cct <= 6000, "NEUTRAL").otherwise("COOL")


def exposure_bin(low: Column, high: Column, log_mean: Column) -> Column:
    """low, high: percent of clipped dark and light values; log_mean: the log-average luminance."""
    return F.when((high > 2.0) | (log_mean > 0.65), "OVER").when((low > 10.0) & (log_mean < 0.08), "UNDER").otherwise("NORMAL")


def unit_labels(au12: Column, au25: Column, au26: Column, mouth: float, smile: float) -> Column:
    """Struct of mouth, smile and teeth by thresholds."""
    opened, smiling = F.greatest(au25, au26) >= mouth, au12 >= smile
    return F.struct(F.when(opened, "open").otherwise("closed").alias("mouth"), F.when(smiling, "smile").otherwise("neutral").alias("smile"), F.when(opened & smiling, "likely").otherwise("").alias("teeth"))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def pose_centering(yaw: Column, pitch: Column) -> Column:
    return clip(1.0 - (F.abs(F.coalesce(yaw, F.lit(0.0))) / 55.0 + F.abs(F.coalesce(pitch, F.lit(0.0))) / 25.0), 0.0, 1.0)


def bin_score(identity: Column, quality: Column, centering: Column, expression: Column, error: Column) -> Column:
    return 0.55 * F.coalesce(identity, F.lit(0.55)) + 0.30 * clip(quality, -1.0, 1.0) + 0.10 * centering + 0.05 * expression - 0.05 * F.least(F.lit(1.0), F.coalesce(error, F.lit(0.0)) / 0.02)


# Similarity of a row to a prototype; cells are compared as text, a missing cell is empty.


def same(a: Column, b: Column) -> Column:
    return (F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))).cast("int")


def pose_similarity(yaw_a: Column, pitch_a: Column, yaw_b: Column, pitch_b: Column) -> Column:
    n = same(yaw_a, yaw_b) + same(pitch_a, pitch_b)
    return F.when(n == 2, 1.0).when(n == 1, 0.5).otherwise(0.0)


def light_similarity(a: Column, b: Column) -> Column:
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    filled = (a != "") & (b != "")
    return F.when(filled & (a == b), 1.0).when(filled & (F.substring(a, 1, 1) == F.substring(b, 1, 1)), 0.5).otherwise(0.0)


def expression_similarity(eyes_a: Column, smile_a: Column, teeth_a: Column, eyes_b: Column, smile_b: Column, teeth_b: Column) -> Column:
    return (same(eyes_a, eyes_b) + same(smile_a, smile_b) + same(teeth_a, teeth_b)) / 3.0


def quota(remaining: Column, demand: Column, total: Column) -> Column:
    """A bin's share of what remains, rounded half to even."""
    return F.bround(remaining.cast("double") * (demand.cast("double") / total.cast("double"))).cast("long")
