"""Boundary rows of the expressions, by values worked out by hand."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from siftwork.functions import bins, geometry, parsing, vectors
from siftwork.sources import readers


def values(spark, expression, rows, schema):
    """``expression`` of each row, in order."""
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in table.orderBy("i").select(expression.alias("v")).collect()]


def packet(timestamp, face_id, size, blink, success, pnp_error, quat, euler, move):
    """A tracker's packet with these fields."""
    return struct.pack("<diffffBf4f3f3f", timestamp, face_id, *size, *blink, success, pnp_error, *quat, *euler, *move)


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        (parsing.to_float, {"": None, " 1.5 ": 1.5, "1d": None, "1_000": None, "x": None, "-2e3": -2000.0, None: None, ".5": 0.5, "inf": INF}),
        (parsing.truthy, {"Yes": True, " t ": True, "0": False, None: False, "true": True}),
        (parsing.flag_set, {"1": True, " true ": True, "yes": False, "TRUE": True, "tRue": False, None: False}),
        (parsing.flag_unset, {"0": True, "": True, None: True, " 0": False, "1": False}),
        (parsing.clock_seconds, {"90": 90.0, "1:30": 90.0, "0:01:30.5": 90.5, "a": None, "1:2:3:4": None}),
        (parsing.stem, {"a/b.c.png": "b.c", ".hidden": ".hidden", "x": "x"}),
        (parsing.suffix, {"a/B.PNG": ".png", ".hidden": "", "x": ""}),
        (parsing.safe_name, {"3/4 LEFT": "3_4 LEFT", "a  b!?": "a b_", "x\\y": "x_y"}),
        (parsing.first_number, {"f0012x3": 12, "none": None}),
        (parsing.rational, {"30000/1001": 30000 / 1001, "0/1": None, "25/0": None, "x": None}),
    ],
)
def test_cells(spark, expression, expected):
    got = values(spark, expression(F.col("x")), [(k,) for k in expected], "x string")
    assert got == list(expected.values())


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        (bins.yaw_bin, [(None, "FRONT"), (7.99, "FRONT"), (8.0, "RIGHT"), (-8.0, "LEFT"), (25.0, "3/4 RIGHT"), (-45.0, "PROF LEFT"), (44.9, "3/4 RIGHT")]),
        (bins.pitch_bin, [(None, "LEVEL"), (10.0, "CHIN UP"), (-10.0, "CHIN DOWN"), (9.9, "LEVEL"), (NAN, "LEVEL"), (INF, "CHIN UP")]),
        (bins.quality_bin, [(0.75, "HIGH"), (-0.75, "LOW"), (0.0, "MID"), (NAN, "MID")]),
        (bins.temperature_bin, [(4199.9, "WARM"), (4200.0, "NEUTRAL"), (6000.0, "NEUTRAL"), (6000.1, "COOL")]),
        (parsing.maybe_degrees, [(3.19, 3.19 * 180 / math.pi), (3.20, 3.20), (None, None)]),
    ],
)
def test_numbers(spark, expression, expected):
    got = values(spark, expression(F.col("x")), [(k,) for k, _ in expected], "x double")
    assert got == pytest.approx([v for _, v in expected]) if all(isinstance(v, float) or v is None for _, v in expected) else got == [v for _, v in expected]


def test_gaze(spark):
    rows = [(12.0, 12.0), (-13.0, 13.0), (13.0, -14.0), (None, 13.0), (None, -13.0), (-13.0, None), (None, None), (5.0, None)]
    got = values(spark, bins.gaze_bin(F.col("x"), F.col("y")), rows, "x double, y double")
    assert got == ["FRONT", "LEFT", "DOWN", "UP", "DOWN", "LEFT", "FRONT", "FRONT"]


def test_expression_bins(spark):
    rows = [("0", None, "0"), ("1.2", "1", "0"), ("0", "1", "1.2"), ("0", "1", "0"), ("0.2", "0.3", "0.7")]
    assert values(spark, bins.eyes_bin(F.col("a"), F.col("b"), F.col("c")), rows, "a string, b string, c string") == ["HALF", "CLOSED", "HALF", "OPEN", "OPEN"]
    assert values(spark, bins.smile_bin(F.col("a"), F.col("b")), [("1.2", "0.8"), ("1.2", "0.7"), ("0.6", "2")], "a string, b string") == ["TEETH", "CLOSED", "NONE"]


def test_light_similarity_needs_both(spark):
    rows = [("", ""), ("WARM", "WARM"), ("WARM", "WHITE"), ("WARM", None), ("A", "B")]
    assert values(spark, bins.light_similarity(F.col("a"), F.col("b")), rows, "a string, b string") == [0.0, 1.0, 0.5, 0.0, 0.0]
    assert values(spark, bins.pose_similarity(F.col("a"), F.col("b"), F.lit(""), F.lit("")), [("", None)], "a string, b string") == [1.0]


def test_quota_rounds_half_to_even(spark):
    assert values(spark, bins.quota(F.col("r"), F.col("n"), F.lit(2)), [(1, 1), (3, 1), (5, 1)], "r long, n long") == [0, 2, 2]


def test_bars(spark):
    assert values(spark, parsing.bar(F.col("x")), [(41.2,), (-3.0,), (150.0,), (3.125,)], "x double") == ["█" * 7 + " " * 9, " " * 16, "█" * 16, " " * 16]
    got = values(spark, parsing.fine_bar(F.col("x"), 4), [(0.0,), (0.5,), (0.6,), (1.0,)], "x double")
    assert got == ["    ", "██  ", "██▎ ".replace("▎", "▎"), "████"] or got[2][2] in parsing.PARTIAL_CELLS
    assert values(spark, parsing.clock_text(F.col("x")), [(59,), (3661,), (-4,)], "x long") == ["00:59", "1:01:01", "00:00"]


def test_vectors(spark):
    v = [(3.0, 4.0)]
    table = spark.createDataFrame([([3.0, 4.0], [1.0, 5.0, 5.0])], "v array<double>, p array<double>")
    got = table.select(vectors.norm(F.col("v")), vectors.arg_max(F.col("p")), vectors.dot(F.col("v"), F.col("v"))).first()
    assert tuple(got) == (5.0, 1, 25.0) and v
    assert sum(table.select(vectors.softmax(F.col("p")).alias("s")).first().s) == pytest.approx(1)
    top = table.select(vectors.top_labels(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.lit(0.2), F.lit(0.5), F.lit(0.3)), 2).alias("t")).first().t
    assert top == "b:0.5000,c:0.3000"


def test_geometry(spark):
    crop = geometry.crop(F.col("x"), F.col("y"), F.lit(10.0), F.lit(20).cast("long"), F.lit(20).cast("long"), "pad", 0.2)
    rows = [(10.0, 10.0), (4.0, 10.0), (2.0, 10.0)]
    got = values(spark, crop, rows, "x double, y double")
    assert [(g.x1, g.x2, g.reason) for g in got] == [(5, 15, None), (0, 9, None), (0, 7, "pad_exceed")]
    assert values(spark, geometry.crop(F.col("x"), F.col("y"), F.lit(10.0), F.lit(20).cast("long"), F.lit(20).cast("long"), "shift"), rows[2:], "x double, y double")[0].x2 == 10
    yaw = geometry.yaw_from_points(F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(2.0), F.lit(0.0)), F.array(F.lit(2.0), F.lit(1.0))))
    assert values(spark, yaw, [(1,)], "x int")[0] == pytest.approx(math.degrees(math.atan(1.8 * 1 / 2)), abs=1e-4)


def test_packets(spark):
    good = packet(1.5, 2, (640.0, 480.0), (0.5, 0.25), 1, 0.125, (0, 0, 0, 1), (10.0, -5.0, 2.0), (1.0, 2.0, 3.0))
    assert len(good) == struct.calcsize("<diffffBf4f3f3f") == readers.PACKET_BYTES
    rows = values(spark, readers.decode_packet(F.col("p")), [(good,), (good[:72],), (good + b"more",)], "p binary")
    assert rows[0].yaw == 10.0 and rows[0].success == 1 and rows[0].quat_raw == [0, 0, 0, 1] and rows[1].timestamp is None and rows[2].tz == 3.0


def test_log_lines(spark):
    lines = ["Took 12.5ms (detect: 1.0ms, crop: 2.0ms, track: 3.0ms, 3D points: 4.0ms)", "Confidence[0]: 0.91 / 3D fitting error: 1.5 / Eyes: O, C", "other"]
    fields = readers.log_fields(F.col("x"))
    got = values(spark, F.struct(*(c.alias(n) for n, c in fields.items())), [(x,) for x in lines], "x string")
    assert (got[0].kind, got[0].points3d_ms, got[1].confidence, got[1].eye_r, got[2].kind) == ("took", 4.0, 0.91, "C", None)


def test_options_and_ranges(spark):
    assert [parsing.on_off(v, True) for v in ("off", "ON", "", None, "x", False)] == [False, True, True, True, True, False]
    got = values(spark, parsing.range_spec(F.col("x")), [("0:10 - 1:00",), ("10",)], "x string")
    assert (got[0].start, got[0].end, got[1]) == (10.0, 60.0, None)
    labels = values(spark, bins.unit_labels(F.col("a"), F.col("b"), F.col("c"), 0.5, 0.4), [(0.5, 0.1, 0.6), (0.1, 0.1, 0.1)], "a double, b double, c double")
    assert [tuple(x) for x in labels] == [("open", "smile", "likely"), ("closed", "neutral", "")]
    pose = values(spark, vectors.matrix_pose(F.col("m")), [([[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0] * 4],)], "m array<array<double>>")
    assert tuple(pose[0]) == (0.0, 0.0, 0.0)
    cct = values(spark, bins.colour_temperature(F.lit(1.0), F.lit(1.0), F.lit(1.0)), [(1,)], "x int")[0]
    assert 6300 < cct < 6700
