"""Operators against plain Python on small tables."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftwork.operators import dataset, extractors, fusion, gates, profile, sampling, selection, timeline
from siftwork.plans import workflows
from siftwork.sources import readers, sinks
from siftwork.streaming import live

ROWS = "src_ord long, path string, bin_yaw string, bin_pitch string, bin_eyes string, bin_smile string, bin_teeth string, bin_light string, id_score string, quality string, upscaled boolean"


def items(rng, n):
    return [(i, f"p{i}", *(rng.choice("ab") if j < 2 else rng.choice(["x", ""]) for j in range(6)), str(rng.randint(0, 3)), rng.choice(["1", "", "0.5"]), rng.random() < 0.4) for i in range(n)]


def score(r, p):
    number = lambda x: float(x) if x else 0.0
    pose = {2: 1.0, 1: 0.5, 0: 0.0}[(r[2] == p[0]) + (r[3] == p[1])]
    light = 1.0 if r[7] and p[5] and r[7] == p[5] else 0.5 if r[7] and p[5] and r[7][0] == p[5][0] else 0.0
    expression = ((r[4] == p[2]) + (r[5] == p[3]) + (r[6] == p[4])) / 3
    return 0.5 * pose + 0.2 * light + 0.3 * expression + (0.05 * number(r[8]) + 0.05 * number(r[9]))


def one_by_one(source, target, minimum, cap, budget):
    """The selection rules, bin after bin."""
    demand = {}
    for r in target:
        demand[r[2:8]] = demand.get(r[2:8], 0) + 1
    of = lambda k: [r for r in source if r[2:8] == k]
    best = lambda rows, k, n: sorted(rows, key=lambda r: -score(r, k))[: max(0, n)]
    chosen, used = [], 0
    for k in demand:
        if cap is None:
            rows = of(k)
            if len(rows) < minimum:
                for r in source:
                    if r not in rows and (r[2] == k[0] or r[3] == k[1] or r[5] == k[3]):
                        rows.append(r)
                        if len(rows) >= 3 * minimum:
                            break
            chosen += [r for r in best(rows, k, minimum) if r not in chosen]
        else:
            native = best([r for r in of(k) if not r[10]], k, minimum)
            up = best([r for r in of(k) if r[10]], k, min(minimum - len(native), cap - used))
            used += len(up)
            chosen += native + up
    total = sum(demand.values())
    left = max(0, (budget or total) - len(chosen))
    before = list(chosen)
    for k, n in sorted(demand.items(), key=lambda x: -x[1]):
        if left <= 0:
            break
        quota = round(left * (n / total))
        free = [r for r in of(k) if r not in chosen]
        if cap is None:
            take = best(free, k, min(quota - sum(r[2:8] == k for r in before), left))
        elif quota <= 0:
            continue
        else:
            take = best([r for r in free if not r[10]], k, min(quota, left))
            up = best([r for r in free if r[10]], k, min(left - len(take), cap - used))
            used += len(up)
            take = take + up
        chosen += take
        left -= len(take)
    return sorted(r[0] for r in chosen)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cap", [None, 3])
def test_selection_equals_the_rule_one_bin_after_another(spark, seed, cap):
    rng = random.Random(seed)
    source, target = items(rng, 60), items(rng, 25)
    minimum, budget = rng.choice([0, 2, 4]), rng.choice([0, 15])
    s, t = spark.createDataFrame(source, ROWS), spark.createDataFrame(target, ROWS)
    got = selection.select_v1(s, t, minimum, budget) if cap is None else selection.select_v2(s, t, minimum, cap, budget)
    assert sorted(r.src_ord for r in got.collect()) == one_by_one(source, target, minimum, cap, budget)


def running(xs):
    out = []
    for i, x in enumerate(xs):
        before = np.array(xs[:i]) - (xs[0] if xs else 0)
        sd = before.std() if i > 1 and before.std() > 1e-6 else 1.0
        out.append((x - xs[0] - before.mean()) / sd if i else 0.0)
    return out


def test_running_score_counts_earlier_rows_only(spark):
    xs = [5.0, 5.0, 5.0, 7.0, 1.0, 4.0]
    table = spark.createDataFrame(list(enumerate(xs)), "i int, x double")
    assert [r.z for r in fusion.running_score(table, "x", "i").orderBy("i").collect()] == pytest.approx(running(xs))
    two = table.union(table.select(F.col("i") + 10, "x")).withColumn("p", F.col("i") >= 10)
    assert [r.z for r in fusion.running_score(two, "x", "i", partition=["p"]).orderBy("i").collect()] == pytest.approx(running(xs) * 2)
    rng = np.random.default_rng(1)
    values = [1e9 + float(x) for x in rng.normal(0, 1, 600)]
    many = spark.createDataFrame([(f"f{i:04d}", x) for i, x in enumerate(values)], "i string, x double")
    for size in (1000, 40, 7):  # one range, some, many; a large mean does not cancel the deviation
        assert [r.z for r in fusion.running_score_at_scale(many, "x", "i", size=size).orderBy("i").collect()] == pytest.approx(running(values), abs=1e-5)
    few = many.withColumn("k", F.lit("one value for all"))
    assert fusion.running_score_at_scale(few, "x", "k", size=50).count() == 600


def test_tagging_workflow(spark):
    of2 = spark.createDataFrame([(1, "a/1.png", "30", None, "0.0", "1", "0"), (2, "b/1.png", "", "0.5", "2", "1", "1.3")], "o int, path string, yaw_deg string, pose_Ry string, AU45_r string, AU05_r string, AU25_r string")
    af = spark.createDataFrame([("1.png", "0.9"), ("2.png", "0.1")], "file string, id_score string")
    names = spark.createDataFrame([("1.png", 10.0), ("2.png", 20.0)], "file string, focus double")
    tagged, histogram, limits = workflows.tagging(names, {"of2": of2, "af": af}, order="o")
    rows = {r.file: r for r in tagged.collect()}
    # Of the two rows of 1.png the last one wins; its angle was written in radians.
    assert rows["1.png"].bins["YAW"] == "3/4 RIGHT" and rows["1.png"].bins["EYES"] == "CLOSED" and rows["1.png"].bins["MOUTH"] == "OPEN"
    assert rows["2.png"].bins["YAW"] == "FRONT" and rows["2.png"].bins["IDENTITY"] == "MISMATCH" and rows["2.png"].scores.q_score == 10.0
    assert limits.first().id_threshold == pytest.approx(0.26)
    counts = {(r.section, r.label): r["count"] for r in histogram.collect()}
    assert counts["EYES", "W-LEFT"] == 0 and counts["YAW", "FRONT"] == 1


def test_overlay_lets_empty_cells_win(spark):
    a = spark.createDataFrame([("k1", "1", "2"), ("k2", "3", "4")], "k string, x string, y string")
    b = spark.createDataFrame([("k1", "", "z"), ("k3", "5", "w")], "k string, x string, v string")
    assert {tuple(r) for r in fusion.overlay(a, b, "k").collect()} == {("k1", "", "2", "z"), ("k2", "3", "4", None), ("k3", "5", None, "w")}


def test_calibration_defaults(spark):
    empty = spark.createDataFrame([], "file string, id_score string, jawOpen string")
    row = fusion.calibration({"af": empty, "mp": empty}).first()
    assert (row.jaw_lo, row.jaw_hi, row.id_threshold, row.mag_mean, row.mag_std) == (0.20, 0.35, 0.50, 0.0, 1.0)


def test_gates_in_order(spark):
    face = lambda x1, y1, x2, y2, e=None: ([x1, y1, x2, y2], [[x1, y1], [x2, y1], [(x1 + x2) / 2, y2]], 0.9, e)
    big, small = face(300.0, 300.0, 900.0, 900.0, [1.0, 0.0]), face(500.0, 400.0, 760.0, 660.0, [0.0, 1.0])
    frames = [(1, 1200.0, 1200.0, []), (2, 1200.0, 1200.0, [big]), (3, 1200.0, 1200.0, [big, small]), (4, 1200.0, 1200.0, [face(0.0, 0.0, 600.0, 600.0, [1.0, 0.0])]), (5, 1200.0, 1200.0, [face(590.0, 590.0, 700.0, 700.0, [1.0, 0.0])]), (6, 1200.0, 1200.0, [face(300.0, 300.0, 900.0, 900.0, [0.0, 1.0])])]
    table = spark.createDataFrame(frames, "frame_idx int, width double, height double, faces array<struct<box:array<double>,kps:array<array<double>>,det_score:double,embedding:array<double>>>")
    refs = spark.createDataFrame([([1.0, 0.0],)], "embedding array<double>")
    got = {r.frame_idx: r.reject_reason for r in gates.gate_frames(table, refs, anchor="box").collect()}
    assert got == {1: "no_faces", 2: None, 3: "crowd", 4: "edge_skip", 5: "native_too_small", 6: "below_sim"}
    kept, rejects, spread = workflows.cropping(table, refs, anchor="box")
    assert kept.count() == 1 and sum(r.n for r in rejects.collect()) == 5 and spread.first().sim == [pytest.approx(1.0)] * 3


def test_compile_and_library(spark):
    inputs = [("r1", spark.createDataFrame([("r1/b.PNG",), ("r1/a.jpg",)], "path string")), ("r2", spark.createDataFrame([("r2/c.png",)], "path string"))]
    have = spark.createDataFrame([("000007.png",), ("x.png",)], "dst_name string")
    names, logs = workflows.compiling(inputs, have, {"r1": spark.createDataFrame([("1", "2")], "a string, b string"), "r2": spark.createDataFrame([("3", "own")], "c string, src_root string")})
    assert sorted(tuple(r) for r in names.collect()) == [("r1", "r1/a.jpg", "000008.jpg"), ("r1", "r1/b.PNG", "000009.png"), ("r2", "r2/c.png", "000010.png")]
    assert {tuple(r) for r in logs.select("a", "b", "src_root", "c").collect()} == {("1", "2", "r1", None), (None, None, "own", "3")}
    files = spark.createDataFrame([(1, "a/s1.png", "h1"), (2, "a/s2.png", "h1"), (3, "a/s3.png", "h2")], "src_ord int, path string, hash string")
    library = spark.createDataFrame([("h2",)], "hash string")
    new = dataset.new_items(files, library)
    assert [r.src_ord for r in new.collect()] == [1] and dataset.new_items(files, library, dedupe_batch=False).count() == 2
    side = spark.createDataFrame([("s1",)], "stem string")
    row = dataset.library_rows(new, "/lib", {"of_csv": (side, "openface_img/.csv"), "magface": (side.where("false"), "magface/.npy")}).first()
    assert (row.file, row.of_csv, row.magface) == ("/lib/aligned/h1.png", "/lib/logs/openface_img/h1.csv", None)


def test_two_tier_target_index(spark):
    files = spark.createDataFrame([("d/a",), ("d/b",), ("d/c",)], "path string")
    tags = spark.createDataFrame([(1, "d/a", "1"), (2, "a", "0"), (3, "b", "1")], "src_ord int, path string, cleanup_flag string")
    assert [r.path for r in dataset.target_index(files, tags).collect()] == ["d/c"]


def test_timeline(spark):
    rows = spark.createDataFrame([("v", float(i), i) for i in range(10)], "track string, t double, x int")
    assert [r.t for r in timeline.remove_range(rows, 3, 5).orderBy("t").collect()] == [float(i) for i in range(8)]
    assert timeline.cut_tail(rows, 2.0, "track").count() == 7
    with pytest.raises(ValueError):
        timeline.remove_range(rows, 5, 5)
    with pytest.raises(Exception, match="not shorter"):
        timeline.cut_tail(rows, 20.0, "track").collect()
    got = timeline.resample(rows.where("t in (0, 3, 9)"), 0.5, "track", "x").orderBy("t").collect()
    assert [(r.t, r.x) for r in got] == [(0.0, 0), (2.0, 0), (4.0, 3), (6.0, 3), (8.0, 3)]


def test_render(spark):
    histogram = [("GAZE", "FRONT", 2111), ("GAZE", "LEFT", 7990), ("GAZE", "RIGHT", 0), ("GAZE", "UP", 28), ("GAZE", "DOWN", 28)]
    lines = profile.render(histogram, 10157, 24645, 0, fps=29, eta="08:19").split("\n")
    assert lines[2] == "TAG        |███████         |   41.2% 10157/24645 FAIL 0 29 FPS   ETA 08:19"
    assert lines[5] == "GAZE       |███████         |   41.2% 10157 FAIL 0"
    assert lines[7] == "FRONT       |█               |    8.6% 2111" and len(lines[0]) == 112
    assert " DUPE 3" in profile.render(histogram, 1, 2, 0, mode="MATCH", duplicates=3, row_duplicates={("GAZE", "LEFT"): 2})


def test_preview(spark):
    tagged = spark.createDataFrame([(f"f{i}", {"YAW": "LEFT" if i % 3 else "", "EYES": "OPEN"}, (0.5,)) for i in range(20)], "file string, bins map<string,string>, scores struct<bin_score:double>")
    there = spark.createDataFrame([(f"f{i}", f"d/f{i}") for i in range(15)], "file string, path string")
    got = sampling.preview(tagged, there, 4, 1, [" yaw ", "eyes"]).collect()
    assert len(got) == 8 and {r.category for r in got} == {"YAW", "EYES"} and all(r.label for r in got)
    assert {r.category for r in sampling.preview(tagged, there, 2, 1, ["yaw"]).collect()} == {"YAW"}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('file,note\n1.png,"a ""q"" b\nsecond"\n2.png,\n')
    rows = readers.read_csv(spark, str(tmp_path / "a.csv"), ["file", "note", "other"]).orderBy("file").collect()
    assert [tuple(r) for r in rows] == [("1.png", 'a "q" b\nsecond', None), ("2.png", None, None)]
    assert readers.read_csv(spark, str(tmp_path / "none.csv"), ["file"]).count() == 0
    (tmp_path / "m.jsonl").write_text('{"hash": "a"}\n\n{broken\n{"hash": "b"}\n')
    manifest = readers.read_jsonl(spark, str(tmp_path / "m.jsonl"), "hash string")
    assert sorted(r.hash for r in manifest.collect()) == ["a", "b"]
    sinks.write_jsonl(manifest, str(tmp_path / "out"))
    sinks.rewrite_jsonl(readers.read_jsonl(spark, str(tmp_path / "out"), "hash string").where("hash = 'a'"), str(tmp_path / "out"))
    assert readers.read_jsonl(spark, str(tmp_path / "out"), "hash string").count() == 1
    for n in ("x.PNG", "y.jpg", "z.txt"):
        (tmp_path / n).write_bytes(b"abc")
    assert sorted(r.name for r in readers.listing(spark, str(tmp_path)).collect()) == ["x.PNG", "y.jpg"]
    assert dataset.content_hash(readers.listing(spark, str(tmp_path), content=True)).select("hash").distinct().count() == 1
    (tmp_path / "list.txt").write_text(" a \n\nb\n")
    assert sorted(r.path for r in readers.read_lines(spark, str(tmp_path / "list.txt")).collect()) == ["a", "b"]
    (tmp_path / "p.json").write_text('{"bins": {"k": 3}}')
    assert readers.read_profile(spark, str(tmp_path / "p.json"), manifest).first() == ("k", 3)
    sinks.write_items(spark.createDataFrame([("one.txt", "1"), ("two.txt", "2")], "n string, t string"), str(tmp_path / "items"), "n", "t")
    assert (tmp_path / "items/two.txt").read_text() == "2"
    plan = spark.createDataFrame([("y.jpg", "would_move", "bad/blur/y.jpg")], "path string, action string, dst string")
    assert sinks.apply_plan(plan, str(tmp_path)) == [] and (tmp_path / "bad/blur/y.jpg").exists()
    sinks.write_vectors(spark.createDataFrame([("b", [2.0]), ("a", [1.0])], "file string, embedding array<double>"), str(tmp_path / "vectors"), "file")
    assert [(r.row, r.file) for r in spark.read.parquet(str(tmp_path / "vectors")).orderBy("row").collect()] == [(0, "a"), (1, "b")]
    sinks.write_metadata(spark.createDataFrame([(1, 0.5)], "n int, t double"), str(tmp_path / "calib.json"))
    assert '"t": 0.5' in (tmp_path / "calib.json").read_text()
    assert readers.discover(["file", "pose_Rx", "AU12_r", "AU45_c", "AUx", "gaze_angle_x"]) == ["pose_Rx", "AU12_r", "AU45_c", "gaze_angle_x"]


def test_frames_are_sampled(spark):
    videos = spark.createDataFrame([("v", 24.0)], "path string, frame_rate double")
    decode = lambda path, step: ((path, i) for i in range(0, 30, step))
    assert [r.i for r in readers.sample_frames(videos, decode, 8.0, "path string, i long").collect()] == list(range(0, 30, 3))


def test_extractors(spark):
    table = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("c", b"1")], "file string, content binary")
    rows = {r.file: r for r in extractors.run(table, extractors.HashExtractor(8)).collect()}
    assert rows["a"].embedding == rows["c"].embedding != rows["b"].embedding and sum(x * x for x in rows["a"].embedding) == pytest.approx(1, abs=1e-5)
    flat, edge = np.full((8, 8, 3), 100, np.uint8), np.zeros((8, 8, 3), np.uint8)
    edge[:, 4:] = 255
    assert extractors.focus(flat) == 0.0 and extractors.focus(edge) > 1000 and extractors.focus(None) == 0.0
    images = spark.createDataFrame([(flat.tobytes(), 8, 8), (None, 8, 8)], "raw binary, w int, h int")
    got = images.select(extractors.measure(F.col("raw"), F.col("w"), F.col("h")).alias("m")).collect()
    assert got[0].m.brightness == pytest.approx(100) and got[0].m.low == 0 and got[1].m.focus == 0.0
    scores = np.array([[1.0, 5.0, 0.0], [4.0, 1.0, 2.0], [0.0, 3.0, 2.0]])
    assert extractors.best_assignment(scores) == ([1, 0, 2], 11.0 - max(0 + 4 + 3, 5 + 2 + 0, 1 + 2 + 3, 1 + 1 + 2))
    detect = extractors.larger_when_empty(lambda image, size: [size] if size >= 640 else [], (320, 640, 960))
    assert detect(flat) == [640] and extractors.model_input(flat).shape == (3, 8, 8) and extractors.brightened(flat, 2.0, 2).shape == (12, 12, 3)


def test_stream_equals_batch(spark, tmp_path):
    table = spark.createDataFrame([("s", i, x) for i, x in enumerate(["Took 1.5ms (detect: 1ms, crop: 1ms, track: 1ms, 3D points: 1ms)", "Confidence[0]: 0.5 / 3D fitting error: 1 / Eyes: O, O", "noise", "Confidence[0]: 0.6 / 3D fitting error: 2 / Eyes: C, O"])], "stream string, line_no long, line string")
    table.write.parquet(str(tmp_path / "in"))
    expected = sorted(tuple(r) for r in live.tracker_lines_batch(table).collect())
    assert expected == [("s", 1, 0.5, 1.0, 1.5), ("s", 2, 0.6, 2.0, None)]
    stream = live.landed(spark, str(tmp_path / "in"), "stream string, line_no long, line string")
    numbered = live.ordinals(stream, "stream", "line_no", ["line"])
    query = live.each_batch(numbered, lambda b, _: b.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "cp"))
    query.awaitTermination()
    assert sorted((r.line_no, r.ordinal) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(i, i + 1) for i in range(4)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=4, max_size=4), min_size=4, max_size=4))
def test_assignment_is_the_best(rows):
    from itertools import permutations

    m = np.array(rows, float)
    sums = sorted((sum(m[i, p[i]] for i in range(4)) for p in permutations(range(4))), reverse=True)
    columns, margin = extractors.best_assignment(m)
    assert sum(m[i, c] for i, c in enumerate(columns)) == sums[0] and margin == sums[0] - sums[1]


def test_matching_and_building(spark):
    rng = random.Random(9)
    schema = ROWS.replace(", upscaled boolean", "") + ", cleanup_flag string"
    rows = lambda n, prefix: [(*r[:1], f"{prefix}/{r[1]}", *r[2:10], rng.choice(["0", "", None, "1"])) for r in items(rng, n)]
    source, target = spark.createDataFrame(rows(80, "s"), schema), spark.createDataFrame(rows(30, "t"), schema)
    there = source.where("src_ord % 5 <> 0").select("path")
    names = spark.createDataFrame([(1, "r", "in/x", "p7")], "ord int, src_root string, src_path string, dst_name string")
    logs = spark.createDataFrame([("r/", "in/x", "2.0"), ("r", "in/none", "3")], "src_root string, src_path string, scale string")
    for cap in (None, 2):
        chosen, report = workflows.matching(source, target, there, logs, names, 2, cap=cap)
        got = {r.path: r.is_upscaled for r in chosen.collect()}
        good = {r.path for r in source.join(there, "path").where("coalesce(cleanup_flag, '0') in ('0', '')").collect()}
        assert set(got) <= good and all(bool(v) == (k == "s/p7") for k, v in got.items())
        assert sum(r.target_count for r in report.collect()) == target.where("coalesce(cleanup_flag, '0') in ('0', '')").count()
        a, b = workflows.building(chosen, source, target.select("path"), target)
        assert a.count() == len(got) and b.count() == sum(r.target_count for r in report.collect())


def test_typed_pose_and_stats(spark):
    table = spark.createDataFrame([("a", "3.0", "1.5", "x", "0.5", "1"), ("b", "", None, "0.9", "-0.5", "0")], "file string, frame string, timestamp string, confidence string, pose_Ry string, success string")
    rows = {r.file: r for r in workflows.typed_pose(table).collect()}
    assert (rows["a"].frame, rows["a"].confidence, rows["b"].frame) == (3, None, None) and rows["a"].yaw_deg == pytest.approx(28.6479, abs=1e-3)
    assert workflows.pose_spread(table, "pose_Ry").first().both_signs
    assert profile.distinct_keys(table, "file").first().keys == 2
    assert profile.section_histogram(table, {"YAW": "success"}, {"YAW": ["1", "9"]}).where("label = '9'").first()["count"] == 0


def test_small_helpers(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "x string, o int")
    assert [r.x for r in dataset.ordered_distinct(rows, "x", "o").orderBy("o").collect()] == ["b", "a"]
    face = "struct<box:array<double>,kps:array<array<double>>,det_score:double,embedding:array<double>>"
    frames = spark.createDataFrame([([([0.0, 0.0, 10.0, 10.0], None, 0.1, None), ([40.0, 40.0, 60.0, 60.0], None, 0.9, None), ([45.0, 45.0, 55.0, 55.0], None, 0.2, None)],)], f"faces array<{face}>")
    best = frames.select(gates.best_per_frame(F.col("faces"), F.lit(100.0), F.lit(100.0), 2).alias("b"), gates.confident(F.col("faces"), 0.5).alias("c")).first()
    assert [f.det_score for f in best.b] == [0.9, 0.2] and len(best.c) == 1
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,c\n3,4\n")
    table = readers.read_csvs(spark, [str(tmp_path / f"{i}.csv") for i in (1, 2, 3)])
    assert table.columns == ["a", "b", "c"] and table.count() == 2
    assert readers.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "1.csv")]).endswith("1.csv")
    assert readers.first_file(readers.listing(spark, str(tmp_path), ("csv",))).first().name == "1.csv"
    for tool in ("match", "tag"):
        sinks.write_run(spark, str(tmp_path / "runs"), tool=tool, budget=3)
    assert sorted(r.tool for r in spark.read.json(str(tmp_path / "runs")).collect()) == ["match", "tag"]
    sinks.write_csv(rows, str(tmp_path / "csv"), ["x", "z"])
    sinks.write_csv(rows, str(tmp_path / "csv"), ["x", "z"], append=True)
    assert readers.read_csv(spark, str(tmp_path / "csv")).count() == 6
