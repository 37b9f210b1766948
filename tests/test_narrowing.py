"""Quantiles by narrowing and numbers over ranges, against plain Python, with groups and ranges of a few rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import dataset, fusion, gates, ordinals, quantiles, timeline

POINTS = {"p0": 0.0, "p02": 0.02, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p1": 1.0}


def odd_values(rng, n):
    draw = lambda: rng.choice([rng.gauss(0, 1), math.exp(rng.gauss(0, 20)), 7.0, 7.0, float("inf"), float("-inf"), float("nan"), 5e-324, 0.0])
    return [(rng.choice([None, "a", "a", "a", "b"]), draw(), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(n)]


def plain_quantiles(rows):
    out = {}
    for g in {r[0] for r in rows}:
        for j, c in ((1, "x"), (2, "y")):
            v = sorted((r[j] for r in rows if r[0] == g and r[j] is not None), key=lambda z: (math.isnan(z), 0 if math.isnan(z) else z))
            if v:
                out[g, c] = [len(v)]
                for p in POINTS.values():
                    place = p * (len(v) - 1)
                    a, b, share = v[math.floor(place)], v[math.ceil(place)], place - math.floor(place)
                    out[g, c].append(a if share == 0 else (1 - share) * a + share * b)
    return out


@pytest.mark.parametrize(("leaf", "cells"), [(None, 1024), (20, 8)])
def test_quantiles(spark, leaf, cells):
    rows = odd_values(random.Random(5), 300)
    table = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r[0], r[1]): list(r[2:]) for r in quantiles.exact_quantiles(table, ["x", "y"], POINTS, ["g"], leaf, cells).collect()}
    expected = plain_quantiles(rows)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values, rel=1e-9, nan_ok=True), key


def test_no_task_holds_a_group(spark):
    """One group with nearly all rows: what is ordered in one task is bounded by the leaf, whatever the group's size."""
    rows = spark.range(4000).select(F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("g"), ((F.col("id") * 7919) % 4001).cast("double").alias("x"))
    found = quantiles.exact_quantiles(rows, ["x"], {"m": 0.5}, ["g"], leaf=100, cells=16)
    expected = {g: v for g, v in rows.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("m")).collect()}
    assert {r.g: r.m for r in found.collect()} == expected
    assert "percentile" not in found._jdf.queryExecution().toString()


def test_a_quantile_between_equal_values_is_that_value(spark):
    """A threshold that is a value must not lie above it by a rounding error."""
    values = [0.1] * 7 + [0.7] * 5
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.exact_quantiles(rows, ["x"], {f"q{i}": i / 97 for i in range(97)}).first()
    assert {got[f"q{i}"] for i in range(0, 48)} == {0.1} and {got[f"q{i}"] for i in range(62, 97)} == {0.7}


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantiles.exact_quantiles(empty, ["x"], POINTS).count() == 0
    assert fusion.quantiles(empty, "x", {"t": 0.2}, {"t": 0.5}).first().t == 0.5
    assert gates.spread(empty, ["x"]).first().x is None
    nulls = spark.createDataFrame([(None,)], "x double")
    assert fusion.quantiles(nulls, "x", {"t": 0.2}, {"t": 0.5}).first().t == 0.5


def test_ordinals_over_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(8)]), i) for i in range(700)]
    table = spark.createDataFrame(rows, "k int, i int")
    expected = [i for _, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    got = ordinals.with_ordinals(table, ["k", "i"], size=60).orderBy("ordinal").collect()
    assert [r.i for r in got] == expected and [r.ordinal for r in got] == list(range(1, 701))
    assert table.count() == ordinals.with_ordinals(table.select("k"), ["k"], size=60).agg(F.countDistinct("ordinal")).first()[0]
    assert ordinals.with_ordinals(table.limit(0), ["k"]).count() == 0
    maps = table.withColumn("m", F.create_map(F.lit("a"), "i"))
    assert [r.i for r in ordinals.with_ordinals(maps, ["i"], size=60).orderBy("ordinal").collect()] == list(range(700))


def test_a_key_with_half_of_all_rows_is_cut(spark):
    """Ranks within keys: a key's rows lie in several ranges, none of which has much more than its share."""
    table = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), ((F.col("id") * 31) % 2003).alias("v"), F.col("id").alias("i"))
    ranged = ordinals.ranged(table, ["k", "v"], 100)
    sizes = [r["count"] for r in ranged.groupBy("__range").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 2 * 2000 / len(sizes) * 1.5
    got = {r.i: r.n for r in ordinals.with_ranks(table, ["k"], [F.desc("v")], "n", 100).collect()}
    held = {}
    for r in sorted(table.collect(), key=lambda r: -r.v):
        held.setdefault(r.k, []).append(r.i)
    assert got == {i: n for ids in held.values() for n, i in enumerate(ids, 1)}


def test_whole_tables_are_aligned_and_timed(spark):
    left, right = spark.range(5).select(F.col("id").alias("a")), spark.range(3).select(F.col("id").alias("b"))
    got = sorted((r.ordinal, r.a, r.b) for r in dataset.align(left, right, [F.desc("a")], ["b"]).collect())
    assert got == [(1, 4, 0), (2, 3, 1), (3, 2, 2), (4, 1, None), (5, 0, None)]
    assert sorted((r.a, r.ms) for r in timeline.synthetic_time(left, "a", 10.0).collect()) == [(i, i * 100.0) for i in range(5)]
    numbered = dataset.number_rows(left, ["a"], F.lit(10))
    assert sorted((r.a, r.number) for r in numbered.collect()) == [(i, 11 + i) for i in range(5)]
    for plan in (dataset.align(left, right, ["a"], ["b"]), numbered, timeline.synthetic_time(left, "a", 10.0)):
        # The only rows in one partition are those of a range each.
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert all("sum(__n" in line for line in text.split("\n") if "Window [" in line)
