"""Equalised reference images against a plain statement of the rule, pixel by pixel."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.operators import extractors


def plain_curves(levels, tiles, clip):
    h, w = levels.shape[0] // tiles[0], levels.shape[1] // tiles[1]
    limit = max(1, int(clip * h * w / 256))
    out = {}
    for i in range(tiles[0]):
        for j in range(tiles[1]):
            counts = [0] * 256
            for v in levels[i * h : i * h + h, j * w : j * w + w].ravel().tolist():
                counts[v] += 1
            over = sum(max(0, c - limit) for c in counts)
            counts = [min(c, limit) + over // 256 for c in counts]
            rest, at = over % 256, 0
            step = max(1, 256 // rest) if rest else 1
            while rest:
                counts[at] += 1
                at, rest = at + step, rest - 1
            total, curve = 0, []
            for c in counts:
                total += c
                curve.append(min(255, round(total * 255.0 / (h * w))))
            out[i, j] = curve
    return out, h, w


def plain_equalised(levels, tiles, clip):
    curves, h, w = plain_curves(levels, tiles, clip)
    out = np.zeros_like(levels)
    keep = lambda v, n: max(0, min(n - 1, v))
    for y in range(levels.shape[0]):
        for x in range(levels.shape[1]):
            ty, tx = y / h - 0.5, x / w - 0.5
            i, j = math.floor(ty), math.floor(tx)
            fy, fx = ty - i, tx - j
            v = levels[y, x]
            of = lambda a, b: curves[keep(a, tiles[0]), keep(b, tiles[1])][v]
            blend = (of(i, j) * (1 - fx) + of(i, j + 1) * fx) * (1 - fy) + (of(i + 1, j) * (1 - fx) + of(i + 1, j + 1) * fx) * fy
            out[y, x] = max(0, min(255, round(blend)))
    return out


@pytest.mark.parametrize("clip", [1.0, 2.0, 40.0])
def test_levels_equal_the_plain_rule(clip):
    rng = np.random.default_rng(3)
    levels = np.clip(rng.normal(60, 15, (24, 32)), 0, 255).astype(np.uint8)
    levels[:8, :8] = 7
    assert (extractors.equalised_levels(levels, (4, 4), clip) == plain_equalised(levels, (4, 4), clip)).all()


def test_sides_that_are_no_multiples():
    rng = np.random.default_rng(4)
    for shape in ((9, 13), (1, 1), (3, 200)):
        levels = rng.integers(0, 256, shape).astype(np.uint8)
        assert extractors.equalised_levels(levels).shape == shape


def test_contrast_grows_and_colours_stay():
    rng = np.random.default_rng(5)
    dark = np.clip(rng.normal(40, 6, (64, 64, 3)), 0, 255).astype(np.uint8)
    out = extractors.equalised(dark)
    assert out.std() > 1.5 * dark.std()
    every = np.stack(np.meshgrid(*[np.arange(0, 256, 15)] * 3), axis=-1).reshape(18, -1, 3).astype(np.uint8)
    assert np.abs(extractors.from_lab(extractors.to_lab(every)).astype(int) - every).max() <= 1
    gray = np.repeat(rng.integers(0, 256, (64, 64, 1)), 3, axis=2).astype(np.uint8)
    assert np.ptp(extractors.equalised(gray).astype(int), axis=2).max() <= 1


def test_prepared_images(spark):
    image = np.random.default_rng(6).integers(0, 256, (10, 20, 3)).astype(np.uint8)
    table = spark.createDataFrame([(1, image.tobytes(), 20, 10), (2, None, 20, 10), (3, b"", 0, 0)], "i int, raw binary, w int, h int")
    rows = {r.i: r.p for r in table.select("i", extractors.prepared(F.col("raw"), F.col("w"), F.col("h")).alias("p")).collect()}
    assert rows[2] is None and rows[3] is None
    assert (rows[1].width, rows[1].height) == (20 + 12, 10 + 12)
    expected = extractors.brightened(extractors.equalised(image), 1.35, 6)
    assert bytes(rows[1].content) == expected.tobytes()
    plain = table.where("i = 1").select(extractors.prepared(F.col("raw"), F.col("w"), F.col("h"), False, 1.0, 0.0).alias("p")).first().p
    assert bytes(plain.content) == image.tobytes()
