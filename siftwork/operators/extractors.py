"""Feature extractors behind one interface, and measures of pixels.

An extractor reads batches of items and writes their features; models are the caller's. ``HashExtractor`` stands in for
one: its vectors depend on the content only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FeatureExtractor(Protocol):
    """``schema`` of the result; ``start`` runs once in a task (to load a model); ``extract`` maps a batch."""

    schema: str

    def start(self) -> None: ...

    def extract(self, batch: pd.DataFrame) -> pd.DataFrame: ...


def run(items: DataFrame, extractor: FeatureExtractor) -> DataFrame:
    """The features of all items, a batch at a time; the model is loaded once for each task."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor.start()
        for batch in batches:
            yield extractor.extract(batch)

    return items.mapInPandas(each, extractor.schema)


class HashExtractor:
    """A stand-in for an embedding model: file, quality (the vector's length) and a unit vector, from a hash of the content."""

    schema = "file string, quality double, embedding array<float>"

    def __init__(self, dimensions: int = 16):
        self.dimensions = dimensions

    def start(self) -> None:
        pass

    def extract(self, batch: pd.DataFrame) -> pd.DataFrame:
        def vector(content: bytes) -> np.ndarray:
            raw = hashlib.shake_128(bytes(content)).digest(2 * self.dimensions)
            return np.frombuffer(raw, "<u2").astype(np.float64) / 32768 - 1

        vectors = [vector(c) for c in batch["content"]]
        lengths = [float(np.linalg.norm(v)) for v in vectors]
        return pd.DataFrame({"file": batch["file"], "quality": lengths, "embedding": [(v / (n + 1e-8)).astype(np.float32) for v, n in zip(vectors, lengths, strict=True)]})


def larger_when_empty(detect: Callable[[np.ndarray, int], list], sizes: tuple[int, ...]) -> Callable[[np.ndarray], list]:
    """A detector that is asked again at larger sizes until it finds something."""

    def again(image: np.ndarray) -> list:
        for size in sizes:
            found = detect(image, size)
            if found:
                return found
        return []

    return again


def shrunk(image: np.ndarray, most: int) -> np.ndarray:
    """``image`` with its longer side at most ``most``, by means of the pixels that fall together."""
    h, w = image.shape[:2]
    if max(h, w) <= most:
        return image
    nh, nw = max(1, h * most // max(h, w)), max(1, w * most // max(h, w))
    rows, columns = np.arange(h) * nh // h, np.arange(w) * nw // w
    sums = np.zeros((nh, nw, *image.shape[2:]))
    np.add.at(sums, (rows[:, None], columns[None, :]), image)
    counts = np.bincount(rows, minlength=nh)[:, None] * np.bincount(columns, minlength=nw)[None, :]
    return sums / (counts if image.ndim == 2 else counts[..., None])


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of blue, green, red."""
    return image if image.ndim == 2 else np.rint(image[..., 0] * 0.114 + image[..., 1] * 0.587 + image[..., 2] * 0.299)


def focus(image: np.ndarray | None, most: int = 256) -> float:
    """Mean squared Sobel gradient of the gray image, edges mirrored; 0 without an image."""
    if image is None or not image.size:
        return 0.0
    g = np.pad(shrunk(gray(image.astype(np.float64)), most), 1, mode="reflect" if min(image.shape[:2]) > 1 else "edge")
    smooth_y, smooth_x = g[:-2] + 2 * g[1:-1] + g[2:], g[:, :-2] + 2 * g[:, 1:-1] + g[:, 2:]
    gx, gy = smooth_y[:, 2:] - smooth_y[:, :-2], smooth_x[2:] - smooth_x[:-2]
    return float(np.mean(gx * gx + gy * gy))


def light(image: np.ndarray, most: int = 128, shrink: float = 0.86) -> tuple[float, float, float, float, float, float]:
    """Mean linear red, green, blue, percent of dark and light values, and log-mean luminance inside a central ellipse."""
    small = shrunk(image.astype(np.float64), most)
    h, w = small.shape[:2]
    y, x = np.ogrid[:h, :w]
    ry, rx = max(0.5, h * shrink / 2), max(0.5, w * shrink / 2)
    inside = ((y - h // 2) / ry) ** 2 + ((x - w // 2) / rx) ** 2 <= 1
    s = small[inside] / 255
    linear = np.where(s <= 0.04045, s / 12.92, ((s + 0.055) / 1.055) ** 2.4)
    b, g, r = linear.T
    luminance = 0.2126 * r + 0.7152 * g + 0.0722 * b
    return float(r.mean()), float(g.mean()), float(b.mean()), float((s < 0.02).mean() * 100), float((s > 0.98).mean() * 100), float(np.exp(np.log(luminance + 1e-6).mean()))


def pixels(content: bytes, width: int, height: int, channels: int = 3) -> np.ndarray:
    return np.frombuffer(bytes(content), np.uint8).reshape(height, width, channels)


LIGHT = "focus double, brightness double, r double, g double, b double, low double, high double, log_mean double"


def measure(raw: Column, width: Column, height: Column) -> Column:
    """Focus, brightness and light of raw images (bytes of blue, green, red), as a struct."""

    @F.pandas_udf(LIGHT)
    def each(content: pd.Series, w: pd.Series, h: pd.Series) -> pd.DataFrame:
        out = []
        for c, x, y in zip(content, w, h, strict=True):
            image = pixels(c, int(x), int(y)) if c is not None and len(c) else None
            out.append((0.0, *[None] * 7) if image is None else (focus(image), float(gray(image).mean()), *light(image)))
        return pd.DataFrame(out, columns=[x.split()[0] for x in LIGHT.split(", ")])

    return each(raw, width, height)


def model_input(image: np.ndarray) -> np.ndarray:
    """Channels first, values about -1..1."""
    return ((image.astype(np.float32) - 127.5) / 128).transpose(2, 0, 1)


def brightened(image: np.ndarray, gamma: float, border: int = 0) -> np.ndarray:
    """A reference image with a gamma curve and mirrored borders, for detectors that miss dark or close faces."""
    curve = np.clip(np.floor((np.arange(256) / 255.0) ** (1.0 / gamma) * 255 + 0.5), 0, 255).astype(np.uint8)
    out = image if abs(gamma - 1.0) < 1e-6 else curve[image]
    return np.pad(out, ((border, border), (border, border), (0, 0)), mode="reflect") if border else out


def tile_curves(levels: np.ndarray, tiles: tuple[int, int], clip: float) -> np.ndarray:
    """The curve (256 levels) of each tile of an image whose sides are multiples of ``tiles``: its cumulated histogram.

    Counts above the limit, ``clip`` times the mean, are cut and handed out evenly, what is left over at equal steps;
    so no stretch of levels is spread by much more than ``clip``.
    """
    rows, columns = tiles
    h, w = levels.shape[0] // rows, levels.shape[1] // columns
    blocks = levels.reshape(rows, h, columns, w).transpose(0, 2, 1, 3).reshape(rows * columns, h * w)
    counts = np.bincount((blocks + 256 * np.arange(len(blocks))[:, None]).ravel(), minlength=256 * len(blocks)).reshape(-1, 256)
    limit = max(1, int(clip * h * w / 256))
    over = np.maximum(counts - limit, 0).sum(axis=1)
    counts = np.minimum(counts, limit) + (over // 256)[:, None]
    for tile in np.flatnonzero(over % 256):
        rest = over[tile] % 256
        counts[tile, : rest * max(1, 256 // rest) : max(1, 256 // rest)] += 1
    return np.clip(np.rint(np.cumsum(counts, axis=1) * (255.0 / (h * w))), 0, 255).reshape(rows, columns, 256)


def equalised_levels(levels: np.ndarray, tiles: tuple[int, int] = (8, 8), clip: float = 2.0) -> np.ndarray:
    """Levels (0..255) spread by the curves of the four nearest tiles, blended by how near their centres are."""
    h, w = levels.shape
    below, right = -h % tiles[0], -w % tiles[1]
    whole = np.pad(levels, ((0, below), (0, right)), mode="reflect" if h > below and w > right else "edge")
    curves = tile_curves(whole.astype(np.int64), tiles, clip)

    def near(n: int, size: float, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(n) / size - 0.5
        first = np.floor(at).astype(np.int64)
        return np.clip(first, 0, last), np.clip(first + 1, 0, last), at - first

    y1, y2, fy = near(h, whole.shape[0] / tiles[0], tiles[0] - 1)
    x1, x2, fx = near(w, whole.shape[1] / tiles[1], tiles[1] - 1)
    at = lambda y, x: curves[y[:, None], x[None, :], levels]
    upper = at(y1, x1) * (1 - fx) + at(y1, x2) * fx
    lower = at(y2, x1) * (1 - fx) + at(y2, x2) * fx
    return np.clip(np.rint(upper * (1 - fy)[:, None] + lower * fy[:, None]), 0, 255).astype(np.uint8)


# Linear sRGB to XYZ of D65 and its white point, and the border and slope of CIE lightness.
TO_XYZ = np.array(((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041)))
WHITE = TO_XYZ.sum(axis=1)
LAB_BORDER, LAB_SLOPE = (6 / 29) ** 3, (29 / 6) ** 2 / 3


def to_lab(image: np.ndarray) -> np.ndarray:
    """Blue, green, red (0..255) as CIE L, a, b."""
    s = image[..., ::-1] / 255.0
    xyz = np.where(s <= 0.04045, s / 12.92, ((s + 0.055) / 1.055) ** 2.4) @ TO_XYZ.T / WHITE
    f = np.where(xyz > LAB_BORDER, np.cbrt(xyz), LAB_SLOPE * xyz + 4 / 29)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], axis=-1)


def from_lab(lab: np.ndarray) -> np.ndarray:
    y = (lab[..., 0] + 16) / 116
    f = np.stack([y + lab[..., 1] / 500, y, y - lab[..., 2] / 200], axis=-1)
    xyz = np.where(f > 6 / 29, f**3, (f - 4 / 29) / LAB_SLOPE) * WHITE
    linear = np.clip(xyz @ np.linalg.inv(TO_XYZ).T, 0, 1)
    s = np.where(linear <= 0.0031308, 12.92 * linear, 1.055 * linear ** (1 / 2.4) - 0.055)
    return np.clip(np.rint(s[..., ::-1] * 255), 0, 255).astype(np.uint8)


def equalised(image: np.ndarray, tiles: tuple[int, int] = (8, 8), clip: float = 2.0) -> np.ndarray:
    """A colour image whose lightness is equalised tile by tile with limited contrast; colours stay."""
    lab = to_lab(image)
    levels = np.clip(np.rint(lab[..., 0] * 2.55), 0, 255).astype(np.uint8)
    lab[..., 0] = equalised_levels(levels, tiles, clip) / 2.55
    return from_lab(lab)


def prepared(raw: Column, width: Column, height: Column, equalise: bool = True, gamma: float = 1.35, border: float = 0.60) -> Column:
    """Reference images made ready for a detector: equalised, brightened and with borders of a share of the shorter side.

    ``raw``: bytes of blue, green, red. A struct of content, width, height; null for images that are null or empty.
    """

    @F.pandas_udf("content binary, width int, height int")
    def each(content: pd.Series, w: pd.Series, h: pd.Series) -> pd.DataFrame:
        out = []
        for c, x, y in zip(content, w, h, strict=True):
            if c is None or not len(c):
                out.append((None, None, None))
                continue
            image = pixels(c, int(x), int(y))
            image = brightened(equalised(image) if equalise else image, gamma, min(round(border * min(image.shape[:2])), min(image.shape[:2]) - 1))
            out.append((image.tobytes(), image.shape[1], image.shape[0]))
        return pd.DataFrame(out, columns=["content", "width", "height"]).astype({"width": "Int32", "height": "Int32"})

    done = each(raw, width, height)
    return F.when(done["content"].isNotNull(), done)


def best_assignment(scores: np.ndarray) -> tuple[list[int], float]:
    """The columns, one for each row, with the largest sum, and its margin over the next best; for a square of a few rows.

    Works through sets of columns, so eight rows take 2 ** 8 steps rather than 8! orders.
    """
    n = len(scores)
    best: dict[int, list[tuple[float, tuple[int, ...]]]] = {0: [(0.0, ())]}
    for mask in range(1 << n):
        row = mask.bit_count()
        for column in range(n):
            if row < n and not mask >> column & 1:
                grown = [(s + float(scores[row, column]), (*c, column)) for s, c in best[mask]]
                new = mask | 1 << column
                best[new] = sorted([*best.get(new, []), *grown], key=lambda x: (-x[0], x[1]))[:2]
    first, *second = best[(1 << n) - 1]
    return list(first[1]), first[0] - second[0][0] if second else float("inf")
