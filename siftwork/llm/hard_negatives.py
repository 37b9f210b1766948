"""Hard negatives by product quantisation with stored residual norms.

1. Vectors become integers. Each pair of components is a subspace with a codebook of at most 256 centroids. The index
   holds every row in pages: codes, the norm of what the codes leave over (the residual), the integers, id and label.
2. The score of a row with an anchor lies within (sum of looked-up products with centroids) plus or minus (the anchor's
   norm times the residual's), so rows out of reach are set aside for certain; no row is lost to the quantisation, and
   poor codebooks cost time only. Codebooks are fitted on at most ``SAMPLE`` rows.
3. Positives: what can still be among an anchor's first rows of its label is scored in exact integers, and the worst of
   the best so far is the bound for all that follows. Each task yields its best, a shuffle merges them.
4. Negatives: each positive is a window of scores. What can lie in a window, and can still be among its first, is scored
   in exact integers; each task yields its best for each window, a shuffle merges them.

Anchors meet the index in blocks: at most ``CHUNK`` bytes of them are broadcast at once (so many bytes pass the driver,
whatever their number), and every task streams its pages past them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, staged

#: Rows on which codebooks are fitted, and the rounds of fitting.
SAMPLE, ROUNDS = 4_096, 6
#: Components of a subspace and centroids of its codebook.
SUB, CENTROIDS = 2, 256
#: Rows of a page of the index, and rows of a task that makes pages.
PAGE, TASK_ROWS = 4_096, 65_536
#: Bytes of the anchors that are broadcast at once.
CHUNK = 32 << 20
#: Anchors and rows of a tile, within which scores are computed at once.
TILE_ANCHORS, TILE_ROWS = 128, 1_024
#: Bounds of windows that are open, and of those that are closed.
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Relative error allowed for sums of looked-up products in single precision.
SINGLE = 1e-5

PAGE_SCHEMA = "n int, ids binary, labels binary, codes binary, residuals binary, vectors binary"


def fit_codebooks(sample: np.ndarray, seed: int = 17) -> np.ndarray:
    """Centroids (subspace, centroid, component) of ``sample`` (rows x components, a multiple of SUB)."""
    rng = np.random.default_rng(seed)
    m, k = sample.shape[1] // SUB, max(1, min(CENTROIDS, len(sample)))
    books = np.zeros((m, k, SUB))
    for j in range(m):
        points = sample[:, SUB * j : SUB * j + SUB].astype(np.float64)
        if not len(points):
            continue
        centres = points[rng.permutation(len(points))[:k]].copy()
        for _ in range(ROUNDS):
            at = nearest(points, centres)
            n = np.bincount(at, minlength=k)
            for c in range(SUB):
                sums = np.bincount(at, weights=points[:, c], minlength=k)
                centres[n > 0, c] = sums[n > 0] / n[n > 0]
        books[j] = centres
    return books.astype(np.float32)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.sum(centres**2, axis=1)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def encode(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x subspaces) and norms of residuals, rounded up, of integer ``vectors``."""
    codes, left = np.empty((len(vectors), len(books)), np.uint8), np.zeros(len(vectors))
    for j, book in enumerate(books.astype(np.float64)):
        own = vectors[:, SUB * j : SUB * j + SUB].astype(np.float64)
        codes[:, j] = nearest(own, book)
        left += np.sum((own - book[codes[:, j]]) ** 2, axis=1)
    return codes, np.sqrt(left) * (1 + 1e-9) + 1e-9


def pages(points: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """The index of ``points`` (vec_id, label, vector): pages of at most PAGE rows."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE):
                part = batch.slice(at, PAGE)
                vectors = padded(part.column("vector"), width)
                codes, left = encode(vectors, books)
                row = [part.num_rows, part.column("vec_id").to_numpy().tobytes(), part.column("label").to_numpy().tobytes(), codes.tobytes(), left.tobytes(), vectors.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), *(pa.array([x], pa.binary()) for x in row[1:])], ["n", "ids", "labels", "codes", "residuals", "vectors"])

    return points.select("vec_id", "label", "vector").mapInArrow(write, PAGE_SCHEMA)


def padded(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix; those that are shorter end in zeros."""
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


class Anchors:
    """A block of anchors: keys, ids, labels, vectors (matrix), and windows of scores for each (low, high)."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.keys, self.ids, self.labels, self.vectors, self.low, self.high = keys, ids, labels, vectors, low, high
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


class Best:
    """The first ``k`` (score descending, id ascending) of each of ``n`` keys among all that has been added."""

    def __init__(self, n: int, k: int):
        self.k, self.count = k, np.zeros(n, np.int64)
        self.scores, self.ids = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def worst(self, a: int, b: int, otherwise: np.ndarray) -> np.ndarray:
        """The score that the next one must reach, for keys from ``a`` to ``b``."""
        return np.where(self.count[a:b] == self.k, self.scores[a:b, -1], otherwise)

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(keys):
            return
        touched = np.unique(keys)
        row, column = np.nonzero(np.arange(self.k)[None, :] < self.count[touched][:, None])
        all_keys = np.concatenate([touched[row], keys])
        all_scores = np.concatenate([self.scores[touched[row], column], scores])
        all_ids = np.concatenate([self.ids[touched[row], column], ids])
        order = np.lexsort((all_ids, -all_scores, all_keys))
        all_keys, all_scores, all_ids = all_keys[order], all_scores[order], all_ids[order]
        rank = np.arange(len(all_keys)) - np.searchsorted(all_keys, all_keys)
        keep = rank < self.k
        self.scores[all_keys[keep], rank[keep]] = all_scores[keep]
        self.ids[all_keys[keep], rank[keep]] = all_ids[keep]
        np.maximum.at(self.count, all_keys[keep], rank[keep] + 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, at = np.nonzero(np.arange(self.k)[None, :] < self.count[:, None])
        return key, self.scores[key, at], self.ids[key, at]


def exact(rows: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of rows i with anchors j, in pieces of bounded size."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        here = slice(at, at + 65_536)
        out[here] = np.einsum("ij,ij->i", rows[i[here]], anchors[j[here]])
    return out


def bounds(codes: np.ndarray, residuals: np.ndarray, tables: np.ndarray, norms: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores by look-up (rows x anchors), and how far the true ones may be from them.

    ``tables``: subspace x centroid x anchor. ``reach``: the largest norm of a row, for the error of single precision.
    """
    scores, part = tables[0][codes[:, 0]], np.empty((len(codes), tables.shape[2]), np.float32)
    for j in range(1, len(tables)):
        np.take(tables[j], codes[:, j], axis=0, out=part)
        scores += part
    return scores, (residuals[:, None] + SINGLE * (reach + residuals.max(initial=0))) * norms[None, :] + 1


def scan(index: DataFrame, anchors: Broadcast, books: Broadcast, k: int, negatives: bool) -> DataFrame:
    """key, at, score, vec_id: each task's first ``k`` rows of each anchor and window (``at``).

    Positives are rows of the anchor's label, without windows; negatives those of other labels inside the windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Anchors = anchors.value
        book = books.value
        width, windows = held.vectors.shape[1], held.low.shape[1]
        best = [Best(len(held.keys), k) for _ in range(windows)]
        any_row = False
        for batch in batches:
            for r in batch.to_pylist():
                any_row = True
                n = r["n"]
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                codes, left = np.frombuffer(r["codes"], np.uint8).reshape(n, -1), np.frombuffer(r["residuals"], np.float64)
                vectors = np.frombuffer(r["vectors"], np.int64).reshape(n, width)
                reach = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)).max())
                if reach * held.norms.max(initial=0) >= 2.0**62:
                    raise OverflowError("inner products may pass 64 bits")
                for a in range(0, len(held.keys), TILE_ANCHORS):
                    b = min(a + TILE_ANCHORS, len(held.keys))
                    own = held.vectors[a:b]
                    tables = np.stack([(book[j].astype(np.float64) @ own[:, SUB * j : SUB * j + SUB].T.astype(np.float64)).astype(np.float32) for j in range(len(book))])
                    for s in range(0, n, TILE_ROWS):
                        e = min(s + TILE_ROWS, n)
                        scores, far = bounds(codes[s:e], left[s:e], tables, held.norms[a:b], reach)
                        alike = labels[s:e, None] == held.labels[None, a:b]
                        floor = np.min([x.worst(a, b, held.low[a:b, w]) for w, x in enumerate(best)], axis=0)
                        # Written so that what is no number goes on to the exact score.
                        can = ~(scores + far < floor[None, :])
                        if negatives:
                            can &= ~(scores - far > held.high[a:b].max(axis=1)[None, :]) & ~alike
                        else:
                            can &= alike & (ids[s:e, None] != held.ids[None, a:b])
                        i, j = np.nonzero(can)
                        value = exact(vectors, own, i + s, j)
                        for w, x in enumerate(best):
                            fits = (value >= x.worst(a, b, held.low[a:b, w])[j]) & (value <= held.high[a + j, w])
                            x.add(j[fits] + a, value[fits], ids[s:e][i[fits]])
        if any_row:
            for w, x in enumerate(best):
                key, score, of = x.entries()
                yield pa.RecordBatch.from_arrays([pa.array(held.keys[key]), pa.array(np.full(len(key), w, np.int32)), pa.array(score), pa.array(of)], ["key", "at", "score", "vec_id"])

    return index.mapInArrow(run, "key long, at int, score long, vec_id long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each key and window, with ``rank`` from 1."""
    spot = Window.partitionBy("key", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(spot)).where(F.col("rank") <= k)


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, vector (integers), is_anchor of the rows that take part; equal rows once."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    there = rows.where("vec_id is not null and label is not null and embedding is not null").where(~F.exists("embedding", bad))
    large = F.exists("embedding", lambda x: F.abs(x.cast("double")) * scale >= 2.0**62)
    checked = F.when(large, F.raise_error(F.lit("components may pass 64 bits")).cast("array<long>")).otherwise(whole_numbers(F.col("embedding"), scale))
    return there.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), checked.alias("vector"), "is_anchor").dropDuplicates(["vec_id", "label", "vector"])


def hard_negatives(rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, embedding, is_anchor. Components become floor(scale * x); scores are integer inner products
    with the anchor, higher first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows
    of its label. For each of them come the first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's.

    Edge cases: rows with a null vec_id, label, vector or component, or a component that is not finite, take no part;
    equal rows (vec_id, label and vector) count once, and rows with the anchor's vec_id are not its positives; vectors
    that are shorter than others end in zeros, empty ones are zeros; anchors without positives, positives whose score is
    negative, and windows without rows give nothing; an empty table gives no rows; other columns are ignored. Scores
    that could pass 64 bits raise an error rather than be wrong.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    points = staged(usable(rows, scale), "points")
    total, width = points.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(SUB, -(-width // SUB) * SUB)
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "vector").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    books = context.broadcast(fit_codebooks(padded(sample, width)))
    tasks = max(context.defaultParallelism, total // TASK_ROWS + 1)
    index = staged(pages(points.repartition(tasks, F.xxhash64("vec_id", "vector")), books.value, width), "index")
    anchors = staged(points.where("is_anchor").select(F.monotonically_increasing_id().alias("key"), "vec_id", "label", "vector"), "anchors")
    discard(points)
    chunks = anchors.count() * (width * 8 + 24) // chunk + 1
    out = []
    for c in range(chunks):
        block = anchors.where(F.pmod(F.xxhash64("key"), F.lit(chunks)) == c)
        held = block.orderBy("key").toArrow().combine_chunks()
        keys, ids, labels = (held.column(x).to_numpy() for x in ("key", "vec_id", "label"))
        vectors = padded(held.column("vector").combine_chunks(), width)
        n = len(keys)
        first = context.broadcast(Anchors(keys, ids, labels, vectors, np.full((n, 1), LEAST), np.full((n, 1), MOST)))
        near = staged(merged(scan(index, first, books, positives, False), positives).select("key", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        first.destroy()
        # As many numbers as anchors have positives, for this block of anchors.
        got = near.toArrow()
        at, place, score = np.searchsorted(keys, got.column("key").to_numpy()), got.column("place").to_numpy() - 1, got.column("positive_score").to_numpy().astype(object)
        lows, highs = np.full((n, positives), MOST), np.full((n, positives), LEAST)
        lows[at, place], highs[at, place] = -(-score * low // 100), score * high // 100
        second = context.broadcast(Anchors(keys, ids, labels, vectors, lows, highs))
        hard = staged(merged(scan(index, second, books, negatives, True), negatives), "negatives")
        second.destroy()
        ids_of = block.select("key", F.col("vec_id").alias("anchor_id"))
        met = near.join(ids_of, "key").join(hard.select("key", (F.col("at") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["key", "place"])
        out.append(met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    return reduce(DataFrame.union, out)


def mine_embeddings(rows: DataFrame, scored: Callable[[Column], Column] = lambda i: i % 50 == 0) -> DataFrame:
    """``hard_negatives`` of a table vec_id, embedding, label in which every seventh label is moved on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding", F.coalesce(scored(F.col("vec_id")), F.lit(False)).alias("is_anchor")))
