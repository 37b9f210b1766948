"""Quality classification by co-training of two views: what a text says and how its page is made up.

The content view sees frequencies of neighbouring character classes, repeated words and word lengths of the whole text.
The metadata view sees language, source, size and line layout. Each view is a logistic regression on features that are
standardised by the moments of all documents. In each round both views score all unlabelled documents, and what one is
confident of becomes pseudo-labels for the other. The views are then calibrated on labelled rows kept apart, and combined.

Moments, scores and numbers of confident documents cover all documents and are computed on the executors. The driver
fits on samples of bounded, documented size: of labelled rows, and of the pseudo-labelled ones of a round.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import split_words, utf8

#: Most labelled rows, and about how many pseudo-labelled rows a view gets in a round, that are fitted on.
LABELLED, PSEUDO = 4000, 2000
ROUNDS = 3
#: How sure a view must be of a document that it labels for the other.
SURE = 0.9
#: Documents with a lower score are rejected.
KEEP_FROM = 0.5

_SINGLE = b""".,!?|*#$%&-_:;"'()/=<>@+"""
CLASSES = 8 + len(_SINGLE)
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[[32, 9]], _CLASS[[10, 13]] = 4, 5
for _i, _c in enumerate(_SINGLE):
    _CLASS[_c] = 8 + _i
CONTENT, METADATA = CLASSES * CLASSES + 5, 64 + 16 + 8


def content_features(data: bytes) -> np.ndarray:
    """Roots of the frequencies of pairs of neighbouring character classes, and repetition and lengths of words."""
    out = np.zeros(CONTENT, np.float32)
    of = _CLASS[np.frombuffer(data, np.uint8)].astype(np.int32)
    if len(of) > 1:
        out[: CLASSES * CLASSES] = np.sqrt(np.bincount(of[:-1] * CLASSES + of[1:], minlength=CLASSES * CLASSES) / (len(of) - 1))
    words = split_words(data)
    if words:
        distinct, n = len(set(words)), len(words)
        pairs = len(set(zip(words, words[1:], strict=False)))
        out[-5:] = distinct / n, pairs / n, np.log1p(n) / 5, (distinct / n) * np.log1p(n) / 5, len(data) / n / 10
    return out


def metadata_features(data: bytes, lang: str | None, source: str | None) -> np.ndarray:
    """Language, source, size and line layout."""
    out = np.zeros(METADATA, np.float32)
    out[zlib.crc32((source or "").encode()) % 64] = 1
    out[64 + zlib.crc32((lang or "").encode()) % 16] = 1
    lines = data.split(b"\n")
    sizes = np.array([len(x) for x in lines])
    out[80:] = np.log1p(len(data)) / 5, np.log1p(len(lines)) / 3, np.log1p(sizes.mean()) / 5, sizes.std() / (1 + sizes.mean()), len(set(lines)) / len(lines), np.log1p(sizes.max()) / 5, (sizes < 30).mean(), (sizes == 0).mean()
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class View:
    """A ridge logistic regression on standardised features."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, ridge: float = 1e-3):
        self.mean, self.scale, self.ridge = mean.astype(np.float32), (1 / np.maximum(deviation, 1e-2)).astype(np.float32), ridge
        self.w, self.b = np.zeros(len(mean), np.float32), 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) * self.scale, -5, 5) @ self.w + self.b

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 150) -> None:
        """Accelerated gradient descent; both classes weigh the same."""
        x = np.clip((x - self.mean) * self.scale, -5, 5)
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
        rate = 4 / max(1e-6, float((weight @ (x * x)).sum()) + 1)
        w, b, vw, vb = self.w, self.b, self.w, self.b
        for t in range(steps):
            g = (sigmoid(x @ vw + vb) - y) * weight
            nw, nb = vw - rate * 8 * (x.T @ g + self.ridge * vw), vb - rate * 8 * g.sum()
            vw, vb = nw + (t / (t + 3)) * (nw - w), nb + (t / (t + 3)) * (nb - b)
            w, b = nw, nb
        self.w, self.b = w.astype(np.float32), float(b)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method for few features; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), grad)
    return w


class CoTrained:
    """Two fitted views, their calibration and their combination."""

    def __init__(self, views: list[View], calibration: list[np.ndarray], combine: np.ndarray):
        self.views, self.calibration, self.combine = views, calibration, combine

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [c[0] * v.logit(x) + c[1] for v, c, x in zip(self.views, self.calibration, (content, metadata), strict=True)]
        return sigmoid(self.combine[0] * z[0] + self.combine[1] * z[1] + self.combine[2]), sigmoid(z[0]), sigmoid(z[1])


def co_train(views: list[View], xs: list[np.ndarray], y: np.ndarray, pseudo: Callable[[list[View], list[np.ndarray], float], list[tuple[np.ndarray, np.ndarray]]]) -> CoTrained:
    """Fits ``views`` on three quarters of the labelled rows (features ``xs``, labels ``y``) and on what ``pseudo`` gives; calibrates on the rest.

    ``pseudo`` takes the views, their calibration and the share of label 1, and returns for each view rows and the labels that the other gives them.
    """
    apart = np.arange(len(y)) % 4 == 3
    if len(set(y[apart])) < 2:
        apart[:] = False
    held = np.flatnonzero(apart) if apart.any() else np.arange(len(y))
    learn = np.flatnonzero(~apart)

    def calibrations() -> list[np.ndarray]:
        return [logistic(view.logit(x[held])[:, None], y[held]) for view, x in zip(views, xs, strict=True)]

    given = [(x[:0], y[:0]) for x in xs]
    for round_ in range(ROUNDS + 1):
        for view, x, (more, labels) in zip(views, xs, given, strict=True):
            view.fit(np.concatenate([x[learn], more]), np.concatenate([y[learn], labels]).astype(np.float32))
        if round_ < ROUNDS:
            given = pseudo(views, calibrations(), float(y.mean()))
    calibration = calibrations()
    z = np.column_stack([c[0] * v.logit(x[held]) + c[1] for v, c, x in zip(views, calibration, xs, strict=True)])
    return CoTrained(views, calibration, logistic(z, y[held]))


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


#: Rows whose features stand in a matrix at once.
SLICE = 1_024


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most SLICE rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _features(frame: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(utf8(b.column("text")), b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True))
            content = [content_features(t or b"").astype(np.float16).tobytes() for t, _, _ in rows]
            metadata = [metadata_features(t or b"", lang, source).astype(np.float16).tobytes() for t, lang, source in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(content, pa.binary()), pa.array(metadata, pa.binary())], ["doc_id", "y", "content", "metadata"])

    return frame.mapInArrow(read, "doc_id long, y int, content binary, metadata binary")


def _columns(docs: DataFrame) -> DataFrame:
    has = set(docs.columns)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *(F.col(c).cast("string").alias(c) if c in has else F.lit(None).cast("string").alias(c) for c in ("lang", "source")))


def matrix(column: pa.Array | list[bytes]) -> np.ndarray:
    rows = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(rows), np.float16).astype(np.float32).reshape(len(rows), -1)


VIEWS = ("content", "metadata")


def moments(features: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of each view's features over all rows; tasks' sums are added up in a few tasks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(2 * (CONTENT + METADATA)), 0
        for batch in slices(batches):
            x = np.concatenate([matrix(batch.column(c)) for c in VIEWS], axis=1).astype(np.float64)
            total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 32], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()])], ["part", "n", "sums"])

    def add(some: pa.Table) -> pa.Table:
        return pa.table({"n": pa.array([sum(some.column("n").to_pylist())], pa.int64()), "sums": pa.array([sum(np.frombuffer(x) for x in some.column("sums").to_pylist()).tobytes()])})

    rows = features.select(*VIEWS).mapInArrow(sums, "part int, n long, sums binary").groupBy("part").applyInArrow(add, "n long, sums binary").collect()  # at most 32
    n = max(1, sum(r.n for r in rows))
    mean, square = np.split(sum(np.frombuffer(r["sums"]) for r in rows) / n, 2)
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return [(mean[a:b], deviation[a:b]) for a, b in ((0, CONTENT), (CONTENT, CONTENT + METADATA))]


def pseudo_labels(features: DataFrame, most: int) -> Callable:
    """What ``co_train`` takes: pseudo-labels from all rows of ``features`` (doc_id, content, metadata), at random about ``most`` of a round for each view."""

    def confident(batch: pa.RecordBatch, views: list[View], calibration: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(view that is sure, label, rows)."""
        for v, (view, c) in enumerate(zip(views, calibration, strict=True)):
            p = sigmoid(c[0] * view.logit(matrix(batch.column(VIEWS[v]))) + c[1])
            yield v, 1, np.flatnonzero(p >= SURE)
            yield v, 0, np.flatnonzero(1 - p >= SURE)

    def of(views: list[View], calibration: list[np.ndarray], share: float) -> list[tuple[np.ndarray, np.ndarray]]:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [(v, y, len(at)) for v, y, at in confident(batch, views, calibration)]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["view", "label", "n"])

        counts = {(r.view, r.label): r.n for r in features.mapInArrow(count, "view long, label long, n long").groupBy("view", "label").agg(F.sum("n").alias("n")).collect()}  # at most 4
        part = {k: most * (share if k[1] else 1 - share) / n for k, n in counts.items() if n}

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                place, rows = batch.column("place").to_numpy(), []
                for v, y, at in confident(batch, views, calibration):
                    at = at[place[at] < part.get((v, y), 0)]
                    other = batch.column(VIEWS[1 - v]).take(pa.array(at)).to_pylist()
                    rows += [(v, y, p, x) for p, x in zip(place[at].tolist(), other, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.binary()))], ["view", "label", "place", "x"])

        # A document's place is a uniform hash of its id, so about ``most`` rows come.
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
        rows = features.withColumn("place", place).mapInArrow(take, "view long, label long, place double, x binary").toPandas().sort_values(["label", "place"], kind="stable")
        out = []
        for v, width in ((1, CONTENT), (0, METADATA)):  # view v labels for the other
            some = rows[rows["view"] == v]
            out.append((matrix(list(some["x"])) if len(some) else np.empty((0, width), np.float32), some["label"].to_numpy()))
        return out

    return of


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pseudo: int = PSEUDO) -> CoTrained | None:
    """Fits on at most ``labelled`` rows of ``labels`` (doc_id, quality), the first by a hash of the id, and on pseudo-labels of all other documents.

    Rows that ``held_out`` names are not looked at. None if the labels seen have fewer than two classes.
    """
    known = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y"))
    rows = _columns(docs).where("doc_id is not null").where(~held_out())
    chosen = F.broadcast(known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))  # bounded
    features = staged(_features(rows.join(chosen, "doc_id", "left").select("doc_id", F.coalesce("y", F.lit(-1)).alias("y"), "text", "lang", "source")), "features")
    # Of repeated rows of one id the first by its features is learnt from.
    learnt = features.where("y >= 0").groupBy("doc_id", "y").agg(F.min(F.struct(*VIEWS)).alias("x")).select("doc_id", "y", "x.*").toPandas()
    learnt = learnt.sort_values("doc_id", key=lambda s: s.map(lambda i: zlib.crc32(b"%d" % i)), kind="stable")
    y = learnt["y"].to_numpy()
    model = None
    if len(set(y)) == 2:
        views = [View(*m) for m in moments(features)]
        model = co_train(views, [matrix(list(learnt[c])) for c in VIEWS], y, pseudo_labels(features.where("y < 0"), pseudo))
    discard(features)
    return model


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """doc_id, score, content_score, metadata_score of every row, in their order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            found = (np.ones(n), np.ones(n), np.ones(n))
            if model and n:
                rows = list(zip(utf8(b.column("text")), b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True))
                parts = []
                for at in range(0, n, 512):
                    some = rows[at : at + 512]
                    parts.append(model.scores(np.stack([content_features(t or b"") for t, _, _ in some]), np.stack([metadata_features(t or b"", lang, source) for t, lang, source in some])))
                found = tuple(np.concatenate(x).astype(np.float64) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, found)], ["doc_id", "score", "content_score", "metadata_score"])

    return _columns(docs).mapInArrow(read, "doc_id long, score double, content_score double, metadata_score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (probability of good quality), content_score, metadata_score, kept.

    Edge cases: a null text counts as empty and is scored like any other; unknown or missing languages and sources
    are features without weight; without labels of both classes every score is 1; an empty table gives no rows;
    repeated rows get equal scores; other columns are ignored.
    """
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "content_score", "metadata_score", (F.col("score") >= KEEP_FROM).alias("kept"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    Edge cases are those of ``classify``: null texts count as empty, missing languages and sources have no weight,
    without labels of both classes all rows stay, an empty table stays empty, and columns of any names pass through.
    """
    model = fit(docs, labels)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None or not b.num_rows:
                yield b
                continue
            names = b.schema.names
            texts = utf8(b.column(names.index("text")))
            lang = b.column(names.index("lang")).cast(pa.string()).to_pylist() if "lang" in names else [None] * b.num_rows
            source = b.column(names.index("source")).cast(pa.string()).to_pylist() if "source" in names else [None] * b.num_rows
            rows = list(zip(texts, lang, source, strict=True))
            keep = [model.scores(np.stack([content_features(t or b"") for t, _, _ in rows[i : i + 512]]), np.stack([metadata_features(t or b"", x, s) for t, x, s in rows[i : i + 512]]))[0] >= KEEP_FROM for i in range(0, len(rows), 512)]
            yield b.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(read, docs.schema)
