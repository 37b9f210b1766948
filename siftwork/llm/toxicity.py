"""Toxicity by two class-conditional Kneser-Ney models of expressions that share their backoff counts.

An expression is a run of bytes inside a word: a byte and up to five before it, not past the word's start. Each class
has its own counts of expressions. What they leave (the discounts) is spread by one distribution for both classes, a
chain of continuation counts: in how many expressions of either class one that is shorter by its first byte ends, and so
on order by order down to single bytes and a uniform base. Where a class has not seen an expression both therefore fall
back to the same probability, and rare expressions say little. A shared factor of both likelihoods cancels when they are
compared, so an expression that neither class has seen is compared by the two back-off weights alone.

A document's toxic and ordinary log-likelihoods are compared for all its words, normalised by their bytes, and for the
words that speak most for the toxic model, normalised by their number, so that a long text does not hide them; as the
strongest of more words are stronger by chance, the logarithm of the number of words counts against them. A logistic
curve fitted on labelled rows that are kept out of the counts turns the two comparisons into a score.

Counts and differences of all expressions and contexts stay distributed tables. Documents are dealt to blocks of a
bounded size; the distinct expressions of each block are joined with the contexts, and each block's documents are
scored with what came back for it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import split_words, utf8
from .quality import logistic, sigmoid

ORDER = 6
DISCOUNT = 0.75
#: Bytes of the documents that are scored together, and what a row counts for besides its text.
BLOCK, ROW = 32 << 20, 64
#: Words that stand for a document's strongest; numbers that the curve weighs.
STRONGEST, FEATURES = 3, 3
#: Bytes that the lowest order of the chain holds equally likely: all, and a word's end.
BASE = 257
#: The curve where calibration rows have one class only.
PLAIN = (-7.4, 2.7, -1.3, -5.9)
#: Most labelled rows on which the logistic curve is fitted, the first by a hash of the id.
CALIBRATION = 5000
TOXIC_FROM = 0.3
#: Distinct words that a task counts before it writes them out.
FLUSH = 200_000


def expressions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The packed expressions of all bytes of ``words`` and of their ends, and the index of each one's word."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    grams = data[1:].astype(np.int64)
    alive = np.ones(len(grams), bool)
    for k in range(1, ORDER):
        before = np.zeros(len(grams), np.int64)
        before[k - 1 :] = data[: max(0, len(data) - k)]
        alive[: k - 1] = False
        grams |= np.where(alive, before, 0) << (8 * k)
        alive &= before != 32
    ends = data[1:] == 32
    return grams, np.concatenate([[0], np.cumsum(ends)[:-1]])


class Evidence:
    """The differences of log-probabilities of a block's expressions."""

    def __init__(self, grams: np.ndarray, llr: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.llr = grams[order], llr[order]

    def of_words(self, words: list[bytes]) -> np.ndarray:
        grams, word = expressions(words)
        at = np.searchsorted(self.grams, grams)
        if len(grams) and not (at.max() < len(self.grams) and np.array_equal(self.grams[at], grams)):
            raise RuntimeError("expressions of a block are missing: its documents have changed between two reads")
        return np.bincount(word, self.llr[at], len(words))

    def features(self, texts: list[bytes | None], cache: dict[bytes, float]) -> np.ndarray:
        """Per text: the difference of log-likelihoods by its bytes, that of its strongest words by their number, and log words."""
        docs = [split_words(t.lower()) if t else [] for t in texts]
        new = list({w for d in docs for w in d if w not in cache})
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            cache.update(zip(some, self.of_words(some).tolist(), strict=True))
        out = np.zeros((len(docs), FEATURES))
        for i, d in enumerate(docs):
            if d:
                x = np.fromiter(map(cache.__getitem__, d), np.float64, len(d))
                best = np.sort(np.partition(x, -STRONGEST)[-STRONGEST:] if len(x) > STRONGEST else x)
                out[i] = x.sum() / sum(len(w) + 1 for w in d), best.sum() / STRONGEST, np.log1p(len(x))
        return out


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def count_expressions(rows: DataFrame) -> DataFrame:
    """gram, n1, n0: how often all texts of ``rows`` (text, y) of each class have each expression."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            grams, word = expressions(words) if words else (np.empty(0, np.int64), np.empty(0, np.int64))
            keys, at = np.unique(grams, return_inverse=True)
            sums = [np.bincount(at, np.array([c[w] for w in words], np.float64)[word], len(keys)).astype(np.int64) if words else np.empty(0, np.int64) for c in (seen[1], seen[0])]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums)], ["gram", "n1", "n0"])

        for batch in batches:
            for data, y in zip(utf8(batch.column("text")), batch.column("y").to_pylist(), strict=True):
                seen[y].update(split_words(data.lower()))
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield flush()
        yield flush()

    return rows.mapInArrow(count, "gram long, n1 long, n0 long").groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def shared_chain(grams: DataFrame) -> DataFrame:
    """gram, p: the probability of the last byte of expressions without their first byte, from continuation counts of all orders."""
    d, levels, current = DISCOUNT, [], grams.select("gram")
    for order in range(ORDER - 1, 0, -1):
        inner = F.col("gram").bitwiseAND((1 << (8 * order)) - 1)
        current = staged(current.groupBy(inner.alias("gram")).agg(F.count("*").alias("ends")), "continuations")
        levels.append(current)
    below = None
    for order, level in zip(range(1, ORDER), reversed(levels), strict=True):
        level = level.withColumns({"context": F.shiftright("gram", 8), "lower": F.col("gram").bitwiseAND((1 << (8 * (order - 1))) - 1)})
        contexts = level.groupBy("context").agg(F.sum("ends").alias("all_ends"), F.count("*").alias("kinds"))
        joined = level.join(contexts, "context")
        joined = joined.withColumn("q", F.lit(1 / BASE)) if below is None else joined.join(below.select(F.col("gram").alias("lower"), F.col("p").alias("q")), "lower")
        below = staged(joined.select("gram", ((F.col("ends") - d) / F.col("all_ends") + d * F.col("kinds") / F.col("all_ends") * F.col("q")).alias("p")), "chain")
    discard(*levels)
    return below


def ratios(grams: DataFrame) -> DataFrame:
    """context, unseen, seen: log-probability in class 1 less that in class 0, of bytes that neither class has seen behind the context and of those seen."""
    d = DISCOUNT
    g = grams.select("gram", "n1", "n0", F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND((1 << (8 * (ORDER - 1))) - 1).alias("inner"))
    contexts = staged(g.groupBy("context").agg(*(f(c).alias(f"{a}_{c}") for c in ("n1", "n0") for a, f in (("sum", F.sum), ("kinds", lambda c: F.count_if(F.col(c) > 0))))), "contexts")
    chain = shared_chain(grams)

    def gamma(c: str) -> Column:
        return F.when(F.col(f"sum_{c}") > 0, d * F.col(f"kinds_{c}") / F.col(f"sum_{c}")).otherwise(F.lit(1.0))

    def probability(c: str) -> Column:
        own = F.when(F.col(f"sum_{c}") > 0, F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(f"sum_{c}")).otherwise(F.lit(0.0))
        return own + gamma(c) * F.col("p")

    llr = F.log(probability("n1") / probability("n0")).cast("float")
    seen = g.join(contexts, "context").join(chain.withColumnRenamed("gram", "inner"), "inner").select("context", F.struct(F.col("gram").bitwiseAND(255).cast("int").alias("byte"), llr.alias("llr")).alias("e"), F.log(gamma("n1") / gamma("n0")).cast("float").alias("unseen"))
    out = staged(seen.groupBy("context").agg(F.first("unseen").alias("unseen"), F.map_from_entries(F.collect_list("e")).alias("seen")), "ratios")  # at most 256 bytes
    discard(contexts, chain)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray] | None:
    """The table of ``ratios`` and the weights of the logistic curve; None without both classes.

    Learns from the rows of ``labels`` (doc_id, toxic) that ``held_out`` does not name.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y")).where("y in (0, 1)")
    texts = docs.where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    curve = F.floor(F.crc32(F.col("doc_id").cast("string")) / 4) % 8 == 0  # an eighth, and of that a bounded number, is kept out of the counts
    chosen = staged(known.where(curve).join(texts.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION), "chosen")
    counted = known.join(F.broadcast(chosen), "doc_id", "left_anti")  # bounded
    grams = staged(count_expressions(texts.join(counted.hint("merge"), "doc_id").select("text", "y")), "expressions")
    sums = grams.agg(F.sum("n1"), F.sum("n0")).first()
    if not sums[0] or not sums[1]:
        return None
    model = ratios(grams)
    discard(grams)
    rows = staged(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")), "curve")
    rows = _featurised(rows, model, np.zeros(FEATURES + 1), "y int").toPandas()
    if rows["y"].nunique() < 2:
        return model, np.array(PLAIN)
    return model, logistic(np.frombuffer(b"".join(rows["features"]), np.float64).reshape(-1, FEATURES), rows["y"].to_numpy())


def _featurised(rows: DataFrame, model: DataFrame, curve: np.ndarray, extra: str) -> DataFrame:
    size = rows.agg(F.sum(F.octet_length("text") + ROW)).first()[0] or 0
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK + 1))).groupBy("block")
    name = extra.split()[0]

    def distinct(block: pa.Table) -> pa.Table:
        words: set[bytes] = set()
        for data in utf8(block.column("text")):
            words.update(split_words(data.lower()))
        grams = np.unique(expressions(list(words))[0]) if words else np.empty(0, np.int64)
        return pa.table({"block": pa.array(np.full(len(grams), block.column("block")[0].as_py(), np.int64)), "gram": pa.array(grams)})

    # Written between, so that the texts of one shuffle only are on disk at a time.
    grams = staged(dealt.applyInArrow(distinct, "block long, gram long"), "block-expressions")
    known = grams.withColumn("context", F.shiftright("gram", 8)).join(model.hint("merge"), "context", "left")
    llr = F.coalesce(F.col("seen")[F.col("gram").bitwiseAND(255).cast("int")], "unseen", F.lit(0.0).cast("float"))
    evidence = staged(known.select("block", "gram", llr.alias("llr")), "evidence")
    discard(grams)

    def read(block: pa.Table, evidence: pa.Table) -> pa.Table:
        of, cache = Evidence(evidence.column("gram").to_numpy(), evidence.column("llr").to_numpy()), {}
        found, texts = [np.empty((0, FEATURES))], utf8(block.column("text"))
        for at in range(0, len(texts), 256):
            found.append(of.features(texts[at : at + 256], cache))
        f = np.concatenate(found)
        return pa.table({"doc_id": block.column("doc_id"), "by_length": f[:, 0].copy(), "strongest": f[:, 1].copy(), "features": pa.array([x.tobytes() for x in f], pa.binary()), "score": sigmoid(f @ curve[:-1] + curve[-1]), name: block.column(name)})

    return dealt.cogroup(evidence.groupBy("block")).applyInArrow(read, f"doc_id long, by_length double, strongest double, features binary, score double, {extra}")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, by_length, strongest (the two normalised differences).

    Only the text is an input of a score. Rows that ``held_out`` names are never learnt from.

    Edge cases: null and empty texts have no evidence and get the score of none; without labels of both classes every
    score is 0; equal texts have equal scores; rows without doc_id are scored and not held out; an empty table gives
    no rows; other columns are ignored.
    """
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    if model is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0.0).alias("by_length"), F.lit(0.0).alias("strongest"))
    else:
        scored = _featurised(rows, *model, "held_out boolean")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "by_length", "strongest")
