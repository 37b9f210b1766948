"""Document fingerprints from prefix arrays of polynomial hashes.

A prefix array holds, for every position of a text, the sum of its characters' code points times powers of a base,
modulo the prime 2**31 - 1. The hash of any span is a difference of two entries, moved to the origin by a power; so any
two spans compare in constant time and longest common extensions are found by binary search. Two bases make chance
agreement of different spans about 2**-62 for short spans.

A fingerprint is the hash of the whole text and a bottom-k sketch of the hashes of all its spans of a fixed length, and of
the shorter spans at its two ends (as if blanks stood before and behind the text), so that texts of any lengths have spans
of the same kinds. The likeness of two fingerprints estimates the share of spans that the texts have in common.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix

PRIME = (1 << 31) - 1
BASES = (911382323, 972663749)
#: Characters of a span; spans that a sketch keeps.
SPAN, KEEP = 8, 48


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x below 2**62."""
    p = np.uint64(PRIME)
    x = (x & p) + (x >> np.uint64(31))
    x = (x & p) + (x >> np.uint64(31))
    return np.where(x >= p, x - p, x)


class Powers:
    """Powers of the bases and of their inverses, extended as longer texts come."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def upto(self, n: int) -> None:
        for i, base in enumerate(BASES):
            for table, factor in ((self.up, base), (self.down, pow(base, -1, PRIME))):
                while len(table[i]) < n:
                    table[i] = np.concatenate([table[i], reduced(table[i] * np.uint64(pow(factor, len(table[i]), PRIME)))])


class Prefixes:
    """The prefix arrays of a text (an array of code points)."""

    def __init__(self, points: np.ndarray, powers: Powers):
        powers.upto(len(points) + 1)
        self.n, self.powers = len(points), powers
        self.sums = []
        for up in powers.up:
            terms = reduced((points.astype(np.uint64) + np.uint64(1)) * up[: self.n])
            # Sums of up to 2**31 terms below 2**31 stay below 2**62.
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), reduced(np.cumsum(terms))]))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """62-bit hashes of the spans of ``length`` characters at ``starts``."""
        out = np.zeros(len(starts), np.uint64)
        for sums, down in zip(self.sums, self.powers.down, strict=True):
            out = (out << np.uint64(31)) | reduced(reduced(sums[starts + length] + np.uint64(PRIME) - sums[starts]) * down[starts])
        return out

    def all_spans(self, length: int) -> np.ndarray:
        """62-bit hashes of all spans of ``length`` characters."""
        m, out = self.n - length + 1, np.uint64(0)
        for sums, down in zip(self.sums, self.powers.down, strict=True):
            out = (out << np.uint64(31)) | reduced(reduced(sums[length:] + np.uint64(PRIME) - sums[:m]) * down[:m])
        return out

    def span(self, start: int, length: int) -> int:
        """The hash of one span, in Python's integers (their cost does not depend on the array)."""
        out = 0
        for sums, down in zip(self.sums, self.powers.down, strict=True):
            out = out << 31 | (int(sums[start + length]) - int(sums[start])) * int(down[start]) % PRIME
        return out


def equal_spans(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether a[i : i + length] and b[j : j + length] have equal hashes."""
    return i + length <= a.n and j + length <= b.n and a.span(i, length) == b.span(j, length)


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common extension of a from i and b from j, by binary search."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        half = (lo + hi + 1) // 2
        if a.span(i, half) == b.span(j, half):
            lo = half
        else:
            hi = half - 1
    return lo


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def span_hashes(of: Prefixes) -> np.ndarray:
    """Mixed hashes of all spans of a text: of SPAN characters inside, and of fewer at its start and at its end."""
    inside = of.all_spans(SPAN) if of.n >= SPAN else np.empty(0, np.uint64)
    short = range(1, min(SPAN - 1, of.n) + 1)
    # The two top bits, which hashes of spans leave free, tell the three kinds apart.
    ends = [of.span(0, k) | 1 << 62 for k in short] + [of.span(of.n - k, k) | 2 << 62 for k in short]
    return mix(np.concatenate([inside, np.array(ends, np.uint64)]))


def sketch(of: Prefixes) -> np.ndarray:
    """The smallest distinct hashes of the spans."""
    hashes = span_hashes(of)
    if len(hashes) > 4 * KEEP:
        # Mixed hashes are uniform, so a bound that a few times KEEP of them meet holds the smallest KEEP but by rare chance.
        few = hashes[hashes < np.uint64(min((1 << 64) - 1, (1 << 64) // len(hashes) * 4 * KEEP))]
        some = np.unique(few)
        if len(some) >= KEEP:
            return some[:KEEP]
    return np.unique(hashes)[:KEEP]


def fingerprint(of: Prefixes) -> tuple[str, np.ndarray]:
    """Hexadecimal digits of the text's length, its hash and its sketch; and the sketch."""
    found = sketch(of)
    # 40 bits of each hash: those that differ among sketches of a few thousand spans.
    cut = np.unique(found >> np.uint64(24))
    return f"{of.n:x}.{of.span(0, of.n):016x}." + "".join(f"{x:010x}" for x in cut.tolist()), cut


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common spans, 2 |A & B| / (|A| + |B|), of texts with sketches ``a`` and ``b``; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:KEEP]
    both = np.intersect1d(np.intersect1d(a, b, assume_unique=True), least, assume_unique=True)
    j = len(both) / len(least)
    return 2 * j / (1 + j)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many characters from the start of ``following``, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


class Fingerprinter:
    """Fingerprints texts one after another; the next text's is kept for when its turn comes."""

    def __init__(self):
        self.powers, self.last = Powers(), (None, None)

    def of(self, text: str) -> tuple[Prefixes, str, np.ndarray]:
        if self.last[0] is None or self.last[0] != text:
            prefixes = Prefixes(code_points(text), self.powers)
            self.last = (text, (prefixes, *fingerprint(prefixes)))
        return self.last[1]

    def row(self, doc: int | None, text: str, following: str) -> tuple:
        prefixes, name, own = self.of(text)
        changed = edited(text, following)
        new = Prefixes(code_points(changed), self.powers)
        new_name, new_sketch = fingerprint(new)
        _, _, next_sketch = self.of(following)
        return doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), name, new_name, likeness(own, new_sketch), likeness(own, next_sketch), common_extension(prefixes, 0, new, 0)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], NAMES)


def end_batch(rows: list[list]) -> pa.RecordBatch:
    types = [pa.int32(), pa.bool_(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types, strict=True)], ["part", "is_first", "doc_id", "text"])


def place(doc: int | None, h: int) -> int:
    """A number that rises with the order of documents: ids descending, none last, then a hash of the text."""
    return ((1 << 64) if doc is None else (1 << 63) - 1 - doc) << 64 | h + (1 << 63)


#: Rows sampled for each border between parts.
SAMPLED = 20


def borders(rows: DataFrame, parts: int) -> list[int]:
    """The first places of all parts but one, from a sample of bounded size of ``rows`` (doc_id, h)."""
    every = max(1, rows.count() // (SAMPLED * parts))
    some = sorted(place(*r) for r in rows.select("doc_id", "h").where(F.pmod(F.xxhash64("doc_id", "h"), F.lit(every)) == 0).distinct().limit(8 * SAMPLED * parts).collect())
    return sorted({some[i * len(some) // parts] for i in range(1, parts)}) if some else []


def part_of(edges: list[int]) -> Column:
    """The part of a document (doc_id, h) between the borders ``edges``."""

    @F.pandas_udf("int")
    def part(docs: pd.Series, missing: pd.Series, hashes: pd.Series) -> pd.Series:
        rows = zip(docs.tolist(), missing.tolist(), hashes.tolist(), strict=True)
        return pd.Series([bisect.bisect_right(edges, place(None if none else d, h)) for d, none, h in rows], dtype="int32")

    return part(F.coalesce("doc_id", F.lit(0).cast("long")), F.col("doc_id").isNull(), "h")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix.

    The next document is the one with the next smaller doc_id; the last one's is the first. The edited text is the text
    with its last third replaced by the start of the next document. near_edited and near_next are the likeness of the
    fingerprint to the edited text's and to the next document's; common_prefix is the longest common extension of the text and the edited text.

    Documents are range-partitioned by doc_id and streamed in order, so each meets its next one in its own task; only
    the two documents at the borders of each partition are brought together afterwards.

    Edge cases: null texts count as empty; empty texts are alike; rows without doc_id come last; rows repeated with one
    doc_id follow each other in order of a hash of their texts; a single document is its own next; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The borders are drawn once, so however often the shuffle is run, a document's part is the same.
    dealt = rows.withColumn("part", part_of(borders(rows, parts)))
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", F.col("doc_id").desc_nulls_last(), "h")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, before, held = Fingerprinter(), None, None
        for batch in batches:
            done = []
            for part, *row in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if part == held:
                    done.append(of.row(*before, row[1]))
                before, held = row, part
            yield batch_of(done)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = [[], [], [], []]

            def put(row: dict, is_first: bool, rows: list[list] = rows) -> None:
                for column, value in zip(rows, (row["part"], is_first, None if is_first else row["doc_id"], row["text"]), strict=True):
                    column.append(value)

            change = np.flatnonzero(np.diff(batch.column("part").to_numpy())) + 1
            for start, end in itertools.pairwise([0, *change.tolist(), batch.num_rows]):
                if start == end:
                    continue
                (first,) = batch.slice(start, 1).to_pylist()
                if last is None or first["part"] != last["part"]:
                    if last is not None:
                        put(last, False)
                    put(first, True)
                (last,) = batch.slice(end - 1, 1).to_pylist()
            yield end_batch(rows)
        if last is not None:
            yield end_batch([[last["part"]], [False], [last["doc_id"]], [last["text"]]])

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter()
        for batch in batches:
            yield batch_of([of.row(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "last", "following")), strict=True)])

    # Partitions stand in a ring of their numbers; a partition's last document and the next one's first meet by the number.
    found = ordered.drop("h").mapInArrow(ends, "part int, is_first boolean, doc_id long, text string")
    ring = F.broadcast(dealt.select("part").distinct().agg(F.sort_array(F.collect_list("part")).alias("parts")))  # as many numbers as partitions
    at = F.array_position("parts", F.col("part")) - 1
    before = F.when(F.col("is_first"), F.pmod(at - 1, F.size("parts"))).otherwise(at)
    met = found.crossJoin(ring).withColumn("spot", before).groupBy("spot").agg(F.max(F.when(~F.col("is_first"), F.struct("doc_id", "text"))).alias("last"), F.max(F.when(F.col("is_first"), F.col("text"))).alias("following"))
    return ordered.select("part", "doc_id", "text").mapInArrow(pairs, SCHEMA).union(met.select("last.doc_id", F.col("last.text").alias("last"), "following").mapInArrow(border, SCHEMA))
