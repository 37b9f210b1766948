"""Exact Jaccard join of documents' shingle sets over points of group counts.

A document's set of shingles is hashed into groups; the numbers of shingles in its groups are its point, with more
groups for larger sets. The overlap of two sets is at most the sum over groups of the smaller count. Two sets differ in
as many shingles, at least, as there are groups where one count is odd and the other even: a bit a group bounds pairs too.

* Routing. Sets of sizes a <= b that link differ in a bounded number D of shingles, (a + b) / 19 for 0.9. The groups are
  gathered into more than D blocks, so some block is equal in both, and its digest is a key that both have. A key
  stands for several shingles together, so a passage that many documents share makes few keys of its own. Documents with
  a key in common are candidates; nothing that links is left out, at any size. A key belongs to a range of sizes, and
  pairs of which the larger set is below that range are left to their own range.
* R-tree. A key's documents are packed into leaf pages by size, pages into nodes; pages and nodes have the largest
  count of each group as their bounding corner. Pairs of nodes are dropped by the bound of their corners, then pairs of
  pages, then pairs of documents by the bits of their points, then by the whole points. Pages are dealt by counts, not
  by a sort, so a key that very many documents share is spread over all tasks.

What survives is verified on the full sets. Equal sets are one node from the start. Each key's members are first
verified against the key's smallest document (as many pairs as rows); only members that are then in different
components meet in the tree. So components of near copies cost as many pairs as members, not their square.

Links are counted afterwards, for those who ask for them: both ends of a link are in one component, so each component's
distinct sets meet each other, in parts of a bounded size that are dealt to all tasks, by products of matrices of the
shingles that they share. This costs the square of a component's distinct sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import WordHashes, connected_components, join_keys, mix, nested, split_words, utf8, windows_of

#: Documents in a page.
PAGE = 256
#: Fewest groups of a point; a point has about as many groups as its set has shingles, a byte for each.
FEWEST = 16
#: Most groups of the points in pages.
COARSE = 128
#: What a count of a page's point stands for when it does not fit into two bytes: more than any overlap.
MANY = 1 << 40
#: Pages of a node; each band of sizes, whose documents share pages, is this much wider than the one before.
NODE, BAND = 32, 1.05
#: Bytes of the sets of a part of a component; shingles and sets that are compared at once.
PART, WIDE, TALL = 16 << 20, 1 << 12, 1 << 9
#: Ids of documents that are sent to all tasks at most (some 60 bytes each in a task's hash table).
SENT = 2_000_000
#: Parts of the key space that are shuffled one after another.
SLICES = 2
#: Keys that must speak for a pair to be verified before pages are made, but for sets of fewer than FEW shingles.
SPOKEN, FEW = 3, 40
#: Each range of sizes is this much wider than the one before; a range has one number of blocks.
WIDER = 1.3
SHINGLE = 0x2545F4914F6CDD1D
#: The lowest bits of a key say which range of sizes it belongs to; there are about a hundred.
RANGE_BITS = 7
PROFILE = "doc_id long, n long, digest binary, point binary, keys array<long>"


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``k`` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return mix(windows_of(words, len(words), 0x5851F42D4C957F2D) + np.uint64(len(words)))
    return np.unique(mix(windows_of(words, k, SHINGLE)))


def lower_words(data: bytes | None) -> list[bytes]:
    return split_words(data.lower()) if data else []  # bytes.lower() changes A-Z only


class Ranges:
    """Size ranges and their numbers of blocks for a threshold of ``percent``."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * WIDER)))
        self.edges = np.array(edges)
        assert len(edges) <= 1 << RANGE_BITS

    def lowest(self, keys: np.ndarray) -> np.ndarray:
        """The smallest size of the ranges that ``keys`` belong to."""
        return self.edges[keys & ((1 << RANGE_BITS) - 1)]

    def reached(self, key: Column, n: Column) -> Column:
        """Whether sets of size ``n`` come up to the range that ``key`` belongs to."""
        low = F.element_at(F.array(*map(F.lit, self.edges.tolist())), key.bitwiseAND(F.lit((1 << RANGE_BITS) - 1)).cast("int") + 1)
        return n >= low

    def most(self, n: int) -> int:
        """A set of size n and a larger one that link differ in at most so many shingles: I >= p U with U = a + b - I."""
        return (n + 100 * n // self.percent) * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> list[tuple[int, int, int, int]]:
        """(range, its blocks, the first so many of which a set of size n needs, its spare blocks), for each range with partners."""
        out = []
        at = int(np.searchsorted(self.edges, n, "right")) - 1
        while self.edges[at] <= 100 * n // self.percent:
            low, top = int(self.edges[at]), int(self.edges[at + 1]) - 1
            most = self.most(max(n, top))
            # Spare blocks make up for empty ones, which say nothing: more than there are in the smallest sets that need them.
            few = low * self.percent // 100
            spare = int(1.5 * (most + 1) * math.exp(-few / (most + 1))) + 1 if most else 0
            out.append((at, most + 1 + spare, self.most(n) + 1 + spare, spare))
            at += 1
        return out


def block_keys(s: np.ndarray, ranges: Ranges) -> np.ndarray:
    """Keys of the blocks of a set: equal if, and but for collisions only if, the block holds the same shingles.

    Of the first D + 1 + spare blocks two linking sets have at least 1 + spare in common. Either one of these is not
    empty, or both sets have 1 + spare empty blocks at the same places: so sets with that many have a key for each
    choice of 1 + spare of their empty blocks too (rarely more than a few).
    """
    keys = []
    content_bits = ~np.uint64((1 << RANGE_BITS) - 1)
    spread = mix(s ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(20)
    for at, blocks, need, spare in ranges.of(len(s)):
        block = (spread % np.uint64(blocks)).astype(np.int64)
        here = block < need
        order = np.argsort(block[here], kind="stable")
        of, content = block[here][order], s[here][order]
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(content + np.uint64(0x632BE59BD9B4E019)))])
        edges = np.searchsorted(of, np.arange(need + 1), "left")
        sizes = np.diff(edges).astype(np.uint64)
        found = mix(total[edges[1:]] - total[edges[:-1]] + np.uint64(0x8EBC6AF09C88C6E3) * sizes + mix(np.arange(need, dtype=np.uint64) + np.uint64(at << 32)))
        keys.append(found[sizes > 0] & content_bits | np.uint64(at))
        empty = np.flatnonzero(sizes == 0).tolist()
        if len(empty) > spare:
            keys.append(np.array([xxhash.xxh3_64_intdigest(repr((at, some)).encode()) for some in itertools.combinations(empty, spare + 1)], np.uint64) & content_bits | np.uint64(at))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def point(s: np.ndarray) -> np.ndarray:
    """The numbers of shingles in groups; a power of two of them, so that points of different lengths can be folded."""
    groups = max(FEWEST, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    while True:
        counts = np.bincount((s >> np.uint64(24)).astype(np.int64) & (groups - 1), minlength=groups)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        groups *= 2


def fold(x: np.ndarray, groups: int) -> np.ndarray:
    return x if len(x) == groups else x.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def profiles(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n (size of the set), digest of the set, point, keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranges = WordHashes(), Ranges(percent)
        for batch in batches:
            n, digests, points, keys, ends = [], [], [], [], [0]
            for data in utf8(batch.column(1)):
                s = shingles(hashes.of(lower_words(data)), k)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                points.append(point(s).tobytes())
                keys.append(block_keys(s, ranges))
                ends.append(ends[-1] + len(keys[-1]))
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(points, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["doc_id", "n", "digest", "point", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, PROFILE)


def sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, s: the set of shingles."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingles(hashes.of(lower_words(data)), k).view(np.int64) for data in utf8(batch.column(1))]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))], ["doc_id", "s"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, s array<long>")


def bounded(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these points and sizes can link: sum of coordinate minima against the overlap that a link needs."""
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64) * (100 + percent) >= percent * (na + nb)


def coarse() -> Column:
    """A point folded to COARSE coordinates, for rows that are there once for each key."""

    @F.pandas_udf("binary")
    def folds(points: pd.Series) -> pd.Series:
        return points.map(lambda x: np.minimum(fold(np.frombuffer(x, np.uint8).astype(np.int64), min(COARSE, len(x))), 65535).astype("<u2").tobytes())

    return folds("point")


def odd_groups() -> Column:
    """A bit for each group of a point: whether its count is odd."""

    @F.pandas_udf("binary")
    def bits(points: pd.Series) -> pd.Series:
        return points.map(lambda x: np.packbits(np.frombuffer(x, np.uint8) & 1).tobytes())

    return bits("point")


def bit_matrix(bits: list[bytes], width: int) -> np.ndarray:
    """Bits as rows of ``width`` bytes, in words as wide as fit; longer ones are folded, which adds up counts of groups."""
    rows = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, width), axis=0) for x in bits])
    return rows.view(np.uint64 if width % 8 == 0 else np.uint16)


def size_bound(na: int, nb: int, percent: int) -> bool:
    return min(na, nb) * 100 >= percent * max(na, nb)


def folded(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two points with as many coordinates as the shorter one has."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    groups = min(len(a), len(b))
    return fold(a, groups), fold(b, groups)


def prune(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that the bound of their points lets through."""
    joined = pairs.join(points.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a")
    joined = joined.join(points.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b")

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = [bool(size_bound(na, nb, percent) and bounded(*folded(x, y), na, nb, percent)) for x, y, na, nb in zip(f["pa"], f["pb"], f["na"], f["nb"], strict=True)]
            yield f.loc[keep, ["a", "b"]]

    return joined.mapInPandas(check, "a long, b long")


def those(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``docs`` joined with the ids of some of them (doc_id, distinct, staged).

    Up to SENT ids, which are counted, go to all tasks, so that whole texts need not be shuffled to find a few of them.
    """
    return docs.join(F.broadcast(ids) if ids.count() <= SENT else ids, "doc_id", how)


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets link."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    held = staged(sets(those(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids), k), "sets")
    both = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a").join(held.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * 100 >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def matrix(points: list[bytes], groups: int) -> np.ndarray:
    """Coarse points as rows of ``groups`` coordinates."""

    def counts(x: bytes) -> np.ndarray:
        short = np.frombuffer(x, "<u2").astype(np.int64)
        return fold(np.where(short == 65535, MANY, short), groups)

    return np.stack([counts(x) for x in points])


def corner(points: list[bytes]) -> bytes:
    """The largest count of each group, in the coordinates of the shortest point."""
    return np.minimum(matrix(points, min(len(x) for x in points) // 2).max(axis=0), 65535).astype("<u2").tobytes()


class Members:
    """The documents of a page: a struct array of doc_id, comp, n, bits."""

    def __init__(self, m: pa.StructArray):
        self.doc, self.comp, self.n = (m.field(c).to_numpy() for c in ("doc_id", "comp", "n"))
        self.bits = m.field("bits").to_pylist()
        self.width = min(map(len, self.bits))

    def pairs(self, other: Members, percent: int, low: int) -> list[np.ndarray]:
        """Pairs of ids, the smaller first, of different components that can link and whose larger set has ``low`` shingles at least."""
        width = min(self.width, other.width)
        a, b = bit_matrix(self.bits, width), bit_matrix(other.bits, width)
        out = []
        for i in range(len(a)):
            least, most = np.minimum(self.n[i], other.n), np.maximum(self.n[i], other.n)
            j = np.flatnonzero((other.comp != self.comp[i]) & (most >= low) & (least * 100 >= percent * most))
            differ = np.bitwise_count(a[i] ^ b[j]).sum(axis=1, dtype=np.int64)
            j = j[differ * (100 + percent) <= (100 - percent) * (self.n[i] + other.n[j])]
            if len(j):
                out.append(np.stack([np.minimum(self.doc[i], other.doc[j]), np.maximum(self.doc[i], other.doc[j])], axis=1))
        return out


def pair_batch(pairs: list[np.ndarray]) -> pa.RecordBatch:
    """The distinct ``pairs``: one pair can have many keys."""
    found = np.unique(np.concatenate([np.empty((0, 2), np.int64), *pairs]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])


def tree_pairs(rows: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rows`` (key, doc_id, comp, n) with one key, of different components, that can link.

    ``points``: doc_id, point, bits. Documents of a key and a band of sizes are dealt to leaf pages, pages to nodes. Nodes meet
    where their sizes can; then their corners, their pages' corners, and at last the bits of the documents decide.
    """
    ranges = Ranges(percent)
    banded = rows.withColumn("band", F.floor(F.log("n") / math.log(BAND)))
    counts = banded.groupBy("key", "band").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    of_key = Window.partitionBy("key")  # a row for each band of the sizes that one key can have: a few
    beside = of_key.orderBy("band")
    counts = counts.withColumns({"down": F.lag("hi").over(beside), "up": F.lead("lo").over(beside)})
    # Rows with no other row of a near enough size beside them have no partner under this key.
    counts = counts.where((F.col("c") > 1) | (F.col("down") * 100 >= percent * F.col("lo")) | (F.col("hi") * 100 >= percent * F.col("up")))
    counts = counts.select("key", "band", "c", F.ceil(F.col("c") / PAGE).alias("pages"))
    # All documents of a key that fit on one page are on one, whatever their bands.
    one = F.sum("c").over(of_key) <= PAGE
    counts = counts.withColumns({"all_pages": F.when(one, 1).otherwise(F.sum("pages").over(of_key)), "leaf": F.when(one, F.min("band").over(of_key)).otherwise(F.col("band"))})
    counts = staged(counts, "page-counts")
    placed = join_keys(banded, counts, ["key", "band"], "c", rows.count(), F.xxhash64("doc_id"))
    placed = placed.withColumn("page", F.pmod(F.xxhash64("doc_id"), "pages")).withColumn("band", F.col("leaf")).join(points, "doc_id")
    # Only pages that meet others need corners, and so points.
    placed = placed.withColumn("point", F.when(F.col("all_pages") > 1, F.col("point")))
    pages = placed.groupBy("key", "band", "page").agg(F.first("all_pages").alias("all_pages"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.collect_list(F.struct("doc_id", "comp", "n", "bits")).alias("m"), F.collect_list("point").alias("points"))
    pages = staged(pages, "pages")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = ranges.lowest(batch.column("key").to_numpy())
            pages = [Members(m.values) for m in batch.column("m")]
            yield pair_batch([x for p, least in zip(pages, low, strict=True) for x in p.pairs(p, percent, least)])

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [corner(points.values.to_pylist()) for points in batch.column("points")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], [*batch.schema.names[:-1], "corner"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, p1, p2 in zip(batch.column("key").to_pylist(), batch.column("p1").to_pylist(), batch.column("p2").to_pylist(), strict=True):
                groups = min(len(x["corner"]) for x in (*p1, *p2)) // 2
                a, b = (matrix([x["corner"] for x in p], groups) for p in (p1, p2))
                lo1, lo2 = (np.array([x["lo"] for x in p]) for p in (p1, p2))
                if not bounded(a.max(axis=0), b.max(axis=0), lo1.min(), lo2.min(), percent):
                    continue
                for i, x in enumerate(p1):
                    for j in np.flatnonzero(bounded(a[i][None, :], b, lo1[i], lo2, percent)).tolist():
                        y = p2[j]
                        if (x["band"], x["page"]) <= (y["band"], y["page"]) and size_bound(x["hi"], y["lo"], percent) | (x["hi"] >= y["lo"]):
                            out.append((key, x["band"], x["page"], y["band"], y["page"]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "band1", "page1", "band2", "page2"])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = ranges.lowest(batch.column("key").to_numpy())
            yield pair_batch([x for m1, m2, least in zip(batch.column("m1"), batch.column("m2"), low, strict=True) for x in Members(m1.values).pairs(Members(m2.values), percent, least)])

    many = pages.where("all_pages > 1")
    leaves = many.select("key", "band", "page", "all_pages", "lo", "hi", "points").mapInArrow(corners, "key long, band long, page long, all_pages long, lo long, hi long, corner binary")
    node = F.floor(F.col("page") / NODE).alias("node")
    nodes = leaves.groupBy("key", "band", node).agg(F.first("all_pages").alias("all_pages"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list(F.struct("band", "page", "lo", "hi", "corner")).alias("p"))
    nodes = staged(nodes, "nodes")
    # The nodes of a key with very many of them meet in several tasks.
    deals = F.ceil(F.col("all_pages") / (8 * NODE))
    left = nodes.select("key", *(F.col(c).alias(f"{c}1") for c in ("band", "node", "hi", "p")), F.explode(F.sequence(F.lit(0).cast("long"), deals - 1)).alias("deal"))
    right = nodes.select("key", *(F.col(c).alias(f"{c}2") for c in ("band", "node", "lo", "p")), F.pmod(F.xxhash64("band", "node"), deals).alias("deal"))
    met = left.join(right, ["key", "deal"]).where(f"(band1 < band2 or band1 = band2 and node1 <= node2) and lo2 * {percent} <= hi1 * 100").select("key", "p1", "p2")
    found = staged(met.mapInArrow(descend, "key long, band1 long, page1 long, band2 long, page2 long"), "page-pairs")
    for i in (1, 2):
        found = found.join(many.select("key", F.col("band").alias(f"band{i}"), F.col("page").alias(f"page{i}"), F.col("m").alias(f"m{i}")), ["key", f"band{i}", f"page{i}"])
    pairs = pages.where("all_pages = 1").select("key", "m").mapInArrow(alone, "a long, b long").union(found.select("key", "m1", "m2").mapInArrow(cross, "a long, b long"))
    return pairs.distinct()


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """The numbers of shingles that each of the sets ``xs`` has in common with each of ``ys``; sets are sorted.

    Only shingles that can be in common have a place in the matrices: those in several sets, or on both sides.
    """
    if xs is ys:
        words, n = np.unique(np.concatenate(ys), return_counts=True)
        words = words[n > 1]
        alone = np.array([len(s) for s in xs])
    else:
        words, alone = np.intersect1d(np.concatenate(xs), np.concatenate(ys)), None
    out = np.zeros((len(xs), len(ys)), np.float32)

    def held(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(sets), len(some)), np.float32)
        for row, s in zip(rows, sets, strict=True):
            s = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], "right")]
            at = np.searchsorted(some, s)
            row[at[some[at] == s]] = 1
        return rows

    for start in range(0, len(words), WIDE):
        some = words[start : start + WIDE]
        right = held(ys, some).T
        for at in range(0, len(xs), TALL):
            out[at : at + TALL] += held(xs[at : at + TALL], some) @ right
    np.rint(out, out=out)
    if alone is not None:
        np.fill_diagonal(out, alone)
    return out


def count_links(groups: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """digest, n: documents whose set links with the set or is equal to it, for the ``groups`` (digest, node, n, comp, n_docs) with others in their component."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingles(hashes.of(lower_words(data)), k).tobytes() for data in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in found], pa.binary()), pa.array(found, pa.binary())], ["digest", "s"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, totals = [], []
            for lo, hi, members in zip(*(batch.column(c).to_pylist() for c in ("lo", "hi", "m")), strict=True):
                a, b = ([x for x in members if x["part"] == p] for p in (lo, hi))
                if not a or not b:
                    continue
                (sa, na, wa), (sb, nb, wb) = ((sets, np.array([len(s) for s in sets]), np.array([x["n_docs"] for x in m])) for m, sets in ((m, [np.frombuffer(x["s"], np.uint64) for x in m]) for m in (a, b)))
                sb = sa if lo == hi else sb
                common, of_a, of_b = overlaps(sa, sb), [], np.zeros(len(b), np.int64)
                for at in range(0, len(a), TALL):
                    links = common[at : at + TALL].astype(np.int64) * (100 + percent) >= percent * (na[at : at + TALL, None] + nb)
                    of_a.append(links @ wb)
                    of_b += wa[at : at + TALL] @ links
                for m, sums in ((a, np.concatenate(of_a)), (b, of_b))[: 1 + (lo != hi)]:
                    digests.extend(x["digest"] for x in m)
                    totals.extend(sums.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(totals, pa.int64())], ["digest", "n"])

    parts = groups.groupBy("comp").agg(F.count("*").alias("members"), F.sum(F.col("n") * 8 + 64).alias("bytes")).where("members > 1").select("comp", F.ceil(F.col("bytes") / PART).alias("parts"))
    dealt = groups.join(parts, "comp").withColumn("part", F.pmod(F.xxhash64("digest"), "parts"))
    ids = staged(dealt.select(F.col("node").alias("doc_id")).distinct(), "ids")
    held = those(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids).select("text").mapInArrow(read, "digest binary, s binary").dropDuplicates(["digest"])
    # Each part meets every other: a row for each part of its component.
    rows = dealt.join(staged(held, "whole-sets"), "digest").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select("comp", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), F.struct("part", "digest", "n_docs", "s").alias("m"))
    return rows.groupBy("comp", "lo", "hi").agg(F.collect_list("m").alias("m")).select("lo", "hi", "m").mapInArrow(count, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, n_links.

    Words are runs without ASCII white space, with A-Z in lower case; a document's set holds its distinct runs of
    ``k`` words, or its whole sequence if it has fewer. Two documents link when 100 |A & B| >= percent |A | B|;
    component_id is the smallest doc_id that links reach. n_links counts the other documents that the document links with,
    those with an equal set among them.

    Edge cases: null and empty texts and texts of white space have no shingles and link with nothing; rows with one
    doc_id are one document (with different sets, one for each set in n_links); rows without doc_id have component_id
    null and count for no other's n_links; an empty table gives no rows; other columns are ignored.
    """
    small, groups = components_of_sets(docs, k, percent)
    counted = staged(count_links(groups, docs.where("doc_id is not null"), k, percent).withColumnRenamed("n", "linked"), "counted")
    of_digest = groups.join(counted, "digest", "left").select("digest", "comp", "n_docs", F.coalesce("linked", "n_docs").alias("linked"))
    out = placed_documents(small, of_digest)
    links = F.coalesce("linked", F.lit(0)) - F.when(F.col("doc_id").isNotNull(), 1).otherwise(0)
    return out.select("doc_id", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, links).otherwise(F.lit(0)).alias("n_links"))


def placed_documents(small: DataFrame, of_digest: DataFrame) -> DataFrame:
    """The documents ``small`` (doc_id, n, digest) with component_id and the columns of their sets (digest, n_docs, comp, ...)."""
    # Empty sets have no component; their ids stand for the digest in the join, so that they are dealt to all tasks.
    keyed = small.withColumn("digest", F.when(F.col("n") > 0, F.col("digest")).otherwise(F.xxhash64("doc_id").cast("string").cast("binary")))
    met = join_keys(keyed, of_digest, ["digest"], "n_docs", small.count(), F.xxhash64("doc_id"), "left")
    comp = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("comp"))).otherwise(F.col("doc_id"))
    return met.withColumn("component_id", comp).withColumnRenamed("n", "n_shingles")


def components_of_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, digest) of all rows; and of the distinct sets digest, node (the smallest document), n, comp, n_docs."""
    known = docs.where("doc_id is not null")
    rows = staged(profiles(docs, k, percent), "profiles")
    full = rows.where("doc_id is not null and n > 0")
    nodes = staged(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.countDistinct("doc_id").alias("n_docs")), "nodes")
    small = staged(rows.select("doc_id", "n", "digest"), "sizes")
    reps = nodes.select(F.col("node").alias("doc_id")).distinct()
    # Other documents than these are few: they are sent to all tasks, so that neither points nor keys are shuffled to be told apart.
    others = staged(full.select("doc_id").distinct().join(reps, "doc_id", "left_anti"), "others")
    points = staged(those(full.select("doc_id", "n", "point"), others, "left_anti"), "points")
    # A key's smallest document stands for its set. The keys are shuffled in slices, so that only a part is on disk at once.
    slices, ranges = [], Ranges(percent)
    for i in range(SLICES):
        keyed = full.select("doc_id", "n", F.explode("keys").alias("key")).where(F.pmod(F.shiftright("key", RANGE_BITS), F.lit(SLICES)) == i)
        shared = keyed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"), F.max(ranges.reached(F.col("key"), F.col("n"))).alias("reached")).where("hub <> last and reached").select("key", "hub")
        slices.append(staged(those(keyed.select("doc_id", "key").join(shared, "key"), others, "left_anti"), "together"))
    discard(rows)
    together = reduce(DataFrame.union, slices)
    sizes = points.select("doc_id", "n")
    members = staged(together.join(sizes, "doc_id").join(sizes.select(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n")), "hub"), "members")
    discard(*slices)

    near = F.least("n", "hub_n") * 100 >= percent * F.greatest("n", "hub_n")
    # First the pairs that several keys speak for, to join what is plainly alike; the pages below meet all others.
    spoken = members.where((F.col("doc_id") != F.col("hub")) & near).groupBy(F.col("hub").alias("a"), F.col("doc_id").alias("b")).agg(F.count("*").alias("keys"), F.first("n").alias("n"))
    stars = staged(spoken.where((F.col("keys") >= SPOKEN) | (F.col("n") < FEW)).select("a", "b"), "candidates")
    links = staged(verified(staged(prune(stars, points, percent), "stars"), known, k, percent), "links")
    comps = connected_components(links)
    placed = members.select("key", "doc_id", "n").join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("comp"))
    placed = staged(placed, "placed")
    discard(members)
    mixed = placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key")
    rest = staged(placed.join(mixed, "key"), "rest")
    discard(placed)
    crossing = tree_pairs(rest, points.select("doc_id", coarse().alias("point"), odd_groups().alias("bits")), percent).join(stars, ["a", "b"], "left_anti")
    crossing = staged(prune(staged(crossing, "crossing"), points, percent), "pruned")
    discard(rest, stars)
    links = staged(links.union(verified(crossing, known, k, percent)), "all-links")
    comps = connected_components(links)
    discard(points, crossing)

    of_node = nodes.join(comps.withColumnRenamed("id", "node"), "node", "left")
    return small, staged(of_node.select("digest", "node", "n", F.coalesce("component", "node").alias("comp"), "n_docs"), "of-digest")


def drop_near_copies(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, and those without doc_id; all their columns.

    Edge cases are those of ``jaccard_components``: texts without words link with nothing and stay, rows repeated with
    one doc_id are one document and stay or go together, an empty table stays empty, columns of any names pass through.
    """
    small, groups = components_of_sets(docs, k, percent)
    gone = staged(placed_documents(small, groups.select("digest", "n_docs", "comp")).where("doc_id > component_id").select("doc_id").distinct(), "gone")
    return those(nested(docs, doc_id=F.col("doc_id").cast("long")), gone, "left_anti").select("rows.*")
