"""Best-fit packing of tokenised documents into training sequences, in bulk-synchronous rounds.

Each round range-sorts the pieces that are left and the gaps of open sequences together, by size. A sweep through the
sorted rows lets every gap take the largest free piece that fits it: pieces are opening and gaps closing brackets, and
matching brackets meet. Tasks sweep their ranges by themselves; what finds no partner in its own range is ranked there,
and ranks of different ranges are matched by the numbers of free pieces and gaps of each range, the nearest range of
smaller pieces first. So each piece is wanted by one gap only. Then gaps shrink by what they took, gaps that no piece
fits close, and the next round begins, until no piece is left.

New sequences are opened by the difference of the tokens that are left and the room of open gaps, so never more than any
way to go on needs, and otherwise only when a round places nothing. A gap of several times the largest piece takes
several pieces in a round.

The driver sees two sums of each round and two counts for each range, not pieces or gaps.
"""

from __future__ import annotations

import base64
import functools
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, staged

MAX_TOKENS = 2048
END_OF_DOCUMENT = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, id long"
#: Rows of a range of a sweep at most, and at least where there are fewer ranges than shuffle partitions.
RANGE, SMALL_RANGE = 2_000_000, 20_000
#: Kinds of rows of a sweep.
PIECE, GAP, MATCH = 0, 1, 2
SWEPT = "kind int, id long, n long, seq long, part int, rank long"


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _ranks(path: str, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: Beyond these characters the two libraries may know different versions of Unicode's classes.
_OTHER = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")


def encode(texts: list[str], tokenizer: str, ranks: str | None, pattern: str | None) -> list[list[int]]:
    """Ids as ``tokenizers`` gives them. For Latin text without special tokens the ranks of the same vocabulary give the same ids, faster."""
    out: list = [None] * len(texts)
    slow = [i for i, x in enumerate(texts) if ranks is None or "<|" in x or _OTHER.search(x)]
    for i, e in zip(slow, _tokenizer(tokenizer).encode_batch([texts[i] for i in slow], add_special_tokens=False) if slow else [], strict=True):
        out[i] = e.ids
    fast = _ranks(ranks, pattern) if ranks else None
    for i, x in enumerate(texts):
        if out[i] is None:
            out[i] = fast.encode_ordinary(x)
    return out


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole, or pieces of ``most`` tokens behind a first one with the rest."""
    if n <= most:
        return [(0, n)]
    first = n % most
    return ([(0, first)] if first else []) + [(s, most) for s in range(first, n, most)]


def tokenised(docs: DataFrame, tokenizer: str, ranks: str | None, pattern: str | None, most: int) -> DataFrame:
    """The pieces of all documents, each with a number of its own."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: tuple = ([], [], [], [], [], [])
            for at in range(0, len(texts), 64):
                for doc, ids in zip(ids_of[at : at + 64], encode(texts[at : at + 64], tokenizer, ranks, pattern), strict=True):
                    ids.append(END_OF_DOCUMENT)
                    data = np.array(ids, "<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), most)):
                        for column, value in zip(rows, (doc, piece, start, length, zlib.crc32(data[start : start + length]), next(number)), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64()), pa.array(rows[5], pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "id"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(pieces, PIECES)


def brackets(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of size (a piece before a gap of its size): the places of pieces and of the gaps that they go to."""
    depth = np.cumsum(np.where(kind == PIECE, 1, -1))
    level = np.where(kind == PIECE, depth, depth + 1)
    lowest_before = np.minimum.accumulate(np.concatenate([[0], depth]))[:-1]
    lowest_after = np.minimum.accumulate(depth[::-1])[::-1]
    free = np.where(kind == PIECE, lowest_after >= level, depth < lowest_before)
    at = np.flatnonzero(~free)
    at = at[np.lexsort((at, level[at]))]
    return at[0::2], at[1::2]


def swept(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (kind, id, n, seq; gaps have ids too) sorted in ``ranges`` and swept: matches, and the free rows of each range with their rank."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, got = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
        if not got:
            return
        kind, id, n, seq = (np.concatenate([b.column(c).to_numpy() for b in got]) for c in ("kind", "id", "n", "seq"))
        pieces, gaps = brackets(kind)
        free = np.ones(len(kind), bool)
        free[pieces] = free[gaps] = False
        columns = [(np.full(len(pieces), MATCH, np.int32), id[pieces], n[pieces], seq[gaps], np.zeros(len(pieces), np.int64))]
        for which in (PIECE, GAP):
            at = np.flatnonzero(free & (kind == which))
            columns.append((np.full(len(at), which, np.int32), id[at], n[at], seq[at], np.arange(len(at))))
        k, i, n, s, rank = (np.concatenate(c) for c in zip(*columns, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array(n), pa.array(s), pa.array(np.full(len(k), part, np.int32)), pa.array(rank)], [x.split()[0] for x in SWEPT.split(", ")])

    order = ["n", "kind", "id"]
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(sweep, SWEPT)


def resolve(counts: dict[tuple[int, int], int]) -> tuple[list, list]:
    """From the numbers of free rows by (range, kind): runs (range, first rank, number, number of the first match, step) of gaps and of pieces.

    A range's free gaps are smaller than its free pieces; they take the largest pieces of the nearest ranges before.
    """
    open_pieces: list[list[int]] = []
    gaps, pieces, match = [], [], 0
    for part in sorted({p for p, _ in counts}):
        left, rank = counts.get((part, GAP), 0), 0
        while left and open_pieces:
            of, free = open_pieces[-1]
            n = min(left, free)
            gaps.append((part, rank, n, match, 1))
            pieces.append((of, free - n, n, match + n - 1, -1))
            left, rank, match = left - n, rank + n, match + n
            open_pieces[-1][1] -= n
            if not open_pieces[-1][1]:
                open_pieces.pop()
        if counts.get((part, PIECE)):
            open_pieces.append([part, counts[part, PIECE]])
    return gaps, pieces


def numbered(free: DataFrame, runs: list) -> DataFrame:
    """Free rows of one kind with the number of their match; null where ``runs`` has none."""
    runs = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = runs[:, 0] << 40 | runs[:, 1]
        for batch in batches:
            at = batch.column("part").to_numpy().astype(np.int64) << 40 | batch.column("rank").to_numpy()
            of = np.searchsorted(firsts, at, "right") - 1
            i = at - firsts[of]
            inside = (of >= 0) & (i < runs[of, 2])
            match = runs[of, 3] + i * runs[of, 4]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "seq")), pa.array(match, mask=~inside)], ["id", "n", "seq", "match"])

    return free.mapInArrow(number, "id long, n long, seq long, match long") if len(runs) else free.select("id", "n", "seq", F.lit(None).cast("long").alias("match"))


def best_fit(pieces: DataFrame, most: int) -> DataFrame:
    """id, seq of ``pieces`` (id, n <= most): the sequences that rounds of best-fit give them."""
    spark = pieces.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gaps = spark.createDataFrame([], "seq long, n long")
    rounds, opened, stalled, stale = [], 0, False, []
    while True:
        left, tokens, least, largest = pieces.agg(F.count("*"), F.sum("n"), F.min("n"), F.max("n")).first()
        if not left:
            break
        fitting = gaps.where(F.col("n") >= least)
        held, room = fitting.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        new = max(0, -(-(tokens - room) // most)) or (-(-tokens // most) if stalled else 0)
        fresh = spark.range(opened, opened + new).select(F.col("id").alias("seq"), F.lit(most).cast("long").alias("n"))
        opened += new
        live = fitting.union(fresh)
        # A gap takes one piece, or as many as fit whatever their size; each of its slots is a row.
        slots = F.greatest(F.lit(1), F.least(F.floor(F.col("n") / largest), F.lit(math.ceil(2 * left / (held + new)))))
        slot = live.select("seq", F.floor(F.col("n") / slots).alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), slots.cast("long") - 1)).alias("slot"))
        rows = pieces.select(F.lit(PIECE).alias("kind"), "id", "n", F.lit(-1).cast("long").alias("seq")).union(slot.select(F.lit(GAP), F.col("seq") * most + F.col("slot"), "n", "seq"))
        many = left + held + new
        found = staged(swept(rows, max(many // RANGE, min(width, many // SMALL_RANGE)) + 1), "swept")
        by_range = found.where(F.col("kind") != MATCH).groupBy("part", "kind").count().collect()  # two rows for each range
        of_gaps, of_pieces = resolve({(r.part, r.kind): r["count"] for r in by_range})
        placed = found.where(F.col("kind") == MATCH).select("id", "n", "seq")
        free = numbered(found.where(F.col("kind") == PIECE), of_pieces)
        if of_gaps:
            takers = numbered(found.where(F.col("kind") == GAP), of_gaps).where("match is not null").select("match", "seq")
            placed = placed.union(free.where("match is not null").drop("seq").join(takers, "match").select("id", "n", "seq"))
        placed = staged(placed, "placed")
        rounds.append(placed)
        next_pieces = staged(free.where("match is null").select("id", "n"), "left")
        # A gap that took nothing is smaller than every piece that is left.
        next_gaps = staged(placed.groupBy("seq").agg(F.sum("n").alias("used")).join(live, "seq").select("seq", (F.col("n") - F.col("used")).alias("n")).where("n > 0"), "gaps")
        stalled = placed.isEmpty()
        discard(found, *stale)
        stale = [next_pieces, next_gaps]
        pieces, gaps = stale
    return functools.reduce(DataFrame.union, [r.select("id", "seq") for r in rounds]) if rounds else pieces.select("id", F.lit(0).cast("long").alias("seq"))


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, most: int = MAX_TOKENS) -> DataFrame:
    """Per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text and an end token; only longer ones than ``most`` tokens are cut.

    Edge cases: null and empty texts are one end token; repeated rows are packed as often as they come; a null doc_id
    stays null; an empty table gives no rows; other columns are ignored.
    """
    made = staged(tokenised(docs, tokenizer, ranks, pattern, most), "pieces")
    sequences = best_fit(made.select("id", F.col("length").alias("n")), most)
    before = Window.partitionBy("seq").orderBy(F.col("length").desc(), "id").rowsBetween(Window.unboundedPreceding, -1)  # a sequence's pieces
    placed = made.join(sequences, "id").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset")
