"""A uniform shuffle of all rows into shards of exact sizes, by a hypergeometric communication matrix.

1. Rows are written once with a number: the part (the task that wrote it) and the place in it. So parts and their sizes
   are facts of a table, whatever task is run again later.
2. Places in the result are dealt to blocks, runs of consecutive slots of one shard. The matrix says how many rows each
   part sends to each block. Its rows sum to the parts' sizes, its columns to the blocks', and it is distributed as if a
   uniform permutation of all rows had been drawn: halves of the parts are split again and again by multivariate
   hypergeometric draws, seeded by the halves. No task or driver draws the whole matrix: a task descends to its own part.
3. Permute locally: the destinations of a part, as often as the matrix says, are shuffled and dealt to its rows by place.
4. Exchange by block, and permute again: within a block, rows are ordered by a seeded hash, and their ranks are slots.

The driver sees one count for each part. A block is never gathered outside of Spark's own (spilling) sort.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import nested

#: Rows of a block: at least and, where there would be more than so many blocks, at most.
LEAST_ROWS, BLOCKS, MOST_ROWS = 1_000, 1_024, 1_000_000
#: Bits of a row's number that hold its place in its part (Spark's own division of monotonically increasing ids).
PLACE_BITS = 33
#: numpy draws hypergeometric numbers from populations up to so many.
EXACT = 1_000_000_000


def draw_one(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement out of ``good`` and ``bad`` are good.

    Populations that numpy doesn't take are drawn by inversion of the distribution around its mode (60 deviations to
    either side hold all of it that a double can tell).
    """
    if good < EXACT and bad < EXACT:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (good + bad + 2)
    total = good + bad
    reach = 60 * int((n * (good / total) * (bad / total) * (total - n) / max(1, total - 1)) ** 0.5 + 1)
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    # log p(k + 1) - log p(k), summed from the first on
    step = np.log(good - k[:-1]) + np.log(n - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - n + k[:-1] + 1)
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    upto = np.cumsum(np.exp(log_p - log_p.max()))
    return int(k[np.searchsorted(upto, rng.random() * upto[-1], side="right").clip(0, len(k) - 1)])


def draw(rng: np.random.Generator, sizes: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows fall to each block: a multivariate hypergeometric draw."""
    total = int(sizes.sum())
    if total < EXACT:
        return rng.multivariate_hypergeometric(sizes, n, method="marginals")
    if len(sizes) == 1:
        return np.array([n], np.int64)
    half = len(sizes) // 2
    left = int(sizes[:half].sum())
    k = draw_one(rng, left, total - left, n)
    return np.concatenate([draw(rng, sizes[:half], k), draw(rng, sizes[half:], n - k)])


def matrix_row(parts: np.ndarray, blocks: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix: rows that it sends to each block.

    ``parts`` and ``blocks``: sizes, with equal sums. All rows, drawn anywhere, fit together: the draw that splits a
    range of parts depends on the seed and the range alone.
    """
    low, high, left = 0, len(parts), blocks.astype(np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        first = draw(np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, low, high]))), left, int(parts[low:mid].sum()))
        low, high, left = (low, mid, first) if part < mid else (mid, high, left - first)
    return left


def destinations(parts: np.ndarray, blocks: np.ndarray, part: int, seed: int) -> np.ndarray:
    """The block of each of the rows of ``part``, by their places: the local permutation."""
    row = matrix_row(parts, blocks, part, seed)
    to = np.repeat(np.arange(len(blocks), dtype=np.int64), row)
    np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, part]))).shuffle(to)
    return to


def block_sizes(total: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, shard and first slot of each block. Shards differ by one row at most, and so do a shard's blocks."""
    per_block = min(MOST_ROWS, max(LEAST_ROWS, -(-total // BLOCKS)))
    sizes, of, first = [], [], []
    for shard in range(shards):
        rows = total // shards + (shard < total % shards)
        n = max(1, -(-rows // per_block))
        own = np.full(n, rows // n, np.int64)
        own[: rows % n] += 1
        sizes.append(own)
        of.append(np.full(n, shard, np.int64))
        first.append(np.cumsum(own) - own)
    return np.concatenate(sizes), np.concatenate(of), np.concatenate(first)


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """All rows of ``docs`` in a uniformly random order over ``shards`` shards: rows (a struct of all columns), shard, slot.

    Shards' numbers of rows differ by one at most, and slots of a shard count from 0 without gaps. Rows come out dealt by
    block and in the order of their slots. Which rows meet depends on the seed and on how the input was divided into tasks.

    Edge cases: nulls in any column, empty and long texts change nothing, a row is a row; repeated rows and rows with
    equal ids are told apart; shards may be empty when there are fewer rows than shards; an empty table gives no rows;
    columns may have any names, those of the result among them.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    rows = staged(nested(docs, number=F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("number", PLACE_BITS)
    # One count for each task that has written rows: the driver keeps as much for any stage.
    counts = sorted((r[0], r[1]) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    names, parts = np.array([c[0] for c in counts], np.int64), np.array([c[1] for c in counts], np.int64)
    sizes, of, first = block_sizes(int(parts.sum()), shards)

    @F.pandas_udf("block long, shard int, before long")
    def place(numbers: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()  # of the last parts; a task reads few
        for batch in numbers:
            number = batch.to_numpy(np.int64)
            own, at = number >> PLACE_BITS, number & ((1 << PLACE_BITS) - 1)
            block = np.empty(len(number), np.int64)
            for p in np.unique(own).tolist():
                if p not in held:
                    held[p] = destinations(parts, sizes, int(np.searchsorted(names, p)), seed)
                    if len(held) > 4:
                        held.popitem(last=False)
                here = own == p
                block[here] = held[p][at[here]]
            yield pd.DataFrame({"block": block, "shard": of[block].astype(np.int32), "before": first[block]})

    again = Window.partitionBy("to.block").orderBy(F.xxhash64(F.lit(seed), "number"), "number")
    dealt = rows.withColumn("to", place("number")).withColumn("rank", F.row_number().over(again) - 1)
    return dealt.select("rows", "to.shard", (F.col("to.before") + F.col("rank")).alias("slot"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """A folder for each shard, ``shard=<n>``: the rows' own columns and ``slot``; each file holds whole blocks in order."""
    sharded.select("rows.*", "shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(folder)


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size (UTF-8 bytes and one), text_crc32, law ('rows'), shard, slot, grown_shard (null).

    The law is that of rows: the shuffle is uniform over rows, copies of a text are dealt like all others. Edge cases:
    null texts have size 1 and the checksum of nothing; else those of ``shuffle_into_shards``.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    sharded = shuffle_into_shards(narrow, shards, seed)
    return sharded.select("rows.doc_id", "rows.size", "rows.text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
