"""Helpers that the text operators share: words, hashing, joins with heavy keys and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, staged

#: ASCII white space, as the contracts of the operators define it (for Java's, DuckDB's and Python's regex engines).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def split_words(data: bytes | None) -> list[bytes]:
    """The maximal runs of bytes that are not ASCII white space (bytes.split() splits at 0x20 and 0x09-0x0D only)."""
    return data.split() if data else []


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


class WordHashes(dict):
    """word -> 64-bit hash; a cache that is emptied when it has grown past ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits, so that sums and products of hashes spread over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows_of(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``k`` consecutive entries (mod 2**64), by doubling window lengths."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    power = base | 1
    out, done, length = None, 0, 1
    cur = h
    rest = k
    while True:
        if rest & 1:
            if out is None:
                out, done = cur, length
            else:
                n = len(h) - (done + length) + 1
                out = out[:n] * np.uint64(power) + cur[done : done + n]
                done += length
        rest >>= 1
        if not rest:
            return out
        n = len(cur) - length
        cur = cur[:n] * np.uint64(power) + cur[length : length + n]
        power = power * power & 0xFFFFFFFFFFFFFFFF
        length *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries; of all entries when there are fewer than ``w``."""
    if len(x) <= w:
        return x.min(keepdims=True) if len(x) else x
    cur, length = x, 1
    while length * 2 <= w:
        cur = np.minimum(cur[:-length], cur[length:])
        length *= 2
    n = len(x) - w + 1
    return np.minimum(cur[:n], cur[w - length : w - length + n])


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def nested(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``docs`` in one column ``rows``, beside ``columns``: so no name of the caller's clashes with ours."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rows"), *(c.alias(name) for name, c in columns.items()))


#: A key with more than this part of all rows is heavy; so there are at most as many heavy keys as its inverse.
HEAVY = 1 / 1000


def join_keys(rows: DataFrame, keys: DataFrame, by: list[str], count: str, total: int, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keys`` (distinct by ``by``; ``count`` says how many of ``total`` rows have the key).

    The rows of heavy keys, however many one key has, meet them by a broadcast of at most 1 / HEAVY rows and are dealt
    by ``spread`` (a hash of the row) in the shuffle in which the others meet theirs. ``count`` is dropped. ``how`` is
    inner or left.

    On the side of the keys the place in the deal is 0 for each row but no literal: Spark would take a literal out of
    the shuffle's columns, and with it the deal.
    """
    others = [c for c in keys.columns if c not in (*by, count)]
    heavy = keys.where(F.col(count) > total * HEAVY).select(*by, F.struct(*others).alias("__heavy"), F.lit(True).alias("__is_heavy"))
    light = keys.where(F.col(count) <= total * HEAVY).select(*by, F.struct(*others).alias("__light"), (F.col(count) < 0).cast("long").alias("__deal"), F.lit(True).alias("__is_light"))
    met = rows.join(F.broadcast(heavy), by, "left").withColumn("__deal", F.when(F.col("__is_heavy"), 1 + F.pmod(spread, F.lit(1 << 20))).otherwise(F.lit(0)))
    met = met.join(light.hint("merge"), [*by, "__deal"], "left")
    if how == "inner":
        met = met.where("__is_heavy or __is_light")
    found = F.coalesce("__heavy", "__light")
    return met.select(*rows.columns, *(found[c].alias(c) for c in others))


def connected_components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(id, component) of undirected ``edges`` (a, b), where component is the smallest id that is reachable.

    Alternates large-star and small-star steps, each a pre-aggregated shuffle by node, until no edge changes; every
    round is written to the shared folder, so lineage stays short. Long chains shrink by half or better in a round.
    Only a count and a checksum reach the driver. Ids of edges must not be null.
    """
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    last = None
    for _ in range(limit):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = staged(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "u", "m")
        new = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
        discard(e, large)
        e = new
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == last or not now[0]:
            break
        last = now
    else:
        raise RuntimeError(f"components have not converged after {limit} rounds")
    members = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
