"""Exact deduplication against a minimal perfect hash over the digests seen before.

The distinct digests of the history are dealt to shards; each shard holds a minimal perfect hash (levels of collision-free
bits, ranked by a running count), and slots with the full 32-byte digest, the winner's locator and the group's size.
A lookup hashes to one slot and compares all 32 bytes, so digests that are not in the history are never taken for
members. Those nonmembers are grouped among themselves.

All digests, those of the history among them, are looked up, and what a slot holds decides: so a wrong slot is a wrong
result. Digests are reduced to one row each before they meet the index, so a group of copies of any size is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import SPACE, join_keys, nested

#: Distinct digests in a shard; bounds the memory of a task that builds or probes one.
SHARD_KEYS = 200_000
#: Bits per key in each level of the hash.
GAMMA = 2.0
#: Rows that go, of which so many at most are sent to all tasks, so that whole texts need not be shuffled (some 150 bytes each there).
SENT = 500_000
#: Orders rows without an id after all others.
NO_ID = (1 << 63) - 1

INDEX_SCHEMA = "shard int, levels array<binary>, sizes array<long>, digests binary, locators binary, counts binary"


def level_slots(lo: np.ndarray, hi: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where level ``level`` puts keys given by two 64-bit halves of their digests."""
    h = lo + np.uint64(level) * hi
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return (h % np.uint64(size)).astype(np.int64)


def halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = np.ascontiguousarray(digests).view("<u8")
    return parts[:, 1], parts[:, 2] | np.uint64(1)


def build_levels(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bits of each level, and the slot (0..n-1) of each of the distinct ``digests`` (n x 32 bytes)."""
    lo, hi = halves(digests)
    slot, left, levels, base = np.zeros(len(digests), np.int64), np.arange(len(digests)), [], 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        at = level_slots(lo[left], hi[left], len(levels), size)
        once = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(once) - 1
        alone = once[at]
        slot[left[alone]] = base + rank[at[alone]]
        base += int(once.sum())
        levels.append(once)
        left = left[~alone]
    return levels, slot


def find_slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The only slot in which each digest can be; -1 if every level leaves it out."""
    out, left, base = np.full(len(digests), -1, np.int64), np.arange(len(digests)), 0
    lo, hi = halves(digests)
    for n, bits in enumerate(levels):
        at = level_slots(lo[left], hi[left], n, len(bits))
        hit = bits[at]
        out[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        base += int(bits.sum())
        left = left[~hit]
    return out


def as_digests(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def index_shard(keys: pd.DataFrame) -> pd.DataFrame:
    keys = keys.reset_index(drop=True)
    digests = as_digests(keys["digest"])
    levels, slot = build_levels(digests)
    order = np.argsort(slot)
    return pd.DataFrame({
        "shard": [int(keys["shard"].iloc[0])],
        "levels": [[np.packbits(x).tobytes() for x in levels]],
        "sizes": [[len(x) for x in levels]],
        "digests": [digests[order].tobytes()],
        "locators": [keys[["doc", "row"]].to_numpy(np.int64)[order].tobytes()],
        "counts": [keys["n"].to_numpy(np.int64)[order].tobytes()],
    })


def probe_shard(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Adds doc_then, row_then, n_then of the member whose full digest is equal; null where there is none."""
    out = keys.assign(doc_then=pd.array([pd.NA] * len(keys), "Int64"), row_then=pd.array([pd.NA] * len(keys), "Int64"), n_then=pd.array([0] * len(keys), "Int64"))
    if len(index) and len(keys):
        shard = index.iloc[0]
        levels = [np.unpackbits(np.frombuffer(x, np.uint8))[:n].astype(bool) for x, n in zip(shard["levels"], shard["sizes"], strict=True)]
        held, asked = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32), as_digests(keys["digest"])
        slots = find_slots(levels, asked)
        same = (slots >= 0) & (held[slots] == asked).all(axis=1)
        locators = np.frombuffer(shard["locators"], np.int64).reshape(-1, 2)[slots]
        counts = np.frombuffer(shard["counts"], np.int64)[slots]
        for name, values in (("doc_then", locators[:, 0]), ("row_then", locators[:, 1]), ("n_then", counts)):
            out[name] = pd.array(np.where(same, values, 0), "Int64")
            if name != "n_then":
                out.loc[~same, name] = pd.NA
    return out[["digest", "doc", "row", "n", "doc_then", "row_then", "n_then"]]


def digests(docs: DataFrame) -> DataFrame:
    """doc (id; null ids come last), row (tells repeated rows apart), digest: SHA-256 of the normalised text."""
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(normal, 256)).alias("digest"))


def distinct_digests(rows: DataFrame, border: int) -> DataFrame:
    """One row per distinct digest of ``rows``: the first row by id and the number of rows, of the history (ids up to ``border``) and of later ones. Pre-aggregated before its shuffle."""
    past = F.col("doc") <= border
    at = F.struct("doc", "row")
    each = rows.groupBy("digest").agg(F.min(F.when(past, at)).alias("p"), F.count_if(past).alias("n_past"), F.min(F.when(~past, at)).alias("w"), F.count_if(~past).alias("n"))
    return each.select("digest", F.col("p.doc").alias("doc_past"), F.col("p.row").alias("row_past"), "n_past", F.coalesce("w.doc", F.lit(0)).alias("doc"), F.coalesce("w.row", F.lit(0)).alias("row"), "n")


def with_shard(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The minimal perfect hash over ``history`` (digest, doc, row, n; digests distinct), one row per shard."""
    return with_shard(history, shards).groupBy("shard").applyInPandas(index_shard, INDEX_SCHEMA)


def lookup(keys: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``keys`` (digest, doc, row, n) with what ``index`` holds for equal digests."""
    schema = "digest binary, doc long, row long, n long, doc_then long, row_then long, n_then long"
    return with_shard(keys, shards).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe_shard, schema)


def decide(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """digest, keep_doc, keep_row, group_size of all ``distinct`` digests (digest, doc, row, n: their rows beyond the history).

    A member's winner and the size of its history come from its slot; nonmembers are groups of their own.
    """
    found = lookup(distinct.select("digest", "doc", "row", "n"), index, shards)
    member = F.col("doc_then").isNotNull()
    return found.select("digest", F.when(member, F.col("doc_then")).otherwise(F.col("doc")).alias("keep_doc"), F.when(member, F.col("row_then")).otherwise(F.col("row")).alias("keep_row"), (F.col("n") + F.col("n_then")).alias("group_size"))


def _decided(rows: DataFrame, history_part: float) -> DataFrame:
    span = rows.where(F.col("doc") < NO_ID).agg(F.min("doc"), F.max("doc"), F.count("*")).first()
    border = span[0] + int((span[1] - span[0]) * history_part) if span[2] else 0
    distinct = staged(distinct_digests(rows, border), "distinct")
    shards = distinct.count() // SHARD_KEYS + 1
    history = distinct.where("n_past > 0").select("digest", F.col("doc_past").alias("doc"), F.col("row_past").alias("row"), F.col("n_past").alias("n"))
    index = staged(build_index(history, shards), "index")
    decided = staged(decide(distinct, index, shards), "decided")
    discard(distinct, index)
    return decided


def exact_dedup(docs: DataFrame, history_part: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space is one space; null counts as empty. Of equal
    texts the row with the smallest doc_id stays. Rows up to ``history_part`` of the range of ids are the history whose
    digests are indexed; all digests are looked up. The result is the same for any division.

    Edge cases: rows without doc_id come after all others and have keep_id null if one of them stays; of rows repeated
    with the same doc_id and text one is kept; empty texts form one group; an empty table gives no rows; other columns are ignored.
    """
    rows = staged(digests(docs), "digests")
    decided = _decided(rows, history_part)
    # A row for each digest, with the group's size: heavy groups' rows are dealt to all tasks.
    joined = join_keys(rows, decided.withColumn("copies", F.col("group_size")), ["digest"], "copies", rows.count(), F.xxhash64("doc", "row"))
    some = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return joined.select(some("doc").alias("doc_id"), some("keep_doc").alias("keep_id"), "group_size", ((F.col("doc") == F.col("keep_doc")) & (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Edge cases are those of ``exact_dedup``: null texts count as empty, rows without doc_id go if any row has their
    text, one of repeated rows stays, an empty table stays empty, and columns of any names pass through.
    """
    key = {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "digest": F.unhex(F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " "), 256))}
    rows = staged(digests(docs), "digests")
    decided = _decided(rows, 0.5)
    # Only what goes is joined back: rows of other winners' digests, and rows of which several have the winner's id and text.
    of_id = rows.groupBy("doc", "digest").agg(F.count("*").alias("n"))
    copies = join_keys(of_id, decided.where("group_size > 1").select("digest", "keep_doc", F.col("group_size").alias("copies")), ["digest"], "copies", rows.count(), F.xxhash64("doc"))
    going = staged(copies.where("doc <> keep_doc or n > 1").select("doc", "digest", (F.col("doc") == F.col("keep_doc")).alias("repeated")), "going")
    met = nested(docs, **key).join(F.broadcast(going) if going.count() <= SENT else going, ["doc", "digest"], "left")
    out = met.where("repeated is null").select("rows.*")
    if going.where("repeated").isEmpty():
        return out
    return out.union(met.where("repeated").dropDuplicates(["doc", "digest"]).select("rows.*"))
