"""Removal of passages that repeat across documents, located by Aho-Corasick automata of recurring phrases.

A passage repeats when a window of 50 consecutive words also starts in a document with a smaller doc_id.

1. Every window names one of its 16-word phrases, the one with the smallest hash, whatever surrounds the window. So two
   equal windows name the same phrase. Phrases that windows of at least two documents name are recurring: only around
   them can windows repeat. That takes one row per about 18 words, pre-aggregated to the first and last doc_id.
2. Recurring phrases are confirmed: the first document that has one gives its words. Documents are dealt to blocks of a
   bounded size, and each block gets a shard of the phrases: those that its documents name. An automaton of the shard's
   phrases is compiled, and all documents of the block are streamed through it, which locates every occurrence and
   compares the words themselves. Only windows around located occurrences are looked at any further.
3. Consecutive windows that name one phrase are a run. Equal runs are decided at once by a digest of their words; only
   where a phrase's runs differ (at the edges of passages, around edits) are digests of single windows compared.
4. Documents meet the windows to remove, and every word that one covers goes.

No step gathers a phrase's or a window's documents in one place: first documents are minima, joined back, and rows of
phrases that very many documents have are dealt to all tasks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import WordHashes, join_keys, mix, sliding_min, split_words, utf8, windows_of

WINDOW, PHRASE = 50, 16
#: Bytes of the documents of a block, for which one automaton is compiled, and what a row counts for besides its text.
BLOCK, ROW = 2 << 20, 64
#: Letters of each place of a word's number in an automaton.
DIGITS = 16
RUNS = "doc long, row long, phrase long, start int, n int, d1 long, d2 long, windows array<long>"
A, B, C = 0x9E6C63D0876A9A47, 0xD1B54A32D192ED03, 0x2127599BF4325C37


class Words:
    """A document's word hashes and the hash of the phrase that each of its windows names."""

    def __init__(self, hashes: np.ndarray, window: int, phrase: int):
        self.hashes = hashes
        self.phrases = mix(windows_of(hashes, phrase, A))
        self.named = sliding_min(self.phrases, window - phrase + 1) if len(hashes) >= window else np.empty(0, np.uint64)


def row_of() -> Column:
    """Tells rows with one doc_id apart by their texts."""
    return F.xxhash64("text")


def named_phrases(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc, block, phrase: the distinct phrases that the windows of each document name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = []
            for data in utf8(batch.column("text")):
                words = split_words(data)
                found.append(np.unique(Words(hashes.of(words), window, phrase).named) if len(words) >= window else np.empty(0, np.uint64))
            of = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(of)), batch.column("block").take(pa.array(of)), pa.array(flat)], ["doc", "block", "phrase"])

    return docs.mapInArrow(read, "doc long, block long, phrase long")


def spelled_out(docs: DataFrame, firsts: DataFrame, window: int, phrase: int) -> DataFrame:
    """phrase, words: the words of recurring phrases, from the document (``firsts``: block, doc, phrases) that has them first."""

    def read(block: pa.Table, firsts: pa.Table) -> pa.Table:
        wanted = {d: x.values.to_numpy().view(np.uint64) for d, x in zip(firsts.column("doc").to_pylist(), firsts.column("phrases"), strict=True)}
        hashes, keys, found = WordHashes(), [], []
        for doc, data in zip(block.column("doc").to_pylist(), utf8(block.column("text")), strict=True):
            some = wanted.get(doc)
            if some is None:
                continue
            words = split_words(data)
            of = mix(windows_of(hashes.of(words), phrase, A))
            distinct, at = np.unique(of, return_index=True)
            here = np.isin(distinct, some)
            keys.append(distinct[here])
            found += [b" ".join(words[i : i + phrase]) for i in at[here].tolist()]
        flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
        return pa.table({"phrase": pa.array(flat), "words": pa.array(found, pa.binary())})

    # Rows of one doc_id with different texts may both spell a phrase; one of them stands for it.
    return docs.groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(read, "phrase long, words binary").groupBy("phrase").agg(F.min("words").alias("words"))


def letters_of(numbers: dict[bytes, int]) -> tuple[dict[bytes, str], int]:
    """Words as strings of a fixed length, which comes second: the digits of their numbers, each place with letters of its own.

    A node of an automaton is searched letter by letter, so few letters are fast, however many words there are. As
    places have different letters, no match starts inside a word.
    """
    width = 1
    while DIGITS**width < len(numbers):
        width += 1
    return {w: "".join(chr(0x100 + DIGITS * i + n // DIGITS ** (width - 1 - i) % DIGITS) for i in range(width)) for w, n in numbers.items()}, width


def locate(documents: list[list[bytes]], phrases: list[bytes], phrase: int) -> Iterator[np.ndarray]:
    """Where any of the ``phrases`` occurs in each of the ``documents`` (lists of words), by an automaton."""
    numbers: dict[bytes, int] = {}
    spelled = [key.split() for key in phrases]
    for word in itertools.chain.from_iterable(spelled):
        numbers.setdefault(word, len(numbers))
    letters, width = letters_of(numbers)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for at, key in enumerate(spelled):
        automaton.add_word("".join([letters[w] for w in key]), at)
    if phrases:
        automaton.make_automaton()
    other = " " * width  # a word that no phrase has
    for words in documents:
        ends = [end // width for end, _ in automaton.iter("".join([letters.get(w, other) for w in words]))] if phrases and len(words) >= phrase else []
        yield np.array(ends, np.int64) - phrase + 1


def runs_of(of: Words, hits: np.ndarray, window: int, phrase: int) -> list[tuple]:
    """(phrase, start, windows, two digests of the run's words, digests of its windows) around the occurrences ``hits``."""
    if not len(hits) or not len(of.named):
        return []
    # A window stands when the phrase that it names has been located in it.
    located = np.full(len(of.phrases), np.iinfo(np.uint64).max)
    located[hits] = of.phrases[hits]
    valid = sliding_min(located, window - phrase + 1) == of.named
    change = np.flatnonzero((of.named[1:] != of.named[:-1]) | (valid[1:] != valid[:-1])) + 1
    starts = np.concatenate([[0], change])
    ends = np.concatenate([change, [len(of.named)]])
    single = windows_of(of.hashes, window, B)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(mix(of.hashes ^ np.uint64(C)))])
    out = []
    for s, e in zip(starts[valid[starts]].tolist(), ends[valid[starts]].tolist(), strict=True):
        inside = single[s:e]
        # Two digests of the run: of its windows in their order, and of its words with their number.
        d1 = windows_of(mix(inside), e - s, A)[0]
        d2 = mix(prefix[e + window - 1 : e + window] - prefix[s : s + 1] + np.uint64(e - s))[0]
        out.append((of.named[s], s, e - s, d1, d2, inside))
    return out


def runs(docs: DataFrame, shards: DataFrame, window: int, phrase: int) -> DataFrame:
    """The runs of ``docs`` (doc, row, text, block) around the phrases of their block's shard (``shards``: block, words)."""

    def read(block: pa.Table, shard: pa.Table) -> pa.Table:
        hashes, rows = WordHashes(), []
        documents = [split_words(x) for x in utf8(block.column("text"))]
        ids = zip(block.column("doc").to_pylist(), block.column("row").to_pylist(), strict=True)
        for key, words, hits in zip(ids, documents, locate(documents, shard.column("words").to_pylist(), phrase), strict=True):
            if len(hits):
                rows += [(*key, *run) for run in runs_of(Words(hashes.of(words), window, phrase), hits, window, phrase)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in columns[7]])]).astype(np.int32)
        flat = np.concatenate(columns[7]).view(np.int64) if rows else np.empty(0, np.int64)
        return pa.Table.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), signed(columns[2]), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32()), signed(columns[5]), signed(columns[6]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc", "row", "phrase", "start", "n", "d1", "d2", "windows"])

    return docs.groupBy("block").cogroup(shards.groupBy("block")).applyInArrow(read, RUNS)


def recurring(docs: DataFrame, blocks: int, window: int, phrase: int) -> tuple[DataFrame, DataFrame]:
    """(block, words) of the phrases that documents of each block name and at least two documents have; and phrase, words of all."""
    found = staged(named_phrases(docs, window, phrase), "phrases")
    shared = staged(found.groupBy("phrase").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("copies")).where("first <> last").select("phrase", "first", "copies"), "shared")
    firsts = shared.groupBy(F.col("first").alias("doc")).agg(F.collect_list("phrase").alias("phrases"))
    spelled = staged(spelled_out(docs, firsts.withColumn("block", block_of("doc", blocks)), window, phrase), "spelled")
    passages = spelled.join(shared.select("phrase", "copies"), "phrase")
    met = join_keys(found, passages, ["phrase"], "copies", found.count(), F.xxhash64("doc"))
    shards = staged(met.select("block", "words").distinct(), "shards")
    discard(found)
    return shards, spelled


def block_of(doc: str, blocks: int) -> Column:
    """The block of a document; rows of one doc_id stand in one."""
    return F.pmod(F.xxhash64(doc), F.lit(blocks))


def repeated_windows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc, row, starts, counts: the windows of each document (from start on, so many) that start in an earlier document too."""
    size = docs.agg(F.sum(F.octet_length("text") + ROW)).first()[0] or 0
    blocks = size // BLOCK + 1
    docs = docs.withColumn("block", block_of("doc", blocks))
    shards, spelled = recurring(docs, blocks, window, phrase)
    run = staged(runs(docs, shards, window, phrase), "runs")
    discard(shards, spelled)
    key = ["phrase", "d1", "d2", "n"]
    firsts = staged(run.groupBy(*key).agg(F.min("doc").alias("first"), F.count("*").alias("copies")), "run-firsts")
    placed = join_keys(run, firsts, key, "copies", run.count(), F.xxhash64("doc"))
    whole = placed.where("doc > first").select("doc", "row", "start", "n")
    # A phrase whose runs are all equal is settled; of others, each distinct run's first document has its windows compared.
    open_phrases = firsts.groupBy("phrase").agg(F.count("*").alias("kinds")).where("kinds > 1").select("phrase")
    single = placed.where("doc = first").join(open_phrases, "phrase").select("doc", "row", "phrase", "start", F.posexplode("windows").alias("at", "digest"))
    single = staged(single.select("doc", "row", "phrase", (F.col("start") + F.col("at")).alias("start"), "digest"), "windows")
    earliest = single.groupBy("phrase", "digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("copies")).where("first <> last").select("phrase", "digest", "first", "copies")
    parts = join_keys(single, staged(earliest, "earliest"), ["phrase", "digest"], "copies", single.count(), F.xxhash64("doc"))
    parts = parts.where("doc > first").select("doc", "row", "start", F.lit(1).alias("n"))
    return whole.union(parts).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "n")).alias("removed"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by one space).

    Words are runs without ASCII white space. A word goes if a window of ``window`` words covers it whose words also
    start in a document with a smaller doc_id; windows are judged on the input.

    Edge cases: null and empty texts have no words; documents shorter than a window keep all words; rows with one
    doc_id are one document and do not remove each other's words; rows without doc_id keep all words and remove none;
    an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), row_of().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where("doc is not null")
    removed = staged(repeated_windows(known, window, phrase), "removed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, digests, texts = [], [], [], []
            for data, windows in zip(utf8(batch.column("text")), batch.column("removed"), strict=True):
                words = split_words(data)
                keep = words
                if windows.is_valid:
                    start, count = (windows.values.field(c).to_numpy() for c in ("start", "n"))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + count + window - 1, -1)
                    keep = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                text = b" ".join(keep)
                n.append(len(words))
                gone.append(len(words) - len(keep))
                digests.append(hashlib.sha256(text).hexdigest())
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    joined = rows.join(removed, ["doc", "row"], "left").select("doc", "text", "removed")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
