"""Collocations: phrases that occur often and more often together than their parts would let expect.

1. All phrases of two to ``longest`` words are counted in a sketch: counters that phrases share by their hashes and that
   stop at the least count that matters. A phrase's counter is an upper bound of its count (up to there), so whatever can
   be frequent enough is a candidate. The number of counters grows with the input; they are kept in chunks, to which blocks
   of documents send the counters that they touch, and each chunk is added up in a task. Of the sketch a bit for each
   counter goes on: whether it has reached the least count. Bits are folded so that they never take more than 64 MB.
2. Tasks read the documents again in blocks of ``BLOCK`` bytes. A block's candidates, with a delimiter on either side of
   each word, are compiled into an automaton (``pyahocorasick``); the block's text, delimited alike, is streamed through
   it, and all matches count, overlapping ones too. No count comes from the sketch. So an automaton holds no more
   phrases than a block has, however many candidates there are, and each text is scanned once.
3. Counts of blocks are summed by phrase, and thresholds, scores and ranks are DataFrame work on the sums.

Words are runs without spaces and tabs; phrases do not reach over a piece's end (punctuation and line ends).
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, staged
from .common import WordHashes, join_keys, mix, utf8

# The bytes at which pieces end.
CUTS = b".,;:!?\n\x0b\x0c\r"
#: Lower case for A-Z, and one byte for all ends of pieces.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + CUTS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(CUTS))
UNKNOWN = "und"
#: Bytes of text for which one automaton is compiled, and words whose hashes a task holds.
BLOCK, HELD_WORDS = 5 << 20, 300_000
#: Counters at least, bytes of text for a counter, counters of a chunk, and bits that tasks get at most.
LEAST_WIDTH, BYTES_PER_COUNTER, CHUNK, BITS = 1 << 16, 12, 1 << 20, 1 << 29
#: Parts of a language in which first ranks are taken.
PARTS = 64
A, B = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD1B54A32D192ED03)


class Pieces:
    """The words of some folded texts of one language, piece after piece."""

    def __init__(self, texts: list[bytes]) -> None:
        self.lines = [words for text in texts for line in text.split(b"\n") if (words := line.split())]

    def words(self) -> list[bytes]:
        return list(itertools.chain.from_iterable(self.lines))

    def left(self) -> np.ndarray:
        """For each word, how many words its piece has from there on."""
        n = np.fromiter(map(len, self.lines), np.int64, len(self.lines))
        ends = np.repeat(np.cumsum(n), n)
        return ends - np.arange(len(ends))


def phrase_hashes(words: np.ndarray, left: np.ndarray, seed: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of words, starts, hashes) of all phrases, from two words on."""
    held = words
    for k in range(2, longest + 1):
        held = held[: len(words) - k + 1] * A + words[k - 1 :] if len(words) >= k else held[:0]
        starts = np.flatnonzero(left[: len(held)] >= k)
        yield k, starts, mix(held[starts] * B + np.uint64(seed))


def slots(hashes: np.ndarray, width: int) -> np.ndarray:
    """The counter of each hash, of ``width`` (a power of two)."""
    return (hashes & np.uint64(width - 1)).astype(np.uint32 if width <= 1 << 32 else np.int64)


def blocks(batches: Iterator[pa.RecordBatch], hashes: WordHashes) -> Iterator[tuple[str, int, Pieces]]:
    """(language, its seed, pieces) of the texts, in blocks of bounded size; a longer text is cut between its pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
            text = text.translate(FOLD)
            while len(text) > BLOCK:
                at = text.rfind(b"\n", 0, BLOCK)
                at = at if at >= 0 else text.find(b"\n", BLOCK)
                at = at if at >= 0 else len(text)
                yield lang, hashes[lang.encode()], Pieces([text[:at]])
                text = text[at + 1 :]
            held.setdefault(lang, []).append(text)
            sizes[lang] += len(text)
            if sizes[lang] >= BLOCK:
                sizes[lang] = 0
                yield lang, hashes[lang.encode()], Pieces(held.pop(lang))
    for lang, texts in held.items():
        yield lang, hashes[lang.encode()], Pieces(texts)


def squeezed(x: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed."""
    return pa.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), "zstd", asbytes=True)


def restored(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, "zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def sketch(texts: DataFrame, width: int, least: int, longest: int) -> np.ndarray:
    """Bits, eight in a byte, of the counters of the phrases of ``texts`` (lang, text): whether they have reached ``least``.

    A task adds up one chunk of counters at a time. The driver gets the bits, BITS at most.
    """
    size, folds = min(CHUNK, width), max(1, min(width, BITS) // CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(HELD_WORDS)
        for _, seed, pieces in blocks(batches, hashes):
            found = [slots(of, width) for _, _, of in phrase_hashes(hashes.of(pieces.words()), pieces.left(), seed, longest)]
            some, n = np.unique(np.concatenate(found), return_counts=True)
            n = np.minimum(n, least).astype(np.uint8)
            edges = np.searchsorted(some, np.arange(0, width, size, dtype=some.dtype))
            edges = np.append(edges, len(some))
            chunks = np.flatnonzero(np.diff(edges))
            gaps = [np.diff(some[edges[c] : edges[c + 1]], prepend=some.dtype.type(c * size)).astype("<u4") for c in chunks.tolist()]
            columns = [chunks.astype(np.int32), np.diff(edges)[chunks].astype(np.int32), [squeezed(x) for x in gaps], [squeezed(n[edges[c] : edges[c + 1]]) for c in chunks.tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["chunk", "n", "gaps", "counts"])
            del pieces, found, some, n, gaps, columns  # before the next block is made

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint8)
        for n, gaps, counts in zip(*(rows.column(c) for c in ("n", "gaps", "counts")), strict=True):
            at = np.cumsum(restored(gaps.as_buffer(), n.as_py(), np.uint32).astype(np.int64))
            total[at] = np.minimum(total[at].astype(np.uint16) + restored(counts.as_buffer(), n.as_py(), np.uint8), least)
        chunk = rows.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk % folds], pa.int32()), "bits": pa.array([np.packbits(total >= least, bitorder="little").tobytes()])})

    def fold(rows: pa.Table) -> pa.Table:
        out = np.zeros(size // 8, np.uint8)
        for bits in rows.column("bits"):
            out |= np.frombuffer(bits.as_buffer(), np.uint8)
        return pa.table({"chunk": rows.column("chunk").slice(0, 1), "bits": pa.array([out.tobytes()])})

    found = texts.mapInArrow(count, "chunk int, n int, gaps binary, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, bits binary")
    if width > BITS:
        found = found.groupBy("chunk").applyInArrow(fold, "chunk int, bits binary")
    found = staged(found, "sketch")
    out = np.zeros(min(width, BITS) // 8, np.uint8)
    for chunk, bits in zip(*(c.to_pylist() for c in found.toArrow().columns), strict=True):
        out[chunk * size // 8 : (chunk + 1) * size // 8] = np.frombuffer(bits, np.uint8)
    discard(found)
    return out


def spelled(words: list[bytes], k: int, starts: list[int]) -> list[bytes]:
    return [b" ".join(words[i : i + k]) for i in starts]


def matches(pieces: Pieces, phrases: list[bytes]) -> np.ndarray:
    """How often each of the ``phrases`` occurs in the pieces, by an automaton over delimited words."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for at, phrase in enumerate(phrases):
        automaton.add_word(f" {phrase.decode('utf-8', 'surrogateescape')} ", at)
    automaton.make_automaton()
    text = b"\n".join([b" " + b" ".join(line) + b" " for line in pieces.lines]).decode("utf-8", "surrogateescape")
    return np.bincount(np.fromiter((at for _, at in automaton.iter(text)), np.int64), minlength=len(phrases))


def counts_of(pieces: Pieces, seed: int, hashes: WordHashes, table: np.ndarray, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(phrases, numbers of words, counts) of the candidates among the pieces' phrases."""
    words, width = pieces.words(), len(table) * 8
    found, flagged, sizes = [], [], []
    for k, starts, of in phrase_hashes(hashes.of(words), pieces.left(), seed, longest):
        at = slots(of, width)
        can = (table[at >> at.dtype.type(3)] >> (at & at.dtype.type(7)).astype(np.uint8) & 1).astype(bool)
        flagged.append((k, starts[can]))
        first = starts[can][np.unique(of[can], return_index=True)[1]]
        found += spelled(words, k, first.tolist())
        sizes += [k] * len(first)
    if not found:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    n = matches(pieces, found)
    if n.sum() != sum(len(s) for _, s in flagged):  # two phrases with one hash: all are spelled out
        pairs = [(p, k) for k, s in flagged for p in sorted(set(spelled(words, k, s.tolist())))]
        found, sizes = [p for p, _ in pairs], [k for _, k in pairs]
        n = matches(pieces, found)
    return found, np.array(sizes, np.int64), n


def counted(texts: DataFrame, table: Broadcast, longest: int) -> DataFrame:
    """lang, words, phrase, f: counts by block of candidates, of single words, and (words 0) of all words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(HELD_WORDS)
        for lang, seed, pieces in blocks(batches, hashes):
            single = Counter(itertools.chain.from_iterable(pieces.lines))
            phrases, sizes, n = counts_of(pieces, seed, hashes, table.value, longest)
            flat = [*single, b"", *phrases]
            number = np.concatenate([np.ones(len(single), np.int64), [0], sizes])
            f = np.concatenate([np.fromiter(single.values(), np.int64, len(single)), [sum(single.values())], n])
            for at in range(0, len(flat), 50_000):
                here = slice(at, at + 50_000)
                some = flat[here]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(number[here].astype(np.int32)), pa.array(some, pa.binary()), pa.array(f[here])], ["lang", "words", "phrase", "f"])
            del pieces, single, phrases, sizes, n, flat, number, f, some  # before the next block is made

    return texts.mapInArrow(read, "lang string, words int, phrase binary, f long")


def pieces_of(phrase: Column, start: int | Column, words: int | Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, words), " ")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, inside: int = 50, top: int = 2000, width: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    ``docs``: lang, text. Candidates are phrases of 2 to ``longest`` words with a count ``a`` of at least ``least``. Cut
    after its first k words, a candidate scores floor(1000000 a a / (l r)), l and r being the counts of both parts; the
    cut with the lowest score counts, of equal ones the smallest k. Candidates go whose words lie inside a longer one
    with at least ``inside`` percent of their count. n: all words of the language. Order: score and a descending,
    phrase ascending by bytes. ``width``: counters of the sketch; any power of two from 8 on gives the same result.

    Edge cases: null texts count as empty, null languages as ``und``; empty texts and pieces have no words; texts of any
    length are read whole; repeated rows count again; an empty table gives no rows; other columns are ignored.
    Arithmetic is in decimals of 38 digits, so counts up to 10^15 are exact.
    """
    if not 1 <= least <= 255:
        raise ValueError("counters of the sketch hold counts up to 255")
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    if width is None:
        size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        width = max(LEAST_WIDTH, 1 << (size // BYTES_PER_COUNTER).bit_length())
    table = context.broadcast(sketch(texts, width, least, longest))
    sums = counted(texts, table, longest).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("words") == 0) | (F.col("f") >= least))
    counts = staged(sums.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f"), "phrase-counts")
    table.destroy()
    candidates = counts.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    scored = with_scores(candidates, counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), "f"), longest)
    # What lies inside a longer candidate: the largest count of those.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: pieces_of(F.col("phrase"), i, k))))
    longer = candidates.where("words >= 3").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    stay = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * inside, F.lit(True)))
    # First ranks in parts of a language, then at most PARTS * top rows of each meet.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    first = stay.withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= top)
    row = F.struct((-F.col("score")).alias("s"), (-F.col("a")).alias("b"), "phrase", "a", "l", "r", "score")
    best = first.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(row)), 1, top).alias("rows"))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    ranked = best.join(totals, "lang").select("lang", "n", F.posexplode("rows").alias("at", "row"))
    return ranked.select("lang", (F.col("at") + 1).alias("rank"), "row.phrase", "row.a", "row.l", "row.r", "n", "row.score")


def with_scores(candidates: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """``candidates`` (lang, words, phrase, a) with l, r and score of the cut that counts. ``counts``: lang, part, f."""
    cut = F.sequence(F.lit(1), F.col("words") - 1)
    sides = F.flatten(F.transform(cut, lambda k: F.array(F.struct(k.alias("k"), F.lit(0).alias("side"), pieces_of(F.col("phrase"), 1, k).alias("part")), F.struct(k.alias("k"), F.lit(1).alias("side"), pieces_of(F.col("phrase"), k + 1, F.col("words") - k).alias("part")))))
    parts = staged(candidates.select("lang", "phrase", "a", F.explode(sides).alias("x")).select("lang", "phrase", "a", "x.*"), "parts")
    # A common word is a part of very many phrases.
    uses = parts.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    keys = staged(counts.join(uses, ["lang", "part"]), "part-counts")
    met = join_keys(parts, keys, ["lang", "part"], "uses", parts.count(), F.xxhash64("phrase", "k", "side"))
    of = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f")))
    wide = met.groupBy("lang", "phrase").agg(F.max("a").alias("a"), *(of(k, s).alias(f"{'lr'[s]}{k}") for k in range(1, longest) for s in (0, 1)))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    each = []
    for k in range(1, longest):
        wide = wide.withColumns({f"__t{k}": big("a") * big("a") * million, f"__b{k}": big(f"l{k}") * big(f"r{k}")})
        each.append(F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(f"__t{k} div __b{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    lowest = F.array_min(F.array(*each)) if len(each) > 1 else each[0]
    return wide.withColumn("__c", lowest).select("lang", "phrase", "a", "__c.l", "__c.r", "__c.score")
