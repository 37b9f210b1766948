"""Sharding, hard negatives and collocations against plain Python, their odd rows, and how heavy keys are dealt."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwork import session
from siftwork.llm import collocations, common, fingerprints, hard_negatives, mixing, pii, queries, sharding

SF = "/root/testdata/sf0.01"


# Heavy keys


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("columns", [["k"], ["k", "j"]])
def test_rows_of_a_heavy_key_are_dealt(spark, how, columns):
    """One key with half of all rows: the largest partition of the join stays below twice the mean."""
    n, parts = 40_000, 16
    heavy = F.col("id") < n // 2
    rows = spark.range(n).select(F.when(heavy, -1).otherwise(F.col("id")).alias("k"), F.when(heavy, 0).otherwise(F.col("id") % 7).alias("j"), F.col("id").alias("v"))
    keys = rows.groupBy(*columns).agg(F.count("*").alias("copies"), F.min("v").alias("first")).where("k % 3 <> 0")
    keys, rows = session.staged(keys, "keys"), session.staged(rows.select(*columns, "v"), "rows")
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = common.join_keys(rows, keys, columns, "copies", n, F.xxhash64("v"), how)
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        got = {r.v: r.first for r in met.collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert max(sizes) < 2 * sum(sizes) / parts
    expected = {v: (0 if v < n // 2 else v) if v < n // 2 or v % 3 else None for v in range(n)}
    assert got == (expected if how == "left" else {v: x for v, x in expected.items() if x is not None})


# Sharding


def test_shards_are_exact_and_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7, "doc_id")
    rows = queries.op11_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    places = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(x == list(range(len(x))) for x in places.values()) and {len(x) for x in places.values()} <= {len(rows) // 8, len(rows) // 8 + 1}


def test_matrix_fits_together():
    rng = random.Random(3)
    for _ in range(20):
        parts = np.array([rng.choice([0, 1, 5, 400]) for _ in range(rng.randint(1, 9))])
        sizes, of, first = sharding.block_sizes(int(parts.sum()), 5)
        rows = np.stack([sharding.matrix_row(parts, sizes, p, 1) for p in range(len(parts))])
        assert (rows.sum(axis=1) == parts).all() and (rows.sum(axis=0) == sizes).all() and (rows >= 0).all()
        for p in range(len(parts)):
            assert (np.bincount(sharding.destinations(parts, sizes, p, 1), minlength=len(sizes)) == rows[p]).all()
        for s in range(5):
            assert (first[of == s] == np.cumsum(sizes[of == s]) - sizes[of == s]).all()


def test_shuffle_is_uniform(spark):
    """Over many seeds each row comes to each shard as often, and pairs of rows of one part as often as independent places would have it."""
    parts, seeds = np.array([6, 2, 4]), 3000
    sizes = np.array([4, 4, 4])
    counts, together = np.zeros((12, 3)), 0
    for seed in range(seeds):
        to = np.concatenate([sharding.destinations(parts, sizes, p, seed) for p in range(3)])
        counts[np.arange(12), to] += 1
        together += to[0] == to[1]
    assert np.abs(counts / seeds - 1 / 3).max() < 0.05 and abs(together / seeds - 3 / 11) < 0.04


def test_draws_from_large_populations():
    rng = np.random.default_rng(5)
    good, bad, n = 6_000_000_000, 14_000_000_000, 1_000_000_000
    draws = np.array([sharding.draw_one(rng, good, bad, n) for _ in range(60)], float)
    mean, sd = n * 0.3, math.sqrt(n * 0.3 * 0.7 * (good + bad - n) / (good + bad - 1))
    assert abs(draws.mean() - mean) < 5 * sd / math.sqrt(60) and 0.6 < draws.std() / sd < 1.5
    assert sharding.draw_one(rng, 2_000_000_000, 5, 2_000_000_003) in range(1_999_999_998, 2_000_000_001)
    sizes = np.full(7, 900_000_000)
    found = sharding.draw(rng, sizes, 3_000_000_000)
    assert found.sum() == 3_000_000_000 and (found <= sizes).all()


def test_odd_rows_are_sharded(spark, tmp_path):
    rows = [(1, "a", 5), (1, "a", 5), (None, None, None), (2, "", 1), (3, "é" * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot long").withColumns({c: F.lit("clash") for c in ("number", "rows", "to", "rank", "shard")})
    got = sharding.shuffle_into_shards(docs, 8).collect()
    assert len(got) == 5 and len({r.shard for r in got}) == 5 and {r.slot for r in got} == {0}
    assert sorted(str((r["rows"].doc_id, r["rows"].slot)) for r in got) == sorted(str((r[0], r[2])) for r in rows)
    assert sharding.shuffle_into_shards(docs.where("false")).count() == 0
    assert {(r.doc_id, r["size"]) for r in sharding.shard_documents(docs).collect()} == {(1, 2), (None, 1), (2, 1), (3, 200_001)}
    sharding.write_shards(sharding.shuffle_into_shards(docs.select("doc_id", "text"), 2), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.groupBy("shard").count().count() == 2 and back.count() == 5 and back.columns == ["doc_id", "text", "slot", "shard"]
    with pytest.raises(ValueError, match="shard"):
        sharding.shuffle_into_shards(docs, 0)


# Hard negatives


def plain_negatives(rows, positives=5, negatives=3, low=50, high=95):
    """rows: (vec_id, label, integers, is_anchor)."""
    out = []
    for a, label, v, is_anchor in rows:
        if not is_anchor:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w, _ in rows))
        near = [(i, -s) for s, i, other in scored if other == label and i != a][:positives]
        for i, s in near:
            fits = [(j, -t) for t, j, other in scored if other != label and low * s <= 100 * -t <= high * s][:negatives]
            out += [(a, i, rank, j, s, t) for rank, (j, t) in enumerate(fits, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * x) for x in r.embedding], r.vec_id % 50 == 0) for r in table]
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, SF).collect())) == plain_negatives(rows)


def test_hard_negatives_of_odd_rows(spark):
    """Nulls, numbers that are not finite, short and empty vectors, ties by the dozen, repeated rows, several blocks of anchors."""
    rng = random.Random(8)
    vector = lambda: rng.choice([[0.5, 0.25, 1.0], [0.5, 0.25, 1.0], [rng.uniform(-1, 2) for _ in range(3)], [1.0], [], [-0.5, 3.0, 0.25, 0.125, 1.0]])
    rows = [(i, rng.choice([0, 1, 1]), vector()) for i in range(160)]
    odd = [(200, None, [1.0]), (250, 1, None), (None, 1, [1.0]), (300, 1, [1.0, None]), (350, 1, [float("nan")]), (400, 0, [float("inf"), 1.0]), (450, 0, [float("-inf")])]
    table = spark.createDataFrame(rows + odd + rows[:30], "vec_id long, label int, embedding array<float>").withColumns({c: F.lit("clash") for c in ("key", "vector", "rank", "at", "score")})
    got = hard_negatives.hard_negatives(table.withColumn("is_anchor", F.coalesce(F.col("vec_id") % 5 == 0, F.lit(False))), chunk=400).collect()
    expected = plain_negatives([(i, y, [math.floor(256 * float(np.float32(x))) for x in v], i % 5 == 0) for i, y, v in rows])
    assert len(expected) > 50 and sorted(map(tuple, got)) == expected
    assert hard_negatives.mine_embeddings(table.where("false")).count() == 0


def test_bounds_hold():
    """No true score lies outside the looked-up one plus or minus the bound, whatever the codebooks are."""
    rng = np.random.default_rng(1)
    for scale, sample in ((200, 4096), (3, 4096), (1 << 40, 3)):
        rows, anchors = (np.rint(rng.normal(0, scale, (n, 6))).astype(np.int64) for n in (500, 40))
        books = hard_negatives.fit_codebooks(rows[:sample])
        codes, left = hard_negatives.encode(rows, books)
        tables = np.stack([(b.astype(float) @ anchors[:, 2 * j : 2 * j + 2].T).astype(np.float32) for j, b in enumerate(books)])
        norm = lambda x: np.sqrt((x.astype(float) ** 2).sum(axis=1))
        found, far = hard_negatives.bounds(codes, left, tables, norm(anchors), float(norm(rows).max()))
        true = rows.astype(float) @ anchors.T.astype(float)
        assert (np.abs(found - true) <= far).all()


def test_scores_beyond_64_bits_are_refused(spark):
    large = spark.createDataFrame([(0, 1, [1e17] * 4, True), (1, 1, [1e17] * 4, False)], "vec_id long, label int, embedding array<float>, is_anchor boolean")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.hard_negatives(large).collect()


# Collocations


def plain_collocations(rows, least=10, longest=3, top=2000, inside=50):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, of in counts.items():
        found = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= inside * of[p[i : i + k]]}
        ranked = []
        for p, a in found.items():
            if p not in gone:
                s, k = min((1_000_000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-s, -a, " ".join(p).encode(), a, of[p[:k]], of[p[k:]]))
        out += [(lang, i, r[2].decode(), r[3], r[4], r[5], n[lang], -r[0]) for i, r in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def test_collocations_equal_brute_force(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    got = sorted(map(tuple, queries.op13_collocations(spark, SF).collect()))
    assert len(got) > 500 and got == plain_collocations(rows)


@pytest.mark.parametrize("width", [None, 8])
@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_of_odd_texts(spark, width, longest):
    """Few words in all orders, runs of one word, empty and null texts, words in several cases and scripts; with 8 counters, all phrases are candidates."""
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "A", "b", "ab", "é", "É", "中", "b.", "c,", "\t", "d;e", "\x1f", "x\nx", "#"])
    rows = [(rng.choice(["en", "de", None, "und"]), rng.choice([None, "", " ", "a " * 40, " ".join(word() for _ in range(rng.randint(1, 60)))])) for _ in range(150)]
    table = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("clash") for c in ("words", "phrase", "f", "n", "a", "part")})
    got = sorted(map(tuple, collocations.collocations(table, least=4, longest=longest, top=15, width=width).collect()))
    assert got == plain_collocations(rows, 4, longest, 15) and len(got) > 20
    assert collocations.collocations(table.where("false")).count() == 0


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    texts = ["one two. " * 40, "no end " * 30, "", "a", "b, c" * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5), pa.array(texts)], ["lang", "text"])
    got = Counter(tuple(line) for _, _, p in collocations.blocks(iter([batch]), common.WordHashes()) for line in p.lines)
    expected = Counter(tuple(line.encode().split()) for t in texts for line in re.split("[.,]", t) if line.split())
    assert got == expected


def test_bits_are_those_of_the_counters(spark, monkeypatch):
    """Chunks and folds, made small, against counters in one array."""
    rng = random.Random(2)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(30))) for _ in range(60)]
    hashes = common.WordHashes()
    pieces = collocations.Pieces([t.encode() for _, t in rows])
    found = np.concatenate([of for _, _, of in collocations.phrase_hashes(hashes.of(pieces.words()), pieces.left(), hashes[b"en"], 3)])
    table = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for width in (8, 1 << 9, 1 << 22):
        counts = np.bincount(collocations.slots(found, width), minlength=width)
        bits = np.unpackbits(collocations.sketch(table, width, 4, 3), bitorder="little").astype(bool)
        assert (bits == (counts >= 4)).all()
    monkeypatch.setattr(collocations, "BITS", 1 << 21)  # twice as many counters as bits
    folded = np.unpackbits(collocations.sketch(table, 1 << 22, 4, 3), bitorder="little").astype(bool)
    assert (folded == bits.reshape(2, -1).any(axis=0)).all() and folded.any()
    assert sorted(map(tuple, collocations.collocations(table, least=4, top=15, width=1 << 22).collect())) == plain_collocations(rows, 4, 3, 15)
    x = np.array([0, 1, 70_000, 1 << 31], np.uint32)
    assert (collocations.restored(collocations.squeezed(x), 4, np.uint32) == x).all()


def test_phrases_with_one_hash_are_told_apart(monkeypatch):
    pieces = collocations.Pieces([b"a b c a b d"])
    bits = np.full(1, 255, np.uint8)
    monkeypatch.setattr(collocations, "phrase_hashes", lambda words, left, seed, longest: iter([(2, np.arange(5), np.zeros(5, np.uint64))]))
    phrases, sizes, n = collocations.counts_of(pieces, 0, common.WordHashes(), bits, 2)
    assert dict(zip(phrases, n.tolist())) == {b"a b": 2, b"b c": 1, b"c a": 1, b"b d": 1} and set(sizes) == {2}


def test_scores_are_exact_beyond_64_bits(spark):
    a, f = 3_000_000_001, 4_000_000_007
    candidates = spark.createDataFrame([("en", 2, "x y", a)], "lang string, words int, phrase string, a long")
    counts = spark.createDataFrame([("en", "x", f), ("en", "y", a)], "lang string, part string, f long")
    assert collocations.with_scores(candidates, counts, 3).first().score == 1_000_000 * a * a // (f * a)


# What earlier operators had left open


def test_fingerprints_without_reused_shuffles(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.repeat(F.col("id").cast("string"), 5)).alias("text")).union(spark.createDataFrame([(None, "x"), (None, None)], "doc_id long, text string"))
    expected = {(r.doc_id, r.edited_sha256) for r in fingerprints.fingerprints(docs).collect()}
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = fingerprints.fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert len(rows) == 602 and len({r.doc_id for r in rows}) == 601 and {(r.doc_id, r.edited_sha256) for r in rows} == expected


def test_values_behind_words_and_signs():
    move = pii.Permutation(b"k").of
    for text, kind in {"no.4111111111111111": "card", "Tel.555-123-4567": "phone", "ssn/123-45-6789": "ssn", "dob-1990-01-02": "date", "BE68 5390 0754 7034 CALL": "iban", "BE68 5390 0754 7034 call": "iban"}.items():
        new, counts = pii.pseudonymised(text, move)
        assert counts[kind] == 1 and sum(counts.values()) == 1 and len(new) == len(text) and new != text and new[-4:] == text[-4:] if "all" in text.lower() else counts[kind] == 1
    for text in ("12-1990-01-02", "1.2.3.4.5", "v1.2.3.4", "x4111111111111111"):
        assert pii.pseudonymised(text, move)[0] == text
    digits = "7" * 1_000_000
    assert pii.pseudonymised(digits, move)[0] == digits


def test_ties_in_the_mixture(spark):
    """Copies of one document have one key, sources one size and weight: results are the same in any order of rows."""
    rows = [(i, "same words here", "en", f"src{i % 4}", 3) for i in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        results.append(sorted((r.doc_id, r.copies) for r in mixing.mix(spark.createDataFrame(rows, schema), **queries.mixture_of()).collect()))
    assert results[0] == results[1] and sum(c for _, c in results[0]) > 0
