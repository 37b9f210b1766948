"""Operators against plain statements of their contracts, exact round trips, and held-out accuracy."""

import bisect
import datetime
import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftwork.llm import common, exact_dedup, fingerprints, mixing, ngram_join, packing, pii, quality, queries, substring_dedup, toxicity

WORD = r"[^\x20\x09-\x0D]+"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


def components(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets, key=lambda i: len(sets[i]))
    for at, i in enumerate(ids):
        for j in ids[at + 1 :] if sets[i] else []:
            if len(sets[j]) * percent > 100 * len(sets[i]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall(WORD, low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(documents, texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    expected = components(sets, percent)
    for r in ngram_join.jaccard_components(documents, k, percent).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), expected[r.doc_id])


@pytest.mark.parametrize("percent", [80, 90])
def test_jaccard_of_chains_and_small_sets(spark, percent):
    """Copies with a few words changed each: links that are not transitive, of all sizes."""
    rng, rows = random.Random(percent), []
    for n in (1, 2, 3, 5, 9, 12, 20, 40, 80, 200):
        words = [f"w{rng.random()}" for _ in range(n)]
        for _ in range(12):
            words = list(words)
            words[rng.randrange(n)] = f"w{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    expected = components({i: shingles(t, 1) for i, t in rows}, percent)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_jaccard_of_a_large_group_below_the_threshold(spark, monkeypatch):
    """Documents that are all alike but do not link have many keys in common: few of their pairs may leave the tree."""
    rng, rows, handed = random.Random(5), [], []
    base = [f"b{i}" for i in range(500)]
    for i in range(80):
        words = list(words if i and i % 8 == 0 else base)
        for at in rng.sample(range(500), 46 if i % 8 else 12):
            words[at] = f"w{rng.random()}"
        rows.append((i, " ".join(words)))
    sets = {i: shingles(t, 1) for i, t in rows}
    prune = ngram_join.prune
    monkeypatch.setattr(ngram_join, "prune", lambda pairs, *rest: handed.append(pairs.count()) or prune(pairs, *rest))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    expected = components(sets, 80)
    assert {r.doc_id: r.component_id for r in got} == expected
    assert handed[-1] < 80 * 79 / 2 / 10


def test_connected_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in common.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_windows_hash_equal_words():
    h = np.random.default_rng(1).integers(0, 1 << 63, 40).astype(np.uint64)
    for k in (1, 2, 3, 5, 16, 31, 40):
        got = common.windows_of(np.concatenate([h, h]), k, 0x1234567)
        assert len(got) == 81 - k and got[0] == got[40] and len(set(got.tolist())) == 40
        assert (common.sliding_min(h, k) == [h[i : i + k].min() for i in range(41 - k)]).all()


def removed(texts, window):
    first, words = {}, {i: re.findall(WORD, t) for i, t in sorted(texts.items())}
    for i, w in words.items():
        for at in range(len(w) - window + 1):
            first.setdefault(tuple(w[at : at + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


def test_substring_dedup(documents, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(documents).collect()}
    assert got == removed(texts, 50)


def test_substring_dedup_of_repetitive_texts(spark):
    """Few distinct words, phrases that repeat inside a text, passages with edits."""
    rng, texts = random.Random(3), {}
    for i in range(60):
        base = texts[rng.randrange(i)].split(" ") if i and rng.random() < 0.7 else [rng.choice("abc") for _ in range(rng.randint(1, 60))]
        base = base[rng.randint(0, 5) :] + [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        texts[i] = " ".join(base * rng.choice([1, 1, 3]))
    table = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(table, 12, 4).collect()}
    assert got == removed(texts, 12)


def test_minimal_perfect_hash():
    keys = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    levels, slot = exact_dedup.build_levels(keys[:4000])
    assert sorted(slot.tolist()) == list(range(4000)) and (exact_dedup.find_slots(levels, keys[:4000]) == slot).all()
    assert exact_dedup.find_slots(levels, keys).max() < 4000


@pytest.mark.parametrize("part", [0.0, 0.3, 1.0])
def test_exact_dedup_whatever_the_history(documents, texts, part):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(i)
    expected = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(documents, part).collect()}
    assert got == expected


def test_slots_decide_exact_copies(documents, texts):
    """A slot that holds another winner gives another result; without an index every digest is its own group."""
    rows = exact_dedup.digests(documents).cache()
    distinct = exact_dedup.distinct_digests(rows, max(texts)).cache()
    history = distinct.select("digest", F.col("doc_past").alias("doc"), F.col("row_past").alias("row"), F.col("n_past").alias("n"))
    right = {bytes(r.digest): r.keep_doc for r in exact_dedup.decide(distinct, exact_dedup.build_index(history, 3), 3).collect()}
    firsts = {}
    for i, text in sorted(texts.items()):
        firsts.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()).digest(), i)
    assert right == firsts
    wrong = exact_dedup.build_index(history.withColumn("doc", F.lit(-7).cast("long")), 3)
    assert {r.keep_doc for r in exact_dedup.decide(distinct, wrong, 3).collect()} == {-7}
    none = exact_dedup.decide(distinct, exact_dedup.build_index(history.where("false"), 3), 3)
    assert {r.keep_doc for r in none.collect()} == {0}


@pytest.mark.parametrize("vocabulary", [2, 16, 17, 300, 5000])
def test_located_phrases(vocabulary):
    draw = np.random.default_rng(vocabulary)
    word = [str(i).encode() for i in range(vocabulary)]
    documents = [[word[i] for i in draw.integers(0, vocabulary, n)] for n in (0, 2, 3, 40, 4000)]
    phrases = [b" ".join(documents[4][i : i + 3]) for i in draw.integers(0, 3000, 1000)]
    for some in (phrases, phrases[:1], []):
        expected = [[i for i in range(len(d) - 2) if b" ".join(d[i : i + 3]) in set(some)] for d in (documents if len(some) < 2 else documents[:4])]
        got = [x.tolist() for x in substring_dedup.locate(documents, list(dict.fromkeys(some)), 3)]
        assert got[: len(expected)] == expected


def test_automata_decide_repeated_windows(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [(i, i, " ".join([f"a{i}", *words, f"b{i}"]), 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc long, row long, text string, block long")
    shards, spelled = substring_dedup.recurring(docs, 1, 50, 16)
    phrases = {r.words for r in shards.collect()}
    assert phrases == {r.words for r in spelled.collect()} and all(p.decode() in " ".join(words) for p in phrases)
    assert {r.doc for r in substring_dedup.runs(docs, shards, 50, 16).collect()} == {0, 1, 2}
    assert substring_dedup.runs(docs, shards.where("false"), 50, 16).count() == 0
    other = shards.withColumn("words", F.lit(" ".join(f"x{i}" for i in range(16)).encode()))
    assert substring_dedup.runs(docs, other, 50, 16).count() == 0


def test_encode_equals_the_tokenizer(texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["", " ", "\n\n  x", "<|endoftext|> and <|x", "it's 12'345 ½ ²", "中文 😀 é", "a b c", "ſtraße ǅ", "\x1c\x85", "tab\tand\r\nline", "a" * 3000]
    for some in (odd, list(texts.values())):
        assert packing.encode(some, **{k: v for k, v in queries.TOKENIZER.items()}) == [e.ids for e in plain.encode_batch(some, add_special_tokens=False)]


def test_packing(documents, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in packing.pack(documents, **queries.TOKENIZER).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    total = 0
    for i, text in texts.items():
        ids, at = [*plain.encode(text, add_special_tokens=False).ids, 0], 0
        total += len(ids)
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()))
            at += r.length
        assert at == len(ids) and (len(pieces[i]) == 1 or all(r.length == 2048 for r in pieces[i] if r.piece))
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    lengths = [r.length for rows in pieces.values() for r in rows]
    assert len(sequences) <= best_fit_decreasing(lengths, 2048) * 1.005 + 1


def best_fit_decreasing(lengths, most):
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else most
        opened += gap == most
        if gap > n:
            bisect.insort(gaps, gap - n)
    return opened


def test_brackets():
    """Each gap, from the smallest, takes the largest piece that is still free and fits."""
    rng = random.Random(2)
    for _ in range(300):
        rows = sorted((rng.randint(1, 9), rng.randint(0, 1)) for _ in range(rng.randint(0, 14)))
        stack, expected = [], set()
        for at, (_, kind) in enumerate(rows):
            if kind == packing.PIECE:
                stack.append(at)
            elif stack:
                expected.add((stack.pop(), at))
        pieces, gaps = packing.brackets(np.array([k for _, k in rows], np.int64))
        assert set(zip(pieces.tolist(), gaps.tolist(), strict=True)) == expected


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_sweeps_of_ranges_equal_one_sweep(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randint(0, 1), i, rng.randint(1, 40), i) for i in range(300)]
    found = packing.swept(spark.createDataFrame(rows, "kind int, id long, n long, seq long"), ranges).cache()
    counts = {(r.part, r.kind): r["count"] for r in found.where("kind <> 2").groupBy("part", "kind").count().collect()}
    gaps, pieces = packing.resolve(counts)
    got = {(r.id, r.seq) for r in found.where("kind = 2").collect()}
    taken = {r.match: r.seq for r in packing.numbered(found.where("kind = 1"), gaps).collect() if r.match is not None}
    got |= {(r.id, taken[r.match]) for r in packing.numbered(found.where("kind = 0"), pieces).collect() if r.match is not None}
    rows = sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    a, b = packing.brackets(np.array([r[0] for r in rows]))
    assert got == {(rows[i][1], rows[j][3]) for i, j in zip(a.tolist(), b.tolist(), strict=True)}


def test_best_fit_of_many_lengths(spark):
    rng, most = random.Random(4), 64
    for lengths in ([rng.randint(1, 64) for _ in range(2000)], [rng.choice([1, 2, 33]) for _ in range(1500)], [1] * 500, [64] * 7, [40] * 20):
        table = spark.createDataFrame(list(enumerate(lengths)), "id long, n long")
        rows = packing.best_fit(table, most).collect()
        sums = Counter()
        for r in rows:
            sums[r.seq] += lengths[r.id]
        assert sorted(r.id for r in rows) == list(range(len(lengths))) and max(sums.values()) <= most
        assert len(sums) <= best_fit_decreasing(lengths, most) * 1.02 + 1


def test_fingerprints(documents, texts):
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in fingerprints.fingerprints(documents).collect()}
    names = {}
    for at, i in enumerate(order):
        t, nxt, r = texts[i], texts[order[(at + 1) % len(order)]], rows[i]
        cut = len(t) // 3
        new = t[: len(t) - cut] + nxt[:cut]
        same = next((n for n, (a, b) in enumerate(zip(t, new, strict=False)) if a != b), min(len(t), len(new)))
        assert (r.n_chars, r.edited_sha256, r.common_prefix) == (len(t), hashlib.sha256(new.encode()).hexdigest(), same)
        names.setdefault(t, set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in names.values()) and len(names) == len(set().union(*names.values()))
    assert sum(r.near_edited > r.near_next for r in rows.values()) >= 0.98 * len(rows)


def test_likeness_estimates_common_spans():
    """Against the true share of common spans, for texts of all lengths, on both sides of any border."""
    rng, powers = random.Random(6), fingerprints.Powers()

    def spans(t):
        k = fingerprints.SPAN
        return {("in", t[i : i + k]) for i in range(len(t) - k + 1)} | {("start", t[:i]) for i in range(1, min(k - 1, len(t)) + 1)} | {("end", t[-i:]) for i in range(1, min(k - 1, len(t)) + 1)}

    for n in [*range(1, 40), 100, 400, 3000]:
        a = "".join(rng.choices("abcdefgh ", k=n))
        for b in (a + "x", a[: n - n // 3] + "".join(rng.choices("ijklm", k=n // 3)), "".join(rng.choices("nopq", k=n)), a):
            x, y = spans(a), spans(b)
            got = fingerprints.likeness(*(fingerprints.fingerprint(fingerprints.Prefixes(fingerprints.code_points(t), powers))[1] for t in (a, b)))
            true = 2 * len(x & y) / (len(x) + len(y))
            assert abs(got - true) < (0.02 if max(len(x), len(y)) <= 24 else 0.3), (n, got, true)


def test_spans_and_extensions():
    rng, powers = random.Random(5), fingerprints.Powers()
    for _ in range(200):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(2))
        pa, pb = (fingerprints.Prefixes(fingerprints.code_points(x), powers) for x in (a, b))
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert fingerprints.common_extension(pa, i, pb, j) == n
        k = rng.randint(0, 5)
        assert fingerprints.equal_spans(pa, i, pb, j, k) == (i + k <= len(a) and j + k <= len(b) and a[i : i + k] == b[j : j + k])


def test_pseudonyms():
    p = pii.Permutation(b"k")
    for n in (1, 2, 3, 10, 1000, 73049):
        xs = range(min(n, 1000))
        ys = [p.of(x, n, "a") for x in xs]
        assert len(set(ys)) == len(xs) and all(0 <= y < n for y in ys) and [p.of(y, n, "a", True) for y in ys] == list(xs)
    text = "card 4111 1111 1111 1111, 4111111111111111 not 4111111111111112; +1 (499) 555-6503 ip 174.91.180.241 no 999.1.1.1 v1.2.3.4.5 on 2020-02-29 or 29.02.2020 not 2021-02-30 ssn 123-45-6789 not 000-45-6789 iban DE89 3704 0044 0532 0130 00 me.55@mail4.example.com"
    new, counts = pii.pseudonymised(text, p.of)
    assert counts == {"card": 2, "phone": 1, "ip": 1, "date": 2, "ssn": 1, "iban": 1, "email": 1}
    old, other = text.split(), new.split()
    assert len(old) == len(other) and all(len(a) == len(b) or "." in a for a, b in zip(old, other, strict=True))
    for kept in ("4111111111111112;", "999.1.1.1", "v1.2.3.4.5", "2021-02-30", "000-45-6789"):
        assert kept in other
    spaced = re.search(r"card (\d{4} \d{4} \d{4} \d{4})", new)[1]
    joined = re.search(r", (\d{16}) not", new)[1]
    assert spaced.replace(" ", "") == joined and pii.luhn_digit(joined[:-1]) == int(joined[-1])
    iso, dotted = re.search(r"on (\S+) or (\S+) not", new).groups()
    assert iso == "-".join(reversed(dotted.split(".")))


def test_forms_of_pseudonyms():
    move = pii.Permutation(b"k").of
    back = lambda x, n, kind: move(x, n, kind, True)
    rng, values = random.Random(9), []
    day = lambda: datetime.date.fromordinal(rng.randint(pii.FIRST_DAY, pii.FIRST_DAY + pii.DAYS - 1))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    for _ in range(300):
        d, body = day(), digits(15)
        values += [("date", f"{d.year}-{d.month:02d}-{d.day:02d}"), ("date", f"{d.day}.{d.month}.{d.year}"), ("date", f"{d.year}/{d.month}/{d.day}")]
        values += [("card", body + str(pii.luhn_digit(body))), ("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4)))]
        values += [("phone", f"+1 ({digits(3)}) 555-{digits(4)}"), ("phone", f"+49 {rng.randint(20, 999)} {rng.randint(1000, 99999999)}"), ("phone", f"+33 {rng.randint(1, 9)} " + " ".join(digits(2) for _ in range(4)))]
        values += [("phone", f"{rng.randint(200, 999)} {digits(3)} {digits(4)}"), ("phone", f"{digits(3)}-{digits(3)}-{digits(4)}"), ("ssn", f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}")]
    new = {}
    for kind, value in values:
        found, counts = pii.pseudonymised(f"see {value} there", move)
        assert counts[kind] == sum(counts.values()) == 1, value
        got = found[4:-6]
        if kind != "ip":
            assert re.sub("[0-9]", "0", got) == re.sub("[0-9]", "0", value), (value, got)
        if kind == "phone" and value[0] == "+":
            assert got.split()[0] == value.split()[0]
        assert pii.pseudonymised(f"see {got} there", back)[0] == f"see {value} there"
        assert new.setdefault(value, got) == got
    assert len(set(new.values())) == len(new)
    stamp, _ = pii.pseudonymised("at 2021-03-05T10:00:00Z or 5.3.2021", move)
    y, m, d = map(int, re.search(r"at (\d{4}-\d{2}-\d{2})T10:00:00Z", stamp)[1].split("-"))
    assert stamp.endswith(f"or {d}.{m}.{y}") and (y, m, d) != (2021, 3, 5)
    plain = "+999 12 or 6405768150 or +0 12345678 or 100 200 3000 or 2021-02-30T10:00"
    assert pii.pseudonymised(plain, move)[0] == plain


def test_pseudonyms_link_documents(documents, texts):
    got = {r.doc_id: r for r in pii.pseudonymise(documents, b"key").collect()}
    for i, t in texts.items():
        r = got[i]
        assert (r.text != t) == any(r[f"n_{k}"] for k in pii.KINDS)
        assert not {m for m in re.findall(r"(?<![\w.])\d{16}(?![\w])", t) if pii.luhn_digit(m[:-1]) == int(m[-1]) and len(set(m)) > 1} & set(re.findall(r"\d{16}", r.text))


def test_mixture_keeps_budgets(documents):
    rows = mixing.mix(documents, **queries.mixture_of()).toPandas()
    taken = (rows.n_tokens * rows.copies).groupby(rows.domain).sum()
    # The prefix of each of some 80 leaves ends before the document that its budget does not hold.
    assert rows.copies.max() <= 2 and 0.9 < taken.sum() / (0.8 * rows.n_tokens.sum()) <= 1
    lone = mixing.mix(documents, **(queries.mixture_of() | {"lang_weights": {"en": 1}, "other": 0, "domain_weights": {"crawl": 1, "set0": 1, "set1": 1, "set2": 1}, "source_weights": {f"src{i}": 1 for i in range(20)}})).toPandas()
    assert set(lone[lone.copies > 0].lang) == {"en"}


def test_mixture_rows_follow_copies(documents):
    copies = {r.doc_id: r.copies for r in mixing.mix(documents, **queries.mixture_of()).collect()}
    rows = mixing.mixture(documents, **queries.mixture_of()).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in rows} == {k: v for k, v in copies.items() if v}


@pytest.fixture(scope="module")
def larger(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def test_toxicity_of_held_out_rows(larger):
    docs, labels = larger
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    hit = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert rows.score.between(0, 1).all() and hit / (rows.toxic == 1).sum() > 0.8 and hit / (rows.predicted == 1).sum() > 0.8


def test_quality_of_held_out_rows(larger):
    docs, labels = larger
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (~rows.kept & (rows.quality == 1)).sum() <= 0.01 * len(rows) and (rows.kept & (rows.quality == 0)).sum() <= 0.02 * len(rows)


def test_pseudo_labels_come_from_all_documents(documents, texts):
    """A round by hand: every document of which a view is sure, with the other view's features."""
    rows = quality._features(quality._columns(documents).withColumn("y", F.lit(-1))).cache()
    held = {r.doc_id: [np.frombuffer(r[c], np.float16).astype(np.float32) for c in quality.VIEWS] for r in rows.collect()}
    moments = quality.moments(rows)
    for v, (mean, deviation) in enumerate(moments):
        x = np.stack([h[v] for h in held.values()]).astype(np.float64)
        assert np.allclose(mean, x.mean(axis=0), atol=1e-6) and np.allclose(deviation, x.std(axis=0), atol=1e-4)
    rng, views = np.random.default_rng(8), [quality.View(*m) for m in moments]
    for view in views:
        view.w = rng.normal(0, 0.3, len(view.w)).astype(np.float32)
    calibration = [np.array([1.1, 0.2]), np.array([0.9, -0.3])]
    given = quality.pseudo_labels(rows, 1 << 40)(views, calibration, 0.5)
    for to in (0, 1):
        by, expected = 1 - to, []
        for h in held.values():
            p = 1 / (1 + np.exp(-(calibration[by][0] * views[by].logit(h[by][None, :])[0] + calibration[by][1])))
            expected += [(label, h[to].tobytes()) for label, sure in ((1, p), (0, 1 - p)) if sure >= quality.SURE]
        assert sorted(expected) == sorted((int(y), x.tobytes()) for x, y in zip(*given[to], strict=True)) and expected


def test_labels_and_metadata_are_no_inputs_of_toxicity(spark):
    docs = spark.createDataFrame([(i, f"{'idiot' if i % 3 == 0 else 'kind'} word{i % 7} here", "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    changed = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), changed).collect()}
    assert a == b and all((a[i] >= 0.3) == (i % 3 == 0) for i in a)


def expression_evidence(rows):
    """Of (text, class) rows: the function that gives a word's difference of log-likelihoods, without any table of bounded size."""

    def of(word):
        w = f" {word} "
        return [w[max(0, i - 5) : i + 1] for i in range(1, len(w))]

    counts = [Counter(), Counter()]
    for text, y in rows:
        counts[y].update(e for w in text.split() for e in of(w))
    sums, kinds = ([Counter(), Counter()] for _ in range(2))
    for y in (0, 1):
        for e, n in counts[y].items():
            sums[y][e[:-1]] += n
            kinds[y][e[:-1]] += 1
    types = {e.rjust(6, "^") for e in counts[0].keys() | counts[1].keys()}
    ends = []  # by order: in how many expressions of the next order each ends
    for order in range(5, 0, -1):
        ends.insert(0, Counter(e[-order:] for e in types))
        types = set(ends[0])

    def shared(e):
        """Continuation probability of the last byte of ``e`` (at most five bytes)."""
        if not e:
            return 1 / 257
        level, context = ends[len(e) - 1], e[:-1]
        same = [n for x, n in level.items() if x[:-1] == context]
        return (level[e] - 0.75) / sum(same) + 0.75 * len(same) / sum(same) * chained(e[1:])

    chained = functools.cache(shared)

    def llr(e):
        context = e[:-1]
        gamma = [0.75 * kinds[y][context] / sums[y][context] if sums[y][context] else 1.0 for y in (0, 1)]
        if not (counts[0][e] or counts[1][e]):
            return math.log(gamma[1] / gamma[0])
        p = chained(e.rjust(6, "^")[1:])
        own = [max(counts[y][e] - 0.75, 0) / sums[y][context] if sums[y][context] else 0.0 for y in (0, 1)]
        return math.log((own[1] + gamma[1] * p) / (own[0] + gamma[0] * p))

    llr = functools.cache(llr)
    return lambda word: sum(map(llr, of(word)))


def test_toxicity_uses_every_expression(spark):
    rng = random.Random(11)
    texts = {i: " ".join("".join(rng.choices("abcdefghi", k=rng.randint(5, 9))) for _ in range(30)) for i in range(120)}
    hashes = {i: zlib.crc32(str(i).encode()) for i in texts}
    evidence = expression_evidence([(t, int(i % 3 == 0)) for i, t in texts.items() if hashes[i] % 4 != 2 and hashes[i] // 4 % 8])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.by_length for r in toxicity.score_toxicity(docs, docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert abs(got[i] - sum(map(evidence, t.split())) / (len(t) + 1)) < 1e-4, i


def test_jaccard_counts_all_links(spark):
    rng = random.Random(12)
    base, rows = [f"w{i}" for i in range(60)], []
    for i in range(150):  # more than two parts of a component, most within one link of each other
        words = list(base)
        for at in rng.sample(range(60), rng.randint(0, 2)):
            words[at] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000, "one two three"), (1001, "one two  three"), (1002, "alone"), (None, rows[0][1]), (1003, None), (1000, "one two three")]
    got = {r.doc_id: r.n_links for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1).where("doc_id is not null").collect()}
    sets = {i: set((t or "").split()) for i, t in rows if i is not None}
    for i, s in sets.items():
        assert got[i] == sum(j != i and bool(s) and 100 * len(s & o) >= 90 * len(s | o) for j, o in sets.items()), i
