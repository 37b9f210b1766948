"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from siftwork.llm import quality, queries
from tests.test_queries import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rows = queries.queries()[name](spark, SF)
    columns = sorted(rows.columns)
    cursor = c.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert sorted(tuple(plain(r[x]) for x in columns) for r in rows.collect()) == sorted(tuple(plain(r[names.index(x)]) for x in columns) for r in cursor.fetchall())


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def near_groups(texts):
    """doc_id -> smallest doc_id that links of five-word shingles with a similarity of 0.8 reach."""
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return group


def test_pipeline(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tables = [table]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        tables.append(stage(spark, tables[-1], SF).cache())
        assert tables[-1].columns == table.columns, name
    whole, good, single, apart, mixed = ({r.doc_id: r.text or "" for r in t.collect()} for t in tables)
    kept = {r.doc_id for r in quality.classify(table, labels).where("kept").collect()}
    assert set(good) == kept and 0 < len(good) < len(whole)
    firsts = {}
    for i in sorted(good):
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[i]), i)
    assert set(single) == set(firsts.values())
    assert set(apart) == {i for i, g in near_groups(single).items() if i == g}
    assert set(mixed) <= set(apart)
    copies = {r.doc_id: r["count"] for r in tables[4].groupBy("doc_id").count().collect()}
    tokens = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in apart.items()}
    assert max(copies.values()) <= 2 and 0 < sum(n * tokens[i] for i, n in copies.items()) <= 0.8 * sum(tokens.values())
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == copies
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    assert max(ends.values()) <= 2048 and sum(ends.values()) == sum(r.length for r in rows)
