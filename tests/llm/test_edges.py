"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns for every operator and stage."""

import pytest
from pyspark.sql import functions as F

from siftwork.llm import exact_dedup, fingerprints, mixing, ngram_join, packing, pii, quality, queries, substring_dedup, toxicity, warc

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "One two three four five six seven", "en", "src1", 5), (2, None, "en", None, None), (3, "", None, "src2", 0), (4, " \t\n ", "de", "src2", 1),
    (5, LONG, "en", "src3", 1), (6, LONG, "en", "src3", 1), (7, "One  two three four five six seven", "xx", "other", 2), (7, "One  two three four five six seven", "xx", "other", 2),
    (None, "no id at all", "en", "src1", 3), (None, None, None, None, None), (8, "é ñ 😀 中文 text", "fr", "src9", 4), (9, "word", "en", "src1", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    # Extra columns with the names that operators use inside or return.
    for c in ("n", "key", "doc", "row", "digest", "score", "kept", "component_id", "piece", "bucket", "budget", "comp", "y", "part", "payload", "whole", "cut_key", "cut_doc", "__id", "__digest", "__tokens", "__copies", "__domain", "domain", "copies", "id", "rows", "repeated", "seq", "block", "band", "page", "pages", "view", "place", "features", "x", "n_docs", "phrase", "first"):
        table = table.withColumn(c, F.lit("clash"))
    return table.cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 10)] + [(None, 1, 1), (5, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


def operators(labels):
    return {
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "substring": substring_dedup.remove_repeats,
        "exact": exact_dedup.exact_dedup,
        "packing": lambda d: packing.pack(d, **queries.TOKENIZER),
        "mixing": lambda d: mixing.mix(d, **queries.mixture_of()),
        "pii": lambda d: pii.pseudonymise(d, b"key"),
        "quality": lambda d: quality.classify(d, labels),
        "fingerprints": fingerprints.fingerprints,
        "join": ngram_join.jaccard_components,
    }


NAMES = ["toxicity", "substring", "exact", "packing", "mixing", "pii", "quality", "fingerprints", "join"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, labels, name):
    rows = operators(labels)[name](docs).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in rows if name != "packing" or r.piece == 0)
    assert ids == sorted((r[0] is None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, name):
    assert operators(labels)[name](docs.where("false")).count() == 0


def test_stages_keep_the_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, str(tmp_path))
        assert rows.columns == docs.columns, name
        assert {x for r in rows.collect() for x in r[5:]} <= {"clash"}, name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
    packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).where("piece = 0").count()
    assert packed == len(ROWS) and corpus_pipeline.packing(spark, docs.where("false"), str(tmp_path)).count() == 0
    assert corpus_pipeline.exact_copies(spark, docs, "").where("doc_id = 7").count() == 0
    assert corpus_pipeline.exact_copies(spark, docs, "").where("doc_id = 1").count() == 1


def test_warc_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "a\r\nb", ""), (2, "u", ""), (None, "u", "x" * 2000), (3, "u", "x" * 2000), (4, "u", "x" * 2000)], "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    rows = warc.round_trip(pages, 128, payload=True).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in rows) == sorted([("1", 0, "response", None), ("2", 0, "response", None), ("2", 0, "response", None), ("None", 2000, "response", None), ("3", 2000, "revisit", 4), ("4", 2000, "response", None)])
    assert {r.url for r in rows if r.page_id == 2} == {"a%0D%0Ab", "u"}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_defined_results(docs, labels):
    exact = {(r.doc_id, r.group_size): r for r in exact_dedup.exact_dedup(docs).collect()}
    assert exact[6, 2].keep_id == 5 and exact[3, 3].keep_id == 2 and exact[4, 1].kept
    assert sum(r.kept for r in exact_dedup.exact_dedup(docs).where("keep_id = 1").collect()) == 1
    join = {r.doc_id: r for r in ngram_join.jaccard_components(docs).where("doc_id is not null").collect()}
    assert join[6].component_id == 5 and join[2].n_shingles == 0 and join[2].component_id == 2 and join[7].component_id == 1 and join[9].n_shingles == 1
    cut = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).where("doc_id is not null").collect()}
    assert cut[5].n_removed == 0 and cut[6].n_removed == cut[6].n_words == 60_000
    assert all(r.score == 1.0 for r in quality.classify(docs, labels.where("false")).collect())
    assert all(r.score == 0.0 and r.predicted == 0 for r in toxicity.score_toxicity(docs, labels.where("toxic = 1")).collect())
