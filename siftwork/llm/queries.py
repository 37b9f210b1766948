"""The queries of the text operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .exact_dedup import exact_dedup
from .fingerprints import fingerprints
from .hard_negatives import mine_embeddings
from .mixing import mix
from .ngram_join import jaccard_components
from .packing import pack
from .pii import pseudonymise
from .quality import classify
from .sharding import shard_documents
from .substring_dedup import remove_repeats
from .toxicity import score_toxicity
from .warc import round_trip

#: The vocabulary of the packing queries; files outside the repository.
TOKENIZER = {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), **TOKENIZER)


#: The tree of the mixing queries: the number in a source's name decides its domain.
def mixture_of() -> dict:
    return {
        "domain": F.when(F.col("source") == "src0", "crawl").otherwise(F.concat(F.lit("set"), (F.coalesce(F.regexp_extract("source", "([0-9]{1,9})", 1).try_cast("long"), F.lit(0)) % 3).cast("string"))),
        "domain_weights": {"crawl": 3, "set0": 2, "set1": 2, "set2": 1},
        "lang_weights": {"en": 4, "de": 2, "fr": 2, "es": 1},
        "source_weights": {"src1": 3, "src2": 2},
        "other": 1,
        "part": 0.8,
        "epochs": 2,
        "seed": 17,
    }


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), **mixture_of())


#: The key of the query over test tables; real keys are secrets that callers pass.
TEST_KEY = b"key of the test tables"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), TEST_KEY)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_warc": op4_warc,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_mixing": op6_mixing,
        "op7_pii": op7_pii,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_fingerprints": op9_fingerprints,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_sharding": op11_sharding,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": r"""
            WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
                 g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
            SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256 FROM d JOIN g USING (h)""",
        "op4_warc": """
            WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
                 g AS (SELECT payload_bytes, payload_digest, max(page_id) AS stored FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
            SELECT page_id, payload_bytes, payload_digest, CASE WHEN stored <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN stored <> page_id THEN stored END AS refers_to
            FROM p LEFT JOIN g USING (payload_bytes, payload_digest)""",
        "op6_mixing": r"""
            WITH d AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' ELSE 'set' || CAST(coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{1,9})', 1), '') AS BIGINT), 0) % 3 AS VARCHAR) END AS domain,
                              coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens FROM documents),
                 leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
                                 CASE domain WHEN 'crawl' THEN 3.0::DOUBLE WHEN 'set0' THEN 2 WHEN 'set1' THEN 2 ELSE 1 END AS w1,
                                 CASE lang WHEN 'en' THEN 4.0::DOUBLE WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w2,
                                 CASE source WHEN 'src1' THEN 3.0::DOUBLE WHEN 'src2' THEN 2 ELSE 1 END AS w3 FROM d GROUP BY ALL),
                 n1 AS (SELECT domain, CAST(sum(tokens) * 2 AS BIGINT) AS cap, any_value(w1) AS w, CAST(floor((SELECT CAST(sum(tokens) AS BIGINT) FROM leaf) * 0.8::DOUBLE) AS BIGINT) AS given FROM leaf GROUP BY domain),
                 l1 AS (SELECT *, (given - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n1),
                 b1 AS (SELECT domain, CAST(CASE WHEN sum(cap) OVER () <= given THEN cap ELSE floor(least(cap::DOUBLE, w * max(level) OVER ())) END AS BIGINT) AS given FROM l1),
                 n2 AS (SELECT domain, lang, CAST(sum(tokens) * 2 AS BIGINT) AS cap, any_value(w2) AS w, any_value(given) AS given FROM leaf JOIN b1 USING (domain) GROUP BY domain, lang),
                 l2 AS (SELECT *, (given - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n2),
                 b2 AS (SELECT domain, lang, CAST(CASE WHEN sum(cap) OVER (PARTITION BY domain) <= given THEN cap ELSE floor(least(cap::DOUBLE, w * max(level) OVER (PARTITION BY domain))) END AS BIGINT) AS given FROM l2),
                 n3 AS (SELECT domain, lang, source, tokens, tokens * 2 AS cap, w3 AS w, given FROM leaf JOIN b2 USING (domain, lang)),
                 l3 AS (SELECT *, (given - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n3),
                 b3 AS (SELECT domain, lang, source, tokens, CAST(CASE WHEN sum(cap) OVER (PARTITION BY domain, lang) <= given THEN cap ELSE floor(least(cap::DOUBLE, w * max(level) OVER (PARTITION BY domain, lang))) END AS BIGINT) AS budget FROM l3),
                 e AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM b3),
                 k AS (SELECT d.*, epochs, rest, md5(CAST(doc_id AS VARCHAR) || '|17|' || CAST(epochs AS VARCHAR)) AS key FROM d JOIN e USING (domain, lang, source)),
                 r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k)
            SELECT doc_id, domain, lang, source, n_tokens, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies FROM r""",
    }
