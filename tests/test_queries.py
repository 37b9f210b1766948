"""Every core query against its SQL in DuckDB, on the small tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from siftwork import queries
from siftwork.operators import dataset

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_sql(spark, duck, sf, name):
    rows = queries.queries()[name](spark, sf)
    columns = sorted(rows.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in rows.collect())
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_renumber_equals_sql_past_six_digits(spark, sf, tmp_path):
    part = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey < 30")
    part.write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([("Supplier#000999990",)], "s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    got = queries.queries()["renumber"](spark, str(tmp_path))
    c = duckdb.connect()
    for name in ("part", "supplier"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert sorted(map(tuple, got.collect())) == sorted(c.execute(queries.oracle_sql()["renumber"]).fetchall())
    # The operator itself cuts no number: as many names as files.
    files = part.select(F.col("p_size").alias("input_ord"), F.lit("set").alias("src_root"), F.concat(F.lit("set/"), F.col("p_partkey").cast("string"), F.lit(".PNG")).alias("src_path"))
    named = dataset.compile_map(files, spark.createDataFrame([("999990.png",)], "dst_name string"))
    assert sorted(r.dst_name for r in named.collect()) == sorted(f"{i}.png" for i in range(999_991, 1_000_021))


def test_entry_imports_without_the_text_operators(spark, sf):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.queries()) <= set(__spark_entry__.queries())
