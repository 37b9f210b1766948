"""Writers: tables of string cells, records, vectors, per-item files, reports, and plans of file actions."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import path_exists


def cells(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` as strings in a fixed order of columns; missing columns and nulls are empty."""
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def write_csv(rows: DataFrame, path: str, columns: list[str], append: bool = False) -> None:
    """A folder of CSV files with the header in each; replaces what is there unless ``append`` is set."""
    cells(rows, columns).write.mode("append" if append else "overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def rewrite_jsonl(rows: DataFrame, path: str) -> None:
    """Replaces a table that ``rows`` may be read from: written beside it first, then renamed in its place."""
    spark = rows.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    rows.write.mode("overwrite").json(new)
    jvm = spark._jvm
    to = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    files = to(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(to(old), True)
    if path_exists(spark, path):
        files.rename(to(path), to(old))
    files.rename(to(new), to(path))
    files.delete(to(old), True)


def write_vectors(rows: DataFrame, path: str, order: str, vector: str = "embedding") -> None:
    """row (number in order, from 0), and the columns of ``rows``, with the vector as an array column, as Parquet.

    Rows are numbered over ranges of the order: no task orders them all.
    """
    from ..operators.dataset import number_rows

    numbered = number_rows(rows, [order], F.lit(-1)).withColumnRenamed("number", "row")
    numbered.withColumn(vector, F.col(vector).cast("array<float>")).write.mode("overwrite").parquet(path)


def write_items(rows: DataFrame, folder: str, name: str, text: str) -> None:
    """A small file for each row, named and filled by two columns, in a folder that all executors share."""
    from pyarrow import fs

    def put(part) -> None:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for row in part:
            with store.open_output_stream(f"{root.rstrip('/')}/{row[name]}", compression=None) as out:
                out.write(row[text].encode())

    rows.select(name, text).foreachPartition(put)


def write_text(text: str, path: str) -> None:
    """A small report on the driver, put in place at once."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    beside = target.with_name(target.name + ".tmp")
    beside.write_text(text, encoding="utf-8")
    beside.replace(target)


def write_metadata(row: DataFrame, path: str) -> None:
    """A table of one row as a JSON file on the driver."""
    write_text(json.dumps(row.limit(1).toPandas().to_dict("records")[0], ensure_ascii=False, indent=2, default=str), path)


def write_run(spark, path: str, **fields) -> None:
    """Appends a record of a run to a table of runs, apart from the items' records."""
    spark.createDataFrame([{k: str(v) for k, v in fields.items()}]).write.mode("append").json(path)


def apply_plan(plan: DataFrame, root: str) -> list[tuple[str, str]]:
    """Carries out a plan's moves (path, action, dst) below a local root, one file after another; returns what failed.

    A caller's choice: operators only make plans. Meant for a plan of files on the driver's disk.
    """
    failed = []
    for row in plan.where(F.col("action").isin("move", "would_move")).toLocalIterator():
        source, target = Path(root, row["path"]), Path(root, row["dst"])
        source = source if source.exists() else Path(root, source.name)
        try:
            target.parent.mkdir(parents=True, exist_ok=True)
            shutil.move(source, target)
        except OSError as e:
            failed.append((row["path"], str(e)))
    return failed
