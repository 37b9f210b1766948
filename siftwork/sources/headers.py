"""Many files of tables whose headers differ: an index of headers, and one scan for each header.

The first record of each file is read in tasks (some kilobytes of it, whatever its size). Files with equal headers are
one scan with that header as schema; so a thousand logs of five tools are five scans, and a file that cannot be a table is
named in the index instead of failing the job.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import store_of

#: Bytes of a file in which its header must end.
HEAD = 1 << 16
INDEX = "path string, header array<string>, problem string"


def header_of(head: bytes, whole: bool) -> tuple[list[str] | None, str | None]:
    """(names, problem) of a table that begins with ``head``; ``whole``: there is no more of it."""
    if not head.strip():
        return None, "empty"
    if b"\0" in head:
        return None, "not a text"
    try:
        text = head.decode("utf-8-sig", "strict" if whole else "ignore")
        names = next(csv.reader(io.StringIO(text, newline=""), strict=True))
    except UnicodeDecodeError:
        return None, "not UTF-8"
    except csv.Error as e:
        return None, f"no header: {e}" if whole else "no header in its first bytes"
    names = [n.strip() for n in names]
    if not all(names):
        return None, "a column without a name"
    if len({n.lower() for n in names}) < len(names):
        return None, "a name of two columns"
    return names, None


def header_index(files: DataFrame) -> DataFrame:
    """path, header (null for a bad file), problem (null for a good one) of ``files`` (path).

    Paths are opened through ``pyarrow.fs`` (local, HDFS, S3, GCS). Edge cases: a path that cannot be opened, an empty
    file, bytes that are no text, a header that does not end, and names that are empty or come twice are problems; null
    paths are left out; a path that is given twice is read once.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, problems = [], []
            for path in batch.column("path").to_pylist():
                try:
                    store, place = store_of(path)
                    with store.open_input_stream(place, compression=None) as source:
                        head = source.read(HEAD)
                        found = header_of(head, len(head) < HEAD)
                except (OSError, pa.ArrowException) as e:
                    found = None, f"cannot be opened: {type(e).__name__}"
                names.append(found[0])
                problems.append(found[1])
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(names, pa.list_(pa.string())), pa.array(problems, pa.string())], ["path", "header", "problem"])

    return files.select("path").where("path is not null").distinct().mapInArrow(read, INDEX)


def read_tables(spark: SparkSession, index: DataFrame, order: str | None = None) -> DataFrame:
    """The union by name of the good files of an ``index`` (see ``header_index``), all cells as strings, with src_file.

    Columns come in the order of their first sight (headers by their first path), and cells that a header lacks are
    null. The driver gets the paths, as it does for any scan of files.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in index.where("problem is null").orderBy("path").toLocalIterator():
        groups.setdefault(tuple(row.header), []).append(row.path)
    if not groups:
        return spark.createDataFrame([], "src_file string")
    taken = {c.lower() for names in groups for c in names}
    held = next(n for n in ("src_file", *(f"src_file_{i}" for i in range(len(taken) + 1))) if n not in taken)

    def scan(names: tuple[str, ...], paths: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(schema).csv(paths, header=True, enforceSchema=True, multiLine=True, quote='"', escape='"')
        return rows.withColumn(held, F.col("_metadata.file_path"))

    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (scan(*g) for g in groups.items()))
    return out.select(*(c for c in out.columns if c != held), held)
