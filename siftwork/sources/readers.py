"""Readers of tables of string cells, records, listings, logs and packets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffixes that count as images.
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "webp")
LIBRARY_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "tif", "tiff")
VIDEO_SUFFIXES = ("mp4", "mkv", "mov", "avi", "webm", "m4v")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern matches anything, in whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def as_uri(path: str) -> str:
    """A path with its scheme; one without is local."""
    return path if re.match(r"[a-z0-9+.-]+:/", path) else f"file://{path}"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the place in it: local, HDFS, S3 or GCS."""
    scheme = re.match(r"([a-z0-9+.-]+):/", path)
    if scheme is None or scheme[1] == "file":
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """All cells as strings, quotes doubled inside quotes, cells over several lines; an empty cell is null.

    A path that is not there gives an empty table with ``columns``. With ``columns``, those that a file lacks are null.
    """
    paths = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or ["path"]]))
    rows = spark.read.csv(paths, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
    return rows if columns is None else rows.select(*(F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns))


def read_csvs(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The union of tables by the names of their columns, one scan for each header; None if there is none.

    Paths (of files, folders or patterns) that are not there are left out, and so are files that are no tables;
    ``headers.header_index`` names those.
    """
    from .headers import header_index, read_tables

    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return None
    index = header_index(spark.read.format("binaryFile").load(there).select("path")).cache()
    try:
        table = read_tables(spark, index) if index.where("problem is null").limit(1).count() else None
    finally:
        index.unpersist()
    return table.drop(table.columns[-1]) if table is not None else None


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A record for each line; blank and malformed lines are dropped."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def listing(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, recursive: bool = False, content: bool = False) -> DataFrame:
    """path, name, bytes (and content if asked for) of the files with one of the suffixes, in any case.

    Only names and sizes are read unless ``content`` is set; sort by path where an order is needed.
    """
    either = ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s) for s in suffixes)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{either}}}").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"), *(["content"] if content else []))


def first_file(files: DataFrame) -> DataFrame:
    """The first file by name: a top-1, not a sort."""
    return files.orderBy("name").limit(1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, cleanup_reason 'manual': the trimmed lines of a list that are not empty."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''").withColumn("cleanup_reason", F.lit("manual"))


def read_profile(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """bin, n of a JSON profile {"bins": {bin: n}}; ``fallback`` if there is none."""
    if not path_exists(spark, path):
        return fallback
    return spark.read.schema("bins map<string,long>").option("multiLine", True).json(path).select(F.explode("bins").alias("bin", "n"))


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of several configuration files that is there."""
    return next((p for p in paths if path_exists(spark, p)), None)


def discover(columns: list[str], prefixes: tuple[str, ...] = ("pose_", "gaze_"), units: tuple[str, ...] = ("_r", "_c")) -> list[str]:
    """The columns with one of the prefixes, and those of action units (AU.._r, AU.._c)."""
    return [c for c in columns if c.startswith(prefixes) or (c.startswith("AU") and c.endswith(units))]


# Layout of a tracker's packet, little-endian, 73 bytes in front of what is not read.
PACKET = [("timestamp", "<f8"), ("face_id", "<i4"), ("width", "<f4"), ("height", "<f4"), ("blink_l", "<f4"), ("blink_r", "<f4"), ("success", "u1"), ("pnp_error", "<f4"), ("quat", "<f4", 4), ("euler", "<f4", 3), ("move", "<f4", 3)]
PACKET_BYTES = 73
PACKET_SCHEMA = "timestamp double, face_id int, width float, height float, blink_l float, blink_r float, success int, pnp_error float, yaw float, pitch float, roll float, tx float, ty float, tz float, quat_raw array<float>"


def packet_fields(packets: pd.Series) -> pd.DataFrame:
    """The fields of packets; all null for packets that are too short."""
    names = [x.split()[0] for x in PACKET_SCHEMA.split(", ")]
    ok = [p is not None and len(p) >= PACKET_BYTES for p in packets]
    r = np.frombuffer(b"".join(bytes(p)[:PACKET_BYTES] for p, whole in zip(packets, ok, strict=True) if whole), np.dtype(PACKET))
    fields = [r[n] for n in names[:8]] + [r["euler"][:, i] for i in range(3)] + [r["move"][:, i] for i in range(3)] + [r["quat"]]
    rows = iter(zip(*(f.tolist() for f in fields), strict=True))
    return pd.DataFrame([next(rows) if whole else (None,) * len(names) for whole in ok], columns=names, dtype=object)


def decode_packet(packets: Column) -> Column:
    """A struct of the fields of binary packets."""

    @F.pandas_udf(PACKET_SCHEMA)
    def fields(column: pd.Series) -> pd.DataFrame:
        return packet_fields(column)

    return fields(packets)


# The two kinds of lines of a tracker's log.
TOOK = r"(?i)Took\s+([0-9.]+)ms\s*\(\s*detect:\s*([0-9.]+)ms,\s*crop:\s*([0-9.]+)ms,\s*track:\s*([0-9.]+)ms,\s*3D points:\s*([0-9.]+)ms\)"
CONFIDENCE = r"(?i)Confidence\[\d+\]\s*:\s*([0-9.]+)\s*/\s*3D\s+fitting\s+error:\s*([0-9.]+)\s*/\s*Eyes:\s*([OC]),\s*([OC])"


def log_fields(line: Column) -> dict[str, Column]:
    """kind (took, confidence or null) and the fields of a log line."""
    number = lambda p, i: F.regexp_extract(line, p, i).try_cast("double")
    word = lambda i: F.nullif(F.regexp_extract(line, CONFIDENCE, i), F.lit(""))
    out = {"kind": F.when(line.rlike(TOOK), "took").when(line.rlike(CONFIDENCE), "confidence")}
    out |= {n: number(TOOK, i) for i, n in enumerate(("proc_ms", "detect_ms", "crop_ms", "track_ms", "points3d_ms"), 1)}
    return out | {"confidence": number(CONFIDENCE, 1), "fit_error": number(CONFIDENCE, 2), "eye_l": word(3), "eye_r": word(4)}


def sample_frames(videos: DataFrame, decode, rate: float, schema: str) -> DataFrame:
    """Frames of videos at about ``rate`` a second.

    ``videos``: path, frame_rate. ``decode(path, step)`` yields tuples of ``schema``, for every step-th frame; it runs in
    tasks, a video at a time, and its rows are sent on in batches.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, source_rate in zip(f["path"], f["frame_rate"], strict=True):
                step, rows = max(1, round((source_rate or 30.0) / rate)), []
                for row in decode(path, step):
                    rows.append(row)
                    if len(rows) == 64:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    return videos.select("path", "frame_rate").mapInPandas(run, schema)
