"""Compiling datasets, keeping a content-addressed library, planning clean-up, and building index lists.

Files are never touched here: operators return plans (source, destination, action) that a caller may apply.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import base_name, first_number, flag_set, flag_unset, padded, stem, suffix
from .ordinals import with_ordinals


def ordered_distinct(rows: DataFrame, column: str, order: str) -> DataFrame:
    """Each value once, with the order of its first row."""
    return rows.groupBy(column).agg(F.min(order).alias(order))


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    """UNION ALL with the union of the columns in order of first sight; missing cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_logs(logs: dict[str, DataFrame]) -> DataFrame:
    """Run logs by their root, together; ``src_root`` is set where a log has no such column."""
    return union_by_name([t if "src_root" in t.columns else t.withColumn("src_root", F.lit(root)) for root, t in logs.items()])


def highest_number(names: DataFrame, column: str) -> DataFrame:
    """One row: the largest first number in the stems of names; 0 without any."""
    return names.agg(F.coalesce(F.max(first_number(stem(F.col(column)))), F.lit(0)).alias("highest"))


def number_rows(rows: DataFrame, order: list[str], start: Column, bucket: str | None = None) -> DataFrame:
    """``rows`` with ``number`` = start + 1, start + 2, ... in ``order``.

    With ``bucket``, a column that rises with the order (a date, an input, a range), rows are numbered within their
    buckets and the buckets' sizes are summed before them; without one, rows are dealt to ranges of the order. Either
    way no task orders all rows.
    """
    if bucket is None:
        return with_ordinals(rows, order, "__ordinal").withColumn("number", start + F.col("__ordinal")).drop("__ordinal")
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("__n"))
    before = sizes.select(bucket, F.coalesce(F.sum("__n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    spot = Window.partitionBy(bucket).orderBy(*order)
    return rows.join(before, bucket).withColumn("number", start + F.col("__before") + F.row_number().over(spot)).drop("__before")


def compile_map(files: DataFrame, have: DataFrame | None = None, width: int = 6) -> DataFrame:
    """src_root, src_path, dst_name: inputs in order (``input_ord``), files by path, numbered on from what the target has.

    ``files``: input_ord, src_root, src_path. ``have``: names (dst_name) that are there already.
    """
    start = highest_number(have, "dst_name") if have is not None else None
    rows = files if start is None else files.crossJoin(F.broadcast(start))
    numbered = number_rows(rows, ["src_path"], F.col("highest") if start is not None else F.lit(0), bucket="input_ord")
    return numbered.select("src_root", "src_path", F.concat(padded(F.col("number"), width), suffix(F.col("src_path"))).alias("dst_name"))


def content_hash(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("hash", F.sha1(content))


def new_items(files: DataFrame, library: DataFrame, dedupe_batch: bool = True) -> DataFrame:
    """``files`` (hash, src_ord, ...) whose hash the library lacks; of equal ones in the batch the first, unless ``dedupe_batch`` is off."""
    fresh = files.join(library.where("hash is not null and hash <> ''").select("hash").distinct(), "hash", "left_anti")
    if not dedupe_batch:
        return fresh
    first = fresh.groupBy("hash").agg(F.min("src_ord").alias("src_ord"))
    return fresh.join(first, ["hash", "src_ord"], "left_semi")


def library_rows(items: DataFrame, root: str, sidecars: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Manifest rows of new items (hash, path): hash, file, and for each kind of sidecar the place of its link, or null.

    ``sidecars``: kind -> (listing with a column stem, folder/suffix such as 'openface_img/.csv').
    """
    out = items.select("hash", F.concat(F.lit(f"{root}/aligned/"), "hash", F.lit(".png")).alias("file"), stem(F.col("path")).alias("__stem"))
    for kind, (listing, place) in (sidecars or {}).items():
        folder, _, ending = place.rpartition("/")
        there = listing.select(F.col("stem").alias("__stem")).distinct().withColumn("__has", F.lit(True))
        out = out.join(there, "__stem", "left").withColumn(kind, F.when(F.col("__has"), F.concat(F.lit(f"{root}/logs/{folder}/"), "hash", F.lit(ending)))).drop("__has")
    return out.drop("__stem")


def refresh_library(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """The manifest rows whose file is still there (``listing``: path)."""
    return manifest.join(listing.select(F.col("path").alias("file")).distinct(), "file", "left_semi").select(*manifest.columns)


def existing(rows: DataFrame, listing: DataFrame, column: str = "path") -> DataFrame:
    return rows.join(listing.select(F.col("path").alias(column)).distinct(), column, "left_semi")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key an earlier run has not finished."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def reasons(cell: Column) -> Column:
    """A comma list as a sorted array of distinct trimmed reasons; 'cleanup' if there is none."""
    parts = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(cell, F.lit("cleanup")), ","), lambda x: F.trim(x)), lambda x: x != "")))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("cleanup")))


def cleanup_candidates(tags: DataFrame, only: list[str] | None = None, ignore: list[str] | None = None) -> DataFrame:
    """path, reason: flagged rows that have one of the ``only`` reasons and none of the ``ignore`` ones (empty: no filter)."""
    rows = tags.where(flag_set(F.col("cleanup_flag"))).select("path", reasons(F.col("cleanup_reason")).alias("r"))
    if only:
        rows = rows.where(F.arrays_overlap("r", F.array(*map(F.lit, only))))
    if ignore:
        rows = rows.where(~F.arrays_overlap("r", F.array(*map(F.lit, ignore))))
    return rows.select("path", F.array_join("r", ",").alias("reason"))


def cleanup_plan(candidates: DataFrame, listing: DataFrame, apply: bool = False) -> DataFrame:
    """path, action, reason, dst: where each candidate's file would go, found by path, then by base name, else missing."""
    a = listing.select(F.col("path"), F.lit(True).alias("__a")).distinct()
    b = listing.select(F.col("path").alias("__base"), F.lit(True).alias("__b")).distinct()
    found = candidates.withColumn("__base", base_name(F.col("path"))).join(a, "path", "left").join(b, "__base", "left")
    there = F.coalesce("__a", "__b", F.lit(False))
    folder = F.coalesce(F.nullif(F.trim(F.get(F.split("reason", ","), 0)), F.lit("")), F.lit("cleanup"))
    dst = F.concat_ws("/", F.lit("bad"), folder, F.col("__base"))
    return found.select("path", F.when(there, "move" if apply else "would_move").otherwise("missing").alias("action"), "reason", F.when(there, dst).otherwise("").alias("dst"))


def source_index(matched: DataFrame, tags: DataFrame) -> DataFrame:
    """path of the matched rows that tags do not flag; rows without tags pass."""
    flags = tags.groupBy("path").agg(F.max(F.struct("src_ord", "cleanup_flag"))["cleanup_flag"].alias("flag"))
    return matched.join(flags, "path", "left").where(flag_unset(F.col("flag"))).select("path")


def target_index(files: DataFrame, tags: DataFrame) -> DataFrame:
    """path of the files whose tags, found by path and then by base name, do not flag them; files without tags pass."""
    last = F.max(F.struct("src_ord", "cleanup_flag"))["cleanup_flag"]
    by_path = tags.groupBy("path").agg(last.alias("f1"), F.lit(True).alias("p1"))
    by_base = by_path.select(F.col("path").alias("__base"), F.col("f1").alias("f2"))
    found = files.withColumn("__base", base_name(F.col("path"))).join(by_path, "path", "left").join(by_base, "__base", "left")
    return found.where(flag_unset(F.when(F.col("p1"), F.col("f1")).otherwise(F.col("f2")))).select("path")


def two_tier(rows: DataFrame, by_first: DataFrame, by_second: DataFrame, first: str, second: str, value: str) -> DataFrame:
    """``rows`` with ``value`` looked up by one key and, where that has none, by another."""
    a, b = by_first.select(first, F.col(value).alias("__1")), by_second.select(second, F.col(value).alias("__2"))
    return rows.join(a, first, "left").join(b, second, "left").withColumn(value, F.coalesce("__1", "__2")).drop("__1", "__2")


def align(left: DataFrame, right: DataFrame, left_order: list[str | Column], right_order: list[str | Column], partition: str | None = None) -> DataFrame:
    """Row i of ``left`` beside row i of ``right`` (within a partition column that both have); unmatched right rows go.

    Without a partition whole tables are aligned, each numbered over ranges of its order.
    """
    if partition is None:
        return with_ordinals(left, left_order).join(with_ordinals(right, right_order), "ordinal", "left")
    n = lambda t, o: t.withColumn("ordinal", F.row_number().over(Window.partitionBy(partition).orderBy(*o)))
    return n(left, left_order).join(n(right, right_order), [partition, "ordinal"], "left")


def to_legacy_tags(tags: DataFrame) -> DataFrame:
    """Current tags (file, yaw_bin, ..., cleanup_ok, reasons) under the older names (path, bin_yaw, ..., cleanup_flag, cleanup_reason)."""
    renamed = {"yaw_bin": "bin_yaw", "pitch_bin": "bin_pitch", "eyes_bin": "bin_eyes", "smile_bin": "bin_smile", "exposure_bin": "bin_light"}
    out = [F.col("file").alias("path"), *(F.col(a).alias(b) for a, b in renamed.items() if a in tags.columns)]
    teeth = F.when(F.col("smile_bin") == "TEETH", "1").otherwise("0").alias("bin_teeth") if "smile_bin" in tags.columns else F.lit("").alias("bin_teeth")
    flag = F.when(F.col("cleanup_ok").cast("string") == "1", "0").otherwise("1").alias("cleanup_flag") if "cleanup_ok" in tags.columns else F.lit("0").alias("cleanup_flag")
    return tags.select(*out, teeth, flag, (F.col("reasons") if "reasons" in tags.columns else F.lit("")).alias("cleanup_reason"))
