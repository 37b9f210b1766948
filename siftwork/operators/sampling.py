"""Seeded stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(item: Column, seed: int) -> Column:
    """The place of an item in a seeded order that every engine with SHA-1 can compute."""
    return F.sha1(F.concat(item.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def stratified(rows: DataFrame, strata: list[str], item: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows of each stratum in the seeded order. Spark keeps only n rows per stratum and task before the shuffle."""
    spot = Window.partitionBy(*strata).orderBy(draw(F.col(item), seed), item)
    return rows.withColumn("__r", F.row_number().over(spot)).where(F.col("__r") <= n).drop("__r")


def preview(tagged: DataFrame, listing: DataFrame, n: int, seed: int, categories: list[str] | None = None) -> DataFrame:
    """category, label, file, score, path: a sample for each label of each category, of items whose file is there.

    ``tagged``: file, bins (map), scores. ``listing``: file, path. ``categories``: names in any case; empty means all.
    """
    allowed = [c.strip().upper() for c in categories or [] if c.strip()]
    rows = tagged.join(listing, "file").select("file", "path", F.col("scores.bin_score").alias("score"), F.explode("bins").alias("category", "label"))
    rows = rows.where(F.coalesce("label", F.lit("")) != "")
    if allowed:
        rows = rows.where(F.col("category").isin(*allowed))
    return stratified(rows, ["category", "label"], "file", n, seed).select("category", "label", "file", "score", "path")
