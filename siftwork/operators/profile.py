"""Counts of categories: by key, zero-filled by section, and as a rendered table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import DOMAINS

# The order of sections in reports, and the layout of its lines.
SECTION_ORDER = ["GAZE", "EYES", "MOUTH", "SMILE", "EMOTION", "YAW", "PITCH", "IDENTITY", "QUALITY", "TEMP", "EXPOSURE"]
BAR_WIDTH, RULE_WIDTH = 16, 112


def key_counts(rows: DataFrame, keys: list[str], count: str = "count") -> DataFrame:
    """Rows by their keys; a missing key is empty."""
    return rows.groupBy(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys)).agg(F.count("*").alias(count))


def domain(spark: SparkSession, sections: dict[str, list[str]]) -> DataFrame:
    """section, section_ord, label, label_ord; one row for each label."""
    rows = [(s, i, label, j) for i, (s, labels) in enumerate(sections.items()) for j, label in enumerate(labels)]
    return spark.createDataFrame(rows, "section string, section_ord int, label string, label_ord int")


def section_histogram(rows: DataFrame, columns: dict[str, str], sections: dict[str, list[str]] | None = None) -> DataFrame:
    """section, label, count for every label of the domain, 0 where there are none.

    ``columns``: the column of each section. One pass: the sections are unpivoted and counted together.
    """
    sections = sections or DOMAINS
    wanted = {s: sections[s] for s in columns}
    pairs = ", ".join(f"'{s}', cast(`{c}` as string)" for s, c in columns.items())
    counts = rows.select(F.expr(f"stack({len(columns)}, {pairs}) as (section, label)")).groupBy("section", "label").agg(F.count("*").alias("n"))
    shown = F.broadcast(domain(rows.sparkSession, wanted))
    return shown.join(counts, ["section", "label"], "left").select("section", "section_ord", "label", "label_ord", F.coalesce("n", F.lit(0)).alias("count"))


def map_histogram(tagged: DataFrame, sections: dict[str, list[str]] | None = None) -> DataFrame:
    """``section_histogram`` of a table with a map column ``bins``."""
    counts = tagged.select(F.explode("bins").alias("section", "label")).groupBy("section", "label").agg(F.count("*").alias("n"))
    shown = F.broadcast(domain(tagged.sparkSession, sections or DOMAINS))
    return shown.join(counts, ["section", "label"], "left").select("section", "section_ord", "label", "label_ord", F.coalesce("n", F.lit(0)).alias("count"))


def coverage_report(demand: DataFrame, selected: DataFrame, keys: list[str], minimum: int) -> DataFrame:
    """Per demanded bin: target_count, selected, coverage_min, coverage_met. ``demand`` has the keys and n."""
    got = key_counts(selected, keys, "selected")
    out = demand.join(got, keys, "left").withColumn("selected", F.coalesce("selected", F.lit(0)))
    return out.select(*keys, F.col("n").alias("target_count"), "selected", F.lit(minimum).alias("coverage_min"), (F.col("selected") >= F.when(F.col("n") > 0, minimum).otherwise(0)).cast("int").alias("coverage_met"))


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg(F.count_distinct(key).alias("keys"))


def render(histogram: list[tuple[str, str, int]], processed: int, total: int, fails: int, mode: str = "TAG", fps: int | None = None, eta: str | None = None, duplicates: int | None = None, row_duplicates: dict[tuple[str, str], int] | None = None) -> str:
    """The bin table as text. ``histogram``: (section, label, count), a row for each label of the domain, in order.

    In mode MATCH lines also carry the numbers of duplicates.
    """
    matching = mode.upper() == "MATCH"
    whole = max(1, total)

    def line(name: str, width: int, count: int, tail: str) -> str:
        share = 100.0 * count / whole
        cells = "█" * round(BAR_WIDTH * min(100.0, share) / 100)
        return f"{name:<{width}}|{cells:<{BAR_WIDTH}}| {share:6.1f}% {count}{tail}"

    extra = f" DUPE {duplicates}" if matching and duplicates is not None else ""
    head = line(mode.upper(), 11, processed, f"/{whole} FAIL {fails}{extra}" + (f" {fps} FPS   ETA {eta}" if fps is not None and eta else ""))
    rule = "=" * RULE_WIDTH
    out = [rule, rule, head, rule, rule]
    for section in [s for s in SECTION_ORDER if any(h[0] == s for h in histogram)]:
        rows = [(label, n) for s, label, n in histogram if s == section]
        out += [line(section, 11, sum(n for _, n in rows), f" FAIL 0{extra}"), "-" * RULE_WIDTH]
        for label, n in rows:
            again = (row_duplicates or {}).get((section, label)) if matching else None
            out.append(line(label, 12, n, "" if again is None else f" {again}"))
        out += [rule, rule]
    return "\n".join(out) + "\n"
