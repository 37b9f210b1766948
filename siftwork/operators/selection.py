"""Selecting a subset whose bins follow a target's, under a coverage minimum and a budget.

The rules are stated one bin after another, but only scalars pass between bins: coverage of a bin does not depend on the
others, and the fill passes on what remains of the budget. So candidates are ranked within their bins in parallel, a
fold over one row of numbers per bin says how many each bin takes, and ranks are cut at that number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bins
from ..functions.parsing import base_name, scalar, truthy
from ..session import staged
from .ordinals import with_ranks

KEYS = ["bin_yaw", "bin_pitch", "bin_eyes", "bin_smile", "bin_teeth", "bin_light"]
NEAR = ["bin_yaw", "bin_pitch", "bin_smile"]
WEIGHTS = (0.5, 0.2, 0.3)


def key_of(prefix: str = "") -> Column:
    return F.struct(*(F.coalesce(F.col(f"{prefix}{k}").cast("string"), F.lit("")).alias(k) for k in KEYS))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with their six keys as a struct ``key``, a missing one empty."""
    return rows.withColumn("key", key_of())


def row_score(row: str, proto: str, weights: tuple[float, float, float] = WEIGHTS) -> Column:
    """Similarity of a row to a prototype of its bin, with a little for identity and quality. Arguments: prefixes of columns."""
    a, b = (lambda c: F.col(f"{row}bin_{c}")), (lambda c: F.col(f"{proto}.bin_{c}"))
    pose = bins.pose_similarity(a("yaw"), a("pitch"), b("yaw"), b("pitch"))
    light = bins.light_similarity(a("light"), b("light"))
    expression = bins.expression_similarity(a("eyes"), a("smile"), a("teeth"), b("eyes"), b("smile"), b("teeth"))
    base = weights[0] * pose + weights[1] * light + weights[2] * expression
    return base + (0.05 * scalar(F.col(f"{row}id_score")) + 0.05 * scalar(F.col(f"{row}quality")))


def demand_of(target: DataFrame) -> DataFrame:
    """key, n, ord: the bins of a target table in order of their first row (``src_ord``)."""
    return keyed(target).groupBy("key").agg(F.count("*").alias("n"), F.min("src_ord").alias("ord"))


#: Bins of which tables are sent to all tasks at most.
SMALL = 100_000


def small(bins_of: DataFrame, count: int) -> DataFrame:
    """A table of ``count`` bins, sent to all tasks where that is little."""
    return F.broadcast(bins_of) if count <= SMALL else bins_of


def postings(source: DataFrame, values: DataFrame, length: int) -> DataFrame:
    """field, value, src_ord, key: for each of the ``values`` (field, value) the first ``length`` rows of ``source`` that have it.

    A value that very many rows share is cut in parts first, so no task orders all of its rows.
    """
    fields = ", ".join(f"'{k}', key.{k}" for k in NEAR)
    entries = source.select("src_ord", "key", F.expr(f"stack({len(NEAR)}, {fields}) as (field, value)")).join(values, ["field", "value"], "left_semi")
    part = Window.partitionBy("field", "value", F.pmod(F.xxhash64("src_ord"), F.lit(64))).orderBy("src_ord")
    whole = Window.partitionBy("field", "value").orderBy("src_ord")
    short = entries.withColumn("r", F.row_number().over(part)).where(F.col("r") <= length)
    return short.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= length).drop("r")


def near_candidates(source: DataFrame, thin: DataFrame, minimum: int, count: int) -> DataFrame:
    """proto, src_ord: for each thin bin (``thin``: proto, own, the number of its own rows; ``count`` of them) the first rows of other bins that share its yaw, pitch or smile, as many as are missing up to three times the minimum (one at least).

    Each value has one list of its first rows in order. A thin bin has fewer than ``minimum`` rows of its own, so the
    first rows that it can use stand among the first 4 * ``minimum`` of each of its three lists: the lists are cut there,
    and a bin merges three short lists, however many rows share a value.
    """
    wanted = thin.select("proto", "own", F.expr("stack(3, 'bin_yaw', proto.bin_yaw, 'bin_pitch', proto.bin_pitch, 'bin_smile', proto.bin_smile) as (field, value)"))
    lists = postings(source, small(wanted.select("field", "value").distinct(), 3 * count), 4 * minimum)
    found = lists.join(wanted, ["field", "value"]).where("key <> proto").select("proto", "own", "src_ord").distinct()
    spot = Window.partitionBy("proto").orderBy("src_ord")
    return found.withColumn("r", F.row_number().over(spot)).where(F.col("r") <= F.greatest(F.lit(minimum * 3) - F.col("own"), F.lit(1))).select("proto", "src_ord")


def ranked(rows: DataFrame, weights: tuple[float, float, float], extra: list[str] | None = None) -> DataFrame:
    """``rows`` with their six keys (key), score and rank ``r`` in their own bin (and ``extra``), written once; bins of any size."""
    scored = keyed(rows).withColumn("score", row_score("", "key", weights))
    return staged(with_ranks(scored, ["key", *(extra or [])], [F.desc("score"), "src_ord"], "r"), "ranked")


def fill_takes(counts: DataFrame, remaining: Column, total: Column) -> DataFrame:
    """key, take: the fold of the first rule over bins (n, ord, already, avail), in order of n.

    take = min(max(0, round(remaining n / total) - already), avail, remaining).
    """
    bins_ = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("d"), "ord", "n", "already", "avail", "key")))
    one = counts.agg(bins_.alias("b"), F.first(remaining).alias("rem"), F.first(total).alias("total"))

    def step(acc: Column, x: Column) -> Column:
        quota = bins.quota(acc["rem"], x["n"], F.col("total"))
        take = F.greatest(F.lit(0).cast("long"), F.least(F.greatest(F.lit(0).cast("long"), quota - x["already"]), x["avail"], acc["rem"]))
        return F.struct((acc["rem"] - take).alias("rem"), F.concat(acc["out"], F.array(F.struct(x["key"].alias("key"), take.alias("take")))).alias("out"))

    first = F.struct(F.col("rem").cast("long").alias("rem"), F.expr("cast(array() as array<struct<key:struct<bin_yaw:string,bin_pitch:string,bin_eyes:string,bin_smile:string,bin_teeth:string,bin_light:string>,take:bigint>>)").alias("out"))
    return one.select(F.explode(F.aggregate("b", first, step)["out"]).alias("t")).select("t.key", "t.take")


def select_v1(source: DataFrame, target: DataFrame, minimum: int, budget: int = 0, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """The first selection rule: coverage with near matches, then a proportional fill with exact ones.

    ``source`` and ``target`` have src_ord (unique, the order of rows), the six keys, id_score and quality; ``source`` also path,
    unique. A budget of 0 means as many as the target has. Coverage may exceed the budget, the fill does not.

    The source is read once, ranked within its bins (over ranges, see ``with_ranks``) and written; what follows are rows
    per bin and, for thin bins, a few candidates. Rows that coverage takes leave gaps in a bin's ranks, so the rank at
    which the fill ends is the number of rows it takes and of gaps before.
    """
    columns = source.columns
    spot = ranked(source, weights)
    sizes = spot.groupBy("key").agg(F.count("*").alias("own"))
    demand = staged(demand_of(target).join(sizes, "key", "left").select("key", "n", "ord", F.coalesce("own", F.lit(0)).alias("own")), "demand")
    count, total, thin = demand.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("own") < minimum)).first()
    # Coverage: the first rows of bins that have enough, and of thin bins all their own and what is near.
    first = spot.join(small(demand.where(F.col("own") >= minimum).select("key"), count), "key", "left_semi").where(F.col("r") <= minimum).select("src_ord", "key", "r") if minimum > 0 else spot.limit(0).select("src_ord", "key", "r")
    if minimum > 0 and thin:
        scarce = demand.where(F.col("own") < minimum).select(F.col("key").alias("proto"), "own")
        near = near_candidates(spot.select("src_ord", "key"), scarce, minimum, thin)
        own = spot.select("src_ord", "key").join(small(scarce, count), F.col("key") == F.col("proto")).select("proto", "src_ord")
        pairs = own.union(near).join(spot.select("src_ord", "key", "r", *KEYS, "id_score", "quality"), "src_ord").withColumn("score", row_score("", "proto", weights))
        best = Window.partitionBy("proto").orderBy(F.desc("score"), "src_ord")
        scarce_first = pairs.withColumn("b", F.row_number().over(best)).where(F.col("b") <= minimum).select("src_ord", "key", "r")
        first = first.union(scarce_first)
    covered = staged(first.distinct(), "covered")
    # The fill: how many free rows each bin takes, and the rank at which it has them.
    already = covered.groupBy("key").agg(F.count("*").alias("already"))
    had = covered.count()
    counts = demand.join(already, "key", "left").select("key", "n", "ord", F.coalesce("already", F.lit(0)).alias("already"), (F.col("own") - F.coalesce("already", F.lit(0))).alias("avail"))
    counts = counts.withColumns({"total": F.lit(total), "rem": F.lit(max(0, (budget if budget > 0 else total) - had))})
    takes = fill_takes(counts, F.col("rem"), F.col("total"))
    place = Window.partitionBy("key").orderBy("r")
    gaps = covered.withColumn("free", F.col("r") - F.row_number().over(place)).join(takes, "key").where("free < take").groupBy("key").agg(F.count("*").alias("gaps"))
    ends = takes.join(gaps, "key", "left").select("key", F.when(F.col("take") > 0, F.col("take") + F.coalesce("gaps", F.lit(0))).otherwise(0).alias("end"))
    out = spot.join(small(ends, count), "key", "left").join(covered.select("src_ord", F.lit(True).alias("covered")), "src_ord", "left")
    return out.where(F.coalesce("covered", F.lit(False)) | (F.col("r") <= F.coalesce("end", F.lit(0)))).select(*columns)


def select_v2(source: DataFrame, target: DataFrame, minimum: int, cap: int, budget: int = 0, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """The second selection rule: exact matches only, native rows first, and at most ``cap`` upscaled rows.

    As ``select_v1``; ``source`` also has the boolean column upscaled. Two folds over one row per bin: coverage in the order of
    the demand, the fill by demand. In the fill a bin's upscaled rows are limited by budget and cap, not by its quota.
    """
    columns, demand = source.columns, demand_of(target)
    spot = ranked(source, weights, ["upscaled"])
    sizes = spot.groupBy("key").agg(F.count_if(~F.col("upscaled")).alias("native"), F.count_if("upscaled").alias("up"))
    counts = demand.join(sizes, "key", "left").select("key", "n", "ord", F.coalesce("native", F.lit(0)).alias("native"), F.coalesce("up", F.lit(0)).alias("up"))
    zero, key_type = F.lit(0).cast("long"), "struct<bin_yaw:string,bin_pitch:string,bin_eyes:string,bin_smile:string,bin_teeth:string,bin_light:string>"
    least = lambda *x: F.greatest(zero, F.least(*x))
    one = counts.agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("ord", "n", "native", "up", "key"))).alias("b"))

    def cover(acc: Column, x: Column) -> Column:
        wanted = x["n"] > 0
        a = F.when(wanted, least(F.lit(minimum).cast("long"), x["native"])).otherwise(zero)
        b = F.when(wanted, least(F.lit(minimum).cast("long") - a, F.lit(cap).cast("long") - acc["used"], x["up"])).otherwise(zero)
        row = F.struct((-x["n"]).alias("d"), x["ord"].alias("ord"), x["n"].alias("n"), x["native"].alias("native"), x["up"].alias("up"), x["key"].alias("key"), a.alias("a"), b.alias("b"))
        return F.struct((acc["used"] + b).alias("used"), (acc["had"] + a + b).alias("had"), F.concat(acc["out"], F.array(row)).alias("out"))

    empty = F.expr(f"cast(array() as array<struct<d:bigint,ord:bigint,n:bigint,native:bigint,up:bigint,key:{key_type},a:bigint,b:bigint>>)")
    covered = one.select("total", F.aggregate("b", F.struct(zero.alias("used"), zero.alias("had"), empty.alias("out")), cover).alias("c"))

    def take(acc: Column, x: Column) -> Column:
        want = bins.quota(acc["rem"], x["n"], F.col("total"))
        goes = (acc["rem"] > 0) & (want > 0)
        a = F.when(goes, least(want, x["native"] - x["a"], acc["rem"])).otherwise(zero)
        b = F.when(goes, least(acc["rem"] - a, F.lit(cap).cast("long") - acc["used"], x["up"] - x["b"])).otherwise(zero)
        row = F.struct(x["key"].alias("key"), (x["a"] + a).alias("native"), (x["b"] + b).alias("up"))
        return F.struct((acc["rem"] - a - b).alias("rem"), (acc["used"] + b).alias("used"), F.concat(acc["out"], F.array(row)).alias("out"))

    limit = F.lit(budget).cast("long") if budget > 0 else F.col("total")
    nothing = F.expr(f"cast(array() as array<struct<key:{key_type},native:bigint,up:bigint>>)")
    start = F.struct(F.greatest(zero, limit - F.col("c.had")).alias("rem"), F.col("c.used").alias("used"), nothing.alias("out"))
    takes = covered.select(F.explode(F.aggregate(F.array_sort("c.out"), start, take)["out"]).alias("t")).select("t.*")
    # The rows of a bin are taken in one order by coverage and fill, so a number of them says which.
    return spot.join(takes.withColumnRenamed("up", "ups"), "key").where(F.col("r") <= F.when(F.col("upscaled"), F.col("ups")).otherwise(F.col("native"))).select(*columns)


def upscaled_names(logs: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct dst_name of upscaled inputs.

    ``logs``: string columns is_upscaled, upscaled, scale, scale_factor, type, kind, dst_name, src_root, src_path, path, as far
    as there are. ``names``: src_root, src_path, dst_name, and ord (of equal keys the last wins). A log row names its
    dst_name itself, or is resolved by (src_root, src_path), or by the path's base name.
    """
    cell = lambda c: F.coalesce(F.col(c), F.lit("")) if c in logs.columns else F.lit("")
    filled = lambda *cs: F.coalesce(*(F.nullif(cell(c), F.lit("")) for c in cs), F.lit(""))
    up = truthy(cell("is_upscaled")) | truthy(cell("upscaled")) | (scalar(filled("scale", "scale_factor")) > 1.0) | F.lower(filled("type", "kind")).contains("upscale")
    rows = logs.where(up).select(cell("dst_name").alias("own"), F.rtrim(cell("src_root"), F.lit("/")).alias("root"), filled("src_path", "path").alias("path")).withColumn("base", base_name(F.col("path")))
    known = names.where((F.coalesce("src_root", F.lit("")) != "") & (F.coalesce("src_path", F.lit("")) != "") & (F.coalesce("dst_name", F.lit("")) != ""))
    last = F.max(F.struct("ord", "dst_name"))["dst_name"]
    by_path = known.groupBy(F.rtrim("src_root", F.lit("/")).alias("root"), F.col("src_path").alias("path")).agg(last.alias("n1"))
    by_base = known.groupBy(base_name(F.col("src_path")).alias("base")).agg(last.alias("n2"))
    found = rows.join(by_path, ["root", "path"], "left").join(by_base, "base", "left")
    return found.select(F.coalesce(F.nullif("own", F.lit("")), "n1", "n2").alias("dst_name")).where("dst_name is not null").distinct()


def mark_upscaled(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with upscaled: whether their path or its base name is among ``names`` (dst_name, distinct)."""
    a, b = names.select(F.col("dst_name").alias("path"), F.lit(True).alias("__p")), names.select(F.col("dst_name").alias("__base"), F.lit(True).alias("__b"))
    out = rows.withColumn("__base", base_name(F.col("path"))).join(a, "path", "left").join(b, "__base", "left")
    return out.withColumn("upscaled", F.coalesce("__p", "__b", F.lit(False)) & (F.coalesce("path", F.lit("")) != "")).drop("__base", "__p", "__b")
