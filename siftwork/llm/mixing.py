"""Mixing sources to target weights: budgets through a tree of domains, languages and sources.

The budget of tokens is split among domains by weight, each domain's among its languages, each language's among its
sources. A node takes no more than its documents give in ``epochs`` epochs; what it leaves goes to its siblings by
weight, and only what a whole subtree cannot take goes to the siblings of its ancestors. Each leaf (a source of a
language of a domain) then takes whole epochs and, of the last epoch, the documents of a seeded order until its tokens are used up.

All of it is DataFrame operations. Budgets are windows over one row per node. The prefix of a leaf is found by descent:
sums of at most FAN buckets of its order, then of the bucket in which the budget ends, until that holds few documents, and
a running sum over those. So no window holds more than FAN rows of a leaf, or the documents of its last bucket.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import WORD, nested

LEAF = ["domain", "lang", "source"]
#: Documents that the last bucket of a leaf's order holds on average, at most; buckets of a step (three hexadecimal digits).
BUCKET, DIGITS = 1000, 3
FAN = 16**DIGITS


def weight(name: str, weights: dict[str, float], other: float) -> Column:
    """The weight of a node by its name; names that are not listed have the weight ``other``."""
    out = F.lit(float(other))
    for key, value in sorted(weights.items()):
        out = F.when(F.col(name) == key, F.lit(float(value))).otherwise(out)
    return out


def share_out(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``budget`` of each node from its parent's (``given``), by weight ``w`` and up to ``cap``.

    With siblings in order of cap / w, the level at which the rest of the budget meets the rest of the weights is
    highest at the first node that is not filled; every node takes its weight times that level, or its cap.
    """
    ratio = F.try_divide("cap", "w").asc_nulls_last()
    order = Window.partitionBy(*parents).orderBy(ratio, name)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    leveled = nodes.withColumn("level", F.try_divide(F.col("given") - before, left))
    whole = Window.partitionBy(*parents)
    top = F.coalesce(F.max("level").over(whole), F.lit(0.0))
    enough = F.sum("cap").over(whole) <= F.col("given")
    budget = F.when(enough, F.col("cap")).otherwise(F.floor(F.least(F.col("cap").cast("double"), F.col("w") * top)))
    return leveled.withColumn("budget", budget.cast("long")).drop("level")


def budgets(leaves: DataFrame, domain_weights: dict, lang_weights: dict, source_weights: dict, other: float, part: float, epochs: int) -> DataFrame:
    """``leaves`` (the three names, n, tokens) with their budget in tokens; ``part`` is the whole budget by the tokens there are."""
    w = [weight("domain", domain_weights, other), weight("lang", lang_weights, other), weight("source", source_weights, other)]
    caps = leaves.withColumns({"w1": w[0], "w2": w[1], "w3": w[2]}).withColumn("cap", F.when((F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0), F.col("tokens") * epochs).otherwise(F.lit(0)))
    domains = caps.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"), F.first("w1").alias("w"))
    domains = domains.withColumn("root", F.lit(0)).withColumn("given", F.floor(F.sum("tokens").over(Window.partitionBy("root")) * F.lit(part)))
    domains = share_out(domains, ["root"], "domain").select("domain", F.col("budget").alias("given"))
    langs = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.first("w2").alias("w")).join(domains, "domain")
    langs = share_out(langs, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given"))
    sources = caps.select(*LEAF, "n", "tokens", "cap", F.col("w3").alias("w")).join(langs, ["domain", "lang"])
    return share_out(sources, ["domain", "lang"], "source").select(*LEAF, "n", "tokens", "budget")


def order_key(seed: int, epoch: Column) -> Column:
    """The place of a document in an epoch: hexadecimal digits of a hash of its id, the seed and the epoch."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc").cast("string"), F.lit("")), F.lit(str(seed)), epoch.cast("string")).cast("binary"))


def leaf_columns(domain: Column) -> dict[str, Column]:
    """The id and the names of the leaf of a document; missing names are empty."""
    return {"doc": F.col("doc_id").cast("long"), "domain": F.coalesce(domain, F.lit("")), "lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))}


def tokens_of(docs: DataFrame, domain: Column) -> DataFrame:
    """doc, the names of the leaf, and tokens: runs without ASCII white space."""
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return staged(docs.select(*(c.alias(name) for name, c in leaf_columns(domain).items()), tokens.alias("n_tokens")), "tokens")


def cuts(rows: DataFrame, domain_weights: dict, lang_weights: dict, source_weights: dict, other: float, part: float, epochs: int, seed: int) -> DataFrame:
    """Per leaf of ``rows``: whole epochs, and the last (key, doc) of the next epoch that its budget holds (null if none)."""
    leaves = rows.groupBy(*LEAF).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))
    given = budgets(leaves, domain_weights, lang_weights, source_weights, other, part, epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    given = staged(given.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "budgets")
    keyed = rows.join(given.select(*LEAF, "whole"), LEAF).select(*LEAF, "doc", "n_tokens", order_key(seed, F.col("whole")).alias("key"))
    # A leaf's open bucket: the first digits of its keys, and the tokens that may still be taken from there on.
    bucket = given.select(*LEAF, F.lit("").alias("prefix"), "rest")
    lasts, steps, left = [], 0, given.agg(F.max("n")).first()[0] or 0
    while left > BUCKET:
        left, steps = left / FAN, steps + 1
    for step in range(steps):
        width = DIGITS * step
        inside = keyed.join(bucket, LEAF).where(F.substring("key", 1, width) == F.col("prefix")) if step else keyed.join(bucket, LEAF)
        sums = inside.groupBy(*LEAF, F.substring("key", 1, width + DIGITS).alias("prefix")).agg(F.sum("n_tokens").alias("inside"), F.max(F.struct("key", "doc")).alias("last"), F.first("rest").alias("rest"))
        run = Window.partitionBy(*LEAF).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        sums = staged(sums.withColumn("before", F.coalesce(F.sum("inside").over(run), F.lit(0))), "buckets")
        lasts.append(sums.where("before + inside <= rest").select(*LEAF, "last"))
        bucket = staged(sums.where("before <= rest and before + inside > rest").select(*LEAF, "prefix", (F.col("rest") - F.col("before")).alias("rest")), "open")
    within = Window.partitionBy(*LEAF).orderBy("key", "doc", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    some = keyed.join(bucket, LEAF).where(F.substring("key", 1, DIGITS * steps) == F.col("prefix")).withColumn("upto", F.sum("n_tokens").over(within))
    lasts.append(some.where("upto <= rest").select(*LEAF, F.struct("key", "doc").alias("last")))
    last = functools.reduce(DataFrame.union, lasts).groupBy(*LEAF).agg(F.max("last").alias("last"))
    return staged(given.join(last, LEAF, "left").select(*LEAF, "whole", F.col("last.key").alias("cut_key"), F.col("last.doc").alias("cut_doc")), "cuts")


def copies(seed: int) -> Column:
    """How often the mixture takes a row (doc, whole, cut_key, cut_doc)."""
    key = order_key(seed, F.col("whole"))
    # Rows without doc_id come first among equal keys, as in the windows' order.
    taken = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (F.col("doc").isNull() | (F.col("doc") <= F.col("cut_doc"))))
    return F.col("whole") + F.when(taken, F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame, domain: Column, domain_weights: dict, lang_weights: dict, source_weights: dict, other: float = 1.0, part: float = 0.8, epochs: int = 2, seed: int = 17) -> DataFrame:
    """Per row of ``docs``: doc_id, domain, lang, source, n_tokens, copies (0: not taken).

    ``domain`` derives a document's domain from its columns. ``part``: the budget as a part of all tokens; ``epochs``:
    how often a leaf may be repeated. A weight of 0 leaves a subtree out.

    Edge cases: missing domains, languages and sources are nodes with an empty name; null and empty texts have no
    tokens and are taken while their order is within the prefix; repeated rows stand beside each other in the order
    and are taken together; an empty table gives no rows; other columns are ignored.
    """
    rows = tokens_of(docs, domain)
    cut = cuts(rows, domain_weights, lang_weights, source_weights, other, part, epochs, seed)
    return rows.join(cut, LEAF).select(F.col("doc").alias("doc_id"), *LEAF, "n_tokens", copies(seed).alias("copies"))


def mixture(docs: DataFrame, domain: Column, domain_weights: dict, lang_weights: dict, source_weights: dict, other: float = 1.0, part: float = 0.8, epochs: int = 2, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with all their columns.

    Edge cases are those of ``mix``: missing names are nodes with an empty name, null and empty texts have no tokens,
    repeated rows are taken together, an empty table stays empty, and columns of any names pass through.
    """
    cut = cuts(tokens_of(docs, domain), domain_weights, lang_weights, source_weights, other, part, epochs, seed)
    met = nested(docs, **leaf_columns(domain)).join(cut, LEAF)
    return met.select("rows", F.explode(F.array_repeat(F.lit(0), copies(seed).cast("int")))).select("rows.*")
