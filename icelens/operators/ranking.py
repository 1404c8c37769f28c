"""Exact ranks and percentiles of groups of any size.

A plain ``rank().over(partitionBy(group))`` sorts a whole group in one task. Here equal
values are counted first, each group's distinct values are cut into ranges by up to 63
split values, ranks are formed inside a range and shifted by the totals of the ranges
below. Split values are those with the smallest hashes, so they are a fixed, even sample
of the distinct values: a recomputed task sees the same ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

RANGES = 64


def ranked_values(long: DataFrame, group: list[str], value: str) -> DataFrame:
    """Per (group, distinct value): ``pct`` (average ties, of 100) and ``rank`` (dense, best first)."""
    counts = long.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    pick = F.row_number().over(W.partitionBy(*group).orderBy(F.xxhash64(value), value))
    splits = (counts.select(*group, value).withColumn("_i", pick).where(F.col("_i") < RANGES)
              .groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias("_splits")))
    cut = (counts.join(splits, group)
           .withColumn("_range", F.size(F.filter("_splits", lambda s: s < F.col(value)))).drop("_splits"))
    inside = W.partitionBy(*group, "_range").orderBy(value)
    local = cut.withColumns({
        "_below": F.coalesce(F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "_nth": F.row_number().over(inside)})
    # At most 64 rows per group from here on.
    ranges = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    shift = (cut.groupBy(*group, "_range").agg(F.sum("_n").alias("_rn"), F.count("*").alias("_rd"))
             .select(*group, "_range",
                     F.coalesce(F.sum("_rn").over(ranges), F.lit(0)).alias("_n0"),
                     F.coalesce(F.sum("_rd").over(ranges), F.lit(0)).alias("_d0"),
                     F.sum("_rn").over(whole).alias("_total"), F.sum("_rd").over(whole).alias("_distinct")))
    mean_rank = F.col("_n0") + F.col("_below") + (F.col("_n") + 1) / 2
    return local.join(shift, [*group, "_range"]).select(
        *group, value,
        F.bround(mean_rank / F.col("_total") * 100, 1).alias("pct"),
        (F.col("_distinct") - F.col("_d0") - F.col("_nth") + 1).alias("rank"))


def attach_ranks(df: DataFrame, group: list[str], ids: list[str], scores: list[str]) -> DataFrame:
    """Add ``<attr>_pct`` and ``<attr>_rank`` for every ``<attr>_score`` of ``scores``.

    Null scores stay null. All scores are ranked together in long form. ``ids`` identify a
    row within its group.
    """
    attrs = [s.removesuffix("_score") for s in scores]
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attr"), F.col(f"{a}_score").cast("double").alias("v"))
                                for a in attrs])).alias("_p")
    long = df.select(*group, *ids, pairs).select(*group, *ids, "_p.*").where(F.col("v").isNotNull())
    ranked = ranked_values(long, [*group, "attr"], "v")
    wide = (long.join(ranked, [*group, "attr", "v"]).groupBy(*group, *ids)
            .agg(*[F.max(F.when(F.col("attr") == a, F.col(c))).alias(f"{a}_{c}")
                   for a in attrs for c in ("pct", "rank")]))
    return df.join(wide, [*group, *ids], "left")


def attach_pool_sizes(df: DataFrame, group: list[str]) -> DataFrame:
    """``all_players`` and, where such scores exist, the qualified ``ppl``/``pkl`` counts."""
    sizes = [F.count("*").alias("all_players")]
    sizes += [F.count(f"{a}_score").alias(f"{a}_players") for a in ("ppl", "pkl") if f"{a}_score" in df.columns]
    return df.join(df.groupBy(*group).agg(*sizes), group)
