"""The previous row of a sequence, for groups of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def attach_previous(df: DataFrame, keys: list[str], position: str, order: list[str], value: Column, name: str,
                    block: int = 4096) -> DataFrame:
    """Add ``name``: ``value`` of the row before, in the order of ``position`` then ``order``.

    A group is cut into blocks of ``position``; inside a block a window looks back, and the
    first row of a block takes the last row of the block before it. So one long group is
    spread over as many tasks as it has blocks.
    """
    cut = df.withColumns({"_block": F.floor(F.col(position) / block), "_value": value})
    rank = F.struct(position, *order)
    inside = W.partitionBy(*keys, "_block").orderBy(position, *order)
    ends = (cut.groupBy(*keys, "_block").agg(F.max_by("_value", rank).alias("_end"))
            .withColumn("_before", F.lag("_end").over(W.partitionBy(*keys).orderBy("_block"))).drop("_end"))
    return (cut.withColumn("_near", F.lag("_value").over(inside))
            .join(ends, [*keys, "_block"])
            .withColumn(name, F.coalesce("_near", "_before")).drop("_block", "_value", "_near", "_before"))
