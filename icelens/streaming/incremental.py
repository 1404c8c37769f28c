"""Resumable loads: only ids that are new, and a memory of ids that turned out empty."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: Ids that one task tells apart at most, so that its memory does not grow with the tables.
IDS_PER_TASK = 1_000_000


def _places(key: str, **tables: DataFrame) -> DataFrame:
    """(key, a boolean for each of ``tables``): every id once, and which of the tables have it.

    Dealt to as many tasks as the ids take; sizes of shuffled ids say little about the memory that they need.
    """
    rows = None
    for place, df in enumerate(tables.values()):
        some = df.select(F.col(key), F.lit(1 << place).alias("_in"))
        rows = some if rows is None else rows.unionAll(some)
    found = rows.repartition(max(1, math.ceil(rows.count() / IDS_PER_TASK)), key).groupBy(key).agg(F.bit_or("_in").alias("_in"))
    return found.select(key, *[(F.col("_in").bitwiseAND(F.lit(1 << place)) != 0).alias(name) for place, name in enumerate(tables)])


def remaining(ids: DataFrame, done: DataFrame, empty: DataFrame, key: str) -> DataFrame:
    """Ids neither loaded nor known to be empty."""
    return ids.select(key).distinct().join(done.select(key).distinct(), key, "left_anti").join(
        empty.select(key).distinct(), key, "left_anti")


def _sorted_out(ids: DataFrame, incoming: DataFrame, done: DataFrame, empty: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of remaining ids, the remaining ids without any, and those with the ``empty`` ones, each once."""
    places = _places(key, wanted=ids, came=incoming, done=done, empty=empty)
    # a null id is nobody's: it equals none of the others
    todo = F.col("wanted") & (F.col(key).isNull() | ~(F.col("done") | F.col("empty")))
    nothing = todo & (F.col(key).isNull() | ~F.col("came"))
    fresh = incoming.join(places.where(todo & F.col("came")).select(key), key, "left_semi")
    return fresh, places.where(nothing).select(key), places.where(F.col("empty") | nothing).select(key)


def merge(ids: DataFrame, incoming: DataFrame, done: DataFrame, empty: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The loaded table with the new ids' rows added, and the list of empty ids with the new ones.

    ``incoming`` may hold rows of any id; only those of remaining ids are taken.
    """
    fresh, _, every = _sorted_out(ids, incoming, done, empty, key)
    return done.unionByName(fresh), every


def append_new(ids: DataFrame, incoming: DataFrame, tables, name: str, key: str) -> None:
    """Append the new ids' rows to a stored table and record the empty ones.

    ``tables`` is a :class:`icelens.sources.tables.TableStore`. The rows still missing are
    worked out from what is stored, so an interrupted load simply continues.
    """
    done, empty = tables.load(name, incoming.schema), tables.load(f"{name}_no_data", ids.select(key).schema)
    fresh, nothing, _ = _sorted_out(ids, incoming, done, empty, key)
    tables.save(nothing, f"{name}_no_data", mode="append")
    tables.save(fresh, name, mode="append")
