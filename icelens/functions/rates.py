"""Per-game scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def per_game(total: Column, gp: Column) -> Column:
    return F.when(gp > 0, total / gp)


def weighted_assists(first: Column, second: Column) -> Column:
    return first * 0.8 + second * 0.2


def physicality(hits: Column, taken: Column) -> Column:
    return hits + taken * 0.5


def offensive_start_share(off: Column, neu: Column, dfn: Column) -> Column:
    return F.try_divide(off, off + neu + dfn) * 100


def workload(gp: Column, toi: Column) -> Column:
    return gp + toi / 60.0
