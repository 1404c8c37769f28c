"""Game clocks and season labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CLOCK_PATTERN = r"^\d{1,2}:\d{2}$"


def is_clock(text: Column) -> Column:
    return F.coalesce(text.rlike(CLOCK_PATTERN), F.lit(False))


def seconds(text: Column) -> Column:
    """Seconds of an ``MM:SS`` text; null unless it has exactly that shape."""
    part = F.split(text, ":")
    return F.when(is_clock(text), part[0].cast("int") * 60 + part[1].cast("int"))


def lenient_seconds(text: Column) -> Column:
    """Seconds of any ``int:int`` text, whatever its width; null when not parseable."""
    part = F.split(text, ":")
    value = (F.trim(F.get(part, F.lit(0))).try_cast("int") * 60
             + F.trim(F.get(part, F.lit(1))).try_cast("int"))
    return F.when(F.size(part) == 2, value).cast("double")


def absolute_second(period: Column, second: Column, period_seconds: int) -> Column:
    return (period - 1) * period_seconds + second


def season_start(season: Column) -> Column:
    return F.substring(season, 1, 4).cast("int")


def shift_season(season: Column, years: int) -> Column:
    """The label ``years`` later (negative: earlier) than ``YYYY-YYYY``."""
    start = season_start(season) + years
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def previous_seasons(season: Column, n: int) -> Column:
    """The ``n`` labels before ``season``, the most recent first."""
    return F.array(*[shift_season(season, -k) for k in range(1, n + 1)])
