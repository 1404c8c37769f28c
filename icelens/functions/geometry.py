"""Shot location and prior-event features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from icelens.config import ALL_SHOTS, DEFAULT_RULES, Rules
from icelens.functions.clock import lenient_seconds


def net_side(x: Column, net_x: float) -> Column:
    return F.when(x >= 0, F.lit(net_x)).otherwise(F.lit(-net_x))


def distance(x: Column, y: Column, net_x: float = DEFAULT_RULES.net_x) -> Column:
    dx = net_side(x, net_x) - x
    return F.sqrt(dx * dx + y * y)


def angle(x: Column, y: Column, net_x: float = DEFAULT_RULES.net_x) -> Column:
    return F.degrees(F.atan2(F.abs(y), F.abs(net_side(x, net_x) - x)))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def shot_features(shots: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every feature that needs nothing but the shot row and its prior event.

    Columns read: time, x, y, period, team, event_type, shot_type and the five
    ``prior_event_*`` ones.
    """
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    px, py = F.col("prior_event_x").cast("double"), F.col("prior_event_y").cast("double")
    base = shots.withColumns({
        "distance": distance(x, y, rules.net_x),
        "angle": angle(x, y, rules.net_x),
        "behind_net": _flag(F.abs(x) > rules.net_x),
        "prior_event_elapsed": F.greatest(
            lenient_seconds(F.col("time")) - lenient_seconds(F.col("prior_event_time")), F.lit(0.0)),
        "_travel": F.sqrt((x - px) * (x - px) + (y - py) * (y - py)),
    })
    # greatest() skips nulls, so an unknown clock has to be put back to null.
    base = base.withColumn("prior_event_elapsed", F.when(
        lenient_seconds(F.col("time")).isNotNull() & lenient_seconds(F.col("prior_event_time")).isNotNull(),
        F.col("prior_event_elapsed")))
    elapsed = F.col("prior_event_elapsed")
    known = px.isNotNull() & py.isNotNull() & elapsed.isNotNull()
    speed = F.col("_travel") / F.nullif(elapsed, F.lit(0.0))
    return base.withColumns({
        "distance_change": F.when(known, F.col("distance") - distance(px, py, rules.net_x)),
        "shot_speed": F.when(known & speed.isNotNull(), F.least(speed, F.lit(rules.speed_cap))),
        "is_rebound": _flag(known & F.col("prior_event_type").isin(*ALL_SHOTS)
                            & (elapsed <= rules.rebound_seconds)),
        "is_rush": _flag(known & (elapsed <= rules.rush_seconds) & (F.col("_travel") >= rules.rush_feet)),
        "crossed_royal_road": _flag(known & (F.signum(y) * F.signum(py) < 0)),
        "lateral_movement": F.when(known, F.abs(y - py)),
        "same_team_as_prior": _flag(known & (F.col("prior_event_team") == F.col("team"))),
        "prior_event_type": F.when(known, F.coalesce(F.col("prior_event_type"), F.lit("unknown")))
                             .otherwise(F.lit("none")),
        "period_number": F.least(F.col("period"), F.lit(4)),
        "shot_type": F.coalesce(F.col("shot_type"), F.lit("unknown")),
        "goal": _flag(F.col("event_type") == "goal"),
    }).drop("_travel")


def off_wing(shoots: Column, x: Column, y: Column) -> Column:
    """1 when the shooter stands on the side opposite to their hand, seen in attack direction."""
    mirrored = y * F.when(x >= 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return _flag(((shoots == "R") & (mirrored < 0)) | ((shoots == "L") & (mirrored > 0)))


def attach_hands(shots: DataFrame, bios: DataFrame) -> DataFrame:
    """Shooting and catching hands, and the off-wing flag.

    ``bios`` has one hand per player; the join side is chosen at run time from its size.
    """
    hand = bios.where(F.col("player_id").isNotNull()).groupBy("player_id").agg(
        F.min("shoots_catches").alias("_hand"))
    out = (shots
           .join(hand.withColumnsRenamed({"player_id": "shooter_id", "_hand": "_s"}), "shooter_id", "left")
           .join(hand.withColumnsRenamed({"player_id": "goalie_id", "_hand": "_g"}), "goalie_id", "left"))
    return out.withColumns({
        "shooter_shoots": F.coalesce("_s", F.lit("unknown")),
        "goalie_catches": F.coalesce("_g", F.lit("unknown")),
        "off_wing": off_wing(F.col("_s"), F.col("x"), F.col("y")),
    }).drop("_s", "_g")
