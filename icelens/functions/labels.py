"""Labels derived from counts, rates and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from icelens.config import DEFAULT_RULES, Rules


def situation(own: Column, opp: Column, own_goalie: Column, opp_goalie: Column) -> Column:
    """Strength of a moment seen from one team."""
    return (F.when(~opp_goalie, "EN_for")
            .when(~own_goalie, "EN_against")
            .otherwise(F.concat(own.cast("string"), F.lit("v"), opp.cast("string"))))


def shot_strength(own: Column, opp: Column, own_goalie: Column, opp_goalie: Column,
                  game_id: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """As :func:`situation`, keeping three-on-three apart before it became the overtime format."""
    year = F.substring(game_id.cast("string"), 1, 4).cast("int")
    early = (own == 3) & (opp == 3) & own_goalie & opp_goalie & (year < rules.first_3v3_overtime_year)
    return F.when(early, "3v3_pre2015ot").otherwise(situation(own, opp, own_goalie, opp_goalie))


def buckets(label: Column, names: tuple) -> Column:
    """The situation buckets a row counts in: ``all`` and, when listed, its own."""
    listed = [n for n in names if n != "all"]
    return F.when(label.isin(*listed), F.array(F.lit("all"), label)).otherwise(F.array(F.lit("all")))


def danger(xg: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return (F.when(xg >= rules.high_danger, "HD").when(xg >= rules.medium_danger, "MD").otherwise("LD"))


def role(position: Column, gp: Column, toi: Column, season_games: Column) -> Column:
    # The limits of the roles.
    share = F.try_divide(gp, season_games)
    average = F.try_divide(toi, gp)
    goalie = (F.when(share >= 0.60, "Starter").when(share >= 0.50, "Tandem (1A)")
              .when(share >= 0.40, "Tandem (1B)").when(share >= 0.10, "Backup").otherwise("Fringe"))
    defence = (F.when(average >= 22.0, "First Pair").when(average > 18.0, "Second Pair")
               .when(average > 13.0, "Third Pair").otherwise("Fringe"))
    forward = (F.when(average >= 18.0, "First Line").when(average > 15.5, "Second Line")
               .when(average > 13.5, "Third Line").when(average > 9.0, "Fourth Line").otherwise("Fringe"))
    return F.when(position == "G", goalie).when(position == "D", defence).otherwise(forward)


def age(season: Column, birth_date: Column) -> Column:
    """Full years on 1 September of the season's first year."""
    day = F.make_date(F.substring(season, 1, 4).cast("int"), F.lit(9), F.lit(1))
    return F.floor(F.months_between(day, birth_date) / 12).cast("int")


def clamp_category(value: Column, known: list[str]) -> Column:
    return F.when(value.isin(*known), value).otherwise(F.lit("unknown"))


def nearest_strength(label: Column, trained: list[str]) -> Column:
    """The trained strength a label is scored with.

    An exact match wins. Otherwise both skater counts are held to 3..5 and the
    trained ``NvM`` state with the smallest gap in skater difference, then in total
    distance, is taken; ties go to the first name in order. Labels without counts
    go to 5v5, or to the first trained state.
    """
    if not trained:
        return F.lit(None).cast("string")
    names = sorted(trained)
    fallback = F.lit("5v5" if "5v5" in names else names[0])
    counted = [n for n in names if len(n) == 3 and n[1] == "v" and n[0].isdigit() and n[2].isdigit()]
    held = [F.least(F.greatest(F.regexp_extract(label, r"^(\d+)v(\d+)", k).try_cast("int"), F.lit(3)), F.lit(5)) for k in (1, 2)]
    states = F.array(*[F.struct(F.lit(int(n[0])).alias("own"), F.lit(int(n[2])).alias("opp"), F.lit(n).alias("name")) for n in counted])

    def nearest(at: Column) -> Column:
        return F.array_min(F.transform(states, lambda n: F.struct(
            F.abs((n["own"] - n["opp"]) - (at["own"] - at["opp"])).alias("gap"),
            (F.abs(n["own"] - at["own"]) + F.abs(n["opp"] - at["opp"])).alias("far"), n["name"].alias("name"))))["name"]
    # an array of one, so that the label is read once however many states there are
    best = F.transform(F.array(F.struct(held[0].alias("own"), held[1].alias("opp"))), nearest)[0] if counted else fallback
    return (F.when(label.isin(*names), label)
            .when(label.rlike(r"^\d+v\d+"), best)
            .otherwise(fallback))
