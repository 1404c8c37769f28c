"""Scores, qualification, yearly and multi-season rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from icelens.config import DEFAULT_RULES, Rules
from icelens.functions import rates
from icelens.functions.clock import shift_season
from icelens.operators.quality import attach_quality, average_quality, neighbour_quality
from icelens.operators.ranking import attach_pool_sizes, attach_ranks

PLAYER = ["season", "player_id"]


def season_games(season: Column, rules: Rules) -> Column:
    table = F.create_map(*[F.lit(x) for pair in rules.season_games.items() for x in pair])
    return F.try_element_at(table, season)


def with_season_games(df: DataFrame, schedule: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add ``season_games``: the configured number, or the most games any team has played."""
    played = (schedule.select("season", "game_id", F.explode(F.array("home_team", "away_team")).alias("team"))
              .groupBy("season", "team").agg(F.countDistinct("game_id").alias("n"))
              .groupBy("season").agg(F.max("n").alias("_played")))
    known = F.nullif(season_games(F.col("season"), rules), F.lit(0))
    return (df.join(played, "season", "left")
            .withColumn("season_games", F.coalesce(known, F.col("_played"), F.lit(0))).drop("_played"))


def _per_situation(stats: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Wide per-player row: ``<situation>_<stat>`` for the wanted statistics, 0 when a row is absent."""
    return stats.groupBy(*PLAYER, "player", "team", "position").agg(*[
        F.coalesce(F.max(F.when(F.col("situation") == s, F.col(c))), F.lit(0)).alias(f"{s}_{c}")
        for s, cols in wanted.items() for c in cols])


def qualify_skaters(stats: DataFrame, schedule: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Skaters with enough ice time, wide over situations, with their special-teams eligibility."""
    wide = _per_situation(stats, {
        "all": ["gp", "toi"],
        "5v5": ["gp", "toi", "ixg", "goals", "first_assists", "second_assists", "hits", "hits_taken",
                "off_zone_starts", "neu_zone_starts", "def_zone_starts", "pdo"],
        "5v4": ["toi"], "4v5": ["toi"]})
    need = F.col("season_games") * rules.skater_min_toi_per_game
    special = F.col("all_gp") * rules.special_min_toi_per_gp
    return (with_season_games(wide, schedule, rules).where(F.col("all_toi") >= need)
            .withColumns({"ppl_ok": F.col("5v4_toi") >= special, "pkl_ok": F.col("4v5_toi") >= special}))


def qualify_goalies(stats: DataFrame, schedule: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    wide = _per_situation(stats, {
        "all": ["gp", "toi"],
        "5v5": ["gp", "rebound_xg_against", "xg_against",
                *[f"{z}_{c}" for z in ("ld", "md", "hd") for c in ("xg_against", "goals_against")]]})
    return with_season_games(wide, schedule, rules).where(
        F.col("all_gp") >= F.col("season_games") * rules.goalie_min_gp_share)


def skater_scores(qualified: DataFrame, war: DataFrame) -> DataFrame:
    """Thirteen raw scores; power-play and kill scores only for those who play there enough."""
    wars = war.select(*PLAYER, *[f"{c}_war" for c in ("tot", "evo", "evd", "ppl", "pkl", "fin", "pen")])
    gp = F.col("5v5_gp")
    return qualified.join(wars, PLAYER, "left").select(
        *PLAYER, "player", "team", "position",
        F.col("tot_war").alias("ovr_score"), F.col("evo_war").alias("evo_score"), F.col("evd_war").alias("evd_score"),
        F.when(F.col("ppl_ok"), F.col("ppl_war")).alias("ppl_score"),
        F.when(F.col("pkl_ok"), F.col("pkl_war")).alias("pkl_score"),
        F.col("fin_war").alias("fin_score"), F.col("pen_war").alias("pen_score"),
        rates.per_game(F.col("5v5_ixg"), gp).alias("xgl_score"),
        rates.per_game(F.col("5v5_goals"), gp).alias("gol_score"),
        rates.per_game(rates.weighted_assists(F.col("5v5_first_assists"), F.col("5v5_second_assists")), gp).alias("ast_score"),
        rates.per_game(rates.physicality(F.col("5v5_hits"), F.col("5v5_hits_taken")), gp).alias("hit_score"),
        rates.offensive_start_share(F.col("5v5_off_zone_starts"), F.col("5v5_neu_zone_starts"),
                                    F.col("5v5_def_zone_starts")).alias("ozs_score"),
        F.col("5v5_pdo").alias("pdo_score"))


def goalie_scores(qualified: DataFrame, war: DataFrame, starts: DataFrame) -> DataFrame:
    gp = F.col("5v5_gp")
    zones = [rates.per_game(F.col(f"5v5_{z}_xg_against") - F.col(f"5v5_{z}_goals_against"), gp).alias(f"{z}g_score")
             for z in ("ld", "md", "hd")]
    return (qualified.join(war.select(*PLAYER, "tot_war", "evs_war", "pkl_war"), PLAYER, "left")
            .join(starts, PLAYER, "left").select(
        *PLAYER, "player", "team", "position",
        F.col("tot_war").alias("ovr_score"), F.col("evs_war").alias("evs_score"), F.col("pkl_war").alias("pkl_score"),
        *zones,
        rates.per_game(-F.col("5v5_rebound_xg_against"), gp).alias("rbd_score"),
        rates.per_game(-F.col("5v5_xg_against"), gp).alias("tmd_score"),
        "gre_score", "qal_score", "bad_score", "awf_score",
        rates.workload(F.col("all_gp"), F.col("all_toi")).alias("wrk_score")))


def score_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_score")]


def rank_scores(scores: DataFrame) -> DataFrame:
    """Percentile and dense rank of every score within (season, position), with pool sizes."""
    ranked = attach_ranks(scores, ["season", "position"], ["player_id"], score_columns(scores))
    return attach_pool_sizes(ranked, ["season", "position"])


def with_quality(scores: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add teammate and competition quality: mean of offence and defence talent at even strength."""
    both = average_quality(neighbour_quality(pairs, scores, "evo_score"),
                           neighbour_quality(pairs, scores, "evd_score"))
    return attach_quality(scores, both)


def yearly_ranking(scores: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Rank one season at a time; skaters (with ``pairs``) also get quality scores."""
    return rank_scores(with_quality(scores, pairs) if pairs is not None else scores)


def weighted_scores(yearly: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Blend each score with those of the two seasons before.

    The weights depend on which of the three exist. Seasons are matched by label, not by
    neighbouring rows, because a player may skip one. Without a current score: null.
    """
    scores = score_columns(yearly)
    key = ["season", "player_id", "position"]
    current = yearly.select(*key, "player", "team", *scores)

    def earlier(years: int) -> DataFrame:
        return yearly.select(shift_season(F.col("season"), years).alias("season"), "player_id", "position",
                             *[F.col(s).alias(f"_{years}_{s}") for s in scores])

    joined = current.join(earlier(1), key, "left").join(earlier(2), key, "left")

    def blend(score: str, weights: dict) -> Column:
        t0, t1, t2 = F.col(score), F.col(f"_1_{score}"), F.col(f"_2_{score}")
        three, two, gap, one = (weights[n] for n in ("three", "two", "gap", "one"))
        return (F.when(t0.isNull(), None)
                .when(t1.isNotNull() & t2.isNotNull(), t0 * three[0] + t1 * three[1] + t2 * three[2])
                .when(t1.isNotNull(), t0 * two[0] + t1 * two[1])
                .when(t2.isNotNull(), t0 * gap[0] + t2 * gap[2])
                .otherwise(t0 * one[0]))

    return joined.select(*key, "player", "team", *[
        F.when(F.col("position") == "G", blend(s, rules.goalie_weights))
         .otherwise(blend(s, rules.skater_weights)).alias(s) for s in scores])


def weighted_ranking(yearly: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return rank_scores(weighted_scores(yearly, rules))
