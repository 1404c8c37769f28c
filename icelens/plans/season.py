"""From typed tables of one league to stored cards: every late stage, each read back from the table it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from icelens.config import DEFAULT_RULES, Rules
from icelens.operators import aggregate as agg, overlap, value
from icelens.operators.attach import tag_strength
from icelens.operators.context import attach_context
from icelens.operators.stints import build_stints
from icelens.plans import cards, rankings, ratings, stats
from icelens.plans.stats import LeagueTables
from icelens.session import settle
from icelens.sources.tables import TableStore


def save_stats(store: TableStore, t: LeagueTables, stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """All statistics of all seasons, a folder for each season, position and situation, written in one pass."""
    skaters = store.conformed(stats.skater_stats(t, stints, rules), "stats")
    goalies = store.conformed(stats.goalie_stats(t, stints, rules), "stats")
    store.save(skaters.unionByName(goalies), "stats", order=("player_id",))
    return store.load("stats")


def save_ratings(store: TableStore, t: LeagueTables, stints: DataFrame, table: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Fitted ratings of every season, each with the prior of those before."""
    plain = stints.select(*build_stints(t.shifts, t.goals, rules).columns)  # as built: the context adds what it needs
    context = settle(attach_context(plain, t.shots, t.goals, t.faceoffs, t.schedule, rules), "context")
    minutes = settle(agg.toi_totals(table.where("position != 'G'")).select("season", "player_id", "situation", "toi"), "minutes")
    seasons = [r["season"] for r in context.select("season").distinct().collect()]
    store.save(store.conformed(ratings.chained_ratings(context, minutes, seasons, rules), "rapm_scores"), "rapm_scores")
    return store.load("rapm_scores")


def save_wins(store: TableStore, t: LeagueTables, stints: DataFrame, table: DataFrame, rated: DataFrame, rules: Rules = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    shots = settle(tag_strength(t.shots, stints, rules), "tagged-shots")
    skaters = value.skater_war(table.where("position != 'G'"), rated, t.standings, shots, tag_strength(t.penalties, stints, rules), rules)
    store.save(store.conformed(skaters, "war_scores"), "war_scores")
    store.save(store.conformed(value.goalie_war(table.where("position = 'G'"), t.standings, shots, rules), "goalie_war_scores"), "goalie_war_scores")
    return store.load("war_scores"), store.load("goalie_war_scores")


def save_rankings(store: TableStore, skaters: DataFrame, goalies: DataFrame, pairs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Yearly and weighted rankings of scored skaters and goalies, by kind, season and position."""
    yearly = [rankings.yearly_ranking(skaters, pairs), rankings.yearly_ranking(goalies)]
    weighted = [rankings.rank_scores(rounded(rankings.weighted_scores(scores, rules))) for scores in (skaters, goalies)]
    parts = [store.conformed(df.withColumn("kind", F.lit(kind)), "rankings") for kind, dfs in (("yearly", yearly), ("weighted", weighted)) for df in dfs]
    for part in parts:
        store.save(part, "rankings")
    return store.load("rankings")


def save_cards(store: TableStore, t: LeagueTables, table: DataFrame, ranked: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Cards from the weighted rankings, with the yearly ones as history, sorted by player within season and position."""
    yearly, weighted = ranked.where("kind = 'yearly'"), ranked.where("kind = 'weighted'").drop("kind")
    skater, goalie = F.col("position") != "G", F.col("position") == "G"
    rows = [cards.skater_cards(weighted.where(skater), yearly.where(skater), table.where(skater), t.bios, t.schedule, rules),
            cards.goalie_cards(weighted.where(goalie), yearly.where(goalie), table.where(goalie), t.bios, agg.goalie_record(t.goalie_logs), t.schedule, rules)]
    cards.publish(store, store.conformed(rows[0], "card_data").unionByName(store.conformed(rows[1], "card_data")))
    return store.load("card_data")


def rounded(scores: DataFrame, digits: int = 6) -> DataFrame:
    """Scores to so many digits, so that sums taken in another order still tie."""
    return scores.withColumns({c: F.round(c, digits) for c in rankings.score_columns(scores)})


def run(store: TableStore, t: LeagueTables, rules: Rules = DEFAULT_RULES, given_ratings: DataFrame | None = None) -> DataFrame:
    """Statistics, ratings, wins, rankings and cards of all seasons of ``t``, stored one after the other.

    ``given_ratings``: use these instead of fitting. Returns the stored cards.
    """
    stints = stats.measured_stints(t, rules)
    table = save_stats(store, t, stints, rules)
    rated = given_ratings if given_ratings is not None else save_ratings(store, t, stints, table, rules)
    wins, goalie_wins = save_wins(store, t, stints, table, rated, rules)
    skaters, goalies = table.where("position != 'G'"), table.where("position = 'G'")
    starts = agg.start_quality(t.goalie_logs, agg.game_gsax(t.shots), agg.goalie_gp(t.box_goalies, t.shifts), rules)
    scored = settle(rounded(rankings.skater_scores(rankings.qualify_skaters(skaters, t.schedule, rules), wins)), "scores")
    goalie_scored = settle(rounded(rankings.goalie_scores(rankings.qualify_goalies(goalies, t.schedule, rules), goalie_wins, starts)), "scores")
    pairs = settle(overlap.shared_seconds(t.shifts, rules), "pairs")
    return save_cards(store, t, table, save_rankings(store, scored, goalie_scored, pairs, rules), rules)
