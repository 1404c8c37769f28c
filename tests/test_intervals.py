"""Interval operators against second-by-second brute force on small random games."""

import random
from collections import defaultdict

import pytest

from icelens.config import Rules
from icelens.operators import attach, context, overlap, perspective, stints as st

RULES = Rules(period_seconds=60)
SHIFT = "season string, game_id long, period int, player_id long, team string, is_goalie boolean, start_sec int, end_sec int"
EVENT = "season string, game_id long, period int, team string, sec int"


def random_game(seed, games=3, teams=("A", "B")):
    rnd = random.Random(seed)
    shifts, goals = [], []
    for g in range(games):
        for p in (1, 2):
            for k, team in enumerate(teams):
                for player in range(k * 100, k * 100 + 8):
                    for _ in range(rnd.randint(0, 3)):
                        a = rnd.randint(0, 50)
                        shifts.append(("2020-2021", 20200 + g, p, player, team, player % 100 == 0, a, a + rnd.randint(1, 15)))
            for _ in range(6):
                goals.append(("2020-2021", 20200 + g, p, rnd.choice(teams + ("Z",)), rnd.randint(0, 62)))
    return shifts, goals


def brute_stints(shifts, goals):
    out = {}
    periods = defaultdict(list)
    for s in shifts:
        periods[s[:3]].append(s)
    for key, rows in periods.items():
        teams = sorted({r[4] for r in rows})
        if len(teams) != 2:
            continue
        cuts = sorted({r[6] for r in rows} | {r[7] for r in rows})
        scored = [g for g in goals if g[:3] == key]
        pieces = []
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            side = []
            for team in teams:
                on = {r[3] for r in rows if r[4] == team and r[6] <= a < r[7]}
                keepers = {r[3] for r in rows if r[4] == team and r[5] and r[6] <= a < r[7]}
                side.append((tuple(sorted(on - keepers)), bool(keepers), min(keepers, default=None)))
            if not all(1 <= len(s[0]) <= 6 for s in side):
                continue
            hits = [g for g in scored if (g[4] > a or (n == 0 and g[4] == a)) and (g[4] <= b or n == len(cuts) - 2)]
            count = [sum(g[3] == t for g in hits) for t in teams]
            look = (side[0][:2], side[1][:2])
            if pieces and pieces[-1]["look"] == look and pieces[-1]["end"] == a:
                pieces[-1]["end"] = b
                pieces[-1]["goals"] = [x + y for x, y in zip(pieces[-1]["goals"], count)]
            else:
                pieces.append({"start": a, "end": b, "look": look, "goals": count, "ids": (side[0][2], side[1][2])})
        out[key] = pieces
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_stints_equal_brute_force(spark, seed):
    shifts, goals = random_game(seed)
    got = st.build_stints(spark.createDataFrame(shifts, SHIFT), spark.createDataFrame(goals, EVENT), RULES).collect()
    want = brute_stints(shifts, goals)
    have = sorted((r["season"], r["game_id"], r["period"], r["start_sec"], r["end_sec"], tuple(r["a_skaters"]), r["a_goalie_on"],
                   r["a_goalie_id"], tuple(r["b_skaters"]), r["b_goalie_on"], r["b_goalie_id"], r["a_goals"], r["b_goals"])
                  for r in got)
    need = sorted((*k, p["start"], p["end"], p["look"][0][0], p["look"][0][1], p["ids"][0], p["look"][1][0], p["look"][1][1],
                   p["ids"][1], *p["goals"]) for k, ps in want.items() for p in ps)
    assert list(map(repr, have)) == list(map(repr, need))
    assert have


def test_pairs_of_segment_and_player_are_not_shuffled(spark):
    """Rows of the join by slices are grouped where they met, one sort serves the merge, and presence is shuffled once."""
    shifts, goals = random_game(3)
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        stints = st.build_stints(spark.createDataFrame(shifts, SHIFT), spark.createDataFrame(goals, EVENT), RULES)
        plan = stints._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lists = [i for i, line in enumerate(plan) if "collect_list" in line]
    below = next(line for line in plan[lists[-1]:] if "Join" in line or "Exchange" in line)
    assert lists and "Join" in below and "_slice" in below
    assert not any("Exchange" in line for line in plan[lists[0]:lists[-1]])
    assert not any("_island" in line for line in plan)
    assert any("ReusedExchange" in line and "player_id" in line and "is_goalie" in line for line in plan)


def test_a_hole_in_the_ice_time_ends_a_stint_and_keeps_its_goals(spark):
    shifts = [("s", 1, 1, 1, "A", False, 0, 10), ("s", 1, 1, 1, "A", False, 20, 30), ("s", 1, 1, 9, "B", False, 0, 30),
              ("s", 1, 1, 8, "B", True, 0, 5), ("s", 1, 1, 7, "B", True, 5, 25)]
    goals = [("s", 1, 1, "A", 0), ("s", 1, 1, "A", 7), ("s", 1, 1, "B", 15), ("s", 1, 1, "B", 22), ("s", 1, 1, "A", 30), ("s", 1, 1, "A", 40)]
    out = sorted((r.start_sec, r.end_sec, r.b_goalie_id, r.a_goals, r.b_goals)
                 for r in st.build_stints(spark.createDataFrame(shifts, SHIFT), spark.createDataFrame(goals, EVENT), RULES).collect())
    assert out == [(0, 10, 8, 2, 0), (20, 25, 7, 0, 1), (25, 30, None, 2, 0)]


def test_seven_skaters_are_dropped_and_lose_their_goals(spark):
    shifts = [("s", 1, 1, p, "A", False, 0, 20) for p in range(6)] + [("s", 1, 1, 6, "A", False, 10, 15)]
    shifts += [("s", 1, 1, 100, "B", False, 0, 20)]
    goals = [("s", 1, 1, "A", 5), ("s", 1, 1, "A", 12), ("s", 1, 1, "B", 99)]
    got = sorted((r["start_sec"], r["end_sec"], r["a_goals"], r["b_goals"]) for r in st.build_stints(
        spark.createDataFrame(shifts, SHIFT), spark.createDataFrame(goals, EVENT), RULES).collect())
    assert got == [(0, 10, 1, 0), (15, 20, 0, 1)]


def test_goalie_swap_does_not_split(spark):
    shifts = [("s", 1, 1, 1, "A", False, 0, 20), ("s", 1, 1, 9, "A", True, 0, 10), ("s", 1, 1, 8, "A", True, 10, 20),
              ("s", 1, 1, 100, "B", False, 0, 20)]
    rows = st.build_stints(spark.createDataFrame(shifts, SHIFT), spark.createDataFrame([], EVENT), RULES).collect()
    assert [(r["start_sec"], r["end_sec"], r["a_goalie_id"]) for r in rows] == [(0, 20, 9)]


INTERVALS = "season string, game_id long, period int, start_sec int, end_sec int, team_a string, team_b string"


def brute_place(sec, spans, mode):
    """Index of the span a second belongs to, spelled out case by case."""
    before = [i for i, (s, _) in enumerate(spans) if s < sec]
    same = [i for i, (s, _) in enumerate(spans) if s == sec]
    if mode == "clamp":
        return before[-1] if before else 0
    if mode == "tile":
        return before[-1] if before else (same[0] if same else None)
    if same:
        return before[-1] if before and spans[before[-1]][1] == sec else same[0]
    if not before:
        return 0
    last = before[-1]
    return last if last == len(spans) - 1 or sec < spans[last][1] else None


@pytest.mark.parametrize("mode", ["tile", "clamp", "gap"])
def test_locate_equals_case_by_case(spark, mode):
    spans = [(5, 10), (10, 14), (20, 25), (26, 30)]
    frame = spark.createDataFrame([("s", 1, 1, a, b, "A", "B") for a, b in spans], INTERVALS)
    ticks = spark.createDataFrame([("s", 1, 1, "A", t) for t in range(0, 40)] + [("s", 2, 1, "A", 3)], EVENT)
    got = {r["sec"]: r["at"] for r in attach.locate(ticks, frame, "start_sec", "end_sec", mode).collect()}
    want = {t: brute_place(t, spans, mode) for t in range(0, 40)}
    assert got == {t: spans[i][0] for t, i in want.items() if i is not None}


def test_add_sums_splits_teams_and_ignores_strangers(spark):
    frame = spark.createDataFrame([("s", 1, 1, 0, 10, "A", "B"), ("s", 1, 1, 10, 20, "A", "B")], INTERVALS)
    shots = spark.createDataFrame([("s", 1, 1, "A", 10), ("s", 1, 1, "B", 15), ("s", 1, 1, "Z", 15), ("s", 1, 1, "A", None)], EVENT)
    from pyspark.sql import functions as F
    got = {r["start_sec"]: (r["a_n"], r["b_n"]) for r in attach.add_sums(frame, shots, {"n": F.count("*")}, "gap").collect()}
    assert got == {0: (1, 0), 10: (0, 1)}


def two_sided(spark, rows):
    """Stints from (start, end, a skaters, b skaters) of one period."""
    data = [("2020-2021", 20200, 1, s, e, e - s, "A", list(range(a)), True, 90, "B", list(range(100, 100 + b)), True, 190, 0, 0, a, b)
            for s, e, a, b in rows]
    return spark.createDataFrame(data, """season string, game_id long, period int, start_sec int, end_sec int, duration int,
        team_a string, a_skaters array<long>, a_goalie_on boolean, a_goalie_id long, team_b string, b_skaters array<long>,
        b_goalie_on boolean, b_goalie_id long, a_goals long, b_goals long, a_n int, b_n int""")


def test_expiry_window_is_inclusive(spark):
    rows = two_sided(spark, [(0, 10, 5, 4), (30, 40, 5, 5), (50, 60, 4, 5), (81, 90, 5, 5)])
    got = {r["start_sec"]: (r["a_ppx"], r["b_ppx"], r["a_pkx"], r["b_pkx"]) for r in context.attach_expiry(rows).collect()}
    assert got == {0: (0, 0, 0, 0), 30: (1, 0, 0, 1), 50: (0, 0, 0, 0), 81: (0, 0, 0, 0)}


def test_on_the_fly_needs_no_faceoff(spark):
    rows = two_sided(spark, [(0, 10, 5, 5), (10, 20, 5, 4), (20, 30, 5, 5), (30, 40, 5, 4)])
    draws = spark.createDataFrame([("2020-2021", 20200, 1, "A", 30)], EVENT)
    got = {r["start_sec"]: r["a_otf"] for r in context.attach_on_the_fly(rows, draws).collect()}
    assert got == {0: 0, 10: 1, 20: 0, 30: 0}


def test_zone_start_takes_first_draw_and_mirrors(spark):
    rows = two_sided(spark, [(0, 10, 5, 5), (10, 20, 5, 5)])
    draws = spark.createDataFrame([("2020-2021", 20200, 1, "B", 10, "O", 7), ("2020-2021", 20200, 1, "A", 10, "O", 8)],
                                  EVENT + ", zone string, seq long")
    got = {r["start_sec"]: (r["a_zone_o"], r["a_zone_d"], r["b_zone_o"], r["b_zone_d"])
           for r in context.attach_zone_start(rows, draws).collect()}
    assert got == {0: (0, 0, 0, 0), 10: (0, 1, 1, 0)}


def test_score_state_is_strict_and_capped(spark):
    rows = two_sided(spark, [(0, 10, 5, 5), (10, 20, 5, 5), (20, 30, 5, 5)])
    goals = spark.createDataFrame([("2020-2021", 20200, 1, "A", 10), ("2020-2021", 20200, 1, "B", 10)]
                                  + [("2020-2021", 20200, 1, "B", 15)] * 5, EVENT)
    got = {r["start_sec"]: (r["a_score_state"], r["b_up3"]) for r in attach.attach_score_state(rows, goals, RULES).collect()}
    assert got == {0: (0, 0), 10: (0, 0), 20: (-3, 1)}


def test_strength_ties_go_to_the_ending_stint(spark):
    rows = two_sided(spark, [(0, 10, 5, 5), (10, 20, 5, 4)])
    events = spark.createDataFrame([("2020-2021", 20200, 1, t, s) for t, s in
                                    (("A", 10), ("B", 11), ("A", 0), ("A", 500), ("Z", 5), ("A", None))], EVENT)
    got = {(r["team"], r["sec"]): r["strength"] for r in attach.tag_strength(events, rows).collect()}
    assert got == {("A", 10): "5v5", ("B", 11): "4v5", ("A", 0): "5v5", ("A", 500): "5v4", ("Z", 5): "unknown", ("A", None): "unknown"}


def brute_pairs(shifts):
    out = defaultdict(int)
    periods = defaultdict(list)
    for s in shifts:
        periods[s[:3]].append(s)
    for (season, *_), rows in periods.items():
        side = {}
        for r in sorted(rows, key=lambda r: (r[6], r[7], r[4])):
            side.setdefault(r[3], r[4])
        keepers = {r[3] for r in rows if r[5]}
        teams = sorted(set(side.values()))
        for t in range(0, 80):
            on = {r[3] for r in rows if r[6] <= t < r[7]}
            n = {team: len([p for p in on if side[p] == team and p not in keepers]) for team in teams}
            for a in on:
                for b in on - {a}:
                    edge = 0
                    if len(teams) == 2:
                        mine, other = side[a], next(x for x in teams if x != side[a])
                        edge = n[mine] - n[other]
                    out[(season, a, b, side[a] == side[b], "PP" if edge > 0 else "PK" if edge < 0 else "ES")] += 1
    return dict(out)


@pytest.mark.parametrize("block", [64, 2])
@pytest.mark.parametrize("teams", [("A", "B"), ("A",), ("A", "B", "C")])
def test_shared_seconds_equal_brute_force(spark, monkeypatch, teams, block):
    monkeypatch.setattr(overlap, "BLOCK", block)
    shifts, _ = random_game(7, games=2, teams=teams)
    got = {(r["season"], r["player_id"], r["other_player_id"], r["same_team"], r["situation"]): r["shared_toi"]
           for r in overlap.shared_seconds(spark.createDataFrame(shifts, SHIFT), RULES).collect()}
    assert got == brute_pairs(shifts)


def test_pairs_of_small_segments_meet_by_slices_of_their_period(spark, monkeypatch):
    monkeypatch.setattr(overlap, "BLOCK", 3)  # some segments above, some below
    shifts, _ = random_game(5, games=2, teams=("A", "B"))
    found = overlap.shared_seconds(spark.createDataFrame(shifts, SHIFT), RULES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("RepartitionByExpression" in line and "slice" in line for line in plan.splitlines())
    got = {(r["season"], r["player_id"], r["other_player_id"], r["same_team"], r["situation"]): r["shared_toi"] for r in found.collect()}
    assert got == brute_pairs(shifts)


def test_perspectives_and_player_rows(spark):
    rows = two_sided(spark, [(0, 10, 5, 4)])
    assert perspective.power_play_rows(rows).count() == 1
    assert perspective.short_handed_rows(rows).select("off_team").first()[0] == "B"
    assert perspective.even_rows(rows).count() == 0
    labels = {(r["player_id"], r["situation"]) for r in perspective.player_stints(rows).collect()}
    assert len(labels) == 9 and (0, "5v4") in labels and (100, "4v5") in labels
