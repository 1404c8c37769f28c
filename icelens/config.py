"""Tunable values of the whole library, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field

# game first: sorts compare its integer prefix before any text
PERIOD_KEYS = ["game_id", "period", "season"]

UNBLOCKED = ("goal", "shot-on-goal", "missed-shot")
ON_GOAL = ("goal", "shot-on-goal")
ALL_SHOTS = ("goal", "shot-on-goal", "missed-shot", "blocked-shot")
POSSESSION_TYPES = ("hit", "giveaway", "takeaway")

SKATER_SITUATIONS = ("all", "5v5", "5v4", "4v5")
GOALIE_SITUATIONS = ("all", "5v5", "4v5")

# name+team pairs whose shift report spelling is known to differ from the roster.
REPORT_NAME_OVERRIDES = (
    ("NICKLAS GROSSMAN", "DAL", 8471269),
    ("CHRISTOPHER BOURQUE", "WSH", 8471246),
    ("CHRISTOPHER BOURQUE", "PIT", 8471246),
    ("JEFF DROUIN DESLAURIERS", "EDM", 8470074),
    ("ALEXANDRE PICARD", "OTT", 8470678),
    ("ALEXANDRE PICARD", "CAR", 8470678),
    ("ALEXANDRE PICARD", "CBJ", 8471221),
)

# Spellings of a team's full name that map to another one.
TEAM_NAME_ALIASES = (
    ("Utah Hockey Club", "Utah Mammoth"),
    ("Montréal Canadiens", "Montreal Canadiens"),
)


def log_spaced(low: float, high: float, n: int) -> tuple:
    """``n`` values from 10**low to 10**high, evenly spaced in their logarithm."""
    return tuple(10 ** (low + (high - low) * i / (n - 1)) for i in range(n))


@dataclass(frozen=True)
class Rules:
    # All numbers below are those the results depend on.
    # clock
    period_seconds: int = 1200
    max_skaters: int = 6
    change_window_seconds: int = 20
    score_cap: int = 3
    # shots
    net_x: float = 89.0
    rebound_seconds: float = 3.0
    rush_seconds: float = 5.0
    rush_feet: float = 40.0
    speed_cap: float = 50.0
    high_danger: float = 0.08
    medium_danger: float = 0.02
    first_3v3_overtime_year: int = 2015
    # xG training: fixed candidates
    min_rows_per_strength: int = 500
    xg_folds: int = 5
    high_volume: tuple = ("5v5", "5v4", "4v5")
    xg_grid: tuple = (
        {"maxDepth": 3, "stepSize": 0.05, "maxIter": 300},
        {"maxDepth": 4, "stepSize": 0.05, "maxIter": 300},
        {"maxDepth": 3, "stepSize": 0.10, "maxIter": 200},
        {"maxDepth": 5, "stepSize": 0.05, "maxIter": 300},
    )
    xg_grid_high_volume: tuple = (
        {"maxDepth": 5, "stepSize": 0.05, "maxIter": 300},
        {"maxDepth": 6, "stepSize": 0.05, "maxIter": 300},
        {"maxDepth": 7, "stepSize": 0.05, "maxIter": 300},
        {"maxDepth": 6, "stepSize": 0.03, "maxIter": 500},
        {"maxDepth": 8, "stepSize": 0.03, "maxIter": 500},
    )
    # ridge: fixed penalties
    rate_cap: float = 50.0
    ridge_folds: int = 5
    alphas: tuple = log_spaced(0.0, 4.5, 20)
    alphas_special: tuple = log_spaced(-1.5, 4.5, 24)
    context_alpha: float = 3.0
    prior_seasons: int = 2
    prior_minutes: dict = field(default_factory=lambda: {"5v5": 200.0, "5v4": 50.0, "4v5": 50.0})
    # value
    penalty_goal_minutes: dict = field(
        default_factory=lambda: {"5v5": 0.09624, "5v4": 0.09624, "4v5": 0.24575})
    attributable_minutes: tuple = (2, 4, 5)
    finishing_k: float = 100.0
    penalty_k: float = 10.0
    goalie_k: float = 300.0
    team_rank: dict = field(default_factory=lambda: {
        ("5v5", "F"): 13, ("5v5", "D"): 7,
        ("5v4", "F"): 9, ("5v4", "D"): 3,
        ("4v5", "F"): 7, ("4v5", "D"): 5,
    })
    goalie_team_rank: int = 1
    pythagorean: float = 2.109
    # scores
    great_start: float = 1.5
    quality_start: float = 0.0
    awful_start: float = -1.5
    # ranking: fixed season lengths, thresholds and season weights
    season_games: dict = field(default_factory=lambda: {
        "2009-2010": 82, "2010-2011": 82, "2011-2012": 82, "2012-2013": 48, "2013-2014": 82,
        "2014-2015": 82, "2015-2016": 82, "2016-2017": 82, "2017-2018": 82, "2018-2019": 82,
        "2019-2020": 71, "2020-2021": 56, "2021-2022": 82, "2022-2023": 82, "2023-2024": 82,
        "2024-2025": 82, "2025-2026": 82, "2026-2027": 0,
    })
    skater_min_toi_per_game: float = 3.6585
    goalie_min_gp_share: float = 0.15
    special_min_toi_per_gp: float = 0.75
    skater_weights: dict = field(default_factory=lambda: {
        "three": (0.436, 0.328, 0.236), "two": (0.535, 0.465, 0.0),
        "gap": (0.591, 0.0, 0.409), "one": (1.0, 0.0, 0.0)})
    goalie_weights: dict = field(default_factory=lambda: {
        "three": (0.366, 0.365, 0.269), "two": (0.526, 0.474, 0.0),
        "gap": (0.553, 0.0, 0.447), "one": (1.0, 0.0, 0.0)})

    @property
    def slice_seconds(self) -> int:
        """Width of the time slices that split one period over many tasks."""
        return max(1, self.period_seconds // 20)


DEFAULT_RULES = Rules()
