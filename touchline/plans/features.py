"""The derived feature space, declared once and generated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import rate_per, safe_ratio, sum_of
from touchline.operators.windows import Trailing, trailing

# Base statistics by column of the performance table, with their label in feature names.
STATS = {
    "minutes": "minutes",
    "non_pen_expected_goals": "np_expected_goals",
    "expected_goals": "expected_goals",
    "goals": "goals",
    "expected_assists": "expected_assists",
    "assists": "assists",
    "shots": "shots",
    "shots_on_target": "shots_on_target",
    "pk_made": "pk_made",
    "pk_attempt": "pk_attempt",
    "yellow_card": "yellow_cards",
    "red_card": "red_cards",
    "touches": "touches",
    "tackles": "tackles",
    "interceptions": "interceptions",
    "blocks": "blocks",
    "shot_creating_actions": "shot_creating_actions",
    "goal_creating_actions": "goal_creating_actions",
    "pass_attempted": "pass_attempted",
    "pass_completed": "pass_completed",
    "pass_progressive": "pass_progressive",
    "carries": "carries",
    "carries_progressive": "carries_progressive",
    "take_ons_attempted": "take_ons_attempted",
    "take_ons_success": "take_ons_success",
}

# Frames by label, as preceding rows.
FRAMES = {"ub": None, "bound_last3": 3, "bound_last6": 6}
TEAM_FRAMES = {"last3": 3, "last6": 6, "ub": None}

# Formulas on rolled labels. The unbounded ratios keep NULL, the bounded ones do not.
FORMULA_FRAMES = {"ub": ("ub", False), "last3": ("bound_last3", True)}
RATIOS = {
    "goals_efficiency": ("goals", "expected_goals"),
    "assists_efficiency": ("assists", "expected_assists"),
    "shots_efficiency": ("goals", "shots"),
}
CONTRIBUTIONS = {
    "contribution_real": ("goals", "assists"),
    "contribution_xgi": ("expected_goals", "expected_assists"),
    "contribution_npxgi": ("np_expected_goals", "expected_assists"),
}
CONTRIBUTION_RATIOS = {
    "contribution_efficiency_xgi": ("contribution_real", "contribution_xgi"),
    "contribution_efficiency_npxgi": ("contribution_real", "contribution_npxgi"),
}
RATES = {
    "goals": "goals",
    "assists": "assists",
    "real_contribution": "contribution_real",
    "xg": "expected_goals",
    "npxg": "np_expected_goals",
    "xa": "expected_assists",
    "xgi": "contribution_xgi",
    "npxgi": "contribution_npxgi",
    "shots": "shots",
    "shots_on_target": "shots_on_target",
    "shot_creating_actions": "shot_creating_actions",
    "goal_creating_actions": "goal_creating_actions",
}


def rolled_names() -> list[str]:
    return [f"rolling_{frame}_{label}" for frame in FRAMES for label in STATS.values()]


def formula_names() -> list[str]:
    shares = [f"{name}_{frame}" for frame in FORMULA_FRAMES for name in [*RATIOS, *CONTRIBUTIONS, *CONTRIBUTION_RATIOS]]
    return shares + [f"{name}_per_90_{frame}" for frame in FORMULA_FRAMES for name in RATES]


def team_names() -> list[str]:
    return [f"rolling_goals_{what}_{frame}" for frame in TEAM_FRAMES for what in ("scored", "conceded")]


def roll_stats(df: DataFrame, partition_by: list[str], order_by: list[str], current: bool = False, literal: bool = True) -> DataFrame:
    """All statistics over all frames.

    With ``current`` the current row counts. The literal frame then has one row
    more than its name says; otherwise it keeps the named length.
    """
    cut = 0 if literal or not current else 1
    specs = [
        Trailing(column, f"rolling_{frame}_{label}", None if rows is None else rows - cut, current)
        for frame, rows in FRAMES.items()
        for column, label in STATS.items()
    ]
    return trailing(df, specs, partition_by, order_by)


def add_formulas(df: DataFrame) -> DataFrame:
    """Efficiency, contribution and per-90 columns from the rolled ones, in two layers."""

    def rolled(frame: str, label: str) -> Column:
        return F.col(f"rolling_{frame}_{label}")

    first: dict[str, Column] = {}
    for suffix, (frame, coalesce) in FORMULA_FRAMES.items():
        for name, (num, den) in RATIOS.items():
            first[f"{name}_{suffix}"] = safe_ratio(rolled(frame, num), rolled(frame, den), coalesce)
        for name, parts in CONTRIBUTIONS.items():
            first[f"{name}_{suffix}"] = sum_of(*[rolled(frame, p) for p in parts])
    df = df.withColumns(first)

    second: dict[str, Column] = {}
    for suffix, (frame, coalesce) in FORMULA_FRAMES.items():
        for name, (num, den) in CONTRIBUTION_RATIOS.items():
            second[f"{name}_{suffix}"] = safe_ratio(F.col(f"{num}_{suffix}"), F.col(f"{den}_{suffix}"), coalesce)
        for name, label in RATES.items():
            value = F.col(f"{label}_{suffix}") if label in CONTRIBUTIONS else rolled(frame, label)
            second[f"{name}_per_90_{suffix}"] = rate_per(value, rolled(frame, "minutes"))
    return df.withColumns(second)


def roll_team(df: DataFrame) -> DataFrame:
    """Goals scored and conceded before each fixture of a team's season."""
    specs = [
        Trailing(f"team_goals_{what}", f"rolling_goals_{what}_{frame}", rows)
        for frame, rows in TEAM_FRAMES.items()
        for what in ("scored", "conceded")
    ]
    return trailing(df, specs, ["team_id", "season"], ["game_week", "fix_id"])
