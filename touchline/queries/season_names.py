"""Columns and formulas as the SQL states them, apart from the maps that the plans use."""

from __future__ import annotations

# Source and output columns of the staging tables.
FIXTURE_SQL = """
    season, event AS game_week, finished, team_h_score AS home_goals, team_a_score AS away_goals, kickoff_time AS game_date,
    team_h AS home_id, team_a AS away_id, team_h_difficulty AS home_team_difficulty, team_a_difficulty AS away_team_difficulty
"""
TEAM_SEASON_SQL = """
    season, id AS fpl_season_id, strength_attack_home AS home_attack_score, strength_defence_home AS home_defence_score,
    strength_attack_away AS away_attack_score, strength_defence_away AS away_defence_score
"""
GAME_SIDE_SQL = """
    total_points AS points, transfers_in, transfers_out, bps AS bonus_point_system, minutes, goals_scored, assists, clean_sheets,
    goals_conceded, own_goals, penalties_saved, penalties_missed, yellow_cards, red_cards, saves, influence AS influence_score,
    creativity AS creativity_score, threat AS threat_score, ict_index
"""
EVENT_SIDE_SQL = """
    Starter AS starter, Pos AS position, Min AS minutes, Performance_Gls AS goals, Performance_Ast AS assists,
    Performance_PK AS pk_made, Performance_PKatt AS pk_attempt, Performance_Sh AS shots, Performance_SoT AS shots_on_target,
    Performance_CrdY AS yellow_card, Performance_CrdR AS red_card, Performance_Touches AS touches, Performance_Tkl AS tackles,
    Performance_Int AS interceptions, Performance_Blocks AS blocks, Expected_xG AS expected_goals,
    Expected_npxG AS non_pen_expected_goals, Expected_xAG AS expected_assists, SCA_SCA AS shot_creating_actions,
    SCA_GCA AS goal_creating_actions, Passes_Cmp AS pass_completed, Passes_Att AS pass_attempted, Passes_PrgP AS pass_progressive,
    Carries_Carries AS carries, Carries_PrgC AS carries_progressive, Take_Ons_Att AS take_ons_attempted,
    Take_Ons_Succ AS take_ons_success, Performance_SoTA AS shot_on_target_against, Performance_GA AS goals_against,
    Performance_Saves AS saves, Performance_PSxG AS post_shot_expected_goals, Captain AS captain
"""

# Statistics that are rolled, with the names of their sums where they differ.
STATS = {
    **{
        name: name
        for name in """
            minutes expected_goals goals expected_assists assists shots shots_on_target pk_made pk_attempt touches tackles
            interceptions blocks shot_creating_actions goal_creating_actions pass_attempted pass_completed pass_progressive
            carries carries_progressive take_ons_attempted take_ons_success
        """.split()
    },
    "non_pen_expected_goals": "np_expected_goals",
    "yellow_card": "yellow_cards",
    "red_card": "red_cards",
}
# Rows before the current one by the name of a frame, and which frames formulas use, coalesced or not.
FRAMES = {"ub": None, "bound_last3": 3, "bound_last6": 6}
TEAM_FRAMES = {"ub": None, "last3": 3, "last6": 6}
FORMULA_FRAMES = {"ub": ("ub", False), "last3": ("bound_last3", True)}
# Formulas over the sums of a frame.
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

ROLLED = [f"rolling_{frame}_{name}" for frame in FRAMES for name in STATS.values()]
FORMULAS = [
    f"{name}_{frame}"
    for frame in FORMULA_FRAMES
    for name in [*RATIOS, *CONTRIBUTIONS, *CONTRIBUTION_RATIOS, *[f"{rate}_per_90" for rate in RATES]]
]
TEAM_ROLLED = [f"rolling_goals_{kind}_{frame}" for frame in TEAM_FRAMES for kind in ("scored", "conceded")]
