"""Column names and types of the raw tables, in load order."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLES = {
    "raw_team_data": """
        code int, draw int, form double, id int, loss int, name string, played int, points int,
        position int, short_name string, strength int, team_division int, unavailable boolean, win int,
        strength_overall_home int, strength_overall_away int, strength_attack_home int,
        strength_attack_away int, strength_defence_home int, strength_defence_away int,
        pulse_id int, season string, fbref_id string""",
    "raw_fixtures": """
        code int, event int, finished boolean, finished_provisional boolean, id int,
        kickoff_time timestamp, minutes int, provisional_start_time boolean, started boolean,
        team_a int, team_a_score double, team_h int, team_h_score double, stats string,
        team_h_difficulty int, team_a_difficulty int, pulse_id int, season string""",
    "raw_players_clean": """
        first_name string, second_name string, goals_scored int, assists int, total_points int,
        minutes int, goals_conceded int, creativity double, influence double, threat double,
        bonus int, bps int, ict_index double, clean_sheets int, red_cards int, yellow_cards int,
        selected_by_percent double, now_cost int, element_type string, team int, season string""",
    "raw_fpl_performance": """
        name string, position string, team string, xP double, assists int, bonus int, bps int,
        clean_sheets int, creativity double, element int, expected_assists double,
        expected_goal_involvements double, expected_goals double, expected_goals_conceded double,
        fixture int, goals_conceded int, goals_scored int, ict_index double, influence double,
        kickoff_time timestamp, minutes int, opponent_team string, own_goals int,
        penalties_missed int, penalties_saved int, red_cards int, round int, saves int, selected int,
        starts int, team_a_score int, team_h_score int, threat double, total_points int,
        transfers_balance int, transfers_in int, transfers_out int, value double, was_home boolean,
        yellow_cards int, GW int, season string""",
    "raw_real_perf": """
        Date date, Day string, Comp string, Round string, Venue string, Result string, Squad string,
        Opponent string, Starter int, Pos string, Min int, Performance_Gls int, Performance_Ast int,
        Performance_PK int, Performance_PKatt int, Performance_Sh int, Performance_SoT int,
        Performance_CrdY int, Performance_CrdR int, Performance_Touches int, Performance_Tkl int,
        Performance_Int int, Performance_Blocks int, Expected_xG double, Expected_npxG double,
        Expected_xAG double, SCA_SCA int, SCA_GCA int, Passes_Cmp int, Passes_Att int,
        Passes_Cmp_percent double, Passes_PrgP int, Carries_Carries int, Carries_PrgC int,
        Take_Ons_Att int, Take_Ons_Succ int, Match_Report string, Name string,
        Performance_SoTA int, Performance_GA int, Performance_Saves int,
        Performance_Save_percent double, Performance_CS int, Performance_PSxG double,
        Penalty_Kicks_PKatt int, Penalty_Kicks_PKA int, Penalty_Kicks_PKsv int, Penalty_Kicks_PKm int,
        Launched_Cmp int, Launched_Att int, Launched_Cmp_percent double, Passes_Att_GK int,
        Passes_Thr int, Passes_Launch_percent double, Passes_AvgLen double, Goal_Kicks_Att int,
        Goal_Kicks_Launch_percent double, Goal_Kicks_AvgLen double, Crosses_Opp int, Crosses_Stp int,
        Crosses_Stp_percent double, Sweeper_OPA int, Sweeper_AvgDist double, Performance_Fls int,
        Performance_Fld int, Performance_Off int, Performance_Crs int, Performance_TklW int,
        Performance_OG int, Performance_PKwon int, Performance_PKcon int, Season string, Captain string""",
    "raw_compiled_ids": "fpl_f_name string, fpl_l_name string, id_fpl int, fbref_name string, id_fbref string",
    "predictions": """
        prediction_id long, player_id int, fixture_id int, predicted_goals double,
        predicted_assists double, prediction_timestamp timestamp""",
}

# File name of each raw table inside a season's folder.
RAW_FILES = {
    "raw_team_data": "teams.csv",
    "raw_fixtures": "fixtures.csv",
    "raw_players_clean": "players_clean.csv",
    "raw_fpl_performance": "merged_gw.csv",
    "raw_real_perf": "fbref_merged_gw_data.csv",
    "raw_compiled_ids": "player_compiled_ids.csv",
}

# Columns of the cleaned player file and of the id list.
CLEAN_PLAYER_COLUMNS = [
    "first_name", "second_name", "goals_scored", "assists", "total_points", "minutes", "goals_conceded",
    "creativity", "influence", "threat", "bonus", "bps", "ict_index", "clean_sheets", "red_cards",
    "yellow_cards", "selected_by_percent", "now_cost", "element_type", "team",
]
ID_LIST_COLUMNS = ["first_name", "second_name", "id"]


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_TABLES[table])
