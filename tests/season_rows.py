"""Small hand-made seasons: four teams, two seasons of eight weeks, the last week not yet played."""

from __future__ import annotations

from datetime import datetime, timedelta

TEAMS = ["Alba", "Boro", "Cito", "Dune"]
ROUNDS = [(0, 1, 2, 3), (0, 2, 3, 1), (0, 3, 1, 2), (1, 0, 3, 2)]
SEASONS = {"2023-24": datetime(2023, 8, 12, 15), "2024-25": datetime(2024, 8, 17, 15)}
# (first, last, name elsewhere, id, position, team per season)
PEOPLE = [
    ("José", "Álvarez", "Jose Alvarez", "aa11", "FWD", {"2023-24": 0, "2024-25": 1}),
    ("Ben", "Stone", "Ben Stone", "bb22", "MID", {"2023-24": 1, "2024-25": 1}),
    ("Carl", "Ruiz", "Carl Ruiz", "cc33", "GK", {"2023-24": 2, "2024-25": 2}),
    ("Dan", "Ford", "Dan Ford", "dd44", "DEF", {"2024-25": 3}),
    ("Eli", "Ford", "Eli Ford", "ee55", "FWD", {"2024-25": 0}),
]


def season_id(team: int, season: str) -> int:
    """Ids that differ from season to season."""
    return (team + (1 if season == "2023-24" else 3)) % 4 + 1


def team_rows():
    return [
        dict(
            name=name, short_name=name[:3].upper(), fbref_id=f"t{i}", season=season, id=season_id(i, season),
            strength_attack_home=100 + i, strength_defence_home=200 + i, strength_attack_away=10 + i, strength_defence_away=20 + i,
        )
        for season in SEASONS
        for i, name in enumerate(TEAMS)
    ]


def fixture_rows():
    rows = []
    for season, start in SEASONS.items():
        for week in range(1, 9):
            a, b, c, d = ROUNDS[(week - 1) % 4]
            games = [(a, b, 0), (c, d, 0)]
            if season == "2024-25" and week == 3:
                games.append((1, 3, 3))  # a second game in the week for two teams
            played = not (season == "2024-25" and week == 8)
            for n, (home, away, later) in enumerate(games):
                rows.append(
                    dict(
                        season=season, event=week, finished=played, kickoff_time=start + timedelta(days=7 * (week - 1) + later),
                        team_h=season_id(home, season), team_a=season_id(away, season),
                        team_h_score=float((week + n) % 4) if played else None, team_a_score=float(week % 3) if played else None,
                        team_h_difficulty=2, team_a_difficulty=3,
                    )
                )
    return rows


def id_rows():
    return [dict(fpl_f_name=f, fpl_l_name=last, id_fpl=i, fbref_name=name, id_fbref=code) for i, (f, last, name, code, _, _) in enumerate(PEOPLE)]


def squad_rows():
    return [
        dict(first_name=f, second_name=last, element_type=pos, team=season_id(team, season), season=season)
        for f, last, _, _, pos, teams in PEOPLE
        for season, team in teams.items()
    ]


def stats_of(person: int, week: int) -> dict:
    return dict(Min=60 + 10 * (week % 4), Performance_Gls=(person + week) % 3, Performance_Ast=week % 2, Performance_Sh=None if week == 5 else 1 + person)


def event_rows():
    """One row per person and week played; Eli misses the last finished week."""
    rows = []
    for p, (_, _, name, _, pos, teams) in enumerate(PEOPLE):
        for season, start in SEASONS.items():
            if season not in teams:
                continue
            for week in range(1, 9):
                if season == "2024-25" and (week == 8 or (name == "Eli Ford" and week == 7)):
                    continue
                rows.append(
                    dict(
                        Date=(start + timedelta(days=7 * (week - 1) + 4)).date(), Round=f"Matchweek {week}", Name=name, Season=season,
                        Starter=1, Pos="GK" if pos == "GK" else "MF", Expected_xG=0.25 * (week % 4), Expected_npxG=0.125 * (week % 4),
                        Expected_xAG=0.5, Performance_CS=week % 2, Captain="0", **stats_of(p, week),
                    )
                )
    return rows


def history_rows():
    return [
        dict(
            name="Ben Stone", team="Boro", season="2024-25", kickoff_time=datetime(2024, 8, 17, 20, 30), value=55.0, total_points=7, minutes=90
        ),
        dict(
            name="Ben Stone", team="Boro", season="2024-25", kickoff_time=datetime(2024, 8, 17, 20, 30), value=55.0, total_points=7, minutes=90
        ),
        dict(name="José María Álvarez", team="Boro", season="2024-25", kickoff_time=datetime(2024, 8, 17, 20, 30), value=60.0, total_points=1, minutes=9),
    ]


def frame(spark, table: str, rows: list[dict]):
    """Rows as the typed raw table, absent columns NULL."""
    from touchline.sources.schemas import schema_of

    schema = schema_of(table)
    known = {f.name for f in schema.fields}
    assert all(set(r) <= known for r in rows), set().union(*rows) - known
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def raw_tables(spark):
    return {
        "raw_team_data": frame(spark, "raw_team_data", team_rows()),
        "raw_fixtures": frame(spark, "raw_fixtures", fixture_rows()),
        "raw_compiled_ids": frame(spark, "raw_compiled_ids", id_rows()),
        "raw_players_clean": frame(spark, "raw_players_clean", squad_rows()),
        "raw_real_perf": frame(spark, "raw_real_perf", event_rows()),
        "raw_fpl_performance": frame(spark, "raw_fpl_performance", history_rows()),
    }
