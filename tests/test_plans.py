"""Staging, marts and reports on the hand-made seasons."""

from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from season_rows import raw_tables

from touchline.operators.quality import check, overlapping
from touchline.plans import marts, reports, staging
from touchline.plans.features import formula_names, rolled_names, team_names
from touchline.session import written

NOW = "2024-25"


@pytest.fixture(scope="module")
def s(spark):
    raw = raw_tables(spark)
    teams = written(staging.teams(raw["raw_team_data"]))
    players = written(staging.players(raw["raw_compiled_ids"]))
    fixtures = written(staging.fixtures(raw["raw_fixtures"]))
    info = written(staging.team_season_info(teams, raw["raw_team_data"]))
    plays = written(staging.plays(raw["raw_players_clean"], info, fixtures, players))
    fpl_player = written(staging.fpl_player(players, raw["raw_players_clean"]))
    real = written(staging.real_performance(raw["raw_real_perf"], raw["raw_compiled_ids"], players, plays, info, fixtures))
    return SimpleNamespace(
        raw=raw, teams=teams, players=players, fixtures=fixtures, info=info, plays=plays, fpl_player=fpl_player, real=real,
        names={r.player_id: f"{r.player_f_name} {r.player_l_name}" for r in players.collect()},
    )


def failures(table):
    return {(r.check, r.column): r.failures for r in table.collect()}


def test_staging_keys(s):
    assert set(failures(check(s.teams, ["team_id"], ["team_id"])).values()) == {0}
    assert set(failures(check(s.players, ["player_id"], ["player_id"])).values()) == {0}
    assert set(failures(check(s.fixtures, ["fix_id"], ["fix_id"])).values()) == {0}
    assert set(failures(check(s.plays, [], ["player_id", "team_id", "start_date"])).values()) == {0}
    assert set(failures(check(s.fpl_player, [["player_id", "season"]], ["player_id", "season"])).values()) == {0}
    assert set(failures(check(s.real, [], ["player_id", "fix_id"])).values()) == {0}


def test_ids_follow_order(s):
    assert [r.team_name for r in s.teams.orderBy("team_id").collect()] == ["Alba", "Boro", "Cito", "Dune"]
    ordered = s.fixtures.orderBy("fix_id").select("season", "game_week", "home_id", "away_id").collect()
    assert [tuple(r) for r in ordered] == sorted(tuple(r) for r in ordered)


def test_tenures(s):
    spans = {(s.names[r.player_id], r.team_id): r for r in s.plays.collect()}
    assert spans["José Álvarez", 1].end_date is not None
    assert spans["José Álvarez", 2].end_date is None
    assert spans["Ben Stone", 2].end_date is None
    assert len(spans) == 6
    assert overlapping(s.plays, "player_id").isEmpty()


def test_event_side_needs_a_tenure_that_has_begun(s):
    """Rows carry a date without a time; both games of a double week match the one row of the week."""
    per_week = s.real.join(s.fixtures, "fix_id").groupBy("player_id", "season", "game_week").count()
    counts = {(s.names[r.player_id], r.season, r.game_week): r["count"] for r in per_week.collect()}
    assert counts["Ben Stone", NOW, 3] == 2
    assert counts["Ben Stone", NOW, 4] == 1
    assert ("Eli Ford", NOW, 7) not in counts
    assert set(s.real.select("clean_sheets").distinct().toPandas()["clean_sheets"]) == {0, 1}


def test_game_side_drops_repeats_and_three_token_names(s):
    rows = staging.fpl_performance(
        s.raw["raw_fpl_performance"], s.teams, s.info, s.fixtures, s.players, s.fpl_player
    ).collect()
    assert [(r.price, r.points, r.minutes) for r in rows] == [(5.5, 7, 90)]


def test_fixture_names(s):
    view = marts.fixture_names(s.fixtures, s.info, s.teams)
    assert view.count() == s.fixtures.count()
    first = view.where("season = '2024-25' AND game_date = '2024-08-17 15:00:00'").collect()
    assert {(r.home_team_name, r.away_team_name) for r in first} == {("Alba", "Boro"), ("Cito", "Dune")}


def expected_history(s):
    """(player, season) -> rows in order, by hand."""
    weeks = {r.fix_id: r for r in s.fixtures.collect()}
    rows = defaultdict(list)
    for r in s.real.where("position <> 'GK'").collect():
        fixture = weeks[r.fix_id]
        rows[s.names[r.player_id], fixture.season].append((fixture.game_week, r.fix_id, r))
    return {k: sorted(v, key=lambda x: x[:2]) for k, v in rows.items()}


def test_player_pre_match_against_hand_sums(s):
    pre = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info, min_minutes=1)
    assert len(pre.columns) == 125
    got = {(r.player_name, r.fix_id): r for r in pre.collect()}
    checked = 0
    for (name, _), rows in expected_history(s).items():
        for i, (_, fix_id, _) in enumerate(rows):
            before = [r for _, _, r in rows[:i]]
            if not before:
                assert (name, fix_id) not in got
                continue
            row = got[name, fix_id]
            assert row.rolling_ub_minutes == sum(r.minutes for r in before)
            assert row.rolling_bound_last3_goals == sum(r.goals for r in before[-3:])
            shots = [r.shots for r in before[-6:] if r.shots is not None]
            assert row.rolling_bound_last6_shots == (sum(shots) if shots else None)
            minutes = sum(r.minutes for r in before[-3:])
            assert row.goals_per_90_last3 == pytest.approx(sum(r.goals for r in before[-3:]) / (minutes / 90))
            checked += 1
    assert checked == len(got) > 30
    assert "Carl Ruiz" not in {k[0] for k in got}


def test_player_pre_match_strengths(s):
    pre = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info, min_minutes=1)
    row = pre.where("player_name = 'Ben Stone' AND season = '2024-25' AND game_week = 2").first()
    assert row.team_strength == 302
    assert row.opponent_strength in {30, 32, 34, 36}
    compat = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info, min_minutes=1, compat=True)
    assert compat.count() == pre.count()


def test_minutes_threshold(s):
    pre = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info)
    assert pre.agg(F.min("rolling_ub_minutes")).first()[0] >= 90


def test_next_match_frames(s):
    named = marts.player_next_match(s.real, s.players, s.fixtures, s.plays, s.info, NOW)
    literal = marts.player_next_match(s.real, s.players, s.fixtures, s.plays, s.info, NOW, literal_frames=True)
    assert len(named.columns) == 125
    rows = {r.player_name: r for r in named.collect()}
    longer = {r.player_name: r for r in literal.collect()}
    assert set(rows) == {"José Álvarez", "Ben Stone", "Dan Ford"}
    history = expected_history(s)["Ben Stone", NOW]
    assert rows["Ben Stone"].game_week == 8
    assert rows["Ben Stone"].rolling_bound_last3_minutes == sum(r.minutes for _, _, r in history[-3:])
    assert longer["Ben Stone"].rolling_bound_last3_minutes == sum(r.minutes for _, _, r in history[-4:])
    assert rows["Ben Stone"].rolling_ub_minutes == sum(r.minutes for _, _, r in history)


def test_next_match_latest_row_keeps_absent_players(s):
    rows = marts.player_next_match(s.real, s.players, s.fixtures, s.plays, s.info, NOW, latest_row=True)
    assert "Eli Ford" in {r.player_name for r in rows.collect()}


def test_team_form(s):
    pre = marts.team_pre_match(s.fixtures, s.info)
    assert pre.count() == 2 * s.fixtures.count()
    first = pre.where("season = '2024-25' AND game_week = 1").first()
    assert first.rolling_goals_scored_ub is None
    nxt = marts.team_next_match(s.fixtures, s.info, NOW)
    assert nxt.count() == 4 and {r.game_week for r in nxt.collect()} == {8}
    week8 = {(r.team_id, r.fix_id): r.rolling_goals_scored_last3 for r in pre.where("season = '2024-25' AND game_week = 8").collect()}
    assert {(r.team_id, r.fix_id): r.rolling_goals_scored_last3 for r in nxt.collect()} == week8


def test_matrices(s):
    pre = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info)
    matrix = marts.modeling_matrix(pre, s.real, marts.team_pre_match(s.fixtures, s.info))
    assert len(matrix.columns) == 129 and matrix.count() == pre.count()
    nxt = marts.player_next_match(s.real, s.players, s.fixtures, s.plays, s.info, NOW)
    team_next = marts.team_next_match(s.fixtures, s.info, NOW)
    scoring = marts.scoring_matrix(nxt, team_next)
    assert len(scoring.columns) == 127 and scoring.count() == nxt.count() > 0
    assert marts.scoring_matrix(nxt, team_next, s.real).isEmpty()


def test_feature_names_are_complete():
    assert len(rolled_names()) == 75 and len(formula_names()) == 16 + 24 and len(team_names()) == 6


def test_reports(s):
    predictions = s.real.select(
        "player_id", F.col("fix_id").alias("fixture_id"),
        F.when(F.col("minutes") > 60, F.col("goals") - 0.5).alias("predicted_goals"), F.lit(-1.0).alias("predicted_assists"),
    )
    pairs = reports.prediction_analysis(predictions, s.players, s.fixtures, s.real)
    assert pairs.columns == ["player_name", "game_week", "season", "goals", "predicted_goals", "assists", "predicted_assists"]
    report = reports.prediction_accuracy(predictions, s.players, s.fixtures, s.real, s.fpl_player, k=1)
    rows = report.collect()
    keepers = [r for r in rows if r.position == "GK"]
    assert keepers and all(r.points is None and r.predicted_points is None for r in keepers)
    for r in rows:
        group = [x for x in rows if (x.position, x.game_week, x.season) == (r.position, r.game_week, r.season)]
        assert sorted(x.predicted_rank for x in group) == list(range(1, len(group) + 1))
    without = [r for r in rows if r.predicted_points is None and r.position != "GK"]
    assert without, "a NULL prediction stays NULL, it does not become 0"
    assert [tuple(r)[3:4] + tuple(r)[1:3] for r in rows] == sorted(tuple(r)[3:4] + tuple(r)[1:3] for r in rows)


def test_rolled_window_uses_one_exchange_and_no_cartesian(spark, s):
    pre = marts.player_pre_match(s.real, s.players, s.fixtures, s.plays, s.info)
    plan = pre._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert initial.count("hashpartitioning(player_id") == 1
    assert initial.count("+- Window [") + initial.count(" Window [") >= 1
