"""The plans from raw tables to matrices and reports, on seasons derived from the test tables.

Nations are teams, suppliers are players, and each year is a season of weekly
rounds in which nation n meets nation (week - n) modulo 25. Goals are a nation's
orders of the week; a player's statistics come from the supplier's lines of the
week. Some suppliers change their nation in 1998.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import marts, reports, staging
from touchline.queries import season_names
from touchline.queries.registry import query, table
from touchline.queries.season_names import (
    CONTRIBUTION_RATIOS,
    CONTRIBUTIONS,
    FORMULA_FRAMES,
    FORMULAS,
    FRAMES,
    RATES,
    RATIOS,
    ROLLED,
    STATS,
    TEAM_FRAMES,
    TEAM_ROLLED,
)
from touchline.session import written

SEASON = "2000-01"

WEEK = "CAST(YEAR(o_orderdate) AS INTEGER) AS yr, CAST(FLOOR((dayofyear(o_orderdate) - 1) / 7) AS INTEGER) + 1 AS week"
LABEL = "CAST(yr AS STRING) || '-' || lpad(CAST((yr + 1) % 100 AS STRING), 2, '0')"
MONTH = "CAST(1 + FLOOR((week - 1) / 5) AS INTEGER)"
TEAM = "CASE WHEN yr >= 1998 AND s_suppkey % 5 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END"

# One text per raw table, run by Spark and by the oracle alike; the plans under test begin after it.
RAW_SQL = {
    "week_goals": f"""
        SELECT yr, week, n, COUNT(*) AS goals
        FROM (SELECT {WEEK}, c_nationkey AS n FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey) x
        GROUP BY yr, week, n""",
    "raw_team_data": f"""
        SELECT DISTINCT n_name AS name, 'N' || CAST(n AS STRING) AS short_name, 't' || CAST(n AS STRING) AS fbref_id,
               {LABEL} AS season, (n + yr) % 25 + 1 AS id,
               1000 + n * 7 + yr % 10 AS strength_attack_home, 1000 + n * 5 + yr % 7 AS strength_defence_home,
               1000 + n * 3 + yr % 5 AS strength_attack_away, 1000 + n * 2 + yr % 3 AS strength_defence_away
        FROM {{week_goals}} w JOIN {{nation}} t ON t.n_nationkey = w.n""",
    "raw_fixtures": f"""
        SELECT {LABEL} AS season, p.week AS event, (yr < 2000 OR (yr = 2000 AND p.week <= 30)) AS finished,
               CAST(COALESCE(h.goals, 0) AS DOUBLE) AS team_h_score, CAST(COALESCE(a.goals, 0) AS DOUBLE) AS team_a_score,
               make_timestamp(yr, {MONTH.replace("week", "p.week")}, (p.week - 1) % 5 * 5 + 1 + home % 5, 15, 0, 0) AS kickoff_time,
               (home + yr) % 25 + 1 AS team_h, (away + yr) % 25 + 1 AS team_a,
               home % 5 + 1 AS team_h_difficulty, away % 5 + 1 AS team_a_difficulty
        FROM (SELECT DISTINCT yr, week, CASE WHEN week % 2 = 0 THEN LEAST(n, o) ELSE GREATEST(n, o) END AS home,
                     CASE WHEN week % 2 = 0 THEN GREATEST(n, o) ELSE LEAST(n, o) END AS away
              FROM (SELECT yr, week, n, (week + 50 - n) % 25 AS o FROM {{week_goals}} g) r WHERE n <> o) p
        LEFT JOIN (SELECT yr AS hy, week AS hw, n AS hn, goals FROM {{week_goals}} g) h ON hy = yr AND hw = p.week AND hn = home
        LEFT JOIN (SELECT yr AS ay, week AS aw, n AS an, goals FROM {{week_goals}} g) a ON ay = yr AND aw = p.week AND an = away""",
    "raw_compiled_ids": """
        SELECT 'S' || CAST(s_nationkey AS STRING) AS fpl_f_name, s_name AS fpl_l_name, CAST(s_suppkey AS INTEGER) AS id_fpl,
               'S' || CAST(s_nationkey AS STRING) || ' ' || s_name AS fbref_name, 'f' || CAST(s_suppkey AS STRING) AS id_fbref
        FROM {supplier} s""",
    "week_lines": f"""
        SELECT s_suppkey, s_nationkey, s_name, yr, week, CAST(SUM(l_quantity) AS INTEGER) AS q, CAST(COUNT(*) AS INTEGER) AS c,
               CAST(SUM(l_linenumber) AS INTEGER) AS n, CAST(FLOOR(SUM(CAST(l_extendedprice AS DECIMAL(18,2)))) AS INTEGER) AS p,
               FLOOR(CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 64) / 64 AS d,
               FLOOR(CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) * 64) / 64 AS t
        FROM (SELECT s.*, l.*, {WEEK} FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
              JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey) x
        GROUP BY s_suppkey, s_nationkey, s_name, yr, week""",
    "raw_players_clean": f"""
        SELECT DISTINCT 'S' || CAST(s_nationkey AS STRING) AS first_name, s_name AS second_name,
               CASE s_suppkey % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'DEF' WHEN 2 THEN 'MID' ELSE 'FWD' END AS element_type,
               ({TEAM} + yr) % 25 + 1 AS team, {LABEL} AS season
        FROM {{week_lines}} w""",
    "raw_fpl_performance": f"""
        SELECT 'S' || CAST(s_nationkey AS STRING) || ' ' || s_name AS name, n_name AS team, {LABEL} AS season,
               make_timestamp(yr, {MONTH}, (week - 1) % 5 * 5 + 1 + s_nationkey % 5, 20, 30, 0) AS kickoff_time, CAST(p % 90 AS DOUBLE) AS value,
               q % 15 AS total_points, p % 100 AS transfers_in, p % 80 AS transfers_out, q % 30 AS bps, q AS minutes, n % 4 AS goals_scored,
               q % 3 AS assists, c % 2 AS clean_sheets, p % 4 AS goals_conceded, p % 2 AS own_goals, n % 2 AS penalties_saved, n % 3 AS penalties_missed,
               c % 2 AS yellow_cards, p % 2 AS red_cards, q % 6 AS saves, d AS influence, t AS creativity, d + t AS threat, t AS ict_index
        FROM {{week_lines}} w JOIN {{nation}} z ON z.n_nationkey = {TEAM}""",
    "raw_real_perf": f"""
        SELECT make_date(yr, {MONTH}, (week - 1) % 5 * 5 + 5) AS Date, 'Matchweek ' || CAST(week AS STRING) AS Round,
               'S' || CAST(s_nationkey AS STRING) || ' ' || s_name AS Name, {LABEL} AS Season, c % 2 AS Starter,
               CASE WHEN s_suppkey % 4 = 0 THEN 'GK' WHEN s_suppkey % 4 = 1 THEN 'DF' ELSE 'MF' END AS Pos, q AS Min,
               n % 4 AS Performance_Gls, q % 3 AS Performance_Ast, n % 2 AS Performance_PK, n % 3 AS Performance_PKatt, q % 9 AS Performance_Sh,
               CASE WHEN q % 11 = 0 THEN NULL ELSE q % 5 END AS Performance_SoT, c % 2 AS Performance_CrdY, p % 2 AS Performance_CrdR,
               q AS Performance_Touches, p % 11 AS Performance_Tkl, p % 7 AS Performance_Int, q % 4 AS Performance_Blocks,
               d AS Expected_xG, d / 2 AS Expected_npxG, t AS Expected_xAG, q % 8 AS SCA_SCA, q % 5 AS SCA_GCA, p % 50 AS Passes_Cmp,
               p % 70 AS Passes_Att, p % 13 AS Passes_PrgP, q % 23 AS Carries_Carries, q % 6 AS Carries_PrgC, n % 7 AS Take_Ons_Att,
               n % 5 AS Take_Ons_Succ, p % 3 AS Performance_SoTA, p % 4 AS Performance_GA, q % 6 AS Performance_Saves,
               c % 2 AS Performance_CS, t AS Performance_PSxG, CAST(c % 2 AS STRING) AS Captain
        FROM {{week_lines}} w""",
}
BASE_TABLES = ["orders", "customer", "nation", "supplier", "lineitem"]


class Season:
    """Raw tables and entities of one scale factor, built when asked for.

    Entities several steps start from are written once, as staging tables are.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sources = {name: table(spark, sf_dir, name) for name in BASE_TABLES}
        # Lines meet their suppliers by a shuffle, so that weekly totals are summed, and written, supplier by supplier.
        self.sources["supplier"] = self.sources["supplier"].hint("shuffle_hash")

    def raw(self, name: str) -> DataFrame:
        if name not in self.sources:
            used = {part: self.raw(part) for part in [*BASE_TABLES, *RAW_SQL] if f"{{{part}}}" in RAW_SQL[name]}
            df = self.spark.sql(RAW_SQL[name], **used)
            # The weekly totals feed several raw tables, the squads two entities.
            self.sources[name] = written(df, name) if name in ("week_goals", "week_lines", "raw_players_clean") else df
        return self.sources[name]

    @cached_property
    def teams(self) -> DataFrame:
        return written(staging.teams(self.raw("raw_team_data")))

    @cached_property
    def players(self) -> DataFrame:
        return written(staging.players(self.raw("raw_compiled_ids")))

    @cached_property
    def fixtures(self) -> DataFrame:
        return written(staging.fixtures(self.raw("raw_fixtures")))

    @cached_property
    def team_season_info(self) -> DataFrame:
        return written(staging.team_season_info(self.teams, self.raw("raw_team_data")))

    @cached_property
    def fpl_player(self) -> DataFrame:
        return written(staging.fpl_player(self.players, self.raw("raw_players_clean")))

    @cached_property
    def plays(self) -> DataFrame:
        return written(staging.plays(self.raw("raw_players_clean"), self.team_season_info, self.fixtures, self.players))

    @cached_property
    def fpl_performance(self) -> DataFrame:
        return staging.fpl_performance(
            self.raw("raw_fpl_performance"), self.teams, self.team_season_info, self.fixtures, self.players, self.fpl_player
        )

    def _event_side(self, fixtures: DataFrame, **options) -> DataFrame:
        return staging.real_performance(
            self.raw("raw_real_perf"), self.raw("raw_compiled_ids"), self.players, self.plays, self.team_season_info, fixtures, **options
        )

    @cached_property
    def event_side(self) -> DataFrame:
        """Rows dealt by player, for plans that read them once."""
        return self._event_side(self.fixtures)

    @cached_property
    def results(self) -> DataFrame:
        """The columns of the event side that reports use."""
        return self._event_side(self.fixtures, columns=["player_id", "fix_id", "goals", "assists"])

    @cached_property
    def team_pre(self) -> DataFrame:
        return marts.team_pre_match(self.fixtures, self.team_season_info)

    def player_pre(self, **options) -> DataFrame:
        return marts.player_pre_match(self.event_side, self.players, self.fixtures, self.plays, self.team_season_info, **options)

    def player_next(self, **options) -> DataFrame:
        # The season's fixtures alone, as the plan takes: other seasons' rows are left out before they are dealt.
        side = self._event_side(self.fixtures.where(F.col("season") == SEASON))
        return marts.player_next_match(
            side, self.players, self.fixtures, self.plays, self.team_season_info, SEASON, **options
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Predictions beside every performance, some below zero."""
        return self.results.select(
            "player_id",
            F.col("fix_id").alias("fixture_id"),
            (F.col("goals") * 0.5 + F.col("player_id") % 5 * 0.25 - 0.5).alias("predicted_goals"),
            (F.col("assists") * 0.5 - F.col("player_id") % 3 * 0.25).alias("predicted_assists"),
        )


def _of_raw(columns: str) -> str:
    """The columns, taken from the table aliased r."""
    return ", ".join(f"r.{column.strip()}" for column in columns.split(","))


# The oracle's own statement of the entities, from the raw tables on.
ENTITY_SQL = {
    "teams": """
        SELECT ROW_NUMBER() OVER (ORDER BY team_name) AS team_id, * FROM (
            SELECT DISTINCT name AS team_name, short_name AS team_short_name, fbref_id AS team_fbref_id FROM raw_team_data)""",
    "players": """
        SELECT ROW_NUMBER() OVER (ORDER BY player_f_name, player_l_name) AS player_id, * FROM (
            SELECT DISTINCT fpl_f_name AS player_f_name, fpl_l_name AS player_l_name, id_fbref AS fbref_id FROM raw_compiled_ids)""",
    "fixtures": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY season, event, team_h, team_a) AS fix_id, {_of_raw(season_names.FIXTURE_SQL)} FROM raw_fixtures r""",
    "team_season_info": f"""
        SELECT team_id, {_of_raw(season_names.TEAM_SEASON_SQL)}
        FROM teams, raw_team_data r WHERE r.name = team_name""",
    "fpl_player": """
        SELECT ROW_NUMBER() OVER (ORDER BY player_id, position, season) AS fpl_player_id, * FROM (
            SELECT player_id, element_type AS position, season FROM raw_players_clean, players
            WHERE first_name = player_f_name AND second_name = player_l_name)""",
    "sides": """
        SELECT f.*, home_id AS own_id, away_id AS other_id, 'home' AS location, home_goals AS scored, away_goals AS conceded FROM fixtures f
        UNION ALL SELECT f.*, away_id, home_id, 'away', away_goals, home_goals FROM fixtures f""",
    "plays": """
        SELECT player_id, team_id, MIN(game_date) AS start_date,
               NULLIF(MAX(game_date), CASE WHEN MAX(game_date) >= (SELECT MAX(game_date) FROM fixtures) THEN MAX(game_date) END) AS end_date
        FROM raw_players_clean r JOIN players ON player_f_name = first_name AND player_l_name = second_name
        JOIN team_season_info i ON i.season = r.season AND i.fpl_season_id = r.team
        JOIN sides s ON s.season = r.season AND s.own_id = r.team GROUP BY player_id, team_id""",
    "fpl_performance": f"""
        SELECT DISTINCT fpl_player_id, fix_id, r.value / 10 AS price, {_of_raw(season_names.GAME_SIDE_SQL)}
        FROM raw_fpl_performance r JOIN teams ON team_name = r.team JOIN team_season_info i ON i.team_id = teams.team_id AND i.season = r.season
        JOIN sides s ON CAST(s.game_date AS DATE) = CAST(r.kickoff_time AS DATE) AND s.own_id = i.fpl_season_id
        JOIN players ON player_f_name = split_part(r.name, ' ', 1) AND player_l_name = split_part(r.name, ' ', 2)
        JOIN fpl_player fp ON fp.player_id = players.player_id AND fp.season = r.season""",
    "real_performance": f"""
        SELECT DISTINCT players.player_id, fix_id, {_of_raw(season_names.EVENT_SIDE_SQL)},
               CASE WHEN Performance_CS = 1 THEN 1 ELSE 0 END AS clean_sheets
        FROM raw_real_perf r JOIN raw_compiled_ids c ON c.fbref_name = r.Name
        JOIN players ON player_f_name = c.fpl_f_name AND player_l_name = c.fpl_l_name
        JOIN plays ON plays.player_id = players.player_id AND CAST(r.Date AS TIMESTAMP) >= start_date
             AND (end_date IS NULL OR CAST(r.Date AS TIMESTAMP) <= end_date)
        JOIN team_season_info i ON i.team_id = plays.team_id AND i.season = r.Season
        JOIN sides s ON s.season = r.Season AND s.game_week = CAST(split_part(r.Round, ' ', 2) AS INTEGER) AND s.own_id = i.fpl_season_id""",
    "team_goals": """
        SELECT i.team_id, s.fix_id, s.season, s.game_week, s.location, s.scored, s.conceded
        FROM sides s JOIN team_season_info i ON i.season = s.season AND i.fpl_season_id = s.own_id""",
    "outfield": """
        SELECT rp.*, f.game_week, f.season, f.home_id, f.away_id, pl.team_id, player_f_name || ' ' || player_l_name AS player_name
        FROM real_performance rp JOIN fixtures f ON f.fix_id = rp.fix_id JOIN players p ON p.player_id = rp.player_id
        JOIN plays pl ON pl.player_id = rp.player_id AND f.game_date >= start_date AND (end_date IS NULL OR f.game_date <= end_date)
        WHERE rp.position <> 'GK'""",
    "last_week": f"SELECT MAX(game_week) AS week FROM fixtures WHERE finished AND season = '{SEASON}'",
    "predictions": """
        SELECT player_id, fix_id AS fixture_id, goals * 0.5 + player_id % 5 * 0.25 - 0.5 AS predicted_goals,
               assists * 0.5 - player_id % 3 * 0.25 AS predicted_assists FROM real_performance""",
}


def with_entities(sql: str) -> str:
    """The query after all raw tables and entities it could need."""
    names = {name: name for name in [*BASE_TABLES, *RAW_SQL]}
    parts = [f"{name} AS ({text.format(**names)})" for name, text in RAW_SQL.items()]
    parts += [f"{name} AS ({text})" for name, text in ENTITY_SQL.items()]
    return f"WITH {', '.join(parts)} {sql}"


def rounded(df: DataFrame, names: list[str]) -> DataFrame:
    """Six digits, by the same arithmetic as in the oracle."""
    return df.withColumns({c: F.floor(F.col(c).cast("double") * 1e6 + 0.5) / 1e6 for c in names})


def _frame_sql(rows: int | None, current: bool = False) -> str:
    start = "UNBOUNDED" if rows is None else str(rows)
    return f"ROWS BETWEEN {start} PRECEDING AND {'CURRENT ROW' if current else '1 PRECEDING'}"


def _rolled_sql(current: bool, cut: int) -> str:
    window = "PARTITION BY player_id, season ORDER BY game_week, fix_id, team_id"
    return ", ".join(
        f"SUM({c}) OVER ({window} {_frame_sql(None if n is None else n - cut, current)}) AS rolling_{frame}_{label}"
        for frame, n in FRAMES.items()
        for c, label in STATS.items()
    )


def _formula_sql() -> tuple[str, str]:
    """Two layers: ratios and contributions, then what builds on contributions."""
    first, second = [], []
    for suffix, (frame, coalesce) in FORMULA_FRAMES.items():
        at = f"rolling_{frame}_"

        def value(name: str) -> str:
            return f"COALESCE({name}, 0)" if coalesce else name

        for name, (num, den) in RATIOS.items():
            first.append(f"CASE WHEN {value(at + den)} > 0 THEN {value(at + num)} / CAST({value(at + den)} AS DOUBLE) ELSE 0 END AS {name}_{suffix}")
        for name, (a, b) in CONTRIBUTIONS.items():
            first.append(f"COALESCE({at}{a}, 0) + COALESCE({at}{b}, 0) AS {name}_{suffix}")
        for name, (num, den) in CONTRIBUTION_RATIOS.items():
            second.append(f"CASE WHEN {den}_{suffix} > 0 THEN {num}_{suffix} / CAST({den}_{suffix} AS DOUBLE) ELSE 0 END AS {name}_{suffix}")
        for name, label in RATES.items():
            source = f"{label}_{suffix}" if label in CONTRIBUTIONS else at + label
            second.append(
                f"CASE WHEN COALESCE({at}minutes, 0) > 0 THEN COALESCE({source}, 0) / (CAST({at}minutes AS DOUBLE) / 90) ELSE 0 END AS {name}_per_90_{suffix}"
            )
    return ", ".join(first), ", ".join(second)


def _round_sql(names: list[str]) -> str:
    return ", ".join(f"FLOOR(CAST({c} AS DOUBLE) * 1e6 + 0.5) / 1e6 AS {c}" for c in names)


FEATURE_NAMES = [*ROLLED, *FORMULAS]
PLAIN_IDS = ["player_name", "player_id", "fix_id", "game_week", "season", "team_id"]
STRENGTH_SQL = """
    CASE WHEN {f}.home_id = own.fpl_season_id THEN 1 ELSE 0 END AS home_or_away, other.fpl_season_id AS opponent_team_id,
    own.home_attack_score + own.home_defence_score AS team_strength, other.away_attack_score + other.away_defence_score AS opponent_strength
"""
OTHER_SQL = "JOIN team_season_info other ON other.season = {f}.season AND other.fpl_season_id = CASE WHEN {f}.home_id = own.fpl_season_id THEN {f}.away_id ELSE {f}.home_id END"
FIRST_LAYER, SECOND_LAYER = _formula_sql()

PLAYER_FORM_SQL = f"""
    SELECT *, {SECOND_LAYER} FROM (SELECT *, {FIRST_LAYER} FROM (
        SELECT o.*, {STRENGTH_SQL.format(f="o")}, {_rolled_sql(False, 0).replace("player_id,", "o.player_id,").replace(", season ORDER", ", o.season ORDER").replace("team_id ROWS", "o.team_id ROWS")}
        FROM outfield o JOIN team_season_info own ON own.team_id = o.team_id AND own.season = o.season {OTHER_SQL.format(f="o")})
    WHERE rolling_ub_minutes >= 90)
"""


def _next_form_sql(cut: int, latest: bool = False) -> str:
    form = f"SELECT player_name, player_id, fix_id, season, team_id, game_week, {_rolled_sql(True, cut)} FROM outfield WHERE season = '{SEASON}'"
    if latest:
        form = f"""
            SELECT * REPLACE ((SELECT week FROM last_week) AS game_week) FROM ({form}) WHERE game_week <= (SELECT week FROM last_week)
            QUALIFY ROW_NUMBER() OVER (PARTITION BY player_id, season ORDER BY game_week DESC, fix_id DESC, team_id DESC) = 1"""
    return f"""
        SELECT *, {SECOND_LAYER} FROM (SELECT *, {FIRST_LAYER} FROM (
            SELECT form.* EXCLUDE (fix_id, game_week), n.fix_id, n.game_week, {STRENGTH_SQL.format(f="n")}
            FROM ({form}) form
            JOIN (SELECT s.*, i.team_id FROM sides s JOIN team_season_info i ON i.season = s.season AND i.fpl_season_id = s.own_id
                  WHERE s.season = '{SEASON}' AND s.game_week = (SELECT week + 1 FROM last_week)) n
              ON n.team_id = form.team_id AND form.game_week + 1 = n.game_week
            JOIN plays pl ON pl.player_id = form.player_id AND n.game_date >= pl.start_date AND (pl.end_date IS NULL OR n.game_date <= pl.end_date)
            JOIN team_season_info own ON own.team_id = pl.team_id AND own.season = n.season {OTHER_SQL.format(f="n")}))
    """


TEAM_FORM_SQL = ", ".join(
    f"SUM({c}) OVER (PARTITION BY team_id, season ORDER BY game_week, fix_id {_frame_sql(n)}) AS rolling_goals_{c}_{frame}"
    for frame, n in TEAM_FRAMES.items()
    for c in ("scored", "conceded")
)


@query(with_entities("SELECT * FROM teams"))
def staged_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).teams


@query(with_entities("SELECT * FROM players"))
def staged_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).players


@query(with_entities("SELECT * FROM fixtures"))
def staged_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).fixtures


@query(with_entities("SELECT * FROM team_season_info"))
def staged_team_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).team_season_info


@query(with_entities("SELECT * FROM fpl_player"))
def staged_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).fpl_player


@query(with_entities("SELECT * FROM plays"))
def staged_tenures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).plays


@query(with_entities("SELECT * FROM fpl_performance"))
def staged_game_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).fpl_performance


@query(with_entities("SELECT * FROM real_performance"))
def staged_event_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).event_side


@query(
    with_entities(
        """
        SELECT fix_id, f.season, finished, h.team_name AS home_team_name, a.team_name AS away_team_name, home_goals, away_goals,
               home_team_difficulty, away_team_difficulty, game_date
        FROM fixtures f JOIN team_season_info hi ON hi.season = f.season AND hi.fpl_season_id = home_id JOIN teams h ON h.team_id = hi.team_id
        JOIN team_season_info ai ON ai.season = f.season AND ai.fpl_season_id = away_id JOIN teams a ON a.team_id = ai.team_id
        """
    )
)
def fixture_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    return marts.fixture_names(season.fixtures, season.team_season_info, season.teams)


@query(with_entities(f"SELECT team_id, fix_id, season, game_week, location AS match_location, {TEAM_FORM_SQL} FROM team_goals"))
def team_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Season(spark, sf_dir).team_pre


TEAM_NEXT_SQL = f"""
    SELECT * FROM (SELECT team_id, fix_id, season, game_week, location AS match_location, {TEAM_FORM_SQL} FROM team_goals WHERE season = '{SEASON}')
    WHERE game_week = (SELECT week + 1 FROM last_week)
"""


@query(with_entities(TEAM_NEXT_SQL))
def team_next_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    return marts.team_next_match(season.fixtures, season.team_season_info, SEASON)


@query(
    with_entities(
        f"SELECT {', '.join(PLAIN_IDS)}, home_or_away, opponent_team_id, team_strength, opponent_strength, {_round_sql(FEATURE_NAMES)} FROM ({PLAYER_FORM_SQL})"
    )
)
def player_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Season(spark, sf_dir).player_pre(), FEATURE_NAMES)


@query(
    with_entities(
        f"SELECT {', '.join(PLAIN_IDS)}, home_or_away, opponent_team_id, team_strength, opponent_strength, {_round_sql(FEATURE_NAMES)} FROM ({_next_form_sql(1)})"
    )
)
def player_next_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Season(spark, sf_dir).player_next(), FEATURE_NAMES)


@query(
    with_entities(f"SELECT player_id, fix_id, {_round_sql(ROLLED)} FROM ({_next_form_sql(0)})")
)
def player_next_form_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames one row longer than named; the opponent by season id as everywhere else."""
    rows = Season(spark, sf_dir).player_next(literal_frames=True)
    return rounded(rows.select("player_id", "fix_id", *ROLLED), ROLLED)


@query(
    with_entities(f"SELECT player_id, fix_id, game_week, team_id, {_round_sql(ROLLED)} FROM ({_next_form_sql(1, latest=True)})")
)
def player_next_form_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players absent from the last finished week come with their latest row before it."""
    rows = Season(spark, sf_dir).player_next(latest_row=True)
    return rounded(rows.select("player_id", "fix_id", "game_week", "team_id", *ROLLED), ROLLED)


SURROGATE_SQL = PLAYER_FORM_SQL.replace("other.fpl_season_id", "other.team_id")


@query(
    with_entities(f"SELECT player_id, fix_id, team_id, home_or_away, opponent_team_id, team_strength, opponent_strength FROM ({SURROGATE_SQL})")
)
def player_form_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opponent's strength found by comparing its season id with the surrogate key."""
    rows = Season(spark, sf_dir).player_pre(compat=True)
    return rows.select("player_id", "fix_id", "team_id", "home_or_away", "opponent_team_id", "team_strength", "opponent_strength")


@query(
    with_entities(
        f"""
        SELECT f.* FROM ({TEAM_NEXT_SQL}) f
        JOIN (SELECT i.team_id FROM sides s JOIN team_season_info i ON i.season = s.season AND i.fpl_season_id = s.own_id
              WHERE s.season = '{SEASON}' AND s.game_week = (SELECT week + 1 FROM last_week)) n ON n.team_id = f.team_id
        """
    )
)
def team_next_form_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A team's rows once per fixture of its next week, as a join by team alone gives them."""
    season = Season(spark, sf_dir)
    return marts.team_next_match(season.fixtures, season.team_season_info, SEASON, compat=True)


MATRIX_NAMES = [*FEATURE_NAMES, *TEAM_ROLLED]


@query(
    with_entities(
        f"""
        SELECT goals AS label_goals, assists AS label_assists, player_id, fix_id, game_week, season, team_strength, opponent_strength,
               {_round_sql(MATRIX_NAMES)}
        FROM ({PLAYER_FORM_SQL}) JOIN (SELECT team_id, fix_id, {TEAM_FORM_SQL} FROM team_goals) USING (team_id, fix_id)
        WHERE rolling_ub_minutes >= 60
        """
    )
)
def training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    return rounded(marts.modeling_matrix(season.player_pre(labels=True), None, season.team_pre), MATRIX_NAMES)


@query(
    with_entities(
        f"""
        SELECT DISTINCT player_id, fix_id, game_week, season, team_strength, opponent_strength, {_round_sql(MATRIX_NAMES)}
        FROM ({_next_form_sql(1)}) JOIN (SELECT * EXCLUDE (season, game_week, match_location) FROM ({TEAM_NEXT_SQL})) USING (team_id, fix_id)
        WHERE rolling_ub_minutes >= 60
        """
    )
)
def next_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    team_next = marts.team_next_match(season.fixtures, season.team_season_info, SEASON)
    return rounded(marts.scoring_matrix(season.player_next(), team_next), MATRIX_NAMES)


PAIRS_SQL = """
    SELECT player_f_name || ' ' || player_l_name AS player_name, f.game_week, f.season, rp.goals, predicted_goals, rp.assists, predicted_assists,
           rp.player_id, f.fix_id
    FROM predictions g JOIN real_performance rp ON rp.player_id = g.player_id AND rp.fix_id = g.fixture_id
    JOIN fixtures f ON f.fix_id = g.fixture_id JOIN players p ON p.player_id = g.player_id
"""


@query(with_entities(f"SELECT * EXCLUDE (player_id, fix_id) REPLACE (ROUND(CAST(predicted_goals AS DOUBLE), 4) AS predicted_goals, ROUND(CAST(predicted_assists AS DOUBLE), 4) AS predicted_assists) FROM ({PAIRS_SQL})"))
def prediction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    pairs = reports.prediction_analysis(season.predictions, season.players, season.fixtures, season.results)
    return pairs.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("predicted_goals", "predicted_assists")})


@query(
    with_entities(
        f"""
        SELECT player_name, position, game_week, season, points, ROUND(CAST(predicted_points AS DOUBLE), 4) AS predicted_points, predicted_rank, actual_rank,
               CASE WHEN actual_rank <= 10 AND predicted_rank <= 10 THEN 'Correctly Predicted' WHEN predicted_rank <= 10 THEN 'False Positive'
                    WHEN actual_rank <= 10 THEN 'Missed Prediction' ELSE 'Correctly Excluded' END AS prediction_accuracy
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY position, game_week, season ORDER BY predicted_points DESC NULLS LAST, player_id, fix_id) AS predicted_rank,
                     ROW_NUMBER() OVER (PARTITION BY position, game_week, season ORDER BY points DESC NULLS LAST, player_id, fix_id) AS actual_rank
              FROM (SELECT x.*, position, goals * w + CASE WHEN w > 0 THEN 3 * assists END AS points,
                           GREATEST(predicted_goals, 0) * w + CASE WHEN w > 0 THEN 3 * GREATEST(predicted_assists, 0) END AS predicted_points
                    FROM ({PAIRS_SQL}) x JOIN (SELECT player_id AS pid, season AS ps, position,
                        CASE position WHEN 'FWD' THEN 4 WHEN 'MID' THEN 5 WHEN 'DEF' THEN 6 END AS w FROM fpl_player) ON pid = player_id AND ps = season))
        """
    )
)
def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = Season(spark, sf_dir)
    report = reports.prediction_accuracy(
        season.predictions, season.players, season.fixtures, season.results, season.fpl_player
    )
    return report.withColumn("predicted_points", F.round(F.col("predicted_points").cast("double"), 4))
