"""Pages, JSON texts, files and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.names import url_path, url_segment
from touchline.plans.cleanup import clean_history, clean_players, id_list, week_history
from touchline.plans.identity import page_id_list
from touchline.queries.registry import query, table
from touchline.session import scratch_path
from touchline.sources.files import (
    publish,
    read_csv_table,
    read_histories,
    read_periods,
    read_season_files,
    replace_table,
    save_id_map,
    typed,
    write_csv,
    write_json,
)
from touchline.sources.schemas import CLEAN_PLAYER_COLUMNS
from touchline.sources.pages import competition_rows, page_links, page_tables
from touchline.sources.payload import current_period, flatten, json_field, read_payload
from touchline.sources.predictions import append_predictions


# Pages that a task makes and parses.
PAGES_PER_TASK = 5_000


@query(
    r"""
    SELECT page_id, unnest(regexp_extract_all(html, '<a\s(?:[^>]*?\s)?href="([^"]*)"', 1)) AS href FROM pages
    """
)
def page_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages")).select("page_id", "href")


@query(
    r"""
    SELECT page_id, href FROM (
        SELECT page_id, unnest(regexp_extract_all(html, '<a\s(?:[^>]*?\s)?href="([^"]*)"', 1)) AS href FROM pages)
    WHERE contains(href, '/th')
    """
)
def page_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"), "/th").select("page_id", "href")


@query(
    r"""
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
           string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[2] AS lang,
           string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[3] AS item,
           string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[4] AS rest
    FROM pages
    """
)
def url_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        url_path(url).alias("path"),
        url_segment(url, 1).alias("lang"),
        url_segment(url, 2).alias("item"),
        url_segment(url, 3).alias("rest"),
    )


@query("SELECT DISTINCT replace(s_name, '#', ' ') AS name, 'k' || s_suppkey AS id FROM supplier")
def page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier pages with a link to the supplier, twice, and links that are not people."""
    suppliers = table(spark, sf_dir, "supplier")
    link = F.concat(
        F.lit('<a href="/en/players/k'), F.col("s_suppkey"), F.lit("/"), F.replace("s_name", F.lit("#"), F.lit("-")), F.lit('">x</a>')
    )
    pages = suppliers.select(
        F.col("s_suppkey").alias("page_id"),
        F.concat(
            F.lit("<html><body>"), link, F.lit('<a class="all" href="/en/players/">all</a>'), link,
            F.lit("<a href='/en/squads/k/x'>squad</a></body></html>"),
        ).alias("html"),
    )
    return page_id_list(pages)


@query(
    """
    SELECT o_orderkey AS page_id, 0 AS row, 'Premier League' AS Comp, 'Matchweek ' || CAST(MONTH(o_orderdate) AS VARCHAR) AS Round,
           CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) AS Performance_Gls, o_orderstatus AS Expected_xG,
           'customer ' || CAST(o_custkey AS VARCHAR) AS name
    FROM orders
    UNION ALL
    SELECT o_orderkey, 1, 'Premier League', 'Matchweek 99', '0', o_orderstatus, 'customer ' || CAST(o_custkey AS VARCHAR)
    FROM orders
    """
)
def page_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a stored page with a two-level table of two league rows, with cells that span both, and a cup row."""

    def cells(tag: str, *values) -> list:
        return [F.concat(F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")) for v in values]

    def row(tag: str, *values):
        return F.concat(F.lit("<tr>"), *cells(tag, *values), F.lit("</tr>"))

    week = F.concat(F.lit("Matchweek "), F.month("o_orderdate"))
    price = F.floor("o_totalprice").cast("string")
    # Spread the narrow rows before they become pages: parsing is the costly part.
    orders = table(spark, sf_dir, "orders")
    orders = orders.repartition(-(-orders.count() // PAGES_PER_TASK) or 1, "o_orderkey")
    html = F.concat(
        F.lit("<html><body><table id='other'><tr><th>Comp</th></tr><tr><td>none</td></tr></table>"),
        F.lit("<table class='stats' id='matchlogs_all'><thead><tr><th></th><th></th><th>Performance</th><th>Expected</th></tr>"),
        row("th", F.lit("Comp"), F.lit("Round"), F.lit("Gls"), F.lit("xG")),
        F.lit("</thead><tbody>"),
        F.lit("<tr><td rowspan='2'>Premier <b>League</b></td><td>"), week, F.lit("</td><td>"), price,
        F.lit("</td><td rowspan=2>"), F.col("o_orderstatus"), F.lit("</td></tr>"),
        F.lit("<tr><td>Matchweek 99</td><td>0</td></tr>"),
        row("td", F.lit("Cup &amp; Shield"), F.lit("Final"), F.lit(""), F.lit("")),
        F.lit("</tbody></table></body></html>"),
    )
    pages = orders.select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("customer "), "o_custkey").alias("person"), html.alias("html"))
    rows = page_tables(pages, "matchlogs_all", ["Comp", "Round", "Performance_Gls", "Expected_xG"], keep=("page_id", "person"))
    return competition_rows(rows, "Premier League", F.col("person")).drop("person")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS none FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", json_field(props, "$.k", "int").alias("k"), json_field(props, "$.none").alias("none")
    )


PAYLOAD_SCHEMA = (
    "source long, elements array<struct<id: long, price: double, place: int>>, "
    "events array<struct<id: int, is_current: boolean>>"
)


@query(
    """
    SELECT c_custkey // 500 AS source, CAST(c_custkey // 500 % 3 AS INTEGER) AS current, c_custkey AS id, c_acctbal AS price,
           CAST(c_custkey % 7 AS INTEGER) AS place
    FROM customer
    """
)
def payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload file per 500 customers, all of them in one nested array, read back from the files."""
    folder = scratch_path(spark, "payloads")
    element = F.struct(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("price"), (F.col("c_custkey") % 7).cast("int").alias("place"))
    events = F.array(*[F.struct(F.lit(i).alias("id"), (F.col("source") % 3 == i).alias("is_current")) for i in (1, 2)])
    number = F.floor(F.col("c_custkey") / 500).alias("source")
    lists = table(spark, sf_dir, "customer").groupBy(number).agg(F.collect_list(element).alias("elements"))
    text = F.to_json(F.struct("source", "elements", events.alias("events")), {"pretty": "true"})
    lists.select("source", text.alias("value")).write.partitionBy("source").text(folder)
    payload = read_payload(spark, f"{folder}/*/*", PAYLOAD_SCHEMA)
    return flatten(payload.withColumn("current", current_period(F.col("events"))), "elements", ("source", "current"))


@query(
    """
    SELECT source, current, id, price, place FROM (
        SELECT o_orderkey AS source, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS current,
               o_custkey AS id, o_totalprice AS price, 1 AS place FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END,
               o_orderkey, o_totalprice * 2, 2 FROM orders)
    """
)
def nested_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON payloads, read back nested, one row per element beside the current period."""
    status = F.col("o_orderstatus")
    element = "struct<id: long, price: double, place: int>"
    first = F.struct(F.col("o_custkey"), F.col("o_totalprice"), F.lit(1)).cast(element)
    second = F.struct(F.col("o_orderkey"), F.col("o_totalprice") * 2, F.lit(2)).cast(element)
    events = [
        F.struct(F.lit(i).alias("id"), (status == code).alias("is_current")) for i, code in ((1, "F"), (2, "O"))
    ]
    text = F.to_json(
        F.struct(F.col("o_orderkey").alias("source"), F.array(first, second).alias("elements"), F.array(*events).alias("events"))
    )
    payload = table(spark, sf_dir, "orders").select(F.from_json(text, PAYLOAD_SCHEMA).alias("p")).select("p.*")
    with_current = payload.withColumn("current", current_period(F.col("events")))
    return flatten(with_current, "elements", ("source", "current"))


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(YEAR(o_orderdate) AS INTEGER) AS season
    FROM orders
    """
)
def file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season folders of CSV written and loaded back by position with fixed types, kept as a table."""
    path = scratch_path(spark, "seasons")
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    write_csv(orders, path, columns, ["season"])
    loaded = read_csv_table(spark, path, "key long, customer long, status string, price double")
    frame = loaded.select(*[F.col(a).alias(b) for a, b in zip(loaded.columns, [*columns, "season"])])
    return publish(frame, "loaded_orders", table=False)


@query("SELECT o_orderkey, o_custkey, CAST(MONTH(o_orderdate) AS INTEGER) AS GW FROM orders WHERE MONTH(o_orderdate) BETWEEN 2 AND 11")
def period_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "periods")
    orders = table(spark, sf_dir, "orders").withColumn("week", F.concat(F.lit("gw_"), F.month("o_orderdate")))
    write_csv(orders, path, ["o_orderkey", "o_custkey"], ["week"])
    merged, _ = read_periods(spark, f"{path}/*", "o_orderkey long, o_custkey long", 2, 11)
    return merged


@query("SELECT CAST(week AS INTEGER) AS GW FROM range(1, 39) t(week) WHERE week NOT IN (SELECT DISTINCT MONTH(o_orderdate) FROM orders)")
def missing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "periods")
    orders = table(spark, sf_dir, "orders").withColumn("week", F.concat(F.lit("gw_"), F.month("o_orderdate")))
    write_csv(orders, path, ["o_orderkey", "o_custkey"], ["week"])
    _, missing = read_periods(spark, f"{path}/*", "o_orderkey long, o_custkey long", 1, 38)
    return missing


@query(
    """
    SELECT c_name AS name, CASE c_nationkey % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'DEF' WHEN 2 THEN 'MID' ELSE 'FWD' END AS position,
           CASE WHEN o_orderstatus = 'F' THEN n.n_name ELSE r.n_name END AS team, c_nationkey AS element, o_orderkey AS fixture,
           o_orderstatus = 'F' AS was_home, o_totalprice AS price
    FROM (SELECT orders.*, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) o
    JOIN (SELECT c_nationkey AS k, MIN(c_name) AS c_name FROM customer GROUP BY 1) c ON c.k = o.c_nationkey
    JOIN nation n ON n.n_nationkey = o.c_nationkey JOIN nation r ON r.n_nationkey = 24 - o.c_nationkey
    """
)
def entity_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one history folder per nation, read back with the id from the folder name, names and teams added."""
    path = scratch_path(spark, "players")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.select(
        F.col("o_orderkey").alias("fixture"),
        (F.col("o_orderstatus") == "F").alias("was_home"),
        F.col("o_totalprice").alias("price"),
        F.concat(F.lit("nation_"), "c_nationkey").alias("player"),
    )
    write_csv(rows, path, ["fixture", "was_home", "price"], ["player"])
    histories = read_histories(spark, f"{path}/*", "fixture long, was_home boolean, price double")
    people = customers.groupBy(F.col("c_nationkey").alias("id")).agg(F.min("c_name").alias("full")).select(
        "id", F.lit("").alias("first_name"), F.col("full").alias("second_name"), (F.col("id") % 4 + 1).alias("element_type")
    )
    fixtures = orders.select(
        F.col("o_orderkey").alias("id"), F.col("c_nationkey").alias("team_h"), (F.lit(24) - F.col("c_nationkey")).alias("team_a")
    )
    teams = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return week_history(histories, people, fixtures, teams).withColumn("name", F.ltrim("name"))


LOADS_SQL = """
    WITH loads AS (SELECT *, CASE WHEN s_acctbal < 3000 THEN 0 WHEN s_acctbal < 6000 THEN 1 ELSE 2 END AS load FROM supplier)
    SELECT load * 4294967296 + ROW_NUMBER() OVER (PARTITION BY load ORDER BY s_suppkey, s_nationkey) AS prediction_id, load,
           s_nationkey AS player_id, s_suppkey AS fixture_id, s_acctbal AS predicted_goals, s_acctbal / 2 AS predicted_assists
    FROM loads
"""


def _loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("player_id"),
        F.col("s_suppkey").alias("fixture_id"),
        F.col("s_acctbal").alias("predicted_goals"),
        (F.col("s_acctbal") / 2).alias("predicted_assists"),
    )
    goals = F.col("predicted_goals")
    return [rows.where(goals < 3000), rows.where((goals >= 3000) & (goals < 6000)), rows.where(goals >= 6000)]


@query(LOADS_SQL)
def append_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    for number, load in enumerate(_loads(spark, sf_dir)):
        grown = append_predictions(load, path, number)
    return grown.drop("prediction_timestamp")


@query(LOADS_SQL)
def repeated_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that arrive out of order, one of them first with wrong rows, and two of them twice."""
    path = scratch_path(spark, "predictions")
    first, second, third = _loads(spark, sf_dir)
    append_predictions(third, path, 2)
    append_predictions(first.unionByName(third), path, 0)
    append_predictions(second, path, 1)
    for number, load in ((0, first), (1, second)):
        grown = append_predictions(load, path, number)
    return grown.drop("prediction_timestamp")


@query("SELECT 'Customer ' || c_custkey AS full_name_full FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def unmatched_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names without a match written as JSON and read back."""
    path = scratch_path(spark, "missing")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    missing = customers.join(orders, "c_custkey", "left_anti")
    write_json(missing.select(F.concat(F.lit("Customer "), "c_custkey").alias("full_name_full")), path)
    return spark.read.schema("full_name_full string").json(path)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS INTEGER) AS o_totalprice, o_orderstatus AS status FROM orders")
def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.StringType()),
            T.StructField("o_totalprice", T.IntegerType()),
            T.StructField("status", T.StringType()),
        ]
    )
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status")
    rounded = orders.withColumn("o_totalprice", F.bround("o_totalprice", 0))
    return typed(rounded, schema)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def season_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per season folder, loaded by its name's pattern from below the root with fixed types."""
    root = scratch_path(spark, "season-files")
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("season_"), F.col("c_nationkey")).alias("season"), "c_custkey", "c_name", "c_acctbal"
    )
    write_csv(customers, root, ["c_custkey", "c_name", "c_acctbal"], ["season"])
    return read_season_files(spark, root, "part-*.csv", "c_custkey long, c_name string, c_acctbal double")


@query("SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_acctbal AS price FROM supplier WHERE s_acctbal > 0")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of fixed types, created and then replaced."""
    name = f"touchline_{uuid.uuid4().hex}"
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast("string").alias("price"), F.col("s_name").alias("name")
    )
    schema = T.StructType.fromDDL("id int, name string, price double")
    replace_table(suppliers, name, schema)
    replace_table(suppliers.where("cast(price as double) > 0"), name, schema)
    return spark.table(name)


@query("SELECT s_nationkey AS nation, CAST(SUM(CAST(s_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS price FROM supplier GROUP BY 1")
def self_replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by rows computed from itself."""
    name = f"touchline_{uuid.uuid4().hex}"
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").cast("decimal(18,2)").alias("price")
    )
    replace_table(suppliers, name)
    totals = spark.table(name).groupBy("nation").agg(F.sum("price").alias("price"))
    replace_table(totals, name, T.StructType.fromDDL("nation long, price double"))
    return spark.table(name)


@query("SELECT n_nationkey, n_name FROM nation")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return publish(nations, f"touchline_{uuid.uuid4().hex}", table=True)


@query(
    """
    SELECT 'found' AS kind, c_name AS name, CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'missing', c_name, NULL FROM customer WHERE c_acctbal <= 0
    """
)
def id_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People with an id as CSV and names without one as JSON, both read back."""
    path = scratch_path(spark, "id-map")
    customers = table(spark, sf_dir, "customer")
    found = customers.where("c_acctbal > 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    missing = customers.where("c_acctbal <= 0").select(F.col("c_name").alias("full_name_full"))
    save_id_map(found, missing, path)
    back = read_csv_table(spark, f"{path}/player_compiled_ids.csv", "name string, id string")
    names = spark.read.schema("full_name_full string").json(f"{path}/missing_fbref_ids.json")
    none = names.select(F.lit("missing").alias("kind"), F.col("full_name_full").alias("name"), F.lit(None).cast("string").alias("id"))
    return back.select(F.lit("found").alias("kind"), "name", "id").unionByName(none)


def _raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as raw players: one number in every column, positions as codes."""
    suppliers = table(spark, sf_dir, "supplier")
    number = {c: F.col("s_suppkey") for c in CLEAN_PLAYER_COLUMNS}
    names = {"first_name": F.col("s_name"), "second_name": F.lower("s_name"), "element_type": (F.col("s_nationkey") % 4 + 1).cast("string")}
    columns = number | names | {"id": F.col("s_suppkey"), "code": F.col("s_nationkey")}
    return suppliers.select(*[v.alias(c) for c, v in columns.items()])


@query(
    """
    SELECT s_name AS first_name, lower(s_name) AS second_name, s_suppkey AS goals_scored, s_suppkey AS assists,
           s_suppkey AS total_points, s_suppkey AS minutes, s_suppkey AS goals_conceded, s_suppkey AS creativity,
           s_suppkey AS influence, s_suppkey AS threat, s_suppkey AS bonus, s_suppkey AS bps, s_suppkey AS ict_index,
           s_suppkey AS clean_sheets, s_suppkey AS red_cards, s_suppkey AS yellow_cards, s_suppkey AS selected_by_percent,
           s_suppkey AS now_cost, CASE s_nationkey % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'DEF' WHEN 2 THEN 'MID' ELSE 'FWD' END AS element_type,
           s_suppkey AS team
    FROM supplier
    """
)
def cleaned_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_players(_raw_players(spark, sf_dir))


@query("SELECT s_name AS first_name, lower(s_name) AS second_name, s_suppkey AS id FROM supplier")
def player_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_list(_raw_players(spark, sf_dir))


@query("SELECT event_id AS element, value AS points, '2024-25' AS season FROM events")
def cleaned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("element"), F.col("value").alias("points"), F.col("event_type").alias("modified")
    )
    return clean_history(events, "2024-25")
