"""Files, payloads, pages and prediction tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline.plans.identity import earlier_id_list, page_id_list
from touchline.session import scratch_path
from touchline.sources import files, pages, payload
from touchline.sources.predictions import append_predictions
from touchline.sources.schemas import RAW_FILES, RAW_TABLES, schema_of


def test_schemas_parse(spark):
    assert len(schema_of("raw_real_perf")) == 73 and len(schema_of("raw_team_data")) == 23
    assert set(RAW_FILES) < set(RAW_TABLES)


def test_season_files_load_by_position(spark, tmp_path):
    for season, player in (("2023-24", 1), ("2024-25", 2)):
        folder = tmp_path / season
        folder.mkdir()
        (folder / "player_compiled_ids.csv").write_text(f"a,b,c,d,e\nAnn,Lee,{player},Ann Lee,x{player}\n", encoding="utf-8")
        (folder / "other.csv").write_text("a\nno\n", encoding="utf-8")
    rows = sorted(tuple(r) for r in files.load_raw(spark, str(tmp_path), "raw_compiled_ids").collect())
    assert rows == [("Ann", "Lee", 1, "Ann Lee", "x1"), ("Ann", "Lee", 2, "Ann Lee", "x2")]


def test_csv_sink_sorts_its_header(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    files.write_csv(spark.createDataFrame([(1, 2, 3)], "b int, a int, c int"), path)
    text = next(p for p in Path(path).iterdir() if p.name.startswith("part-")).read_text()
    assert text.splitlines() == ["a,b,c", "2,1,3"]


def test_history_and_period_files(spark, tmp_path):
    for folder, week in (("Ann_Lee_7", 1), ("Ben_12", 2)):
        (tmp_path / "players" / folder).mkdir(parents=True)
        (tmp_path / "players" / folder / "gw.csv").write_text(f"round,points\n{week},{week * 10}\n")
    rows = files.read_histories(spark, f"{tmp_path}/players/*/gw.csv", "round int, points int", pattern=r"_(\d+)/gw\.csv")
    assert sorted(tuple(r) for r in rows.collect()) == [(7, 1, 10), (12, 2, 20)]
    (tmp_path / "gws").mkdir()
    for week in (1, 3, 4):
        (tmp_path / "gws" / f"gw_{week}.csv").write_text(f"points\n{week}\n")
    merged, missing = files.read_periods(spark, f"{tmp_path}/gws/gw_*.csv", "points int", 1, 3, pattern=r"gw_(\d+)\.csv")
    assert sorted((r.points, r.GW) for r in merged.collect()) == [(1, 1), (3, 3)]
    assert [r.GW for r in missing.collect()] == [2]


def test_payload(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"elements": [{"id": 1, "name": "x"}, {"id": 2, "name": null}],\n "events": [{"id": 4, "is_current": false}, {"id": 5, "is_current": true}]}'
    )
    df = payload.read_payload(
        spark, str(tmp_path / "p.json"),
        "elements array<struct<id int, name string>>, events array<struct<id int, is_current boolean>>",
    )
    assert sorted(tuple(r) for r in payload.flatten(df, "elements").collect()) == [(1, "x"), (2, None)]
    assert df.select(payload.current_period(F.col("events"))).first()[0] == 5
    none = df.select(payload.current_period(F.filter("events", lambda e: ~e["is_current"]))).first()[0]
    assert none == 0
    text = spark.createDataFrame([('{"a": "7"}',), ('{"a": "x"}',), ("broken",)], "t string")
    assert [r[0] for r in text.select(payload.json_field(F.col("t"), "$.a", "int")).collect()] == [7, None, None]


def test_links(spark):
    html = """<a class="q" href="/en/players/ab/Ann-Lee?x=1&amp;y=2">x</a><a href='/en/players/cd/Ben'>y</a><A HREF=/en/squads/1/z>z</A>
        <area href="/en/players/no/No"><a name="k">n</a><a href="">e</a><a href="/en/players/ab/Ann-Lee">x</a>"""
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    hrefs = [r.href for r in pages.page_links(df).orderBy("page_id", "position").collect()]
    assert hrefs == ["/en/players/ab/Ann-Lee?x=1&y=2", "/en/players/cd/Ben", "/en/squads/1/z", "", "/en/players/ab/Ann-Lee"]
    assert sorted(tuple(r) for r in page_id_list(df).collect()) == [("Ann Lee", "ab"), ("Ben", "cd")]


def test_tables_with_spans_and_two_headers():
    html = """<table><tr><th>Comp</th></tr><tr><td>no</td></tr></table>
    <table id="m"><caption>c</caption><thead><tr><th></th><th colspan="2">Performance</th><th>Passes</th></tr>
    <tr><th>Comp</th><th>Gls</th><th>Ast</th><th>Cmp%</th></tr></thead>
    <tbody><tr><th>League</th><td>1</td><td>2</td><td>88.1</td></tr>
    <tr><td>Cup &amp; Co</td><td colspan=2>On  bench</td><td></td></tr></tbody></table>"""
    rows = pages.read_table(html, "m")
    assert rows == [
        {"Comp": "League", "Performance_Gls": "1", "Performance_Ast": "2", "Passes_Cmp_percent": "88.1"},
        {"Comp": "Cup & Co", "Performance_Gls": "On bench", "Performance_Ast": "On bench", "Passes_Cmp_percent": ""},
    ]
    assert pages.read_table(html, "absent") == [] and pages.read_table("<p>", "m") == []


def test_cells_that_span_rows():
    html = """<table id="m"><tr><th rowspan=2>A</th><th>B</th><th rowspan="0">D</th></tr><tr><th>C</th><th></th></tr>
    <tr><th>E</th><th>F</th><th>G</th></tr>
    <tr><td rowspan=3>x</td><td>1</td><td rowspan=2 colspan=1>y</td></tr><tr><td>2</td></tr><tr><td>3</td><td>z</td></tr>
    <tr><th>A</th><th>B</th><th>D</th></tr></table>"""
    names = ["A_A_E", "B_C_F", "D_G"]
    rows = [["x", "1", "y"], ["x", "2", "y"], ["x", "3", "z"], ["A", "B", "D"]]
    assert pages.read_table(html, "m") == [dict(zip(names, cells)) for cells in rows]


ODD_PAGES = [
    "<table id=m><tr><th>A</th></tr><tr><td>1<br/>2 &amp; 3 &lt; 4</td></tr></table>",
    "<table id='m'><tr><th>A</th><th>B</th></tr><tr><td title='a > b'>1</td><td>2 < 3</td></tr></table>",
    "<table><tr><td><table id=\"m\"><tr><th>A</th></tr><tr><td>in</td></tr></table></td></tr></table>",
    "<TABLE ID=m CLASS=x><TR><TH>A<TR><TD COLSPAN=2>1<TD>2<!-- <td>no</td> --></TABLE><p <b>",
    "<table id=m><tr><th>A</th></tr><tr><td>1<script>if (a<b) '</td>'</script></td></tr></table>",
    "<table id=m><tr><th>A</th><th>B</th></tr><tr><td/><td rowspan=2/>x</td></tr><tr><td>y</td></tr></table> &am",
    "<table id='m' id='n'><tr><th>A</th></tr><tr><td colspan='&#50;'>1</td></tr></table>",
    "<table id=m><tr><th>A</th></tr><tr><td>1</td></tr><tr><td>unclosed &am",
]


def test_plain_markup_reads_like_any_other(monkeypatch):
    """Plain pages never reach the slow parser, and all pages give the rows it gives."""
    plain = "<p>x</p><table id='m'><tr><th>A</th></tr><tr><td rowspan='1' class=c>1 &amp; <b>2</b></td></tr></table><p <"
    with monkeypatch.context() as m:
        m.setattr(pages._Table, "feed", None)
        assert pages.read_table(plain, "m") == [{"A": "1 & 2"}]
    read = [pages.read_table(html, "m") for html in [plain, *ODD_PAGES]]
    monkeypatch.setattr(pages._Table, "feed_plain", lambda self, html: False, raising=False)
    assert read == [pages.read_table(html, "m") for html in [plain, *ODD_PAGES]]


def test_page_tables_job(spark):
    html = "<table id='m'><tr><th>Comp</th><th>Min</th></tr><tr><td>League</td><td>90</td></tr><tr><td>Cup</td><td></td></tr></table>"
    df = spark.createDataFrame([(1, "Ann", html), (2, "Ben", "<p>none</p>"), (3, "Cid", None)], "page_id long, who string, html string")
    rows = pages.page_tables(df, "m", ["Comp", "Min"], keep=("page_id", "who"))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "Ann", 0, "League", "90"), (1, "Ann", 1, "Cup", None)]
    assert [tuple(r) for r in pages.competition_rows(rows, "League", F.col("who")).select("name", "Min").collect()] == [("Ann", "90")]


def test_predictions_only_grow(spark):
    path = scratch_path(spark, "test-predictions")
    new = spark.createDataFrame([(2, 1, 0.5, 0.1), (1, 1, 0.4, 0.2)], "player_id int, fixture_id int, predicted_goals double, predicted_assists double")
    assert append_predictions(new, path).count() == 2
    assert append_predictions(new, path).count() == 2, "the same load again"
    rows = append_predictions(new, path, 3).orderBy("prediction_id").collect()
    base = 3 << 32
    assert [(r.prediction_id, r.player_id, r.load) for r in rows] == [(1, 1, 0), (2, 2, 0), (base + 1, 1, 3), (base + 2, 2, 3)]
    assert all(r.prediction_timestamp for r in rows)
    with pytest.raises(Exception, match="required prediction"):
        append_predictions(new.withColumn("predicted_goals", F.lit(None).cast("double")), path, 3)
    assert spark.read.parquet(path).count() == 4, "a load that fails leaves the table as it was"
    assert append_predictions(new.limit(1), path, 3).count() == 3
    with pytest.raises(ValueError):
        append_predictions(new, path, -1)


def test_earlier_lists(spark):
    df = spark.createDataFrame(
        [("2021-22", "Ann", "a2"), ("2020-21", "Ann", "a1"), ("2024-25", "Ben", "b1"), ("2023-24", "Cid", "c1")], "season string, name string, id string"
    )
    assert sorted(tuple(r) for r in earlier_id_list(df, "2023-24").collect()) == [("Ann", "a1"), ("Cid", "c1")]


def test_tables_and_views(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert files.publish(df, "touchline_view", table=False).collect() == df.collect()
    from pyspark.sql import types as T

    typed = files.typed(df, T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.DoubleType())]))
    assert typed.dtypes == [("b", "string"), ("a", "double")]
