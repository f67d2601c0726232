"""Column, name and season functions on small rows."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from touchline.functions import columns as c
from touchline.functions import names as n
from touchline.functions import seasons as s
from touchline.plans import cleanup


def one(df):
    return tuple(df.first())


def test_ratios_and_null(spark):
    df = spark.createDataFrame([(None, 2.0), (3.0, 0.0), (3.0, None), (3.0, 2.0)], "a double, b double")
    strict = [r[0] for r in df.select(c.safe_ratio(F.col("a"), F.col("b"), coalesce=False)).collect()]
    lenient = [r[0] for r in df.select(c.safe_ratio(F.col("a"), F.col("b"))).collect()]
    rate = [r[0] for r in df.select(c.rate_per(F.col("a"), F.col("b"), 90)).collect()]
    assert strict == [None, 0.0, 0.0, 1.5]
    assert lenient == [0.0, 0.0, 0.0, 1.5]
    assert rate == [0.0, 0.0, 0.0, 135.0]
    assert [r[0] for r in df.select(c.sum_of(F.col("a"), F.col("b"))).collect()] == [2.0, 3.0, 3.0, 5.0]


def test_integer_ratio_is_not_truncated(spark):
    assert one(spark.range(1).select(c.safe_ratio(F.lit(1), F.lit(4)), c.rate_per(F.lit(1), F.lit(45)))) == (0.25, 2.0)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.5,), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(c.clip_at_zero(F.col("x"))).collect()] == [0.0, None, 2.0]


def test_decode_fails_on_unknown_code(spark):
    df = spark.createDataFrame([("1",), ("4",)], "code string")
    assert [r[0] for r in df.select(c.decode(F.col("code"))).collect()] == ["GK", "FWD"]
    for bad in ("5", None):
        with pytest.raises(Exception, match="unknown code"):
            spark.createDataFrame([(bad,)], "code string").select(c.decode(F.col("code"))).collect()


def test_flags(spark):
    df = spark.createDataFrame([("Y",), ("Y*",), ("N",), ("?",), (None,)], "x string")
    assert [r[0] for r in df.select(c.flag_to_int(F.col("x"))).collect()] == [1, None, 0, None, None]
    assert [r[0] for r in df.select(c.is_marked(F.col("x"))).collect()] == [0, 1, 0, 0, 0]


def test_points(spark):
    df = spark.createDataFrame([("FWD", 1, 1), ("MID", 1, 1), ("DEF", 1, 1), ("GK", 1, 1), ("FWD", None, 1)], "p string, g int, a int")
    points = [r[0] for r in df.select(c.goal_points(F.col("p"), F.col("g"), F.col("a"))).collect()]
    assert points == [7, 8, 9, None, None]


def test_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 11), (11, 1), (11, 11)], "p int, a int")
    got = [r[0] for r in df.select(c.confusion_class(F.col("p"), F.col("a"))).collect()]
    assert got == ["Correctly Predicted", "False Positive", "Missed Prediction", "Correctly Excluded"]


def test_contains_is_literal(spark):
    df = spark.createDataFrame([("a.c",), ("abc",)], "x string")
    assert [r[0] for r in df.select(c.contains_text(F.col("x"), "a.c")).collect()] == [True, False]


def test_frame_helpers(spark):
    df = spark.createDataFrame([(1, "On", 2.0, True)], "A int, B string, C double, D boolean")
    assert c.columns_of(df, "number") == ["A", "C"] and c.columns_of(df, "boolean") == ["D"]
    assert c.lower_names(df).columns == ["a", "b", "c", "d"]
    assert c.drop_columns(df, ["B", "gone"], [0]).columns == ["C", "D"]
    assert c.null_sentinel(df, "On").first().B is None


def test_names(spark):
    row = one(
        spark.range(1).select(
            n.short_name(F.lit("Bruno Miguel"), F.lit("Borges Fernandes")),
            n.full_name(F.lit("A"), F.lit(None).cast("string")),
            n.file_key(F.lit("Ann"), F.lit("de la Cruz")),
            n.match_key(F.lit("Ödegaard Martin")),
            n.round_number(F.lit("Matchweek 7")),
            n.round_number(F.lit("Final")),
        )
    )
    assert row == ("Bruno Fernandes", None, "Ann_de_la_Cruz", "martin odegaard", 7, None)
    first, rest = n.split_once(F.lit("Ann de Cruz"))
    alone = n.split_once(F.lit("Neymar"))
    assert one(spark.range(1).select(first, rest, *alone)) == ("Ann", "de Cruz", "Neymar", None)


def test_fold_accents_is_nfkd(spark):
    texts = ["Øystein Güler", "ﬁne ½ Å", "plain", "", None, "Çalhanoğlu", "ñandú"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(n.fold_accents("t")).collect()]
    want = [None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)) for t in texts]
    assert got == want and got[0].startswith("Øystein")


def test_links(spark):
    urls = [
        "https://x.example/en/players/ab12/Ann-de-Cruz?x=1#y",
        "/en/players/ab12/Ann-de-Cruz",
        "https://x.example/en/players/ab12",
        "https://x.example/en/players/ab12/all/Ann",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(n.link_id(F.col("u")), n.link_name(F.col("u"))).collect()]
    assert got == [("ab12", "Ann de Cruz"), ("ab12", "Ann de Cruz"), (None, None), (None, None)]


def test_seasons(spark):
    df = spark.createDataFrame([("2024-07-31",), ("2024-08-01",), ("1999-09-01",), ("2000-01-01",)], "d string")
    labels = df.select(s.season_of(F.to_date("d")).alias("x"))
    assert [r.x for r in labels.collect()] == ["2023-24", "2024-25", "1999-00", "1999-00"]
    row = one(
        spark.range(1).select(
            s.previous_season(F.lit("2024-25")), s.season_start(F.lit("2024-25")), s.season_end(F.lit("2024-25")),
            s.long_season(F.lit("2024-25")), s.is_season(F.lit("2024-25")), s.is_season(F.lit("2024-2025")),
        )
    )
    assert row == ("2023-24", 2024, 2025, "2024-2025", True, False)
    old = one(spark.range(1).select(*[f(F.lit(x)) for x in ("1998-99", "1999-00") for f in (s.season_end, s.long_season)]))
    assert old == (1999, "1998-1999", 2000, "1999-2000")


def test_clean_events(spark):
    rows = [
        ("Matchweek 7", "Y*", "90"),
        ("Matchweek ?", "N", cleanup.NOT_PLAYED),
        ("Champions League Group", "Y", "90"),
    ]
    got = [tuple(r) for r in cleanup.clean_events(spark.createDataFrame(rows, "Round string, Start string, Min string"), "2024-25").collect()]
    assert got == [(7, 1, "90", "2024-25", 1), (None, 0, None, "2024-25", 0)]


def test_clean_players(spark):
    from touchline.sources.schemas import CLEAN_PLAYER_COLUMNS

    row = {name: "1" for name in CLEAN_PLAYER_COLUMNS} | {"id": "9", "extra": "x"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    cleaned = cleanup.clean_players(df)
    assert cleaned.columns == CLEAN_PLAYER_COLUMNS and cleaned.first().element_type == "GK"
    assert cleanup.id_list(df).columns == ["first_name", "second_name", "id"]
