"""Rules for dirty text, calendars and exact rounding, on hand-written rows."""

import datetime as dt


from bizlens.functions.calendar import day_name, iso_yearweek, minutes_between, month_name, seven_day_week, sunday_week
from bizlens.functions.lists import ordered_list
from bizlens.functions.numeric import ratio_round
from bizlens.functions.text import clean_null_tokens, csv_count, csv_items, explode_csv, parse_measure


def test_parse_measure_units_and_markers(spark):
    rows = [("20km",), ("23.4 km",), ("10",), ("null",), ("",), (None,), ("25mins",), ("15 minute",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(parse_measure("t")).collect()]
    assert got == [20.0, 23.4, 10.0, None, None, None, 25.0, 15.0]


def test_missing_markers_become_null(spark):
    rows = [("",), ("null",), ("NULL",), (" ",), (None,), ("Restaurant Cancellation",)]
    df = clean_null_tokens(spark.createDataFrame(rows, "c string"), ["c"])
    assert [r[0] for r in df.collect()] == [None, None, None, None, None, "Restaurant Cancellation"]


def test_csv_items_and_explode(spark):
    df = spark.createDataFrame([(1, "1, 4"), (2, "2,6"), (3, "null"), (4, None), (5, "")], "id int, x string")
    items = {r.id: r.items for r in df.select("id", csv_items("x").alias("items")).collect()}
    assert items == {1: ["1", "4"], 2: ["2", "6"], 3: [], 4: [], 5: []}
    assert [r[1] for r in df.select("id", csv_count("x")).orderBy("id").collect()] == [2, 2, 0, 0, 0]
    ex = explode_csv(df, "x", "item", "int").select("id", "item").collect()
    assert sorted((r.id, r.item) for r in ex) == [(1, 1), (1, 4), (2, 2), (2, 6)]


def test_calendar_rules(spark):
    days = [dt.date(2018, 1, 1), dt.date(2017, 1, 1), dt.date(2020, 6, 15), dt.date(2021, 1, 1),
            dt.date(2018, 6, 18)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(sunday_week("d"), iso_yearweek("d"), day_name("d"), month_name("d"),
                    seven_day_week("d")).collect()
    assert [r[0] for r in got] == [0, 1, 24, 0, 24]
    assert got[3][1] == 202053
    assert got[3][2] == "Friday" and got[3][3] == "January"
    assert [r[4] for r in got] == [1, 1, 24, 1, 25]


def test_minutes_between_counts_whole_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 10, 0, 59), dt.datetime(2020, 1, 1, 10, 2, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between("a", "b")).first()[0] == 1


def test_ratio_round_half_away_from_zero_exact(spark):
    # 107/40 = 2.675 exactly; binary floating point would round it down
    df = spark.createDataFrame([(107, 40), (-107, 40), (1, 8), (5, 0), (None, 3)], "n long, d long")
    got = [r[0] for r in df.select(ratio_round("n", "d", 2)).collect()]
    assert got == [2.68, -2.68, 0.13, None, None]


def test_ordered_list_skips_nulls_and_orders(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, None), (2, 1, None)], "k int, s int, v string")
    got = {r.k: r.l for r in df.groupBy("k").agg(ordered_list("v", "s").alias("l")).collect()}
    assert got == {1: "a, c", 2: None}


def test_parse_timestamp_ntz_is_zone_free(spark):
    from bizlens.functions.calendar import parse_timestamp_ntz
    rows = [("1998-04-05 02:15:47",), ("null",), ("",), (None,), ("2020-13-01 00:00:00",), ("2020-01-01 18:15:34",),
            ("2020-01-01 18:15:34.500",), (" 2020-01-01T18:15 ",), ("2020-01-01 18:15:61",), ("2020-01-01 18",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(parse_timestamp_ntz("t")).collect()]
    assert got == [dt.datetime(1998, 4, 5, 2, 15, 47), None, None, None, None, dt.datetime(2020, 1, 1, 18, 15, 34),
                   dt.datetime(2020, 1, 1, 18, 15, 34, 500000), dt.datetime(2020, 1, 1, 18, 15), None, None]


def test_day_names_and_differences_ignore_session_zone(spark):
    from bizlens.functions.calendar import day_name, minutes_between, seconds_between
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(1998, 4, 5, 1, 47, 0), dt.datetime(1998, 4, 5, 2, 15, 47))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(seconds_between("a", "b"), minutes_between("a", "b"), minutes_between("b", "a"),
                      day_name("b")).first()
        assert tuple(r) == (1727, 28, -28, "Sunday")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
