from datetime import date, datetime

import pytest
from helpers import ts, tuples
from pyspark.sql import functions as F

from fleetday.functions import clock
from fleetday.functions.clock import export_timestamp, logical_day, parse_ts, seconds_between
from fleetday.functions.dedup import add_unseen, keep_first, keep_latest
from fleetday.functions.joins import salted_join
from fleetday.functions.numbers import parse_double
from fleetday.functions.ordered import split_heavy, with_next, with_previous_max


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-31 02:30:00", datetime(2024, 3, 31, 2, 30)),
        ("2024-03-31T02:30:00.25", datetime(2024, 3, 31, 2, 30, 0, 250000)),
        ("2024-03-31", datetime(2024, 3, 31)),
        ("2024-1-5", datetime(2024, 1, 5)),
        (" 2024-1-5 7:05:09 ", datetime(2024, 1, 5, 7, 5, 9)),
        ("2024/01/05 10:00:00", datetime(2024, 1, 5, 10)),
        ("05/01/2024 10:00:00", datetime(2024, 1, 5, 10)),
        ("5-1-2024", datetime(2024, 1, 5)),
        ("31/02/2024", None),
        ("2024-01-051", None),
        ("2026", None),
        ("2026-10", None),
        ("2026-13-01 00:00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    assert one(spark, parse_ts("x"), text) == expected


def test_dashed_times_are_read_as_by_the_patterns(spark):
    odd = ["2024-01-05", "2024-01-05 1:02", "2024-01-05T10:11:12.1234567Z", "2024-01-05 10:00 +02:00", "2024-01-051", "2024-13-01", "2024-02-30",
           "-202-01-05", "+202-01-05", " 2024-01-05 ", "\t2024-01-05", "2024-1-05", "202a-01-05", "2024-01-", "2024-01-5x", "2024-01-5 ", "24:0-01-05",
           "T1:2-08:00", "12-3-1-2024", "1-12-2024", "01/1-2024", "1/1-20-24", "2024/01-05", "02-1-2024 3:04", "2024-01", "٢٠٢٤-01-05", "", None]
    text = F.trim("x")
    iso = F.regexp_replace(F.regexp_replace(text, clock._SLASHES, "$1-$2-$3"), clock._DAY_FIRST, "$3-$2-$1")
    by_pattern = F.when(iso.rlike(clock._FULL_DATE), iso.try_cast("timestamp_ntz"))
    rows = spark.createDataFrame([(x,) for x in odd], "x string").select("x", parse_ts("x").alias("got"), by_pattern.alias("want")).collect()
    assert [(r.x, r.got) for r in rows] == [(r.x, r.want) for r in rows] and sum(r.got is not None for r in rows) > 8


def test_parse_ts_with_formats(spark):
    column = parse_ts("x", ("dd.MM.yyyy HH:mm",))
    assert one(spark, column, "31.01.2024 13:05") == datetime(2024, 1, 31, 13, 5)


def test_formats_know_no_clock_changes(spark):
    """02:30 does not exist on that night in New York; a wall-clock time does."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for text in ("10.03.2024 02:30", "10/03/2024 02:30"):
            assert one(spark, parse_ts("x", ("dd.MM.yyyy HH:mm",)), text) == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("COURIER_DAILY_20260601_163355.csv", datetime(2026, 6, 1, 16, 33, 55)),
        ("x120260601_163355.csv", datetime(2026, 6, 1, 16, 33, 55)),
        ("COURIER_DAILY_20261301_163355.csv", None),
        ("COURIER_DAILY.csv", None),
    ],
)
def test_export_timestamp(spark, name, expected):
    assert one(spark, export_timestamp("x"), name) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.5", 1.5), ("-2", -2.0), (".5", 0.5), ("1e3", 1000.0), ("1.5d", None), (" 1", None),
        ("NaN", None), ("Infinity", None), ("abc", None), ("", None), (None, None),
    ],
)
def test_parse_double(spark, text, expected):
    assert one(spark, parse_double("x"), text) == expected


@pytest.mark.parametrize(
    "moment, expected",
    [
        ("2024-01-02 01:59:59.999", date(2024, 1, 1)),
        ("2024-01-02 02:00:00", date(2024, 1, 2)),
        ("2024-01-01 00:00:00", date(2023, 12, 31)),
    ],
)
def test_logical_day(spark, moment, expected):
    assert one(spark, logical_day(F.col("x"), 2), ts(moment), "timestamp_ntz") == expected


@pytest.mark.parametrize("zone", ["UTC", "Europe/Madrid"])
def test_seconds_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [(ts("2024-03-31 01:30:00.9"), ts("2024-03-31 03:30:00.1"))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 7199
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_keep_first_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame(
        [(None, 2), (None, 1), ("a", 5), ("a", 4), ("b", 9)], "k string, n int"
    )
    assert tuples(keep_first(df, ["k"], ["n"])) == [("a", 4), ("b", 9), (None, 1)]


def test_keep_latest_is_idempotent(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", 1, "z")], "k string, t int, v string"
    )
    once = keep_latest(df, ["k"], "t")
    assert tuples(once) == [("a", 2, "w"), ("b", 1, "z")]
    assert tuples(keep_latest(once, ["k"], "t")) == tuples(once)


def test_add_unseen_matches_null_keys(spark):
    stored = spark.createDataFrame([(None,), ("a",)], "k string")
    new = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    assert tuples(add_unseen(stored, new, ["k"])) == [("b",)]


def events(spark):
    """One rider holds most rows; gaps, ties and a rider with a single row."""
    rows = [("hot", ts(f"2024-01-{d:02d} {h:02d}:{m:02d}:00"), f"e{h}{m}") for d in (1, 2, 5)
            for h in (0, 3, 23) for m in (0, 1, 59)]
    rows += [("hot", ts("2024-01-02 03:01:00"), "a"), ("cold", ts("2024-01-09 00:00:00"), "z")]
    return rows, spark.createDataFrame(rows, "k string, t timestamp_ntz, tie string")


@pytest.mark.parametrize("heavy", [1, 5, 1000])
def test_with_next_equals_a_scan_over_the_whole_key(spark, heavy):
    rows, df = events(spark)
    expected = []
    ordered = sorted(rows)
    for a, b in zip(ordered, [*ordered[1:], None]):
        expected.append((*a, b[1] if b and b[0] == a[0] else None))
    got = tuples(with_next(df, ["k"], "t", ["tie"], "next", heavy), "k", "t", "tie", "next")
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("heavy", [1, 5, 1000])
def test_with_previous_max_equals_a_scan_over_the_whole_key(spark, heavy):
    rows, df = events(spark)
    value = F.when(F.minute("t") == 0, F.day("t") * 100 - F.hour("t"))
    expected, seen = [], {}
    for k, t, tie in sorted(rows):
        expected.append((k, t, tie, seen.get(k)))
        if t.minute == 0:
            seen[k] = max(seen.get(k, -1), t.day * 100 - t.hour)
    out = with_previous_max(df, ["k"], "t", ["tie"], value, "peak", heavy)
    assert tuples(out, "k", "t", "tie", "peak") == sorted(expected, key=str)


def test_a_burst_within_one_second_is_spread(spark):
    """All rows of a rider at the same time, most of them equal in every column; another has no id."""
    at = ts("2024-01-01")
    rows = [("hot", at, "same")] * 600 + [("hot", at, f"{i:03d}") for i in range(300)] + [("hot", ts("2024-01-02"), "z"), ("cold", at, "a")]
    rows += [(None, ts(f"2024-01-01 00:00:{s:02d}"), "n") for s in range(60)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, tie string")
    light, heavy = split_heavy(df, ["k"], ["t", "tie"], 40)
    assert tuples(light) == [("cold", at, "a")]
    counts = [r["count"] for r in heavy.groupBy("_range", "k").count().collect()]
    assert sum(counts) == 961 and max(counts) <= 60 and len(counts) >= 30
    got = with_next(df, ["k"], "t", ["tie"], "next", 40)
    assert got.count() == len(rows) and got.where("k = 'hot' AND next = t").count() == 899
    assert tuples(got.where("next > t AND k = 'hot'"), "t", "next") == [(at, ts("2024-01-02"))]
    assert tuples(got.where("next is null"), "k", "t") == sorted([("cold", at), ("hot", ts("2024-01-02")), (None, ts("2024-01-01 00:00:59"))], key=str)
    assert got.where("k is null AND next = t + INTERVAL 1 SECOND").count() == 59
    peak = with_previous_max(df, ["k"], "t", ["tie"], F.length("tie"), "peak", 40)
    assert peak.where("peak is null").count() == 3 and peak.where("k = 'hot' AND peak = 3").count() == 300
    assert peak.where("k = 'hot' AND peak = 4").count() == 600


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(spark, how):
    big = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "k string, n int")
    small = spark.createDataFrame([("a", True)], "k string, hit boolean")
    plain = big.join(small, ["k"], how)
    assert tuples(salted_join(big, small, ["k"], ["n"], how, 7)) == tuples(plain)
