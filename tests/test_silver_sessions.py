from datetime import timedelta

import pytest
from helpers import connections, daily, ts, tuples
from pyspark.sql import functions as F

from fleetday.config import Config
from fleetday.operators import sessions as N
from fleetday.operators import silver as V

CFG = Config()
DAY = ts("2024-01-05")


def build(spark, *rows):
    return V.build_silver(daily(spark, *[{"datestr": DAY, **r} for r in rows]), CFG)


def test_only_the_newest_export_counts(spark):
    out = build(
        spark,
        {"market_name": "A", "num_of_trips": 5.0, "file_date": ts("2024-02-01")},
        {"market_name": "B", "num_of_trips": 3.0, "file_date": ts("2024-02-02")},
    )
    assert tuples(out, "market_name", "num_of_trips") == [("B", 3.0)]


def test_markets_of_one_export_are_summed_and_the_busiest_names_the_day(spark):
    out = build(
        spark,
        {"market_name": "A", "num_of_trips": 2.0, "total_km": 4.0, "driver_email": "a@x"},
        {"market_name": "B", "num_of_trips": 6.0, "total_km": 4.0},
        {"market_name": "B", "num_of_trips": 1.0, "total_km": 90.0},
        {"market_name": None, "num_of_trips": None, "total_km": 1.0},
    )
    row = out.first()
    assert (row.market_name, row.num_of_trips, row.total_km) == ("B", 8.0, 9.0)
    assert row.total_km_avg == 9.0 / 8.0
    assert row.driver_email is None


def test_empty_columns_sum_to_zero_but_late_counters_stay_empty(spark):
    row = build(spark, {"market_name": "A"}, {"market_name": "B"}).first()
    assert (row.online_hours, row.num_of_trips, row.total_km_avg) == (0.0, 0.0, 0.0)
    assert (row.late_p2_trips, row.late_p3_trips) == (None, None)
    row = build(spark, {"market_name": "A", "late_p2_trips": 2.0}, {"market_name": "B"}).first()
    assert row.late_p2_trips == 2.0


def test_rows_without_rider_or_day_are_dropped(spark):
    out = V.build_silver(
        daily(spark, {"datestr": DAY, "driver_uuid": None}, {"datestr": None}, {"datestr": DAY}), CFG
    )
    assert out.count() == 1


@pytest.mark.parametrize("sync_days, kept", [(7, 22), (60, 61)])
def test_recent_window_is_counted_from_the_newest_day_of_the_data(spark, sync_days, kept):
    days = [ts("2024-06-01") - timedelta(days=n) for n in (0, kept, kept + 1)]
    frame = daily(spark, *[{"datestr": d} for d in days])
    out = V.build_silver(frame, Config(sync_days=sync_days))
    assert out.count() == 2


def test_two_times_on_one_date_are_two_rows(spark):
    out = V.build_silver(
        daily(spark, {"datestr": DAY}, {"datestr": DAY + timedelta(hours=6)}), CFG
    )
    assert out.count() == 2


def test_multi_market_counts_an_empty_name_as_a_market(spark):
    out = V.multi_market_count(
        daily(
            spark,
            {"datestr": DAY, "market_name": "A"},
            {"datestr": DAY, "market_name": None},
            {"datestr": DAY, "driver_uuid": "b", "market_name": "A"},
        )
    )
    assert tuples(out, "driver_uuid", "markets") == [("a", 2)]


def closed(spark, *rows):
    out = N.closed_sessions(connections(spark, *rows), CFG)
    return tuples(out.select(F.col("dia").cast("string"), "status", "seconds", "early_seconds"))


def test_session_over_midnight_stays_on_its_start_date(spark):
    got = closed(spark, ("a", "open", "2024-01-01 23:00:00", "2024-01-02 04:00:00"))
    assert got == [("2024-01-01", "open", 5 * 3600, 0)]


def test_session_over_the_cutoff_counts_only_the_part_before(spark):
    got = closed(spark, ("a", "ontrip", "2024-01-01 01:30:00", "2024-01-01 03:30:00"))
    assert got == [("2024-01-01", "ontrip", 7200, 1800)]


def test_open_session_is_closed_by_the_next_event_of_any_status(spark):
    got = closed(
        spark,
        ("a", "open", "2024-01-01 10:00:00", None),
        ("a", "offline", "2024-01-01 10:30:00", None),
        ("a", "open", "2024-01-03 10:00:00", None),
        ("b", "open", "2024-01-03 11:00:00", None),
    )
    assert got == [("2024-01-01", "open", 1800, 0)]


def test_an_open_session_can_be_closed_days_later_if_short_enough(spark):
    got = closed(
        spark,
        ("a", "open", "2024-01-01 20:00:00", None),
        ("a", "open", "2024-01-02 13:00:00", "2024-01-02 13:10:00"),
        ("c", "open", "2024-01-01 01:00:00", None),
        ("c", "offline", "2024-01-02 01:00:00", None),
    )
    assert got == [("2024-01-01", "open", 17 * 3600, 0), ("2024-01-02", "open", 600, 0)]


def test_long_and_backward_sessions_are_dropped(spark):
    got = closed(
        spark,
        ("a", "open", "2024-01-01 00:00:00", "2024-01-01 18:00:00"),
        ("b", "open", "2024-01-01 00:00:00", "2024-01-01 18:00:01"),
        ("c", "open", "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
        ("d", "open", "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
        ("e", "open", "unreadable", "2024-01-01 09:00:00"),
        (None, "open", "2024-01-01 08:00:00", "2024-01-01 09:00:00"),
    )
    assert got == [("2024-01-01", "open", 18 * 3600, 7200)]


def test_early_share(spark):
    out = N.early_share(
        connections(
            spark,
            ("a", "open", "2024-01-01 01:00:00", "2024-01-01 02:00:00"),
            ("a", "ontrip", "2024-01-01 12:00:00", "2024-01-01 15:00:00"),
        ),
        CFG,
    )
    assert tuples(out, "frac_horas", "horas_conn", "horas_madrugada") == [(0.25, 4.0, 1.0)]


def test_offer_share_counts_accepted_offers_only(spark):
    offers = spark.createDataFrame(
        [
            ("2024-01-01 01:59:00", "a", "ACCEPT"),
            ("2024-01-01 02:00:00", "a", "ACCEPT"),
            ("2024-01-01 01:00:00", "a", "REJECT"),
            ("bad", "a", "ACCEPT"),
        ],
        "timestamp string, courier_uuid string, courier_action string",
    )
    out = N.offer_early_share(offers, CFG)
    assert tuples(out, "frac_rta", "rta_total", "rta_madrugada") == [(0.5, 2, 1)]
