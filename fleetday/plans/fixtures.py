"""The input tables of the registered queries, derived by Spark from `events`.

Every event is one session, one offer and one order; its type gives the state or action and its
value the length. Nothing is sampled: each table grows with `events`.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.functions.clock import export_timestamp

# The data ends on 30 January 2024; runs over it are dated accordingly.
CONFIG = Config(first_day_without_late_report=date(2024, 1, 10))
AS_OF = datetime(2024, 2, 5, 9, 0)
PRUNE_AS_OF = datetime(2024, 3, 10, 10, 30)  # the limit falls inside the earlier export
PUBLISH_AS_OF = date(2024, 1, 29)
REPROCESS_SINCE = date(2024, 2, 3)
CLOSED_AT = "2024-01-29T06:00:00+00:00"
FIRST_EXPORT = "2024-01-16 00:00:00"


_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"

# shared pieces of SQL
_SECONDS = "CAST(floor(value * 60) AS BIGINT)"
_LATER = f"ts + make_dt_interval(0, 0, 0, {_SECONDS})"
_RIDER = "CAST(user_id AS STRING)"
_FLEET = "concat('fleet ', CAST(user_id % 3 AS STRING))"
_ORDER = "concat('T', CAST(event_id AS STRING))"
_EMPTY = "CAST(NULL AS STRING)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema is given, so no job reads file footers to infer it."""
    return spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per event, and every 97th event once more with a start that can't be read."""
    whole = events(spark, sf_dir)
    unreadable = {
        "status": F.lit("open"),
        "start_time": F.concat(F.lit("n/a "), F.col("event_id").cast("string")),
        "end_time": F.lit(None).cast("string"),
    }
    rows = _connections(whole)
    again = _connections(whole.filter("event_id % 97 = 0")).withColumns(unreadable)
    return rows.unionByName(again).drop("event_id")


def _connections(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "event_id",
        f"{_RIDER} AS courier_uuid",
        f"concat('rider ', {_RIDER}) AS courier_name",
        f"{_EMPTY} AS contact_number",
        f"{_FLEET} AS fleet_name",
        "CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'enroute' "
        "WHEN 'purchase' THEN 'ontrip' WHEN 'signup' THEN 'offline' "
        "WHEN 'error' THEN 'unavailable' END AS status",
        "CAST(to_date(ts) AS STRING) AS datestr",
        "CAST(ts AS STRING) AS start_time",
        f"if(event_id % 3 <> 0, CAST({_LATER} AS STRING), NULL) AS end_time",
        f"{_EMPTY} AS job_daily_rank",
        "'connections_20240131_000000.csv' AS conn_file",
    )


def overlapping_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions, and an earlier export of the month so far in which every session is open."""
    whole = connections(spark, sf_dir)
    earlier = whole.filter(F.col("start_time") < FIRST_EXPORT).withColumns(
        {
            "end_time": F.lit(None).cast("string"),
            "conn_file": F.lit("connections_20240116_000000.csv"),
        }
    )
    return whole.unionByName(earlier)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "CAST(ts AS STRING) AS timestamp",
        f"{_RIDER} AS courier_uuid",
        "if(event_id % 50 <> 0, concat('O', CAST(event_id AS STRING)), NULL) AS offer_id",
        "if(event_type = 'error', 'REJECT', 'ACCEPT') AS courier_action",
        f"{_EMPTY} AS contact_number",
        f"concat('r', {_RIDER}) AS email",
        f"{_FLEET} AS fleet_name",
        "'CANCELLATION_RTA_20240131_000000.csv' AS rta_file",
    )


def overlapping_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = offers(spark, sf_dir)
    earlier = whole.filter(F.col("timestamp") < FIRST_EXPORT).withColumns(
        {
            "email": F.lit(None).cast("string"),
            "rta_file": F.lit("CANCELLATION_RTA_20240116_000000.csv"),
        }
    )
    return whole.unionByName(earlier)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exports a month, two markets; which export holds an event depends on its number.

    By the rider's city, the rows of one market are there a second time: with fewer trips, as they
    are, without trips, as a market without a name, or without rider or date.
    """
    rows = events(spark, sf_dir).selectExpr(
        "user_id",
        "event_type",
        f"{_SECONDS} AS secs",
        "CAST(floor(value) AS BIGINT) AS whole",
        "to_date(ts) AS d",
        "concat('M', CAST(event_id % 2 AS STRING)) AS market_name",
        "concat('COURIER_DAILY_2024020', CAST(event_id % 3 + 1 AS STRING), '_060000.csv') "
        "AS file_name",
    )
    totals = rows.groupBy("user_id", "d", "market_name", "file_name").agg(
        *[
            F.expr(sql).alias(name)
            for name, sql in {
                "online_hours": "sum(secs) / 3600D",
                "active_hours": "0.75D * sum(secs) / 3600D",
                "open_hours": "sum(if(event_type = 'view', secs, 0)) / 3600D",
                "enroute_p2_hours": "sum(if(event_type = 'click', secs, 0)) / 3600D",
                "ontrip_p3_hours": "sum(if(event_type = 'purchase', secs, 0)) / 3600D",
                "num_of_trips": "double(count(*))",
                "single_trips_total": "double(count_if(event_type = 'view'))",
                "purchases": "double(count_if(event_type = 'purchase'))",
                "clicks": "double(count_if(event_type = 'click'))",
                "accept_trips": "double(count_if(event_type <> 'error'))",
                "reject_trips": "double(count_if(event_type = 'error'))",
                "cancel_trips": "double(count_if(event_type = 'signup'))",
                "p2_km": "sum(whole) / 10D",
                "p2_min": "sum(secs) / 60D",
                "total_km": "sum(whole) / 5D",
                "total_min": "sum(secs) / 30D",
            }.items()
        ]
    )
    named = {
        "weekstr": "CAST(date_sub(d, weekday(d)) AS TIMESTAMP_NTZ)",
        "datestr": "CAST(d AS TIMESTAMP_NTZ)",
        "driver_uuid": _RIDER,
        "driver_name": f"concat('rider ', {_RIDER})",
        "driver_email": f"concat('r', {_RIDER}, '@example.org')",
        "fleet_name": _FLEET,
        "city_id": "double(user_id % 7)",
        "city_name": "concat('city ', CAST(user_id % 7 AS STRING))",
        "late_p2_trips": "if(user_id % 2 <> 0, purchases, NULL)",
        "late_p3_trips": "if(user_id % 3 <> 0, clicks, NULL)",
    }

    def column(name: str) -> str:
        if name in named:
            return f"{named[name]} AS {name}"
        if name in totals.columns:
            return name
        return f"CAST(NULL AS {'STRING' if name in S.DAILY_TEXT else 'DOUBLE'}) AS {name}"

    once = totals.selectExpr(*[column(c) for c in S.DAILY_COLUMNS], "file_name")
    nameless = "city_id = 3"
    odd = "CAST(driver_uuid AS BIGINT) % 2 = 1"
    changed = {
        "num_of_trips": f"CASE WHEN city_id = 0 THEN num_of_trips - 1 WHEN city_id = 2 THEN NULL "
        f"WHEN {nameless} THEN 1D ELSE num_of_trips END",
        # nothing but its trip, so that sums over three markets don't depend on their order
        **{c: f"if({nameless} AND {c} IS NOT NULL, 0D, {c})" for c in S.SUMMED_COLUMNS if c != "num_of_trips"},
        "market_name": f"if({nameless}, NULL, market_name)",
        "driver_uuid": f"if(city_id = 4 AND {odd}, NULL, driver_uuid)",
        "datestr": f"if(city_id = 4 AND NOT {odd}, NULL, datestr)",
    }
    again = once.filter("city_id < 5 AND market_name = 'M0'").selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in once.columns]
    )
    return once.unionByName(again).withColumn("file_date", export_timestamp("file_name"))


def exported_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once per export that holds it: exports are made on even days, the last of them up
    to three days after the data's last day, so that every event is in one, and reach five days back.

    An event can only be in the exports of the five days after it, so it is repeated for those
    instead of being compared with every export. The events are dealt evenly first: a file may be one
    row group, and the task that reads it would make and sort all their copies.
    """
    whole = events(spark, sf_dir)
    last_export = whole.agg(F.date_add(F.to_date(F.max("ts")), 3).alias("last_export")).scalar()
    return (
        whole.hint("rebalance", "event_id")
        .selectExpr("*", "explode(sequence(date_add(ts, 1), date_add(ts, 5))) AS d")
        .filter("day(d) % 2 = 0")
        .filter(F.col("d") <= last_export)
        .selectExpr("*", "CAST(d AS TIMESTAMP_NTZ) AS _ts_fichero")
    )


def cancels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_events(spark, sf_dir).selectExpr(
        "CAST(ts AS STRING) AS hour",
        f"{_RIDER} AS driver_uuid",
        f"{_ORDER} AS delivery_trip_uuid",
        f"{_ORDER} AS order_id",
        "CASE event_type WHEN 'error' THEN 'CANCEL' WHEN 'signup' THEN 'REJECT' "
        "WHEN 'click' THEN 'CANCEL_NOT_AT_FAULT' WHEN 'view' THEN 'OTHER' END AS event_type",
        "concat('R', CAST(day(d) AS STRING)) AS cancellation_reason_name",
        f"{_EMPTY} AS form_factor",
        "_ts_fichero",
    )


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_events(spark, sf_dir).selectExpr(
        f"{_RIDER} AS driver_uuid",
        f"{_ORDER} AS delivery_trip_uuid",
        f"{_ORDER} AS order_id",
        "CAST(ts AS STRING) AS courier_accept_timestamp_local",
        f"if(event_id % 19 <> 0, double({_SECONDS}), NULL) AS actual_p2_driving",
        "300D AS estimated_p2_driving",
        f"{_SECONDS} / 2D AS actual_p3_driving",
        "900D AS estimated_p3_driving",
        "_ts_fichero",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks are missing on the newest day of a file and on one earlier day of every other file;
    one file lacks the batch column."""
    newest = "to_date(ts) = date_sub(d, 1)"
    earlier = "(to_date(ts) = date_sub(d, 3) AND day(d) % 4 = 0)"
    unmarked = f"(({newest} OR {earlier}) AND event_id % 10 <> 0)"

    def mark(n: int) -> str:
        return f"if({unmarked}, NULL, if(event_id % {n} = 0, '0', '1'))"

    return exported_events(spark, sf_dir).selectExpr(
        f"{_RIDER} AS courier_uuid",
        f"{_ORDER} AS trip_uuid",
        "CAST(ts AS STRING) AS momento",
        "if(event_id % 13 <> 0, value / 10D, NULL) AS km",
        f"{_ORDER} AS order_id",
        f"{mark(3)} AS p2_on_time",
        f"{mark(4)} AS p3_on_time",
        "value AS pickup_approach_minutes",
        "double(floor(value / 2)) AS estimated_pickup_approach_minutes",
        "value AS dropoff_approach_minutes",
        "double(floor(value / 4)) AS estimated_dropoff_approach_minutes",
        "if(d = DATE '2024-01-20', NULL, if(event_id % 5 = 0, 'BATCH', 'NO BATCH')) "
        "AS batch_order",
        "CAST(ts AS STRING) AS courier_accept_timestamp_local",
        f"if(event_id % 11 <> 0, CAST({_LATER} AS STRING), NULL) AS courier_dropoff_timestamp_local",
        f"{_EMPTY} AS form_factor",
        "_ts_fichero",
        "concat('trips_', date_format(d, 'yyyyMMdd'), '_000000.csv') AS _file_name",
        "event_id AS _row",
    )
