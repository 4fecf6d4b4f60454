"""Per-order feeds: cancellations, delays and kilometres."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.functions.clock import logical_day, timestamp_column
from fleetday.functions.dedup import keep_latest, keep_one
from fleetday.functions.joins import salted_join
from fleetday.functions.numbers import double_column
from fleetday.functions.ordered import with_previous_max

_FILE = "_ts_fichero"
_ACCEPT, _DROPOFF = "courier_accept_timestamp_local", "courier_dropoff_timestamp_local"


def _day(df: DataFrame, column: str, cfg: Config) -> Column:
    return logical_day(timestamp_column(df, column, cfg.timestamp_formats), cfg.cutoff_hour)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _iso(day: str = "day") -> Column:
    return F.col(day).cast("string").alias("day")


def _dated(dated: bool) -> list[str]:
    """The file time of each row, for a merge in which the newest file wins."""
    return [_FILE] if dated else []


def cancel_events(cancels: DataFrame, cfg: Config, dated: bool = False) -> DataFrame:
    """Cancellations and rejections, one row per (rider, order, type) from the newest file."""
    usable = (
        cancels.filter(
            F.col("event_type").isin(*cfg.event_types)
            & F.col("driver_uuid").isNotNull()
            & F.col("delivery_trip_uuid").isNotNull()
        )
        .withColumn("day", _day(cancels, "hour", cfg))
        .filter(F.col("day").isNotNull())
    )
    latest = keep_latest(usable, ["delivery_trip_uuid", "driver_uuid", "event_type"])
    return latest.select(
        F.col("driver_uuid").alias("courier_uuid"),
        "delivery_trip_uuid",
        "event_type",
        _iso(),
        "order_id",
        F.col("cancellation_reason_name").alias("reason"),
        "form_factor",
        *_dated(dated),
    )


def late_events(late: DataFrame, cfg: Config, dated: bool = False) -> DataFrame:
    """Delay of each leg in seconds, one row per (rider, order) from the newest file."""
    limit = cfg.late_minutes * 60
    usable = (
        late.withColumns(
            {
                "day": _day(late, "courier_accept_timestamp_local", cfg),
                "retraso_p2": double_column(late, "actual_p2_driving")
                - double_column(late, "estimated_p2_driving"),
                "retraso_p3": double_column(late, "actual_p3_driving")
                - double_column(late, "estimated_p3_driving"),
            }
        )
        .filter(
            F.col("driver_uuid").isNotNull()
            & F.col("delivery_trip_uuid").isNotNull()
            & F.col("day").isNotNull()
        )
        .select("driver_uuid", "delivery_trip_uuid", "day", "order_id", "retraso_p2", "retraso_p3", _FILE)
    )
    latest = keep_latest(usable, ["delivery_trip_uuid", "driver_uuid"])
    return latest.select(
        F.col("driver_uuid").alias("courier_uuid"),
        "delivery_trip_uuid",
        _iso(),
        "order_id",
        "retraso_p2",
        "retraso_p3",
        _true(F.col("retraso_p2") > limit).alias("tarde_p2"),
        _true(F.col("retraso_p3") > limit).alias("tarde_p3"),
        *_dated(dated),
    )


def order_km(trips: DataFrame, cfg: Config, dated: bool = False) -> DataFrame:
    """Kilometres per (rider, order) from the newest file that has them."""
    usable = trips.select(
        "courier_uuid",
        "trip_uuid",
        _day(trips, "momento", cfg).alias("day"),
        double_column(trips, "km").alias("km"),
        "form_factor",
        _FILE,
    ).filter(
        F.col("courier_uuid").isNotNull()
        & F.col("trip_uuid").isNotNull()
        & F.col("day").isNotNull()
        & F.col("km").isNotNull()
    )
    latest = keep_latest(usable, ["trip_uuid", "courier_uuid"])
    return latest.select("courier_uuid", "trip_uuid", _iso(), "km", "form_factor", *_dated(dated))


def usable_trips(trips: DataFrame, cfg: Config) -> DataFrame:
    """Orders with a rider, an acceptance time and a day; one row per order and file.

    The same order can come twice in a file; the first one in file order counts. Several operators
    below read the result more than once, so a plan stores it before going on.
    """
    in_file = [c for c in ("_file_name", "_row") if c in trips.columns]
    timed = trips.select(
        _FILE,
        "courier_uuid",
        "trip_uuid",
        *in_file,
        *[c for c in S.TRIP_OPTIONAL if c not in (_ACCEPT, _DROPOFF)],
        F.col(_DROPOFF).isNotNull().alias("_has_dropoff"),
        timestamp_column(trips, _ACCEPT, cfg.timestamp_formats).alias("_acepta"),
        timestamp_column(trips, _DROPOFF, cfg.timestamp_formats).alias("_entrega"),
        _day(trips, "momento", cfg).alias("day"),
    ).filter(
        F.col("courier_uuid").isNotNull()
        & F.col("trip_uuid").isNotNull()
        & F.col("_acepta").isNotNull()
        & F.col("day").isNotNull()
    )
    order = [F.col(c).asc_nulls_last() for c in in_file]
    key = ["trip_uuid", "courier_uuid", _FILE]  # sorted by the column that differs most
    return keep_one(timed, key, order, unique="_row" in in_file)


def chained_orders(orders: DataFrame, cfg: Config) -> DataFrame:
    """`_chained`: accepted before the rider had dropped off every earlier order of the file.

    An order without a drop-off time counts with its acceptance.
    """
    ties = [c for c in ("_file_name", "_row") if c in orders.columns] + ["trip_uuid"]
    followed = with_previous_max(
        orders,
        [_FILE, "courier_uuid"],
        "_acepta",
        ties,
        F.coalesce("_entrega", "_acepta"),
        "_entrega_previa",
        cfg.heavy_rows,
    )
    return followed.withColumn("_chained", _true(F.col("_acepta") < F.col("_entrega_previa")))


def legacy_late_flags(chained: DataFrame, cfg: Config) -> DataFrame:
    """Delay of each leg in minutes and whether it counts as late under the older measure.

    A leg is late if the order was on its own (no batch, no chain), took more than the limit over
    the estimate and carries the off-time mark. The mark is compared as text.
    """
    alone = _true(F.col("batch_order") == "NO BATCH") & ~F.col("_chained")

    def over(actual: str, estimated: str) -> Column:
        return double_column(chained, actual) - double_column(chained, estimated)

    def late(leg: str) -> Column:
        over_limit = F.col(f"retraso_{leg}") > cfg.late_minutes
        return _true(F.col("_suelto") & over_limit & (F.col(f"{leg}_on_time") == "0"))

    return chained.withColumns(
        {
            "_suelto": alone,
            "retraso_p2": over("pickup_approach_minutes", "estimated_pickup_approach_minutes"),
            "retraso_p3": over("dropoff_approach_minutes", "estimated_dropoff_approach_minutes"),
        }
    ).withColumns({"tarde_p2": late("p2"), "tarde_p3": late("p3")})


def file_days(orders: DataFrame, cfg: Config) -> DataFrame:
    """One row per (file, day) with the three conditions for using that day of the file.

    `complete`: the file fills each measure column somewhere. `marked`: enough orders of the day
    carry an on-time mark. `interior`: neither the first nor the last day of the file.

    Everything is counted per (file, day) before any row is compared with another; the window over a
    file only sees that file's days.
    """
    marked = F.col("p2_on_time").isNotNull() | F.col("p3_on_time").isNotNull()
    # a usable order always has its acceptance
    filled = {c: F.col(c).isNotNull() for c in S.TRIP_MEASURES if c not in (_ACCEPT, _DROPOFF)}
    filled["dropoff"] = F.col("_has_dropoff")
    per_day = orders.groupBy(_FILE, "day").agg(
        F.count("*").alias("orders"),
        F.count_if(marked).alias("marked_orders"),
        *[F.bool_or(present).alias(f"_filled_{c}") for c, present in filled.items()],
    )
    per_file = Window.partitionBy(_FILE)
    complete = reduce(and_, [F.bool_or(f"_filled_{c}").over(per_file) for c in filled])
    return per_day.select(
        _FILE,
        "day",
        "orders",
        "marked_orders",
        complete.alias("complete"),
        (F.col("marked_orders") / F.col("orders") >= cfg.min_marked_share).alias("marked"),
        (
            (F.col("day") > F.min("day").over(per_file))
            & (F.col("day") < F.max("day").over(per_file))
        ).alias("interior"),
    )


def valid_days(orders: DataFrame, cfg: Config) -> DataFrame:
    return file_days(orders, cfg).filter("complete AND marked AND interior").select(_FILE, "day")


def incomplete_files(orders: DataFrame, cfg: Config) -> DataFrame:
    """One row: number of files that lack a measure column."""
    return (
        file_days(orders, cfg)
        .filter(~F.col("complete"))
        .agg(F.count_distinct(_FILE).alias("incomplete_files"))
    )


def mark_valid_days(orders: DataFrame, valid: DataFrame, cfg: Config) -> DataFrame:
    """Every order with `_dia_valido`: whether its day of its file is in `valid`."""
    checked = valid.withColumn("_valid", F.lit(True))
    joined = salted_join(
        orders, checked, [_FILE, "day"], ["courier_uuid", "trip_uuid"], "left", cfg.salts
    )
    return joined.withColumn("_dia_valido", _true(F.col("_valid"))).drop("_valid")


def marked_trips(orders: DataFrame, cfg: Config) -> DataFrame:
    """All usable orders with their delays, late flags and the validity of their day."""
    flagged = legacy_late_flags(chained_orders(orders, cfg), cfg)
    return mark_valid_days(flagged, valid_days(orders, cfg), cfg)


def trip_delays(orders: DataFrame, cfg: Config, dated: bool = False) -> DataFrame:
    """Orders marked off-time, from valid days after the late report ended, newest file first."""
    off_time = _true((F.col("p2_on_time") == "0") | (F.col("p3_on_time") == "0"))
    flagged = legacy_late_flags(chained_orders(orders, cfg), cfg)
    candidates = flagged.filter(
        off_time & (F.col("day") >= F.lit(cfg.first_day_without_late_report))
    ).select(
        "courier_uuid", "trip_uuid", "day", "order_id",
        "retraso_p2", "retraso_p3", "tarde_p2", "tarde_p3", _FILE,
    )
    usable = salted_join(
        candidates,
        valid_days(orders, cfg),
        [_FILE, "day"],
        ["courier_uuid", "trip_uuid"],
        "left_semi",
        cfg.salts,
    )
    latest = keep_latest(usable, ["trip_uuid", "courier_uuid"])
    return latest.select(
        "courier_uuid",
        F.col("trip_uuid").alias("delivery_trip_uuid"),
        _iso(),
        "order_id",
        "retraso_p2",
        "retraso_p3",
        "tarde_p2",
        "tarde_p3",
        *_dated(dated),
    )
