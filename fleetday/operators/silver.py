"""Silver: one row per (rider, day) from the newest export of that day, summed over markets."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.functions.clock import days
from fleetday.functions.dedup import keep_one

RIDER_DAY = ["driver_uuid", "datestr"]
_TRACE_COLUMNS = [
    "datestr", "market_name", "city_name", "file_name",
    "online_hours", "active_hours", "num_of_trips",
]


def valid_daily(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("datestr").isNotNull() & F.col("driver_uuid").isNotNull())


def recent_cutoff(bronze: DataFrame, cfg: Config) -> Column:
    """First day that is recomputed, counted back from the newest day in the data.

    One day more than is published: the first published day needs the day before it as the
    destination of its early hours. The newest day of the bronze is the newest day of the silver, so
    this is a scalar subquery over one column and can be used at any scan.
    """
    back = max(timedelta(weeks=cfg.reprocess_weeks), timedelta(days=cfg.sync_days))
    back += timedelta(days=1)
    newest = valid_daily(bronze).agg(F.max("datestr").alias("newest")).scalar()
    return newest - days(back.days)


def recent_window(bronze: DataFrame, cfg: Config) -> DataFrame:
    """Rows of the days that are recomputed; prunes the days of a table stored by day."""
    cutoff = recent_cutoff(bronze, cfg)
    recent = valid_daily(bronze).filter(F.col("datestr") >= cutoff)
    if S.BRONZE_DAY in bronze.columns:
        recent = recent.filter(F.col(S.BRONZE_DAY) >= F.to_date(cutoff))
    return recent


def best_row_per_market(valid: DataFrame) -> DataFrame:
    """One row per (rider, day, market): the newest export first, then the most trips.

    Every map task sends at most one row per market, however often a day was exported again.
    """
    return keep_one(
        valid,
        [*RIDER_DAY, *S.MARKET_COLUMNS],
        [F.col("file_date").desc_nulls_last(), F.col("num_of_trips").desc_nulls_last()],
    )


def latest_export(valid: DataFrame) -> DataFrame:
    """All rows of the newest export that holds the (rider, day); exports are never mixed."""
    rank = F.rank().over(Window.partitionBy(*RIDER_DAY).orderBy(F.col("file_date").desc()))
    return valid.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_markets(valid: DataFrame) -> DataFrame:
    """One row per market of the newest export of each (rider, day).

    Reducing to markets first gives the same rows as picking the export first: a market of the
    newest export is represented by its row in that export, any other market by an older file that
    the second step removes. The first step is what keeps one rider's exports out of a single task.
    """
    return latest_export(best_row_per_market(valid))


def sum_markets(markets: DataFrame) -> DataFrame:
    """Totals per (rider, day) and the identity of the market with the most trips.

    A column that is empty in every row sums to 0, except the late counters: empty there means
    "not measured" and stays empty.
    """
    by_trips = (
        "PARTITION BY driver_uuid, datestr "
        "ORDER BY num_of_trips DESC NULLS LAST, market_name, city_id, city_name"
    )
    whole_day = f"({by_trips} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"

    def total(column: str) -> str:
        day_sum = f"sum({column}) OVER {whole_day}"
        return day_sum if column in S.LATE_COUNTERS else f"coalesce({day_sum}, 0D)"

    return (
        markets.selectExpr(
            *RIDER_DAY,
            *[f"{total(c)} AS {c}" for c in S.SUMMED_COLUMNS],
            *S.IDENTITY_COLUMNS,
            f"row_number() OVER ({by_trips}) AS _position",
        )
        .filter("_position = 1")
        .drop("_position")
    )


def recompute_averages(silver: DataFrame) -> DataFrame:
    per_trip = "if(num_of_trips > 0, {0} / num_of_trips, 0D) AS {0}_avg"
    return silver.selectExpr("*", *[per_trip.format(c) for c in S.DISTANCE_COLUMNS])


def build_silver(bronze: DataFrame, cfg: Config, whole_history: bool = False) -> DataFrame:
    valid = valid_daily(bronze) if whole_history else recent_window(bronze, cfg)
    return recompute_averages(sum_markets(latest_markets(valid)))


def multi_market_count(bronze: DataFrame) -> DataFrame:
    """(rider, day) pairs seen in more than one market; an empty market name counts as one."""
    market = F.col("market_name")
    distinct = F.count_distinct(market) + F.max(F.when(market.isNull(), 1).otherwise(0))
    return (
        valid_daily(bronze)
        .groupBy(*RIDER_DAY)
        .agg(distinct.cast("long").alias("markets"))
        .filter("markets > 1")
    )


def trace_rider(bronze: DataFrame, rider: str) -> DataFrame:
    """The raw rows of one rider by day, to compare a single case with its source."""
    columns = [c for c in _TRACE_COLUMNS if c in bronze.columns]
    return (
        valid_daily(bronze)
        .filter(F.col("driver_uuid") == rider)
        .orderBy("datestr", "file_name", "market_name")
        .select(*columns)
    )

