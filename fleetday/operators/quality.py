"""Cleaning, quality profiles and integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from fleetday.config import Config
from fleetday.functions.numbers import ratio


def _no_work():
    def zero(column: str):
        return F.coalesce(F.col(column), F.lit(0.0)) == 0

    return zero("num_of_trips") & zero("online_hours")


def emptied_keys(final: DataFrame) -> DataFrame:
    """(rider, day) that the cutoff rule left without trips and hours."""
    if "_frac_horas_dbg" not in final.columns:
        return final.sparkSession.createDataFrame([], "courier_uuid string, day date")
    return (
        final.filter((F.col("_frac_horas_dbg") > 0) & _no_work())
        .select(F.col("driver_uuid").alias("courier_uuid"), F.to_date("datestr").alias("day"))
        .distinct()
    )


def drop_empty_days(final: DataFrame) -> DataFrame:
    return final.filter(~_no_work())


def utilisation_by_weekday(final: DataFrame, cfg: Config) -> DataFrame:
    """Rows and mean active/online per ISO weekday, and whether enough rows qualify to rely on it."""
    day = F.col("_dia") if "_dia" in final.columns else F.to_date("datestr")
    by_weekday = (
        final.filter(
            (F.col("online_hours") > cfg.qc_min_online_hours)
            & (F.col("active_hours") > cfg.qc_min_active_hours)
        )
        .groupBy((F.weekday(day) + 1).alias("weekday"))
        .agg(
            F.count("*").alias("rows"),
            F.avg(ratio(F.col("active_hours"), F.col("online_hours"))).alias("utilisation"),
        )
    )
    # seven rows at most
    everything = Window.partitionBy(F.lit(0))
    enough = F.sum("rows").over(everything) > cfg.qc_min_rows
    return by_weekday.withColumn("enough_rows", enough).orderBy("weekday")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_rider_days(final: DataFrame) -> DataFrame:
    return duplicate_keys(
        final.select("driver_uuid", F.to_date("datestr").alias("day")), ["driver_uuid", "day"]
    )


def step_rows(steps: dict[str, DataFrame]) -> DataFrame:
    """Row count of every step of a run."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("step"), "rows")
        for name, df in steps.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def counting(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """`df`, and what its next write counts on the way: its rows, and those that the cutoff rule touched."""
    seen = Observation(name)
    rule = "ajustado_connections"
    touched = F.count_if(F.col(rule)) if rule in df.columns else F.lit(None).cast("long")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), touched.alias("adjusted")), seen


def moved_rows(final: DataFrame) -> DataFrame:
    """One row: rows of the daily table and how many of them the cutoff rule touched."""
    return final.agg(
        F.count("*").alias("rows"), F.count_if("ajustado_connections").alias("adjusted")
    )
