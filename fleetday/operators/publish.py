"""Published tables: projection, window, merge by key, deletes and the closed-day marker."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday import schema as S


def resolve_day(final: DataFrame) -> DataFrame:
    """`day`: the logical day if the table has one, else the date of the row."""
    if "_dia" in final.columns:
        return final.withColumnRenamed("_dia", "day")
    return final.withColumn("day", F.to_date("datestr"))


def fill_missing_metrics(final: DataFrame) -> DataFrame:
    defaults = {
        "pct_aceptacion": F.lit(0.0),
        "pct_cancelacion": F.lit(0.0),
        "tph_adj": F.lit(0.0),
        "flow_type": F.lit(None).cast("string"),
    }
    return final.withColumns({c: v for c, v in defaults.items() if c not in final.columns})


def percent_to_ratio(final: DataFrame) -> DataFrame:
    return final.withColumns(
        {
            "pct_accept": F.col("pct_aceptacion") / F.lit(100.0),
            "pct_cancel": F.col("pct_cancelacion") / F.lit(100.0),
        }
    )


def published_projection(final: DataFrame, live: bool = True) -> DataFrame:
    """The published columns, missing ones empty; without `live` the narrower older set."""
    wanted = S.PUBLISHED_COLUMNS + (S.LIVE_COLUMNS if live else [])

    def column(name: str) -> Column:
        if name in final.columns:
            return F.col(name)
        return F.lit(None).cast("string" if name in S.PUBLISHED_TEXT else "double").alias(name)

    return final.select(*[column(c) for c in wanted])


def publish_window(published: DataFrame, as_of: date, window_days: int) -> DataFrame:
    """The last days up to `as_of`, the day as ISO text."""
    first = as_of - timedelta(days=window_days)
    return published.filter(F.col("day") >= F.lit(first)).withColumn(
        "day", F.col("day").cast("string")
    )


def published_daily(
    final: DataFrame, as_of: date, window_days: int, live: bool = True
) -> DataFrame:
    prepared = fill_missing_metrics(resolve_day(final)).withColumnsRenamed(S.PUBLISHED_RENAMES)
    return publish_window(published_projection(percent_to_ratio(prepared), live), as_of, window_days)


def upsert_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace by key. Columns only one side has are empty in the other's rows."""
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def rows_to_delete(
    emptied: DataFrame, uploaded: DataFrame, as_of: date, window_days: int
) -> DataFrame:
    """Emptied (rider, day) keys to remove from the published table.

    Strictly after the first day of the window, so that the day before, which took over the work, is
    published too; and never a key that this run has just uploaded.
    """
    limit = as_of - timedelta(days=window_days)
    inside = emptied.filter(F.col("day") > F.lit(limit)).withColumn(
        "day", F.col("day").cast("string")
    )
    return inside.join(uploaded.select("courier_uuid", "day"), ["courier_uuid", "day"], "left_anti")


def delete_rows(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(deletes.select(*keys), keys, "left_anti")


def days_closed(uploaded: DataFrame, closed_at: str) -> DataFrame:
    """Row count and closing time of every uploaded day."""
    return uploaded.groupBy(F.col("day").alias("dia")).agg(
        F.count("*").alias("filas"), F.lit(closed_at).alias("cerrado_en")
    )
