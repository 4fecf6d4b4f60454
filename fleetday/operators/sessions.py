"""Share of a rider's day that lies before the cutoff hour, from sessions and from offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetday.config import Config
from fleetday.functions.clock import day_start, hours, seconds_between, timestamp_column
from fleetday.functions.numbers import ratio
from fleetday.functions.ordered import with_next


def parse_sessions(connections: DataFrame, cfg: Config) -> DataFrame:
    """Start and end as timestamps; rows without a readable start or without a rider are dropped."""
    start = timestamp_column(connections, "start_time", cfg.timestamp_formats)
    end = timestamp_column(connections, "end_time", cfg.timestamp_formats)
    return connections.select(
        "courier_uuid", "status", start.alias("start_dt"), end.alias("end_dt")
    ).filter(F.col("start_dt").isNotNull() & F.col("courier_uuid").isNotNull())


def close_open_sessions(sessions: DataFrame, cfg: Config) -> DataFrame:
    """`end_eff`: the end, or for an open session the start of the rider's next event of any status."""
    followed = with_next(
        sessions, ["courier_uuid"], "start_dt", ["status", "end_dt"], "next_start", cfg.heavy_rows
    )
    return followed.withColumn("end_eff", F.coalesce("end_dt", "next_start")).drop("next_start")


def work_sessions(closed: DataFrame, cfg: Config) -> DataFrame:
    """Sessions in a working state with an end after the start."""
    return closed.filter(
        F.col("status").isin(*cfg.work_states) & (F.col("end_eff") > F.col("start_dt"))
    )


def split_at_cutoff(sessions: DataFrame, cfg: Config) -> DataFrame:
    """Whole seconds of every session, and those before the cutoff of its start date."""
    start, end = F.col("start_dt"), F.col("end_eff")
    cutoff = day_start(start) + hours(cfg.cutoff_hour)
    early = F.when(start < cutoff, seconds_between(start, F.least(end, cutoff))).otherwise(F.lit(0))
    return sessions.select(
        "courier_uuid",
        "status",
        "start_dt",
        "end_eff",
        F.to_date(start).alias("dia"),
        seconds_between(start, end).alias("seconds"),
        F.greatest(early, F.lit(0)).alias("early_seconds"),
    )


def drop_long_sessions(split: DataFrame, cfg: Config) -> DataFrame:
    """A session longer than the limit is a data error and is dropped whole."""
    return split.filter(F.col("seconds") <= cfg.max_session_hours * 3600)


def share_by_day(split: DataFrame) -> DataFrame:
    """Hours, early hours and early share per (rider, calendar date).

    Seconds are summed as integers and divided once, so the result does not depend on row order.
    """
    totals = split.groupBy("courier_uuid", "dia").agg(
        F.sum("seconds").alias("seconds"), F.sum("early_seconds").alias("early")
    )
    share = F.least(ratio(F.col("early"), F.col("seconds")), F.lit(1.0))
    return totals.select(
        "courier_uuid",
        "dia",
        share.alias("frac_horas"),
        (F.col("seconds") / F.lit(3600.0)).alias("horas_conn"),
        (F.col("early") / F.lit(3600.0)).alias("horas_madrugada"),
    )


def closed_sessions(connections: DataFrame, cfg: Config) -> DataFrame:
    closed = close_open_sessions(parse_sessions(connections, cfg), cfg)
    return drop_long_sessions(split_at_cutoff(work_sessions(closed, cfg), cfg), cfg)


def early_share(connections: DataFrame, cfg: Config) -> DataFrame:
    return share_by_day(closed_sessions(connections, cfg))


def offer_early_share(offers: DataFrame, cfg: Config) -> DataFrame:
    """Share of accepted offers before the cutoff hour per (rider, calendar date)."""
    ts = timestamp_column(offers, "timestamp", cfg.timestamp_formats)
    accepted = offers.filter(F.col("courier_action") == "ACCEPT").select(
        "courier_uuid", ts.alias("ts")
    )
    totals = (
        accepted.filter(F.col("ts").isNotNull())
        .groupBy("courier_uuid", F.to_date("ts").alias("dia"))
        .agg(
            F.count("*").alias("rta_total"),
            F.count_if(F.hour("ts") < cfg.cutoff_hour).alias("rta_madrugada"),
        )
    )
    return totals.select(
        "courier_uuid",
        "dia",
        ratio(F.col("rta_madrugada"), F.col("rta_total")).alias("frac_rta"),
        "rta_total",
        "rta_madrugada",
    )
