"""The cutoff rule: move the early share of every total from a day to the day before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.functions.numbers import ratio

_SESSION_SHARE = "courier_uuid string, dia date, frac_horas double, horas_conn double"
_OFFER_SHARE = "courier_uuid string, dia date, frac_rta double, rta_madrugada long"


def _total(column: str) -> str:
    """SQL for a total with empty as 0; the late counters stay empty."""
    return column if column in S.LATE_COUNTERS else f"coalesce({column}, 0D)"


def _offered(column: str) -> str:
    amount = f"{_total(column)} * frac_horas"
    return f"bround({amount}, 0)" if column in S.COUNT_COLUMNS else amount


def attach_shares(
    silver: DataFrame, sessions: DataFrame | None, offers: DataFrame | None
) -> DataFrame:
    """Silver rows with both shares of their calendar date, 0 where a source has none."""
    spark = silver.sparkSession
    if sessions is None:
        sessions = spark.createDataFrame([], _SESSION_SHARE)
    if offers is None:
        offers = spark.createDataFrame([], _OFFER_SHARE)
    day_key = [F.col("courier_uuid").alias("driver_uuid"), F.col("dia").alias("_dia")]
    by_session = sessions.select(*day_key, "frac_horas", "horas_conn")
    by_offer = offers.select(*day_key, "frac_rta", "rta_madrugada")
    key = ["driver_uuid", "_dia"]
    return (
        silver.withColumn("_dia", F.to_date("datestr"))
        .join(by_session, key, "left")
        .join(by_offer, key, "left")
        .withColumns(
            {
                "frac_horas": F.coalesce("frac_horas", F.lit(0.0)),
                "frac_rta": F.coalesce("frac_rta", F.lit(0.0)),
                "rta_madrugada": F.coalesce("rta_madrugada", F.lit(0)),
            }
        )
    )


def transfer(shared: DataFrame) -> DataFrame:
    """Subtract what leaves each day and add what arrives from the day after, in one pass.

    Counts move rounded half to even, hours, kilometres and minutes exactly. Nothing leaves a day
    whose rider has no row for the day before. What arrives at a row always has a destination (the
    row itself), so it is taken from the unmoved totals of the next day and both directions fit in
    one window over the rider's days. That group is one row per day of the recomputed weeks.

    Adds `_early_share` (the share after the destination check), `_has_next`, `mv_*` and `in_*`.
    """
    days = "PARTITION BY driver_uuid ORDER BY unix_date(_dia) RANGE BETWEEN"
    day_before = f"({days} 1 PRECEDING AND 1 PRECEDING)"
    day_after = f"({days} 1 FOLLOWING AND 1 FOLLOWING)"
    kept = [c for c in shared.columns if c not in S.MOVED_COLUMNS]

    offered = shared.selectExpr("*", *[f"{_offered(c)} AS mv_{c}" for c in S.MOVED_COLUMNS])
    seen = offered.selectExpr(
        "*",
        f"count(*) OVER {day_before} > 0 AS _has_previous",
        f"count(*) OVER {day_after} > 0 AS _has_next",
        *[f"sum(mv_{c}) OVER {day_after} AS in_{c}" for c in S.MOVED_COLUMNS],
    )
    settled = seen.selectExpr(
        *kept,
        *S.MOVED_COLUMNS,
        "_has_next",
        "if(_has_previous, frac_horas, 0D) AS _early_share",
        *[f"if(_has_previous, mv_{c}, {_total(c)} * 0D) AS mv_{c}" for c in S.MOVED_COLUMNS],
        *[f"coalesce(in_{c}, 0D) AS in_{c}" for c in S.MOVED_COLUMNS],
    )
    return settled.selectExpr(
        *kept,
        "_has_next",
        "_early_share",
        *[f"{_total(c)} - mv_{c} + in_{c} AS {c}" for c in S.MOVED_COLUMNS],
        *[f"{p}_{c}" for p in ("mv", "in") for c in S.MOVED_COLUMNS],
    )


def derived_rates(moved: DataFrame) -> DataFrame:
    """Trips per hour, acceptance % and cancellation % of the moved totals."""
    accept, reject = F.col("accept_trips"), F.col("reject_trips")
    return moved.withColumns(
        {
            "tph_adj": ratio(F.col("num_of_trips"), F.col("online_hours")),
            "pct_aceptacion": ratio(accept, accept + reject) * 100,
            "pct_cancelacion": ratio(F.col("cancel_trips"), accept) * 100,
        }
    )


def adjusted_flag(moved: DataFrame) -> DataFrame:
    """True if a share left the day, or if the rider has a row for the day after."""
    return moved.withColumn(
        "ajustado_connections", (F.col("_early_share") > 0) | F.col("_has_next")
    )


def drop_helpers(moved: DataFrame) -> DataFrame:
    """The public columns; the shares stay for inspection under their debug names."""
    helpers = [f"{p}_{c}" for c in S.MOVED_COLUMNS for p in ("mv", "in")]
    return moved.withColumns(
        {"_frac_horas_dbg": F.col("_early_share"), "_frac_rta_dbg": F.col("frac_rta")}
    ).drop(
        "frac_rta", "frac_horas", "rta_madrugada", "horas_conn",
        "_early_share", "_has_next", *helpers,
    )


def apply_transfer(
    silver: DataFrame, sessions: DataFrame | None, offers: DataFrame | None
) -> DataFrame:
    """The whole rule; without any source the totals stay as they are."""
    if sessions is None and offers is None:
        return unadjusted(silver)
    moved = transfer(attach_shares(silver, sessions, offers))
    return drop_helpers(adjusted_flag(derived_rates(moved)))


def unadjusted(silver: DataFrame) -> DataFrame:
    """Trips per hour only: no source to measure the early share with."""
    return silver.withColumns(
        {
            "tph_adj": ratio(F.col("num_of_trips"), F.col("online_hours")),
            "ajustado_connections": F.lit(False),
            "_frac_rta_dbg": F.lit(0.0),
            "_frac_horas_dbg": F.lit(0.0),
        }
    )


def hours_mismatch(shared: DataFrame, cfg: Config) -> DataFrame:
    """One row: days whose session hours and reported hours differ by more than the limit."""
    gap = F.abs(F.col("horas_conn") - F.col("online_hours"))
    counted = shared.agg(
        F.count_if(gap > cfg.mismatch_hours).alias("mismatched"), F.count("*").alias("rows")
    )
    pct = F.lit(100.0) * F.col("mismatched") / F.greatest(F.col("rows"), F.lit(1))
    return counted.withColumn("pct", pct).withColumn("alert", F.col("pct") > cfg.mismatch_alert_pct)


def without_destination(shared: DataFrame) -> DataFrame:
    """Rows with an early share but no day before to move it to; they keep their totals."""
    by_day = Window.partitionBy("driver_uuid").orderBy(F.unix_date("_dia")).rangeBetween(-1, -1)
    return (
        shared.withColumn("_previous", F.count(F.lit(1)).over(by_day))
        .filter((F.col("frac_horas") > 0) & (F.col("_previous") == 0))
        .drop("_previous")
    )
