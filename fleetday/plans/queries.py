"""Registered queries: every operator on the whole of its derived input table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.functions.clock import export_timestamp, logical_day, parse_ts
from fleetday.functions.dedup import keep_first, keep_latest, keep_one
from fleetday.operators import bronze as B
from fleetday.operators import orders as O
from fleetday.operators import publish as P
from fleetday.operators import quality as Q
from fleetday.operators import sessions as N
from fleetday.operators import silver as V
from fleetday.operators import transfer as T
from fleetday.plans import fixtures as X
from fleetday.plans import orders as R
from fleetday.plans.daily import DailyTables, daily_tables
from fleetday.plans.publish import publish_daily, publish_events as publish_feeds
from fleetday.sources.publication import read_published
from fleetday.sources.tables import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]
CFG = X.CONFIG
_SHARE = ["frac_horas", "horas_conn", "horas_madrugada"]


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as ISO text, so that both engines return the same type."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# ------------------------------------------------------------------ bronze


def logical_day_counts(spark, sf_dir):
    day = logical_day(F.col("ts"), CFG.cutoff_hour)
    counted = X.events(spark, sf_dir).groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    return _text(counted, "day")


def parsed_dates(spark, sf_dir):
    """Times of all events, written in five forms by their number, and read again."""
    written = F.expr(
        """CASE event_id % 5
             WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 1 THEN date_format(ts, 'yyyy/MM/dd HH:mm:ss')
             WHEN 2 THEN date_format(ts, 'd/M/yyyy H:mm:ss') WHEN 3 THEN date_format(ts, 'yyyy-M-d')
             ELSE date_format(ts, 'dd-MM-yyyy HH:mm:ss') END"""
    )
    return _text(X.events(spark, sf_dir).select("event_id", parse_ts(written).alias("parsed")), "parsed")


def dedup_keep_first(spark, sf_dir):
    rows = X.overlapping_connections(spark, sf_dir)
    return keep_first(rows, S.CONNECTION_KEY, ["conn_file"]).select(
        *S.CONNECTION_KEY, "end_time", "conn_file"
    )


def dedup_offers(spark, sf_dir):
    rows = X.overlapping_offers(spark, sf_dir)
    return keep_first(rows, S.OFFER_KEY, ["rta_file", "timestamp"]).select(
        "offer_id", "timestamp", "courier_uuid", "courier_action", "email", "rta_file"
    )


def ingest_first_wins(spark, sf_dir):
    """Bronze holding the earlier export plus what the whole export adds to it."""
    both = X.overlapping_connections(spark, sf_dir)
    stored = both.filter(F.col("conn_file").contains("20240116"))
    new = both.filter(~F.col("conn_file").contains("20240116"))
    added = B.first_wins(stored, new, S.CONNECTION_KEY, ["conn_file"])
    return B.append_rows(stored, added).select(*S.CONNECTION_KEY, "end_time", "conn_file")


def dedup_latest_by_file(spark, sf_dir):
    latest = keep_latest(X.trips(spark, sf_dir), ["courier_uuid", "trip_uuid"])
    return _text(
        latest.select("courier_uuid", "trip_uuid", "momento", "km", "p2_on_time", "_ts_fichero"),
        "_ts_fichero",
    )


def latest_lineitem(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    latest = keep_one(
        rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()]
    )
    return _text(latest, "l_shipdate")


def prune_retention(spark, sf_dir):
    rows = X.overlapping_connections(spark, sf_dir)
    return B.prune_retention(rows, "start_time", X.PRUNE_AS_OF, CFG).select(
        *S.CONNECTION_KEY, "end_time", "conn_file"
    )


def _files(daily: DataFrame) -> DataFrame:
    return daily.select("file_name").distinct()


def ledger_new_files(spark, sf_dir):
    """Bronze holds the exports before the newest one; the newest is still to be read."""
    daily = X.daily(spark, sf_dir)
    bronze = daily.filter(F.col("file_date") < F.lit(X.REPROCESS_SINCE))
    return B.new_files(_files(daily), bronze, "file_name")


def reprocess_from(spark, sf_dir):
    daily = X.daily(spark, sf_dir)
    kept = B.reprocess_from(
        daily, _files(daily), X.REPROCESS_SINCE, ["driver_uuid", "datestr"], CFG
    )
    return _text(
        kept.select("driver_uuid", "datestr", "market_name", "file_name", "num_of_trips"), "datestr"
    )


def catch_up_days(spark, sf_dir):
    return B.catch_up_days(X.offers(spark, sf_dir), X.connections(spark, sf_dir), X.AS_OF, CFG)


def export_times(spark, sf_dir):
    files = (
        X.trips(spark, sf_dir).select(F.col("_file_name").alias("file_name"))
        .unionByName(X.daily(spark, sf_dir).select("file_name"))
        .groupBy("file_name")
        .agg(F.count("*").alias("rows"))
    )
    return _text(files.withColumn("export_time", export_timestamp("file_name")), "export_time")


# ------------------------------------------------------------------ silver

_MARKET_ROW = [
    "driver_uuid", "datestr", "city_id", "city_name", "market_name", "file_name",
    "num_of_trips", "online_hours",
]


def latest_export(spark, sf_dir):
    rows = V.latest_export(V.valid_daily(X.daily(spark, sf_dir)))
    return _text(rows.select(*_MARKET_ROW), "datestr")


def market_dedup(spark, sf_dir):
    rows = V.latest_markets(V.valid_daily(X.daily(spark, sf_dir)))
    return _text(rows.select(*_MARKET_ROW), "datestr")


def silver(spark, sf_dir):
    return _text(V.build_silver(X.daily(spark, sf_dir), CFG, True), "datestr", "weekstr")


def silver_window(spark, sf_dir):
    return _text(V.build_silver(X.daily(spark, sf_dir), CFG), "datestr", "weekstr")


def multi_market(spark, sf_dir):
    return _text(V.multi_market_count(X.daily(spark, sf_dir)), "datestr")


def trace_rider(spark, sf_dir):
    """The rider is the argument of this operator; the filter runs over the whole bronze."""
    return _text(V.trace_rider(X.daily(spark, sf_dir), "7"), "datestr")


# ---------------------------------------------------------------- sessions


def closed_sessions(spark, sf_dir):
    rows = N.closed_sessions(X.connections(spark, sf_dir), CFG)
    return _text(rows, "start_dt", "end_eff", "dia")


def early_share(spark, sf_dir):
    return _text(N.early_share(X.connections(spark, sf_dir), CFG), "dia")


def offer_early_share(spark, sf_dir):
    return _text(N.offer_early_share(X.offers(spark, sf_dir), CFG), "dia")


# ---------------------------------------------------------------- transfer


def _shared(spark, sf_dir) -> DataFrame:
    return T.attach_shares(
        V.build_silver(X.daily(spark, sf_dir), CFG, True),
        N.early_share(X.connections(spark, sf_dir), CFG),
        N.offer_early_share(X.offers(spark, sf_dir), CFG),
    )


def _tables(spark, sf_dir) -> DailyTables:
    return daily_tables(
        X.daily(spark, sf_dir), X.connections(spark, sf_dir), X.offers(spark, sf_dir), CFG, True
    )


def attached_shares(spark, sf_dir):
    shared = _shared(spark, sf_dir)
    return _text(
        shared.select("driver_uuid", "_dia", "frac_horas", "frac_rta", "rta_madrugada"), "_dia"
    )


def moved_amounts(spark, sf_dir):
    moved = T.transfer(_shared(spark, sf_dir))
    return _text(
        moved.select("driver_uuid", "_dia", *[f"mv_{c}" for c in S.MOVED_COLUMNS]), "_dia"
    )


def transfer(spark, sf_dir):
    moved = T.transfer(_shared(spark, sf_dir))
    return _text(moved.select("driver_uuid", "_dia", *S.MOVED_COLUMNS), "_dia")


def rates(spark, sf_dir):
    rated = T.derived_rates(T.transfer(_shared(spark, sf_dir)))
    return _text(
        rated.select("driver_uuid", "_dia", "tph_adj", "pct_aceptacion", "pct_cancelacion"), "_dia"
    )


def adjusted_flag(spark, sf_dir):
    flagged = T.adjusted_flag(T.transfer(_shared(spark, sf_dir)))
    return _text(flagged.select("driver_uuid", "_dia", "ajustado_connections"), "_dia")


def without_destination(spark, sf_dir):
    rows = T.without_destination(_shared(spark, sf_dir))
    return _text(rows.select("driver_uuid", "_dia", "frac_horas"), "_dia")


def final_daily(spark, sf_dir):
    return _text(_tables(spark, sf_dir).final, "datestr", "weekstr", "_dia")


def unadjusted_daily(spark, sf_dir):
    tables = daily_tables(X.daily(spark, sf_dir), None, None, CFG, True)
    return _text(tables.final, "datestr", "weekstr")


# ----------------------------------------------------------------- quality


def hours_mismatch(spark, sf_dir):
    return T.hours_mismatch(_shared(spark, sf_dir), CFG)


def emptied_keys(spark, sf_dir):
    return _text(_tables(spark, sf_dir).emptied, "day")


def utilisation_weekday(spark, sf_dir):
    profile = Q.utilisation_by_weekday(_tables(spark, sf_dir).final, CFG)
    # means of doubles depend on the order of rows in their last digits
    return profile.withColumns(
        {"weekday": F.col("weekday").cast("long"), "utilisation": F.round("utilisation", 6)}
    )


def duplicate_keys(spark, sf_dir):
    """On the bronze, where several exports and markets repeat a (rider, day)."""
    return _text(Q.duplicate_rider_days(X.daily(spark, sf_dir)), "day")


def step_rows(spark, sf_dir):
    daily = X.daily(spark, sf_dir)
    tables = _tables(spark, sf_dir)
    tables.adjusted = stage(tables.adjusted, "adjusted")  # counted before and after its empty days go
    return Q.step_rows(
        {"bronze": daily, "silver": tables.silver, "adjusted": tables.adjusted, "final": tables.final}
    )


def moved_rows(spark, sf_dir):
    return Q.moved_rows(_tables(spark, sf_dir).adjusted)


# ----------------------------------------------------------------- publish


def published_daily(spark, sf_dir):
    return P.published_daily(_tables(spark, sf_dir).final, X.PUBLISH_AS_OF, CFG.sync_days)


def published_daily_narrow(spark, sf_dir):
    """The 21-day window and 17 columns of a target without the live columns."""
    return P.published_daily(_tables(spark, sf_dir).final, X.PUBLISH_AS_OF, 21, live=False)


def _earlier_published(spark, sf_dir) -> DataFrame:
    """What a run before the sessions arrived had published: every day, nothing moved."""
    early = daily_tables(X.daily(spark, sf_dir), None, None, CFG, True).final
    days = (X.PUBLISH_AS_OF - X.CONFIG.first_day_without_late_report) + timedelta(days=30)
    return P.published_daily(early, X.PUBLISH_AS_OF, days.days)


def upsert_merge(spark, sf_dir):
    updates = stage(published_daily(spark, sf_dir), "updates")  # read for its keys and for its rows
    return P.upsert_rows(_earlier_published(spark, sf_dir), updates, S.TABLE_KEYS[S.DAILY_STATS])


def delete_emptied(spark, sf_dir):
    """The earlier published rows without those whose work has moved to the day before."""
    tables = _tables(spark, sf_dir)
    tables.adjusted = stage(tables.adjusted, "adjusted")  # gives the uploaded and the emptied rows
    uploaded = P.published_daily(tables.final, X.PUBLISH_AS_OF, CFG.sync_days)
    deletes = P.rows_to_delete(tables.emptied, uploaded, X.PUBLISH_AS_OF, CFG.sync_days)
    target = _earlier_published(spark, sf_dir)
    return P.delete_rows(target, deletes, S.TABLE_KEYS[S.DAILY_STATS])


def days_closed(spark, sf_dir):
    return P.days_closed(published_daily(spark, sf_dir), X.CLOSED_AT)


def _publish_two_runs(spark, sf_dir) -> str:
    """Publish before the sessions arrive and again after; returns the folder of the tables."""
    root = scratch_path(spark, "published")
    early = daily_tables(X.daily(spark, sf_dir), None, None, CFG, True)
    adjusted = stage(_tables(spark, sf_dir).adjusted, "adjusted")
    closed_at = datetime.fromisoformat(X.CLOSED_AT)
    publish_daily(early.final, early.emptied, root, X.PUBLISH_AS_OF, closed_at, CFG)
    publish_daily(
        Q.drop_empty_days(adjusted), Q.emptied_keys(adjusted), root, X.PUBLISH_AS_OF, closed_at, CFG
    )
    return root


def published_table(spark, sf_dir):
    root = _publish_two_runs(spark, sf_dir)
    return _text(read_published(spark, root, S.DAILY_STATS), "day")


def closed_table(spark, sf_dir):
    root = _publish_two_runs(spark, sf_dir)
    return _text(read_published(spark, root, S.DAYS_CLOSED), "dia")


def publish_events(spark, sf_dir):
    """The three order tables after three publications: the earlier files, the later ones, and the
    earlier ones once more, which change nothing."""
    root = scratch_path(spark, "orders")
    inputs = {
        "cancels": X.cancels(spark, sf_dir), "late": X.late(spark, sf_dir),
        "trips": R.stored_trips(X.trips(spark, sf_dir), CFG),
    }
    for wanted in ("_ts_fichero < '2024-01-20'", "_ts_fichero >= '2024-01-20'", "_ts_fichero < '2024-01-20'"):
        report = publish_feeds(spark, {k: v.where(wanted) for k, v in inputs.items()}, root, CFG)
    tables = [(t, read_published(spark, root, t)) for t in (S.ORDER_EVENTS, S.ORDER_DELAYS, S.ORDER_KM)]
    assert set(report.values()) == {"published"}
    named = [t.withColumn("table", F.lit(name)) for name, t in tables]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), named)


# ------------------------------------------------------------------ orders


def cancel_events(spark, sf_dir):
    return O.cancel_events(X.cancels(spark, sf_dir), CFG)


def late_events(spark, sf_dir):
    return O.late_events(X.late(spark, sf_dir), CFG)


def order_km(spark, sf_dir):
    return O.order_km(X.trips(spark, sf_dir), CFG)


def _orders(spark, sf_dir) -> DataFrame:
    return R.stored_orders(X.trips(spark, sf_dir), CFG)


def dedup_within_file(spark, sf_dir):
    """Every order twice in its file, the second time without its mark."""
    rows = X.trips(spark, sf_dir)
    again = {"p2_on_time": F.lit(None).cast("string"), "_row": F.col("_row") + 1_000_000_000}
    twice = rows.unionByName(rows.withColumns(again))
    kept = O.usable_trips(twice, CFG)
    return _text(
        kept.select("_ts_fichero", "courier_uuid", "trip_uuid", "p2_on_time", "day"), "_ts_fichero", "day"
    )


def chained_orders(spark, sf_dir):
    rows = O.chained_orders(_orders(spark, sf_dir), CFG)
    return _text(
        rows.select("_ts_fichero", "courier_uuid", "trip_uuid", "_entrega_previa", "_chained"),
        "_ts_fichero", "_entrega_previa",
    )


def legacy_late(spark, sf_dir):
    rows = O.legacy_late_flags(O.chained_orders(_orders(spark, sf_dir), CFG), CFG)
    return _text(
        rows.select(
            "_ts_fichero", "courier_uuid", "trip_uuid", "_suelto",
            "retraso_p2", "retraso_p3", "tarde_p2", "tarde_p3",
        ),
        "_ts_fichero",
    )


def file_days(spark, sf_dir):
    return _text(O.file_days(_orders(spark, sf_dir), CFG), "_ts_fichero", "day")


def valid_days(spark, sf_dir):
    return _text(O.valid_days(_orders(spark, sf_dir), CFG), "_ts_fichero", "day")


def incomplete_files(spark, sf_dir):
    return O.incomplete_files(_orders(spark, sf_dir), CFG)


def marked_trips(spark, sf_dir):
    rows = O.marked_trips(_orders(spark, sf_dir), CFG)
    return _text(
        rows.select(
            "_ts_fichero", "courier_uuid", "trip_uuid", "day", "tarde_p2", "tarde_p3", "_dia_valido"
        ),
        "_ts_fichero", "day",
    )


def trip_delays(spark, sf_dir):
    return O.trip_delays(_orders(spark, sf_dir), CFG)


def order_delays_published(spark, sf_dir):
    """The delay table after both feeds: the late report, then the orders rebuilt from trips."""
    updates = stage(trip_delays(spark, sf_dir), "updates")
    return P.upsert_rows(late_events(spark, sf_dir), updates, S.TABLE_KEYS[S.ORDER_DELAYS])


def queries() -> dict[str, Query]:
    from fleetday.plans import csv_queries as C

    registered = [
        logical_day_counts, parsed_dates, dedup_keep_first, dedup_offers, ingest_first_wins,
        dedup_latest_by_file, latest_lineitem, prune_retention, ledger_new_files, reprocess_from,
        catch_up_days, export_times,
        latest_export, market_dedup, silver, silver_window, multi_market, trace_rider,
        closed_sessions, early_share, offer_early_share,
        attached_shares, moved_amounts, transfer, rates, adjusted_flag, without_destination,
        final_daily, unadjusted_daily,
        hours_mismatch, emptied_keys, utilisation_weekday, duplicate_keys, step_rows, moved_rows,
        published_daily, published_daily_narrow, upsert_merge, delete_emptied, days_closed,
        published_table, closed_table, publish_events,
        cancel_events, late_events, order_km, dedup_within_file, chained_orders, legacy_late,
        file_days, valid_days, incomplete_files, marked_trips, trip_delays,
        order_delays_published,
    ]
    return {q.__name__: q for q in [*registered, *C.registered()]}
