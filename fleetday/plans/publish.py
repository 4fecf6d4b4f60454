"""Publishing: keyed tables, deletes of emptied days, the closed-day marker, the order feeds."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.operators import orders as O
from fleetday.operators import publish as P
from fleetday.plans.orders import stored_trips, trip_delays
from fleetday.sources.csv_files import Scan, discover_files, file_error_gate, scan_family
from fleetday.sources.families import CANCELS, LATE, TRIPS, Family
from fleetday.sources.publication import Publication
from fleetday.sources.tables import stage


def publish_daily(
    final: DataFrame,
    emptied: DataFrame | None,
    root: str,
    as_of: date,
    closed_at: datetime,
    cfg: Config,
    window_days: int | None = None,
) -> int:
    """Upsert the window, delete emptied days and mark the days closed, all in one commit; returns the rows sent.

    With nothing in the window nothing is deleted and no day is marked.
    """
    spark = final.sparkSession
    window = cfg.sync_days if window_days is None else window_days
    publication = Publication(spark, root)
    target = publication.read(S.DAILY_STATS)
    live = target is None or set(S.LIVE_COLUMNS) <= set(target.columns)
    uploaded = stage(P.published_daily(final, as_of, window, live), S.DAILY_STATS)
    rows = uploaded.count()
    if rows == 0:
        return 0
    deletes = None
    if emptied is not None:
        deletes = stage(P.rows_to_delete(emptied, uploaded, as_of, window), "deletes")
    publication.merge(S.DAILY_STATS, S.TABLE_KEYS[S.DAILY_STATS], "day", uploaded, deletes)
    marker = P.days_closed(uploaded, closed_at.isoformat())
    publication.merge(S.DAYS_CLOSED, S.TABLE_KEYS[S.DAYS_CLOSED], "dia", marker)
    publication.commit()
    return rows


#: The order feeds in the order in which they are merged: name, table, input, transformation. The late
#: report goes before the delays rebuilt from trips, which only cover later days.
ORDER_FEEDS = [
    ("cancels", S.ORDER_EVENTS, "cancels", O.cancel_events),
    ("late report", S.ORDER_DELAYS, "late", O.late_events),
    ("late trips", S.ORDER_DELAYS, "trips", trip_delays),
    ("kilometres", S.ORDER_KM, "trips", O.order_km),
]


def merge_feed(publication: Publication, name: str, rows: DataFrame, cfg: Config) -> None:
    """Merge one order feed. A row of an older file doesn't replace one of a newer file, nor a row of an
    earlier feed one that a later feed has put into the same table."""
    rank, (_, table, _, transform) = next((i, f) for i, f in enumerate(ORDER_FEEDS) if f[0] == name)
    dated = stage(transform(rows, cfg, True), table)
    version = F.struct(F.lit(rank).alias("feed"), F.col("_ts_fichero").alias("file"))
    updates = dated.withColumn("_version", version).drop("_ts_fichero")
    publication.merge(table, S.TABLE_KEYS[table], S.TABLE_DAY[table], updates, version="_version")


def publish_events(
    spark: SparkSession, inputs: dict[str, DataFrame | None], root: str, cfg: Config, tables: tuple[str, ...] | None = None
) -> dict[str, str]:
    """Upsert the four order feeds into their three tables in one commit; returns what happened to each.

    A feed without input is left out. With `tables` given, so is a feed whose target is not among them.
    """
    publication = Publication(spark, root)
    report = {}
    for name, table, source, _ in ORDER_FEEDS:
        rows = inputs.get(source)
        if rows is None:
            report[name] = "no files"
        elif tables is not None and table not in tables:
            report[name] = f"skipped: no table {table}"
        else:
            merge_feed(publication, name, rows, cfg)
            report[name] = "published"
    publication.commit()
    return report


def _scan(spark: SparkSession, family: Family, directory: str, cfg: Config) -> Scan:
    files = discover_files(spark, directory, family.pattern)
    scan = scan_family(spark, files, family, cfg.timestamp_formats)
    file_error_gate(family, scan)
    return scan


def publish_orders(
    spark: SparkSession, input_root: str, root: str, cfg: Config, tables: tuple[str, ...] | None = None
) -> tuple[dict[str, str], DataFrame, DataFrame | None]:
    """Read the three kinds of order exports and publish them, see `publish_events`.

    Also returns the refused files, and the number of trip files that lack a measure (None without any).
    """
    scans = {
        source: _scan(spark, family, f"{input_root}/{folder}", cfg)
        for source, family, folder in (
            ("cancels", CANCELS, cfg.cancel_dir), ("late", LATE, cfg.late_dir), ("trips", TRIPS, cfg.trips_dir)
        )
    }
    errors = reduce(DataFrame.unionByName, [scan.errors for scan in scans.values()])
    inputs = {source: scan.rows for source, scan in scans.items()}
    if inputs["trips"] is not None:
        inputs["trips"] = stored_trips(inputs["trips"], cfg)  # read by two feeds
    incomplete = None if inputs["trips"] is None else O.incomplete_files(O.usable_trips(inputs["trips"], cfg), cfg)
    return publish_events(spark, inputs, root, cfg, tables), errors, incomplete
