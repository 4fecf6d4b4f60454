"""Registered queries over CSV exports that Spark writes from the derived tables.

Every family is written in several layouts (separator, column order, column names, null token) and
read back with the same scan a run uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.functions.clock import export_timestamp
from fleetday.functions.dedup import keep_one
from fleetday.operators import bronze as B
from fleetday.operators import orders as O
from fleetday.plans import fixtures as X
from fleetday.plans.ingest import ingest
from fleetday.plans.orders import trip_delays
from fleetday.plans.run import NoDailyData, require_daily
from fleetday.sources import families as FA
from fleetday.sources.csv_files import discover_files, scan_family, too_many_failed
from fleetday.sources.tables import scratch_path, stage

CFG = X.CONFIG
_STAMP = "_stamp"


def _export(df: DataFrame, directory: str, prefix: str, **options) -> None:
    """Write one layout. Each task writes its own part of every export, named like an export."""
    spark = df.sparkSession
    parts = scratch_path(spark, "csv-parts")
    written = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", **options}
    df.write.partitionBy(_STAMP).options(**written).csv(parts)

    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(parts)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(directory))
    for folder in system.listStatus(root):
        if not folder.isDirectory():
            continue
        stamp = folder.getPath().getName().partition("=")[2]
        files = [f.getPath() for f in system.listStatus(folder.getPath())]
        for number, file in enumerate(sorted(files, key=lambda p: p.getName())):
            system.rename(file, path(f"{directory}/{prefix}p{number}_{stamp}.csv"))


def _read(spark: SparkSession, directory: str, family: FA.Family):
    return scan_family(spark, discover_files(spark, directory, family.pattern), family)


def _stamp(file_column: str):
    return F.regexp_extract(file_column, r"(\d{8}_\d{6})", 1)


# ---------------------------------------------------------------- daily


def csv_daily(spark, sf_dir):
    """Three layouts; names hold quotes, commas and line breaks."""
    name = F.concat(F.lit('rider "'), F.col("driver_uuid"), F.lit('",\nnight'))
    rows = X.daily(spark, sf_dir).withColumn("driver_name", name)
    text = stage(
        rows.withColumns({c: F.col(c).cast("string") for c in S.DAILY_DATES}).withColumn(
            _STAMP, _stamp("file_name")
        ),
        "csv-source",
    )
    directory = scratch_path(spark, "csv-daily")
    layouts = [
        ("20240201_060000", S.DAILY_COLUMNS, {"sep": ",", "nullValue": "NA"}),
        ("20240202_060000", [*reversed(S.DAILY_COLUMNS)], {"sep": "\t", "nullValue": "\\N"}),
        (
            "20240203_060000",
            [c for c in S.DAILY_COLUMNS if c != "form_factor"],
            {"sep": ",", "nullValue": "NULL"},
        ),
    ]
    for stamp, columns, options in layouts:
        part = text.filter(F.col(_STAMP) == stamp).select(*columns, _STAMP)
        _export(part.withColumn("extra", F.lit("x")), directory, "COURIER_DAILY_", **options)
    read = _read(spark, directory, FA.DAILY).rows.drop("file_name")
    return read.withColumns(
        {c: F.col(c).cast("string") for c in [*S.DAILY_DATES, "file_date"]}
    )


# ------------------------------------------------- connections and offers


def _first_in_ingest_order(rows: DataFrame, family: FA.Family) -> DataFrame:
    order = [
        export_timestamp(family.file_column).asc_nulls_last(),
        family.file_column, "_block", "_row",
    ]
    return keep_one(rows, family.key, order)


def csv_connections(spark, sf_dir):
    rows = X.overlapping_connections(spark, sf_dir).withColumn(_STAMP, _stamp("conn_file"))
    directory = scratch_path(spark, "csv-connections")
    early = rows.filter(F.col(_STAMP) == "20240116_000000")
    late = rows.filter(F.col(_STAMP) == "20240131_000000")
    _export(early.drop("conn_file"), directory, "connections_", sep="\t", nullValue="null")
    _export(late.drop("conn_file", "contact_number"), directory, "Connections_", sep=",")
    read = _read(spark, directory, FA.CONNECTIONS).rows
    first = _first_in_ingest_order(read, FA.CONNECTIONS)
    kept = B.prune_retention(first, "start_time", X.PRUNE_AS_OF, CFG)
    return kept.select(*S.CONNECTION_KEY, "end_time", "fleet_name", _stamp("conn_file").alias("stamp"))


def bronze_two_runs(spark, sf_dir):
    """The earlier export is ingested by one run, the whole month by the next."""
    rows = X.overlapping_connections(spark, sf_dir).withColumn(_STAMP, _stamp("conn_file"))
    directory = scratch_path(spark, "csv-connections")
    path = scratch_path(spark, "bronze-connections")
    bronze = None
    for stamp in ("20240116_000000", "20240131_000000"):
        part = rows.filter(F.col(_STAMP) == stamp).drop("conn_file")
        _export(part, directory, "connections_", sep=",", nullValue="NA")
        bronze, _ = ingest(spark, FA.CONNECTIONS, directory, path, X.PRUNE_AS_OF, CFG)
    return bronze.select(
        *S.CONNECTION_KEY, "end_time", "fleet_name", _stamp("conn_file").alias("stamp")
    )


def ingest_daily(spark, sf_dir):
    """The first two exports are ingested by one run, the third by the next; all rows stay."""
    rows = X.daily(spark, sf_dir).withColumn(_STAMP, _stamp("file_name"))
    text = {c: F.col(c).cast("string") for c in S.DAILY_DATES}
    rows = stage(rows.withColumns(text).drop("file_name", "file_date"), "csv-source")
    directory, path = scratch_path(spark, "csv-daily"), scratch_path(spark, "bronze-daily")
    last = F.col(_STAMP) == "20240203_060000"
    bronze = None
    for part in (rows.filter(~last), rows.filter(last)):
        _export(part, directory, "COURIER_DAILY_", sep=",", nullValue="NA")
        bronze, _ = ingest(spark, FA.DAILY, directory, path, X.AS_OF, CFG)
    return bronze.select(
        "driver_uuid", F.col("datestr").cast("string").alias("datestr"), "market_name", "num_of_trips",
        "online_hours", _stamp("file_name").alias("stamp"),
    )


def ingest_offers(spark, sf_dir):
    """Two exports in one run, and a run that finds nothing new. Every tenth offer of the first export
    is 90 days old: it counts as the first of its key, then expires, so that the later row of its key
    is not stored either."""
    rows = X.overlapping_offers(spark, sf_dir).withColumn(_STAMP, _stamp("rta_file")).drop("rta_file")
    old = (F.col(_STAMP) == "20240116_000000") & F.col("offer_id").endswith("1")
    moved = (F.col("timestamp").cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(90))).cast("string")
    rows = stage(rows.withColumn("timestamp", F.when(old, moved).otherwise(F.col("timestamp"))), "csv-source")
    directory, path = scratch_path(spark, "csv-offers"), scratch_path(spark, "bronze-offers")
    bronze = None
    _export(rows, directory, "CANCELLATION_RTA_", sep=",", nullValue="NA")
    for _ in range(2):
        bronze, _ = ingest(spark, FA.OFFERS, directory, path, X.AS_OF, CFG)
    return bronze.select("offer_id", "email", _stamp("rta_file").alias("stamp"))


def noop_run(spark, sf_dir):
    """A second run over the same exports: the files of the table before and after, and its rows."""
    rows = X.daily(spark, sf_dir).withColumn(_STAMP, _stamp("file_name"))
    text = {c: F.col(c).cast("string") for c in S.DAILY_DATES}
    rows = rows.withColumns(text).drop("file_name", "file_date")
    directory, path = scratch_path(spark, "csv-daily"), scratch_path(spark, "bronze-daily")
    _export(rows, directory, "COURIER_DAILY_", sep=",", nullValue="NA")
    found = []
    for _ in range(2):
        bronze, _ = ingest(spark, FA.DAILY, directory, path, X.AS_OF, CFG)
        files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("at"))
        found.append(stage(files.distinct(), "files"))
    before, after = found
    changed = before.exceptAll(after).unionByName(after.exceptAll(before)).count()
    return bronze.agg(F.lit(changed).cast("long").alias("changed_files"), F.count(F.lit(1)).alias("rows"))


def no_input_gate(spark, sf_dir):
    """Whether a run with the daily exports stops for want of them, and one with other exports only."""
    rows = X.daily(spark, sf_dir).withColumn(_STAMP, _stamp("file_name"))
    text = {c: F.col(c).cast("string") for c in S.DAILY_DATES}
    rows = rows.withColumns(text).drop("file_name", "file_date")
    found = []
    for kind, prefix in (("daily", "COURIER_DAILY_"), ("other", "OTHER_")):
        directory, path = scratch_path(spark, f"csv-{kind}"), scratch_path(spark, "bronze-daily")
        _export(rows, directory, prefix, sep=",", nullValue="NA")
        bronze, _ = ingest(spark, FA.DAILY, directory, path, X.AS_OF, CFG)
        try:
            require_daily(bronze, directory)
            found.append((kind, False, bronze.count()))
        except NoDailyData:
            found.append((kind, True, 0))
    return spark.createDataFrame(found, "exports string, stopped boolean, rows long")


def file_error_gate(spark, sf_dir):
    """One of the cancel exports is broken, and all but one of the late reports: only they stop a run.

    Counted by export, each of which Spark writes as one file or more.
    """
    late = X.late(spark, sf_dir).withColumn(
        _STAMP, F.date_format("_ts_fichero", "yyyyMMdd_HHmmss")
    ).drop("_ts_fichero")
    late = stage(late.repartition(_STAMP), "csv-source")  # one file for each export
    directory = scratch_path(spark, "csv-late")
    good = F.col(_STAMP) == "20240120_000000"
    _export(late.filter(good), directory, "LATE_", sep=",", nullValue="")
    _export(late.filter(~good).drop("order_id"), directory, "LATE_", sep=",", nullValue="")
    cancels = _cancel_files(spark, sf_dir, whole_exports=True)
    rows = []
    for family, folder in ((FA.CANCELS, cancels), (FA.LATE, directory)):
        scan = _read(spark, folder, family)
        rows.append((family.name, scan.failed, scan.total, too_many_failed(scan)))
    return spark.createDataFrame(rows, "family string, failed long, total long, abort boolean")


def csv_offers(spark, sf_dir):
    rows = X.overlapping_offers(spark, sf_dir).withColumn(_STAMP, _stamp("rta_file"))
    directory = scratch_path(spark, "csv-offers")
    _export(rows.drop("rta_file"), directory, "CANCELLATION_RTA_", sep=",", nullValue="NA")
    read = _read(spark, directory, FA.OFFERS).rows
    first = _first_in_ingest_order(read, FA.OFFERS)
    return first.select("offer_id", "email", _stamp("rta_file").alias("stamp"))


# ----------------------------------------------------------- order feeds


def _cancel_files(spark, sf_dir, whole_exports: bool = False) -> str:
    """The export of 20 January lacks the event type and is refused."""
    rows = X.cancels(spark, sf_dir).withColumn(
        _STAMP, F.date_format("_ts_fichero", "yyyyMMdd_HHmmss")
    ).drop("_ts_fichero")
    rows = stage(rows.repartition(_STAMP) if whole_exports else rows, "csv-source")
    directory = scratch_path(spark, "csv-cancels")
    broken = F.col(_STAMP) == "20240120_000000"
    _export(rows.filter(~broken), directory, "CANCEL_", sep=",", nullValue="")
    _export(rows.filter(broken).drop("event_type"), directory, "CANCEL_", sep=",", nullValue="")
    # the offers family has the same start of the name and is not for this feed
    _export(rows.select("order_id", _STAMP), directory, "CANCELLATION_RTA_", sep=",")
    return directory


def csv_cancels(spark, sf_dir):
    return O.cancel_events(_read(spark, _cancel_files(spark, sf_dir), FA.CANCELS).rows, CFG)


def csv_refused_files(spark, sf_dir):
    scan = _read(spark, _cancel_files(spark, sf_dir), FA.CANCELS)
    return scan.errors.select("family", _stamp("file_name").alias("stamp"), "reason").distinct()


def csv_trips(spark, sf_dir):
    """Two layouts with different column names; one of them also lists undelivered orders."""
    rows = X.trips(spark, sf_dir).withColumn(_STAMP, _stamp("_file_name")).drop(
        "_ts_fichero", "_file_name", "_row"
    )
    rows = stage(rows, "csv-source")
    directory = scratch_path(spark, "csv-trips")
    fourth = F.substring(_STAMP, 7, 2).cast("int") % 4 == 0
    status = F.when(F.col("trip_uuid").endswith("7"), "FAILED").otherwise("COMPLETED")
    _export(
        rows.filter(fourth)
        .withColumn("delivery_status", status)
        .withColumnsRenamed({"courier_uuid": "driver_uuid", "trip_uuid": "workflow_uuid"})
        .withColumnsRenamed({"momento": "day_date", "km": "distance_km"}),
        directory, "trips_", sep="\t", nullValue="\\N",
    )
    _export(
        rows.filter(~fourth)
        .withColumnsRenamed({"trip_uuid": "delivery_trip_uuid", "km": "actual_pickup_dropoff_km"})
        .drop("momento", "form_factor"),
        directory, "TRIPS_DATA_", sep=",", nullValue="NA",
    )
    return trip_delays(_read(spark, directory, FA.TRIPS).rows, CFG)


def registered():
    return [
        csv_daily, csv_connections, bronze_two_runs, csv_offers, csv_cancels, csv_refused_files, csv_trips,
        ingest_daily, ingest_offers, file_error_gate, noop_run, no_input_gate,
    ]
