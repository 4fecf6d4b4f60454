"""One whole run: ingest, daily table, publishing, order feeds, checks.

    python -m fleetday.plans.run run <input folder> <output folder> [options]
    python -m fleetday.plans.run catch-up <output folder> [options]
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday import schema as S
from fleetday.config import Config
from fleetday.operators import quality as Q
from fleetday.operators.bronze import catch_up_days
from fleetday.operators.sessions import early_share, offer_early_share
from fleetday.operators.silver import (
    build_silver,
    multi_market_count,
    recent_cutoff,
    trace_rider,
)
from fleetday.operators.transfer import apply_transfer, attach_shares, hours_mismatch, without_destination
from fleetday.plans.ingest import ingest
from fleetday.plans.publish import publish_daily, publish_orders
from fleetday.session import cluster_session
from fleetday.sources.families import CONNECTIONS, DAILY, OFFERS
from fleetday.sources.publication import expire
from fleetday.sources.tables import read_table, stage, staging, write_table


#: How a damaged file shows: in its footer while the table is opened, in its pages while it is read.
_UNREADABLE = (PySparkException, Py4JJavaError)


class NoDailyData(RuntimeError):
    """There is no daily export, neither new nor stored."""


@dataclass
class Report:
    """Outcome of a run; the frames are small or lazy."""

    steps: DataFrame
    final: DataFrame
    mismatch: DataFrame | None
    utilisation: DataFrame
    duplicates: DataFrame
    silver_duplicates: DataFrame
    multi_market: DataFrame
    without_destination: DataFrame | None
    moved: DataFrame
    trace: DataFrame | None
    published_rows: int
    file_errors: DataFrame
    incomplete_files: DataFrame | None = None
    feeds: dict[str, str] = field(default_factory=dict)
    feed_error: str | None = None


def bronze_path(output_root: str, name: str, cfg: Config) -> str:
    return f"{output_root}/{cfg.output_dir}/bronze_{name}{cfg.bronze_suffix}"


def require_daily(bronze: DataFrame | None, folder: str) -> None:
    """Stop a run that has no daily export, neither new nor stored."""
    if bronze is None:
        raise NoDailyData(f"no daily export under {folder}")


def _non_empty(df: DataFrame | None) -> DataFrame | None:
    return None if df is None or df.isEmpty() else df


def run(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    as_of: datetime,
    cfg: Config,
    closed_at: datetime | None = None,
) -> Report:
    """`as_of` is the wall-clock time of the run in the data's own zone, `closed_at` the instant that
    the closed-day marker carries (by default the time of the call)."""
    closed_at = closed_at or datetime.now(timezone.utc)
    scans = {}
    bronze = {}
    for family, folder in [
        (DAILY, cfg.daily_dir),
        (CONNECTIONS, cfg.connections_dir),
        (OFFERS, cfg.offers_dir),
    ]:
        path = bronze_path(output_root, family.name, cfg)
        bronze[family.name], scans[family.name] = ingest(
            spark, family, f"{input_root}/{folder}", path, as_of, cfg
        )
        if family is DAILY:
            require_daily(bronze["daily"], f"{input_root}/{cfg.daily_dir}")
    errors = scans["daily"].errors
    for name in ("connections", "offers"):
        errors = errors.unionByName(scans[name].errors)

    daily = bronze["daily"]
    connections, offers = _non_empty(bronze["connections"]), _non_empty(bronze["offers"])
    # a share belongs to the date its session or offer starts on, and an open session is closed by a
    # later event: days before the silver's window cannot matter and are not read
    recent = F.col(S.BRONZE_DAY) >= F.to_date(recent_cutoff(daily, cfg))
    sessions = None if connections is None else early_share(connections.filter(recent), cfg)
    accepted = None if offers is None else offer_early_share(offers.filter(recent), cfg)
    # every step is counted by the write that stores it
    counted, silver_seen = Q.counting(build_silver(daily, cfg), "silver")
    silver = stage(counted, "silver")
    counted, adjusted_seen = Q.counting(apply_transfer(silver, sessions, accepted), "adjusted")
    adjusted = stage(counted, "adjusted")

    output = f"{output_root}/{cfg.output_dir}/{cfg.silver_name}"
    counted, final_seen = Q.counting(Q.drop_empty_days(adjusted), "final")
    write_table(counted, output)
    final = spark.read.parquet(output)
    # a stored table's own count comes from its files' footers
    seen = {"bronze": daily.count(), "silver": silver_seen.get["rows"], "adjusted": adjusted_seen.get["rows"], "final": final_seen.get["rows"]}

    shared = None if sessions is None else attach_shares(silver, sessions, accepted)
    report = Report(
        steps=spark.createDataFrame(list(seen.items()), "step string, rows long"),
        final=final,
        mismatch=None if shared is None else hours_mismatch(shared, cfg),
        utilisation=Q.utilisation_by_weekday(final, cfg),
        duplicates=Q.duplicate_rider_days(final),
        silver_duplicates=Q.duplicate_rider_days(silver),
        multi_market=multi_market_count(daily),
        without_destination=None if shared is None else without_destination(shared),
        moved=spark.createDataFrame([(seen["adjusted"], adjusted_seen.get["adjusted"])], "rows long, adjusted long"),
        trace=trace_rider(daily, cfg.traced_rider) if cfg.traced_rider else None,
        published_rows=publish_daily(
            final,
            Q.emptied_keys(adjusted),
            f"{output_root}/published",
            as_of.date(),
            closed_at,
            cfg,
        ),
        file_errors=errors,
    )
    # the order feeds stand on their own: their failure does not undo the daily metrics
    try:
        report.feeds, refused, report.incomplete_files = publish_orders(
            spark, input_root, f"{output_root}/published", cfg, cfg.order_tables
        )
        report.file_errors = errors.unionByName(refused)
    except Exception as e:
        report.feed_error = str(e)
    expire(spark, f"{output_root}/published", cfg.kept_commits)
    return report


def catch_up(spark: SparkSession, output_root: str, as_of: datetime, cfg: Config) -> int:
    """Days the next download has to reach back; an unreadable bronze is left out."""

    def stored(name: str, column: str) -> DataFrame | None:
        try:
            df = read_table(spark, bronze_path(output_root, name, cfg))
            return None if df is None else df.select(column)
        except _UNREADABLE as e:
            print(f"bronze {name} left out: {e}", file=sys.stderr)
            return None

    sources = {"offers": "timestamp", "connections": "start_time"}
    tables = {name: stored(name, column) for name, column in sources.items()}
    try:
        days = catch_up_days(tables["offers"], tables["connections"], as_of, cfg)
        return cfg.catch_up_first_run_days if days is None else days.first()["days"]
    except _UNREADABLE:
        # a damaged data file shows only now: find the table that has it
        for name, df in tables.items():
            try:
                if df is not None:
                    df.agg(F.max(sources[name])).first()
            except _UNREADABLE as e:
                print(f"bronze {name} left out: {e}", file=sys.stderr)
                tables[name] = None
    days = catch_up_days(tables["offers"], tables["connections"], as_of, cfg)
    return cfg.catch_up_first_run_days if days is None else days.first()["days"]


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fleetday")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "catch-up"):
        command = commands.add_parser(name)
        if name == "run":
            command.add_argument("input")
        command.add_argument("output")
        command.add_argument("--as-of", type=datetime.fromisoformat, help="wall-clock time of the run")
        command.add_argument("--suffix", dest="bronze_suffix", help="suffix of the bronze tables")
        command.add_argument("--retention-days", type=int)
        command.add_argument("--sync-days", type=int, help="days to publish")
        command.add_argument("--reprocess-from", type=date.fromisoformat)
        command.add_argument("--trace", dest="traced_rider", help="rider whose rows are printed")
        for folder in ("daily", "connections", "offers", "cancel", "late", "trips", "output"):
            command.add_argument(f"--{folder}-dir")
        command.add_argument("--order-tables", type=lambda names: tuple(names.split(",")), help="order tables to publish, comma separated; others are skipped")
        command.add_argument("--shuffle-partitions", type=int)
    return parser.parse_args(argv)


def settings(arguments: argparse.Namespace) -> Config:
    """The defaults with what the command line gives."""
    given = {k: v for k, v in vars(arguments).items() if v is not None and hasattr(Config, k)}
    return replace(Config(), **given)


def show(report: Report) -> None:
    frames = {
        "rows by step": report.steps,
        "refused files": report.file_errors,
        "rows moved": report.moved,
        "hours mismatch": report.mismatch,
        "days without destination": report.without_destination,
        "more than one market": report.multi_market,
        "utilisation by weekday": report.utilisation,
        "repeated keys": report.duplicates,
        "repeated keys before the transfer": report.silver_duplicates,
        "trip files without a measure": report.incomplete_files,
        "trace": report.trace,
    }
    for title, frame in frames.items():
        if frame is not None:
            print(title)
            frame.show(truncate=False)
    print(f"published rows: {report.published_rows}; feeds: {report.feeds or report.feed_error}")


def main(argv: list[str]) -> int:
    arguments = _arguments(argv[1:])
    as_of, cfg = arguments.as_of or datetime.now(), settings(arguments)
    spark = cluster_session(shuffle_partitions=arguments.shuffle_partitions)
    if arguments.command == "catch-up":
        print(catch_up(spark, arguments.output, as_of, cfg))
        return 0
    try:
        with staging(spark):  # the report's frames read it, so it is shown inside
            show(run(spark, arguments.input, arguments.output, as_of, cfg))
    except NoDailyData as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
