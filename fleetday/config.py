"""One frozen settings object; operators never read the environment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Config:
    # -------------------------------------------------------------- fixed values
    # Defaults that must equal the established daily process to give its results.
    daily_dir: str = "COURIER_DAILY"
    connections_dir: str = "CONNECTIONS"
    offers_dir: str = "CANCELLATIONS_RTA"
    cancel_dir: str = "CANCEL"
    late_dir: str = "LATE_TRIPS"
    trips_dir: str = "TRIPS_DATA"
    output_dir: str = "datos_salida"
    silver_name: str = "rides_silver"
    bronze_suffix: str = ""
    reprocess_weeks: int = 3
    retention_days: int = 60
    cutoff_hour: int = 2
    work_states: tuple[str, ...] = ("open", "enroute", "ontrip")
    max_session_hours: int = 18
    sync_days: int = 7
    event_types: tuple[str, ...] = ("CANCEL", "CANCEL_NOT_AT_FAULT", "REJECT")
    late_minutes: int = 10
    first_day_without_late_report: date = date(2026, 10, 12)
    catch_up_first_run_days: int = 30
    catch_up_margin_days: int = 1
    catch_up_max_days: int = 30
    catch_up_min_days: int = 2
    mismatch_hours: float = 1.0
    mismatch_alert_pct: float = 10.0
    min_marked_share: float = 0.5
    qc_min_online_hours: float = 2.0
    qc_min_active_hours: float = 0.5
    qc_min_rows: int = 100
    # ---------------------------------------------------------- end fixed values

    # Optional inputs of a run
    reprocess_from: date | None = None
    traced_rider: str | None = None
    # order tables that the target has; feeds of others are skipped (None: all are there)
    order_tables: tuple[str, ...] | None = None

    # Physical settings. A rider with more than `heavy_rows` rows is cut into ranges in an ordered
    # scan, so that no task scans many more rows of one rider than that.
    # `salts` is the number of slices of a key that many rows share in a join.
    heavy_rows: int = 1_000_000
    # buckets of the keys of a table whose key lacks the day; fixed once such a table is there
    key_buckets: int = 64
    # commits of the published tables that a run leaves to readers
    kept_commits: int = 20
    salts: int = 32
    timestamp_formats: tuple[str, ...] = ()
