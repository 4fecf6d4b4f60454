"""The daily table: bronze to one adjusted row per (rider, day)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetday.config import Config
from fleetday.operators.quality import drop_empty_days, emptied_keys
from fleetday.operators.sessions import early_share, offer_early_share
from fleetday.operators.silver import build_silver
from fleetday.operators.transfer import apply_transfer


@dataclass
class DailyTables:
    """`adjusted` still holds the days that lost all their work; `final` is what is published."""

    silver: DataFrame
    adjusted: DataFrame

    @property
    def emptied(self) -> DataFrame:
        return emptied_keys(self.adjusted)

    @property
    def final(self) -> DataFrame:
        return drop_empty_days(self.adjusted)


def daily_tables(
    bronze_daily: DataFrame,
    connections: DataFrame | None,
    offers: DataFrame | None,
    cfg: Config,
    whole_history: bool = False,
) -> DailyTables:
    """`whole_history` skips the recent window, to compute every day the bronze holds."""
    silver = build_silver(bronze_daily, cfg, whole_history)
    sessions = None if connections is None else early_share(connections, cfg)
    accepted = None if offers is None else offer_early_share(offers, cfg)
    return DailyTables(silver, apply_transfer(silver, sessions, accepted))
