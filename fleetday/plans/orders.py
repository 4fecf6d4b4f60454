"""Order feeds that read their input several times: it is stored once, slim, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetday.config import Config
from fleetday.functions.clock import timestamp_column
from fleetday.operators import orders as O
from fleetday.sources.tables import stage


def stored_trips(trips: DataFrame, cfg: Config) -> DataFrame:
    """The trip exports for the feeds that read them, with the times that every feed filters by already
    parsed. The drop-off time stays as it is: a file also fills it with what can't be read."""
    parsed = {c: timestamp_column(trips, c, cfg.timestamp_formats) for c in ("momento", "courier_accept_timestamp_local")}
    return stage(trips.withColumns(parsed), "trips")


def stored_orders(trips: DataFrame, cfg: Config) -> DataFrame:
    """The usable orders of every file. Chains, their carry and the day checks all start here, so
    the exports are parsed and shuffled once instead of once per use."""
    return stage(O.usable_trips(trips, cfg), "orders")


def trip_delays(trips: DataFrame, cfg: Config, dated: bool = False) -> DataFrame:
    return O.trip_delays(stored_orders(trips, cfg), cfg, dated)


def marked_trips(trips: DataFrame, cfg: Config) -> DataFrame:
    return O.marked_trips(stored_orders(trips, cfg), cfg)
