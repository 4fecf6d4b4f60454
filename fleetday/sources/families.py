"""What each CSV family looks like and how a file's header is matched to it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from fleetday import schema as S


class MissingColumns(ValueError):
    """The file lacks columns its family cannot do without."""


# A layout maps every output column to its position in the file, None for an empty column.
Layout = dict[str, int | None]


def fixed_columns(columns: list[str], required: list[str]) -> Callable[[list[str]], Layout]:
    """Always these columns; absent ones are empty, but a file without a required one is refused."""

    def resolve(header: list[str]) -> Layout:
        missing = [c for c in required if c not in header]
        if missing:
            raise MissingColumns(", ".join(missing))
        return {c: header.index(c) if c in header else None for c in columns}

    return resolve


def first_alias(aliases: dict[str, list[str]], optional: list[str]) -> Callable[[list[str]], Layout]:
    """Each logical column under the first of its names that the file has."""

    def resolve(header: list[str]) -> Layout:
        found = {
            logical: next((header.index(n) for n in names if n in header), None)
            for logical, names in aliases.items()
        }
        missing = [logical for logical, position in found.items() if position is None]
        if missing:
            raise MissingColumns(", ".join(missing))
        extras = {c: header.index(c) if c in header else None for c in optional}
        return {**found, **extras}

    return resolve


@dataclass(frozen=True)
class Family:
    name: str
    pattern: str
    layout: Callable[[list[str]], Layout]
    file_column: str
    # export time column and the value for files without one; None for families without it
    time_column: str | None = None
    time_fallback: str | None = None
    # a column that must hold this value, applied only to files that have the column
    keep_only: tuple[str, str] | None = None
    # bronze: key whose first row counts, and the column that dates a row
    key: list[str] = field(default_factory=list)
    dated_by: str | None = None


DAILY = Family(
    name="daily",
    pattern=S.DAILY_PATTERN,
    layout=fixed_columns(S.DAILY_COLUMNS, S.DAILY_DATES),
    file_column="file_name",
    time_column="file_date",
    time_fallback="0001-01-01 00:00:00",
    dated_by="datestr",
)
CONNECTIONS = Family(
    name="connections",
    pattern=S.CONNECTIONS_PATTERN,
    layout=fixed_columns(S.CONNECTION_COLUMNS, S.CONNECTION_KEY),
    file_column="conn_file",
    key=S.CONNECTION_KEY,
    dated_by="start_time",
)
OFFERS = Family(
    name="offers",
    pattern=S.OFFERS_PATTERN,
    layout=fixed_columns(S.OFFER_COLUMNS, S.OFFER_KEY),
    file_column="rta_file",
    key=S.OFFER_KEY,
    dated_by="timestamp",
)
CANCELS = Family(
    name="cancels",
    pattern=S.CANCEL_PATTERN,
    layout=fixed_columns(S.CANCEL_COLUMNS, S.CANCEL_COLUMNS),
    file_column="_file_name",
    time_column="_ts_fichero",
    time_fallback="1970-01-01 00:00:00",
)
LATE = Family(
    name="late",
    pattern=S.LATE_PATTERN,
    layout=fixed_columns(S.LATE_COLUMNS, S.LATE_COLUMNS),
    file_column="_file_name",
    time_column="_ts_fichero",
    time_fallback="1970-01-01 00:00:00",
)
TRIPS = Family(
    name="trips",
    pattern=S.TRIPS_PATTERN,
    layout=first_alias(S.TRIP_ALIASES, [*S.TRIP_OPTIONAL, "form_factor"]),
    file_column="_file_name",
    time_column="_ts_fichero",
    time_fallback="1970-01-01 00:00:00",
    keep_only=("delivery_status", "COMPLETED"),
)
