"""Small literal tables for the unit tests."""

from __future__ import annotations

from datetime import datetime

from fleetday import schema as S

_DAILY_SCHEMA = ", ".join(
    f"{c} {'timestamp_ntz' if c in S.DAILY_DATES else 'string' if c in S.DAILY_TEXT else 'double'}"
    for c in S.DAILY_COLUMNS
) + ", file_name string, file_date timestamp_ntz"
_SILVER_COLUMNS = ["driver_uuid", "datestr", *S.SUMMED_COLUMNS, *S.IDENTITY_COLUMNS]


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _row(columns, values):
    return tuple(values.get(c) for c in columns)


def daily(spark, *rows: dict):
    """Daily bronze rows; unnamed columns are null."""
    columns = [*S.DAILY_COLUMNS, "file_name", "file_date"]
    filled = [{"file_date": ts("2024-02-01"), "driver_uuid": "a", **r} for r in rows]
    return spark.createDataFrame([_row(columns, r) for r in filled], _DAILY_SCHEMA)


def silver(spark, *rows: dict):
    schema = ", ".join(
        f"{c} "
        + (
            "timestamp_ntz"
            if c in ("datestr", "weekstr")
            else "string"
            if c in S.DAILY_TEXT
            else "double"
        )
        for c in _SILVER_COLUMNS
    )
    filled = [{"driver_uuid": "a", **r} for r in rows]
    return spark.createDataFrame([_row(_SILVER_COLUMNS, r) for r in filled], schema)


def shares(spark, *rows):
    """(rider, 'YYYY-MM-DD', share, hours)"""
    return spark.createDataFrame(
        [(r, ts(d).date(), f, h) for r, d, f, h in rows],
        "courier_uuid string, dia date, frac_horas double, horas_conn double",
    )


def connections(spark, *rows):
    """(rider, status, start, end)"""
    return spark.createDataFrame(
        list(rows), "courier_uuid string, status string, start_time string, end_time string"
    )


def trips(spark, *rows: dict):
    columns = [
        "courier_uuid", "trip_uuid", "momento", "km", *S.TRIP_OPTIONAL, "form_factor",
        "_ts_fichero", "_file_name", "_row",
    ]
    filled = []
    for n, r in enumerate(rows):
        row = {"courier_uuid": "a", "_ts_fichero": ts("2024-01-10"), "_file_name": "f", "_row": n}
        row |= r
        row.setdefault("momento", row.get("courier_accept_timestamp_local"))
        filled.append(_row(columns, row))
    types = {"_ts_fichero": "timestamp_ntz", "_row": "long"}
    return spark.createDataFrame(filled, ", ".join(f"{c} {types.get(c, 'string')}" for c in columns))


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
