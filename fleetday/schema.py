"""Data contracts: what every CSV family and every published table looks like."""

# ---------------------------------------------------------------- fixed values
# Column names, orders, key columns, file patterns and null tokens are given by
# the exporting platform and by the consumers of the published tables.

NULL_TOKENS = ["", "NA", "null", "NULL", "\\N"]

# file name patterns (case-insensitive)
DAILY_PATTERN = r"COURIER_DAILY.*\.csv$"
CONNECTIONS_PATTERN = r"connections.*\.csv$"
OFFERS_PATTERN = r"CANCELLATION.*\.csv$"
CANCEL_PATTERN = r"^CANCEL_.*\.csv$"
LATE_PATTERN = r"LATE.*\.csv$"
TRIPS_PATTERN = r"trips.*\.csv$"

DAILY_COLUMNS = [
    "weekstr", "datestr", "driver_uuid", "driver_name", "driver_number", "driver_email",
    "fleet_name", "city_id", "city_name", "market_name", "form_factor",
    "online_hours", "active_hours", "open_hours",
    "enroute_p2_hours", "ontrip_p3_hours", "unavailable_hours",
    "num_of_trips", "single_trips_total", "late_p2_trips", "late_p3_trips",
    "accept_trips", "reject_trips", "cancel_trips", "cancel_not_at_fault_trips",
    "p2_km", "p2_min", "p2_km_avg", "p2_min_avg", "p3_km", "p3_min", "p3_km_avg", "p3_min_avg",
    "total_km", "total_min", "total_km_avg", "total_min_avg",
]
DAILY_DATES = ["weekstr", "datestr"]
DAILY_TEXT = [
    "driver_uuid", "driver_name", "driver_number", "driver_email",
    "fleet_name", "city_name", "market_name", "form_factor",
]
MARKET_COLUMNS = ["city_id", "city_name", "market_name"]
HOUR_COLUMNS = [
    "online_hours", "active_hours", "open_hours",
    "enroute_p2_hours", "ontrip_p3_hours", "unavailable_hours",
]
COUNT_COLUMNS = [
    "num_of_trips", "single_trips_total", "late_p2_trips", "late_p3_trips",
    "accept_trips", "reject_trips", "cancel_trips", "cancel_not_at_fault_trips",
]
DISTANCE_COLUMNS = ["p2_km", "p2_min", "p3_km", "p3_min", "total_km", "total_min"]
LATE_COUNTERS = ["late_p2_trips", "late_p3_trips"]
IDENTITY_COLUMNS = [
    "weekstr", "driver_name", "driver_number", "driver_email",
    "fleet_name", "city_id", "city_name", "market_name", "form_factor",
]

CONNECTION_COLUMNS = [
    "courier_uuid", "courier_name", "contact_number", "fleet_name", "status",
    "datestr", "start_time", "end_time", "job_daily_rank",
]
CONNECTION_KEY = ["courier_uuid", "start_time", "status"]

OFFER_COLUMNS = [
    "timestamp", "courier_uuid", "offer_id", "courier_action",
    "contact_number", "email", "fleet_name",
]
OFFER_KEY = ["offer_id"]

CANCEL_COLUMNS = [
    "hour", "driver_uuid", "delivery_trip_uuid", "order_id", "event_type",
    "cancellation_reason_name", "form_factor",
]
LATE_COLUMNS = [
    "driver_uuid", "delivery_trip_uuid", "order_id", "courier_accept_timestamp_local",
    "actual_p2_driving", "estimated_p2_driving", "actual_p3_driving", "estimated_p3_driving",
]

TRIP_ALIASES = {
    "courier_uuid": ["driver_uuid", "courier_uuid"],
    "trip_uuid": ["delivery_trip_uuid", "trip_uuid", "workflow_uuid", "job_uuid", "order_uuid"],
    "momento": [
        "courier_accept_timestamp_local", "courier_begintrip_timestamp_local",
        "courier_dropoff_timestamp_local", "day_date", "datestr",
    ],
    "km": ["actual_pickup_dropoff_km", "pickup_dropoff_km", "distance_km"],
}
TRIP_OPTIONAL = [
    "order_id", "p2_on_time", "p3_on_time",
    "pickup_approach_minutes", "estimated_pickup_approach_minutes",
    "dropoff_approach_minutes", "estimated_dropoff_approach_minutes",
    "batch_order", "courier_accept_timestamp_local", "courier_dropoff_timestamp_local",
]
TRIP_MEASURES = [
    "batch_order", "courier_accept_timestamp_local", "courier_dropoff_timestamp_local",
    "pickup_approach_minutes", "estimated_pickup_approach_minutes",
    "dropoff_approach_minutes", "estimated_dropoff_approach_minutes",
]

PUBLISHED_RENAMES = {
    "driver_uuid": "courier_uuid",
    "driver_email": "email",
    "city_name": "city",
    "cancel_not_at_fault_trips": "cancel_not_at_fault",
    "tph_adj": "tph",
}
PUBLISHED_COLUMNS = [
    "day", "courier_uuid", "driver_name", "driver_number", "email", "city",
    "flow_type", "num_of_trips", "online_hours", "active_hours",
    "accept_trips", "reject_trips", "cancel_trips", "cancel_not_at_fault",
    "tph", "pct_accept", "pct_cancel",
]
LIVE_COLUMNS = ["market_name", "form_factor", "late_p2_trips", "late_p3_trips", "total_km"]
# ------------------------------------------------------------ end fixed values

# Derived lists
SUMMED_COLUMNS = HOUR_COLUMNS + COUNT_COLUMNS + DISTANCE_COLUMNS
MOVED_COLUMNS = COUNT_COLUMNS + HOUR_COLUMNS + DISTANCE_COLUMNS
DAILY_NUMBERS = [c for c in DAILY_COLUMNS if c not in DAILY_DATES + DAILY_TEXT]
PUBLISHED_TEXT = [
    "day", "courier_uuid", "driver_name", "driver_number", "email", "city",
    "flow_type", "market_name", "form_factor",
]

# Partition column of the bronze tables: the date of the column that dates a row
BRONZE_DAY = "_day"

# Published keyed tables: name -> key columns
DAILY_STATS = "daily_stats"
DAYS_CLOSED = "days_closed"
ORDER_EVENTS = "order_events"
ORDER_DELAYS = "order_delays"
ORDER_KM = "order_km"
TABLE_KEYS = {
    DAILY_STATS: ["courier_uuid", "day"],
    DAYS_CLOSED: ["dia"],
    ORDER_EVENTS: ["courier_uuid", "delivery_trip_uuid", "event_type"],
    ORDER_DELAYS: ["courier_uuid", "delivery_trip_uuid"],
    ORDER_KM: ["courier_uuid", "trip_uuid"],
}
TABLE_DAY = {
    DAILY_STATS: "day",
    DAYS_CLOSED: "dia",
    ORDER_EVENTS: "day",
    ORDER_DELAYS: "day",
    ORDER_KM: "day",
}
