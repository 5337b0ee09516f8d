"""Declared schemas for every layer.

Raw files are read with an all-string schema built from these (no inference),
then cast with ``try_cast`` so one malformed cell becomes NULL instead of
failing the job under ANSI mode.  Ids are text (``USR000001``, a uuid, ``CNT0001``)
and pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _schema(
    ("user_id", S), ("name", S), ("email", S), ("age", I), ("gender", S), ("region", S),
    ("device", S), ("signup_date", DT), ("is_active", B), ("preferred_lang", S),
)

SUBSCRIPTIONS = _schema(
    ("subscription_id", S), ("user_id", S), ("plan", S), ("start_date", DT), ("end_date", DT),
    ("amount_paid", I), ("payment_method", S), ("auto_renew", B),
)

CONTENT_CATALOG = _schema(
    ("content_id", S), ("title", S), ("type", S), ("genre", S), ("language", S),
    ("release_year", I), ("duration_mins", I), ("rating", D), ("num_seasons", I),
    ("is_original", B),
)

WATCH_EVENTS = _schema(
    ("event_id", S), ("user_id", S), ("content_id", S), ("watch_start_time", TS),
    ("duration_mins", I), ("watched_mins", I), ("completion_pct", D), ("device", S),
    ("region", S), ("buffering_events", I), ("quality", S),
)

# Typed schema and business key of each raw table.
RAW = {
    "users": (USERS, "user_id"),
    "subscriptions": (SUBSCRIPTIONS, "subscription_id"),
    "content_catalog": (CONTENT_CATALOG, "content_id"),
    "watch_events": (WATCH_EVENTS, "event_id"),
}

# The columns silver takes from each bronze table, with their silver names
# where these differ (``device`` means another thing for users and for events).
PROFILE_USERS = ["user_id", "name", "age", "gender", "region", "device AS user_preferred_device",
                 "signup_date", "is_active", "preferred_lang"]
PROFILE_SUBSCRIPTIONS = ["user_id", "plan", "amount_paid", "start_date", "end_date"]
PROFILE_EVENTS = ["event_id", "user_id", "content_id", "watch_start_time", "watched_mins", "completion_pct",
                  "device AS watch_device", "quality", "buffering_events", "watch_date", "watch_hour"]
TITLE_ATTRIBUTES = ["content_id", "title", "type", "genre", "language", "rating"]

# Logical source label written into bronze ``source_file`` (fixed values).
SOURCE_FILES = {
    "users": "raw/users/users.csv",
    "subscriptions": "raw/subscriptions/subscriptions.csv",
    "content_catalog": "raw/content_catalog/content_catalog.csv",
    "watch_events": "raw/watch_events/watch_events.json",
}


def as_strings(schema: T.StructType) -> T.StructType:
    """The raw landing schema: same names, every field a string."""
    return T.StructType([T.StructField(f.name, S, True) for f in schema.fields])


# Real-time event fields as they arrive inside an envelope (all text: query
# strings carry numbers as text, JSON bodies as numbers; both parse to text).
EVENT_FIELDS = ["event_id", "user_id", "content_id", "completion_pct", "watched_mins",
                "device", "region", "event_time"]
EVENT_PAYLOAD = _schema(*[(f, S) for f in EVENT_FIELDS])
ENVELOPE = T.StructType(
    list(EVENT_PAYLOAD.fields)
    + [
        T.StructField("queryStringParameters", T.MapType(S, S), True),
        T.StructField("Records", T.ArrayType(_schema(("body", S))), True),
        T.StructField("body", S, True),
    ]
)

QUALITY_REPORT = _schema(
    ("check_name", S), ("table", S), ("total_records", L), ("passed", L), ("failed", L),
    ("pass_rate_pct", D), ("status", S), ("run_time", S),
)
