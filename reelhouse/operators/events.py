"""Per-event rules as DataFrame transforms (identical in batch and streaming).

Input is a frame with a text column ``value`` holding one message.  A message
is a viewing event in one of four envelopes, tried in this order:

1. bare event whose ``user_id`` is non-empty,
2. ``queryStringParameters`` with any entry (all values text),
3. ``Records`` -- a queue batch; every record's ``body`` is JSON text and gets an id of its own,
4. ``body`` -- JSON text,

otherwise it is an empty event.  All records of a queue batch are kept (one
output row each).  Message-level ``event_id`` / ``event_time`` (delivery
metadata) back-fill the payload's own, and the position of the message in its
source stands in for an id that neither has: two equal messages at two positions
are two events, one position read twice is one.  Every rule is a built-in column
expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as R

# -- fixed values (texts the reference emits) -----------------------------------
BADGE = ("BINGE_WATCHER_BADGE", "User %s earned Binge Watcher badge!")
REWARD = ("COMPLETION_REWARD", "User %s completed %s!")
LONG_SESSION = ("LONG_SESSION", "User %s watched %d mins")
ROUTES = [
    ("HIGH", "SEND_BINGE_NOTIFICATION", "Binge watcher detected: "),
    ("MEDIUM", "UPDATE_RECOMMENDATIONS", "Update recommendations for: "),
]
DEFAULT_ROUTE = ("LOG_AND_EXIT", "Low engagement for: ")
VALIDATION_ERROR = ("ValidationError", "Event failed validation checks")
PROCESSING_ERROR = ("ProcessingError", "Engagement scoring failed")
REQUIRED = ["user_id", "content_id", "completion_pct", "watched_mins"]
UNKNOWN_ID, UNKNOWN_ATTR = "UNKNOWN", "unknown"
STAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
NUMBER_OF_MINUTES = r'"watched_mins"\s*:\s*-?[0-9]'


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def parse_envelopes(df: DataFrame, value_col: str = "value", arrived_col: str = "arrived_at") -> DataFrame:
    """Message text -> one row per event payload.

    Output: ``raw`` (message text), ``p`` (payload struct of text fields),
    ``event_id`` and ``event_time`` (payload value, else message metadata, for
    the id else the message's ``position``; the records of a batch that share the
    message's id or position get it and their place), ``mins_is_number`` (minutes
    sent as a JSON number) and ``arrived_at`` (of the message).  ``position`` and
    ``arrived_at`` are NULL if the source has no such column.
    """
    env = F.from_json(F.col(value_col), schemas.ENVELOPE)
    arrived, position = (F.col(c) if c in df.columns else F.lit(None) for c in (arrived_col, "position"))
    e = df.select(F.col(value_col).alias("raw"), arrived.cast("timestamp_ntz").alias("arrived_at"),
                  position.cast("string").alias("position"), env.alias("env"))
    fields = schemas.EVENT_FIELDS
    number = lambda text: F.coalesce(text.rlike(NUMBER_OF_MINUTES), F.lit(False))

    def event(p: Column, text: Column) -> Column:
        return F.struct(p.cast(schemas.EVENT_PAYLOAD).alias("p"), text.alias("number"))

    top = F.struct(*[F.col(f"env.{f}").alias(f) for f in fields])
    query = F.col("env.queryStringParameters")
    records = F.col("env.Records")
    body = F.col("env.body")
    payloads = (
        F.when(_nonempty(F.col("env.user_id")), F.array(event(top, number(F.col("raw")))))
        .when(F.size(query) > 0, F.array(event(F.struct(*[query.getItem(f).alias(f) for f in fields]), F.lit(False))))
        .when(F.size(records) > 0,
              F.transform(records, lambda r: event(F.from_json(r["body"], schemas.EVENT_PAYLOAD), number(r["body"]))))
        .when(_nonempty(body), F.array(event(F.from_json(body, schemas.EVENT_PAYLOAD), number(body))))
        .otherwise(F.array(event(F.lit(None), F.lit(False))))
    )
    out = e.select("raw", "arrived_at", F.coalesce("env.event_id", "position").alias("_m_id"), F.col("env.event_time").alias("_m_time"),
                   (F.size(records) > 1).alias("_many"), F.posexplode(payloads).alias("_place", "e"))
    own = F.when(F.col("_many") & F.col("_m_id").isNotNull(),
                 F.concat("_m_id", F.lit("#"), F.col("_place").cast("string"))).otherwise(F.col("_m_id"))
    return out.select(
        "raw", F.col("e.p").alias("p"),
        F.coalesce(F.col("e.p.event_id"), own).alias("event_id"),
        F.coalesce(F.col("e.p.event_time"), F.col("_m_time")).alias("event_time"),
        F.col("e.number").alias("mins_is_number"), "arrived_at",
    )


def extract_fields(df: DataFrame) -> DataFrame:
    """Typed fields with the processor's defaults (ids UNKNOWN, numbers 0,
    device/region unknown).  A present value that does not parse as a number
    sets ``parse_error`` instead of failing the job."""
    pct_txt, mins_txt = F.col("p.completion_pct"), F.col("p.watched_mins")
    pct = pct_txt.try_cast("double")
    mins = mins_txt.try_cast("double").try_cast("int")  # int(float(x)): truncates
    return df.withColumns({
        "user_id": F.coalesce(F.col("p.user_id"), F.lit(UNKNOWN_ID)),
        "content_id": F.coalesce(F.col("p.content_id"), F.lit(UNKNOWN_ID)),
        "completion_pct": F.when(pct_txt.isNull(), F.lit(0.0)).otherwise(pct),
        "watched_mins": F.when(mins_txt.isNull(), F.lit(0)).otherwise(mins),
        "device": F.coalesce(F.col("p.device"), F.lit(UNKNOWN_ATTR)),
        "region": F.coalesce(F.col("p.region"), F.lit(UNKNOWN_ATTR)),
        "event_ts": F.col("event_time").try_cast("timestamp_ntz"),
        "parse_error": F.when(pct_txt.isNotNull() & pct.isNull(),
                              F.concat(F.lit("could not parse completion_pct: "), pct_txt))
                       .when(mins_txt.isNotNull() & mins.isNull(),
                             F.concat(F.lit("could not parse watched_mins: "), mins_txt)),
    })


_ge = R.at_least
engagement_level = R.engagement_level


def notifications(user: Column, content: Column, pct: Column, mins: Column) -> Column:
    """Badge (>= 80 %), reward (== 100 %), long session (> 120 min), in that order."""
    def note(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("message"))
    return F.array_compact(F.array(
        F.when(_ge(pct, R.HIGH_PCT), note(BADGE[0], F.format_string(BADGE[1], user))),
        F.when(pct == 100, note(REWARD[0], F.format_string(REWARD[1], user, content))),
        F.when(mins > R.LONG_SESSION_MINS,
               note(LONG_SESSION[0], F.format_string(LONG_SESSION[1], user, mins))),
    ))


def process_events(df: DataFrame) -> DataFrame:
    """The processor record per event (rows with ``parse_error`` excluded)."""
    pct, mins = F.col("completion_pct"), F.col("watched_mins")
    notes = notifications(F.col("user_id"), F.col("content_id"), pct, mins)
    return df.where(F.col("parse_error").isNull()).select(
        F.col("event_id").alias("request_id"),
        "event_ts",
        "user_id", "content_id", "completion_pct", "watched_mins", "device", "region",
        engagement_level(pct).alias("engagement_level"),
        _ge(pct, R.HIGH_PCT).alias("is_binge_watcher"),
        _ge(pct, R.MEDIUM_PCT).alias("is_engaged"),
        # an event without a time of its own is stamped with its arrival
        F.date_format(F.date_trunc("second", F.coalesce("event_ts", "arrived_at")), STAMP_TEXT).alias("processed_at"),
        "arrived_at",
        notes.alias("notifications"),
        F.size(notes).alias("notification_count"),
    )


def processor_errors(df: DataFrame) -> DataFrame:
    return df.where(F.col("parse_error").isNotNull()).select(
        F.col("event_id").alias("request_id"), F.lit("ParseError").alias("error"),
        F.col("parse_error").alias("cause"), "raw")


# -- validate -> score -> route (the state machine) ------------------------------

def whole_minutes(text: Column) -> Column:
    """Minutes as the validator reads them: a JSON number is truncated, text must be whole."""
    return F.when(F.col("mins_is_number"), text.try_cast("double").try_cast("int")).otherwise(text.try_cast("int"))


def validation_error(p: str = "p") -> Column:
    """First failing rule wins: missing fields, completion range, minutes, user id."""
    f = lambda n: F.col(f"{p}.{n}")
    missing = F.array_compact(F.array(*[F.when(f(n).isNull(), F.lit(n)) for n in REQUIRED]))
    pct = f("completion_pct").try_cast("double")
    mins = whole_minutes(f("watched_mins"))
    pct_text = F.coalesce(pct.cast("string"), f("completion_pct"))
    return (
        F.when(F.size(missing) > 0,
               F.concat(F.lit("Missing required fields: ['"), F.array_join(missing, "', '"),
                        F.lit("']")))
        .when(pct.isNull() | F.isnan(pct) | (pct < 0) | (pct > 100),
              F.concat(F.lit("Invalid completion_pct: "), pct_text, F.lit(". Must be 0-100.")))
        .when(mins.isNull() | (mins < 0),
              F.concat(F.lit("Invalid watched_mins: "), f("watched_mins"), F.lit(". Must be >= 0.")))
        .when(f("user_id").isin("", UNKNOWN_ID),
              F.concat(F.lit("Invalid user_id: "), f("user_id")))
    )


def validate_events(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Adds ``validation_error``; passing rows get typed fields and PASSED."""
    stamp = stamp if stamp is not None else F.date_format(F.current_timestamp(), STAMP_TEXT)
    return df.withColumn("validation_error", validation_error()).withColumns({
        "user_id": F.col("p.user_id"),
        "content_id": F.col("p.content_id"),
        "completion_pct": F.col("p.completion_pct").try_cast("double"),
        "watched_mins": whole_minutes(F.col("p.watched_mins")),
        "device": F.col("p.device"),
        "region": F.col("p.region"),
        "validation_status": F.when(F.col("validation_error").isNull(), F.lit("PASSED")),
        "validated_at": F.when(F.col("validation_error").isNull(), stamp),
    })


def score_events(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    stamp = stamp if stamp is not None else F.date_format(F.current_timestamp(), STAMP_TEXT)
    pct, mins = F.col("completion_pct"), F.col("watched_mins")
    return df.withColumns({
        "engagement_score": R.engagement_score(pct, mins),
        "engagement_level": engagement_level(pct),
        "should_notify": _ge(pct, R.HIGH_PCT),
        "scored_at": stamp,
    })


BODY_COLUMNS = ["event_id", "user_id", "content_id", "completion_pct", "watched_mins", "device",
                "region", "validation_status", "validated_at", "engagement_score",
                "engagement_level", "should_notify", "scored_at"]


def route_events(df: DataFrame) -> DataFrame:
    level = F.col("engagement_level")
    action = F.when(level == ROUTES[0][0], ROUTES[0][1]).when(level == ROUTES[1][0], ROUTES[1][1]) \
        .otherwise(DEFAULT_ROUTE[0])
    prefix = F.when(level == ROUTES[0][0], ROUTES[0][2]).when(level == ROUTES[1][0], ROUTES[1][2]) \
        .otherwise(DEFAULT_ROUTE[1])
    return df.select(
        action.alias("action"),
        F.concat(prefix, F.col("user_id")).alias("message"),
        "engagement_score",
        F.struct(*BODY_COLUMNS).alias("data"),
    )


def state_machine(payloads: DataFrame, stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """validate -> score -> route; returns (routed, errors).  Nothing raises:
    failing events become dead-letter rows."""
    v = validate_events(payloads, stamp)
    ok = score_events(v.where(F.col("validation_error").isNull()), stamp)
    scored_ok = ok.where(F.col("engagement_score").isNotNull())
    routed = route_events(scored_ok)
    errors = v.where(F.col("validation_error").isNotNull()).select(
        F.col("event_id").alias("request_id"), F.lit(VALIDATION_ERROR[0]).alias("error"),
        F.lit(VALIDATION_ERROR[1]).alias("cause"), F.col("validation_error").alias("detail"), "raw",
    ).unionByName(ok.where(F.col("engagement_score").isNull()).select(
        F.col("event_id").alias("request_id"), F.lit(PROCESSING_ERROR[0]).alias("error"),
        F.lit(PROCESSING_ERROR[1]).alias("cause"), F.lit(None).cast("string").alias("detail"), "raw",
    ))
    return routed, errors
