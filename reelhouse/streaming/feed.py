"""Message feed derived from the watch events (test and bench input).

Each event becomes a message in one of the four envelopes, chosen by the event's
number modulo 4 (bare, query string, queue records, body), with the time it
arrived and its position in the queue (topic, partition, offset).  Messages carry
delivery metadata (``event_id``, ``event_time``) at the top level; the query-string
envelope sends every value as text.  The feed is as untidy as a queue:

* numbers ending in 00 are sent again five minutes later, at another offset;
* numbers ending in 50 are read twice from the same offset;
* some messages have no id at all; each of these is sent twice in one second,
  which makes two events, and some of them are then read twice;
* numbers ending in 999 have a corrupt body;
* some events have no time, a time two years on or one in 2099;
* some queue batches hold a second record without an id of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.domain import number_of

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CORRUPT_BODY = "not json"
TOPIC, PARTITIONS = "watch-events", 8

NAMELESS = "number % 45 = 31"
# Event times of the feed, by the event's number.
EVENT_TIME = """CASE WHEN number % 300 = 7 OR number % 90 = 31 THEN NULL
  WHEN number % 200 = 13 THEN watch_start_time + INTERVAL 730 DAY
  WHEN number % 500 = 21 THEN TIMESTAMP_NTZ '2099-01-01 00:00:00' ELSE watch_start_time END"""
SECOND_RECORD = "number % 40 = 2"        # of the queue batches (number % 4 = 2)
# Deliveries: which copy of the message, and how many minutes late.
DELIVERIES = f"""CASE WHEN number % 135 = 121 THEN array((0, 0), (1, 0), (1, 0))
  WHEN {NAMELESS} THEN array((0, 0), (1, 0))
  WHEN number % 100 = 0 THEN array((0, 0), (1, 5))
  WHEN number % 100 = 50 THEN array((0, 0), (0, 0)) ELSE array((0, 0)) END"""


def envelope_feed(watch_events: DataFrame) -> DataFrame:
    """Watch events -> ``(value, arrived_at, topic, partition, offset)`` messages."""
    numbered = watch_events.withColumn("number", F.expr(number_of("event_id"))).withColumn(
        "delivery", F.explode(F.expr(DELIVERIES).cast("array<struct<copy: int, late: int>>")))
    ev = numbered.select(
        F.when(~F.expr(NAMELESS), F.col("event_id")).alias("event_id"),
        "user_id", "content_id", "completion_pct", "watched_mins", "device", "region",
        F.date_format(F.expr(EVENT_TIME), TS_TEXT).alias("event_time"),
        F.expr("CAST(date_trunc('second', watch_start_time + INTERVAL 1 MINUTE) AS TIMESTAMP_NTZ)"
               " + make_dt_interval(0, 0, delivery.late)").alias("arrived_at"),
        (F.col("number") % PARTITIONS).cast("int").alias("partition"),
        (F.col("number") * 2 + F.col("delivery.copy")).cast("long").alias("offset"),
        (F.col("number") % 4).alias("_shape"),
        (F.col("number") % 1000 == 999).alias("_corrupt"),
        F.expr(SECOND_RECORD).alias("_second"),
    )
    fields = ["event_id", "user_id", "content_id", "completion_pct", "watched_mins", "device",
              "region", "event_time"]
    payload = F.to_json(F.struct(*fields))
    second = [F.struct(F.to_json(F.struct(F.col("user_id"), F.col("content_id"), F.lit(85).alias("completion_pct"),
                                          (F.lit(30.5) + i).alias("watched_mins"), "device", "region")).alias("body"))
              for i in (0, 1)]
    one = F.array(F.struct(payload.alias("body")))
    as_text = F.struct(*[F.col(f).cast("string").alias(f) for f in fields])
    meta = [F.col("event_id"), F.col("event_time")]
    value = (
        F.when(F.col("_shape") == 0, payload)
        .when(F.col("_shape") == 1,
              F.to_json(F.struct(*meta, as_text.alias("queryStringParameters"))))
        .when(F.col("_shape") == 2,
              F.to_json(F.struct(*meta, F.when(F.col("_second"), F.array(*second)).otherwise(one).alias("Records"))))
        .otherwise(F.to_json(F.struct(
            *meta, F.when(F.col("_corrupt"), F.lit(CORRUPT_BODY)).otherwise(payload).alias("body"))))
    )
    return ev.select(value.alias("value"), "arrived_at", F.lit(TOPIC).alias("topic"), "partition", "offset")


def land_feed(feed: DataFrame, path: str) -> None:
    """Write messages as Parquet files for a file stream, as the scan split them."""
    feed.write.mode("overwrite").parquet(path)
