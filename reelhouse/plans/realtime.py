"""Event-path outputs: batch forms of the processor and the state machine,
and the streamed engagement store with its read patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import store
from ..session import new_scratch
from ..sources import domain
from ..streaming.engagement import located, message_stream, parsed_events, run_engagement_stream
from ..streaming.feed import envelope_feed, land_feed

def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_feed(domain.watch_events(spark, sf_dir))


def flat_notifications(df: DataFrame) -> DataFrame:
    """Replace the notification array with comparable text columns."""
    return df.withColumns({
        "notification_types": F.array_join(F.transform("notifications", lambda n: n["type"]), ","),
        "notification_text": F.array_join(F.transform("notifications", lambda n: n["message"]), "|"),
    }).drop("notifications")


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.process_events(parsed_events(feed(spark, sf_dir)))


def state_machine(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    payloads = ev.parse_envelopes(located(feed(spark, sf_dir)))
    validated = ev.validate_events(payloads)
    passed = validated.where(F.col("validation_error").isNull())
    scored = ev.score_events(passed)
    routed, errors = ev.state_machine(payloads)
    keep = ["event_id", "user_id", "content_id", "completion_pct", "watched_mins", "device",
            "region", "validation_status"]
    return {
        "event_validated": passed.select(*keep, "validated_at"),
        "event_scored": scored.select(*keep, "engagement_score", "engagement_level",
                                      "should_notify", "validated_at", "scored_at"),
        "event_routed": routed,
        "event_errors": errors,
    }


def stream_store(spark: SparkSession, sf_dir: str, dedupe: str = "batch") -> str:
    """Land the feed as files and replay it through the stream; returns the store dir."""
    root = new_scratch(spark, "engagement")
    land_feed(feed(spark, sf_dir), f"{root}/feed")
    run_engagement_stream(spark, f"{root}/feed", f"{root}/store", f"{root}/dead_letters",
                          f"{root}/checkpoint", dedupe=dedupe)
    return f"{root}/store"


def compacted_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stream runs over two halves of the feed (separate checkpoints), a
    compaction between them, then the latest view read as snapshot + newer
    batches.  Repeats that straddle the halves meet in the view."""
    root = new_scratch(spark, "engagement-compacted")
    land_feed(feed(spark, sf_dir), f"{root}/feed")
    for part, half in (("a", 0), ("b", 1)):
        messages = message_stream(spark, f"{root}/feed").where(F.pmod(F.xxhash64("value"), F.lit(2)) == half)
        run_engagement_stream(spark, f"{root}/feed", f"{root}/store", f"{root}/dead",
                              f"{root}/checkpoint_{part}", messages=messages)
        if part == "a":
            store.compact(spark, f"{root}/store", f"{root}/snapshot")
    return store.read_latest(spark, f"{root}/store", f"{root}/snapshot")


def store_outputs(spark: SparkSession, store_dir: str) -> dict[str, DataFrame]:
    rows = store.read_store(spark, store_dir)
    view = store.latest(rows)
    top = store.busiest_user(view)
    return {
        "engagement_store": rows,
        "engagement_latest": view,
        "engagement_by_user": store.events_of_user(view, top),
        "engagement_range": store.recent_events(view, top, days=30),
        "engagement_high_users": store.high_engagement_users(view),
    }


def stored_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store as two runs wrote it with repeats left out at the sink: no reader collapses
    anything.  The first run gets the first copies, the second one the whole feed."""
    root = new_scratch(spark, "engagement-once")
    msgs = feed(spark, sf_dir)
    land_feed(msgs.where("offset % 2 = 0"), f"{root}/feed_a")
    land_feed(msgs, f"{root}/feed_b")
    for part in ("a", "b"):
        run_engagement_stream(spark, f"{root}/feed_{part}", f"{root}/store", f"{root}/dead",
                              f"{root}/checkpoint_{part}", dedupe="sink")
    return spark.read.schema(store.STORE_SCHEMA).parquet(*[b.path for b in store.committed(spark, f"{root}/store")])


def batch_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The save status of each batch of two runs: the first copies, then the copies sent again."""
    root, msgs = new_scratch(spark, "engagement-status"), feed(spark, sf_dir)
    for part in (0, 1):
        land_feed(msgs.where(f"offset % 2 = {part}"), f"{root}/feed_{part}")
        run_engagement_stream(spark, f"{root}/feed_{part}", f"{root}/store", f"{root}/dead", f"{root}/checkpoint_{part}")
    return store.statuses(spark, f"{root}/store").select("version", "batch_id", "status", "n_events", "n_rejected")
