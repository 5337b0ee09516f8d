"""Gold from per-day state: a new day does not rescan the history of events.

Two state tables hold, for each watch date, exact mergeable measures by user:
``activity`` by (date, device, user) and ``viewing`` by (date, title, user).  Sums are
exact decimals and distinct users are rows, so merging days gives what a full
rebuild gives.  Each state is a table replaced by dates; its commit keeps the version
of every event date it was made from, and ``refresh`` reads only the dates whose
version changed since.  A date no longer among the events is dropped.

State holds events only.  Users and subscriptions are applied when gold is made: an
event counts once for each subscription of its user, once if there is none, and not at
all without the user; so a late user or plan needs no date to be read again.

A state has at most one row for each event; it is smaller by how often a user comes
back to a device or title in a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import half_up
from ..functions.columns import DECIMALS, exact_sql
from ..session import run_concurrently
from ..sources import tables
from ..sources.sinks import write_parquet
from . import gold

STATES = {"activity": "device AS watch_device", "viewing": "content_id"}
DAY = "watch_date"


def day_state(watch: DataFrame, by: str) -> DataFrame:
    """Measures of events for each (date, ``by``, user)."""
    name = by.rpartition(" ")[2]
    pct = exact_sql("completion_pct")
    rows = watch.selectExpr(DAY, by, "user_id", "event_id", "CAST(watched_mins AS BIGINT) AS watched_mins",
                            f"{pct} AS completion_pct", "CAST(buffering_events AS BIGINT) AS buffering_events")
    return rows.groupBy(DAY, name, "user_id").agg(
        F.count("event_id").alias("events"),
        *[f(c).alias(f"{c}_{label}") for c in ("watched_mins", "completion_pct", "buffering_events")
          for f, label in ((F.sum, "sum"), (F.count, "n"))])


def refresh(spark: SparkSession, bronze_dir: str, state_dir: str) -> dict[str, list[str]]:
    """Bring the states up to the event table; returns the dates each has read."""
    def job(name: str):
        return lambda: tables.derive(spark, f"{bronze_dir}/watch_events", f"{state_dir}/{name}", DAY,
                                     lambda events: day_state(events, STATES[name]))
    return run_concurrently({name: job(name) for name in STATES})


def _mean(column: str, scale: int, times: str = "1") -> F.Column:
    total, n = f"sum({column}_sum * {times})", f"sum({column}_n * {times})"
    if column == "completion_pct":
        unit = 10 ** DECIMALS
        return half_up(f"CAST({total} AS DECIMAL(28,{DECIMALS})) * {unit}", f"{n} * {unit}", scale)
    return half_up(total, n, scale)


def profile_weights(users: DataFrame, subs: DataFrame) -> DataFrame:
    """(user_id, times): the profile rows each event of a user has."""
    plans = subs.groupBy(F.col("user_id").alias("_user")).agg(F.count("*").alias("n"))
    return users.select("user_id").join(plans, F.expr("user_id = _user"), "left").select(
        "user_id", F.expr("coalesce(n, 1L) AS times"))


def daily_active(activity: DataFrame, weights: DataFrame, ingestion_time: str) -> DataFrame:
    return activity.join(weights, "user_id").groupBy(DAY).agg(
        F.count_distinct("user_id").alias("daily_active_users"),
        F.expr("sum(events * times)").alias("total_watch_events"),
        _mean("watched_mins", 1, "times").alias("avg_watch_mins"),
        _mean("completion_pct", 1, "times").alias("avg_completion_pct"),
        F.expr("sum(watched_mins_sum * times)").alias("total_watch_mins"),
    ).withColumn("ingestion_time", F.lit(ingestion_time))


def device_analytics(activity: DataFrame, weights: DataFrame, ingestion_time: str) -> DataFrame:
    return activity.join(weights, "user_id").groupBy("watch_device").agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.expr("sum(events * times)").alias("total_sessions"),
        _mean("watched_mins", 1, "times").alias("avg_watch_mins"),
        _mean("completion_pct", 1, "times").alias("avg_completion_pct"),
    ).withColumn("ingestion_time", F.lit(ingestion_time))


def content_performance(viewing: DataFrame, content: DataFrame) -> DataFrame:
    per_title = viewing.groupBy("content_id").agg(
        F.sum("events").alias("total_views"),
        _mean("completion_pct", 1).alias("avg_completion_pct"),
        F.sum("watched_mins_sum").alias("total_watch_mins"),
        F.count_distinct("user_id").alias("unique_viewers"),
        _mean("buffering_events", 2).alias("avg_buffering"))
    return per_title.join(content.select(*schemas.TITLE_ATTRIBUTES), "content_id", "left").select(
        *schemas.TITLE_ATTRIBUTES, *per_title.columns[1:])


def gold_tables(spark: SparkSession, bronze_dir: str, state_dir: str, ingestion_time: str) -> dict[str, DataFrame]:
    users, subs, content = (spark.read.parquet(f"{bronze_dir}/{t}") for t in ("users", "subscriptions", "content_catalog"))
    activity, viewing = (tables.read(spark, f"{state_dir}/{name}") for name in STATES)
    weights = profile_weights(users, subs)
    return {"dau_metrics": daily_active(activity, weights, ingestion_time),
            "revenue_summary": gold.revenue_summary(subs, ingestion_time),
            "top_content": gold.top_content(content_performance(viewing, content), ingestion_time),
            "device_analytics": device_analytics(activity, weights, ingestion_time)}


def run(spark: SparkSession, bronze_dir: str, state_dir: str, gold_dir: str, ingestion_time: str) -> dict[str, int]:
    """Job: refresh the states, then write the gold tables from them; returns row counts and
    ``dates_<state>``, how many dates of events were read."""
    dates = refresh(spark, bronze_dir, state_dir)
    counts = run_concurrently({
        name: (lambda d=df, n=name: write_parquet(d, f"{gold_dir}/{n}"))
        for name, df in gold_tables(spark, bronze_dir, state_dir, ingestion_time).items()})
    return counts | {f"dates_{name}": len(found) for name, found in dates.items()}
