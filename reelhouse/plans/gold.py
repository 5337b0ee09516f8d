"""Silver -> gold: the four KPI tables.

The reference sorts each table before writing; a global sort is not a
property a Parquet table keeps, so it is dropped here and readers sort (the
report queries do).  All averages are exact HALF_UP (see functions.columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import avg_half_up, half_up
from ..session import run_concurrently
from ..sources.sinks import write_parquet


def dau_metrics(profile: DataFrame, ingestion_time: str) -> DataFrame:
    """Per watch_date: distinct users, events, mean minutes / completion, total minutes."""
    return profile.groupBy("watch_date").agg(
        F.count_distinct("user_id").alias("daily_active_users"),
        F.count("event_id").alias("total_watch_events"),
        avg_half_up("watched_mins", 0, 1).alias("avg_watch_mins"),
        avg_half_up("completion_pct", 1, 1).alias("avg_completion_pct"),
        F.sum("watched_mins").alias("total_watch_mins"),
    ).withColumn("ingestion_time", F.lit(ingestion_time))


def revenue_summary(subs: DataFrame, ingestion_time: str) -> DataFrame:
    """Per (start month as yyyy-MM, plan): new subscribers, revenue, mean amount."""
    return (
        subs.withColumn("month", F.date_format("start_date", "yyyy-MM"))
        .groupBy("month", "plan")
        .agg(
            F.count("subscription_id").alias("new_subscribers"),
            F.sum("amount_paid").alias("monthly_revenue"),
            avg_half_up("amount_paid", 0, 2).alias("avg_revenue_per_user"),
        )
        .withColumn("ingestion_time", F.lit(ingestion_time))
    )


def top_content(perf: DataFrame, ingestion_time: str) -> DataFrame:
    """Per-title measures plus watch hours (minutes / 60, HALF_UP to 1 dp)."""
    return perf.select(
        "content_id", "title", "type", "genre", "language", "rating", "total_views",
        "avg_completion_pct", "total_watch_mins", "unique_viewers",
    ).withColumns({
        "watch_hours": half_up("total_watch_mins", "60", 1),
        "ingestion_time": F.lit(ingestion_time),
    })


def device_analytics(profile: DataFrame, ingestion_time: str) -> DataFrame:
    return profile.groupBy("watch_device").agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count("event_id").alias("total_sessions"),
        avg_half_up("watched_mins", 0, 1).alias("avg_watch_mins"),
        avg_half_up("completion_pct", 1, 1).alias("avg_completion_pct"),
    ).withColumn("ingestion_time", F.lit(ingestion_time))


def gold_tables(profile: DataFrame, perf: DataFrame, subs: DataFrame,
                ingestion_time: str) -> dict[str, DataFrame]:
    return {
        "dau_metrics": dau_metrics(profile, ingestion_time),
        "revenue_summary": revenue_summary(subs, ingestion_time),
        "top_content": top_content(perf, ingestion_time),
        "device_analytics": device_analytics(profile, ingestion_time),
    }


def run(spark: SparkSession, silver_dir: str, bronze_dir: str, gold_dir: str,
        ingestion_time: str) -> dict[str, int]:
    profile = spark.read.parquet(f"{silver_dir}/user_watch_profile")
    perf = spark.read.parquet(f"{silver_dir}/content_performance")
    subs = spark.read.parquet(f"{bronze_dir}/subscriptions")
    return run_concurrently({
        name: (lambda d=df, n=name: write_parquet(d, f"{gold_dir}/{n}"))
        for name, df in gold_tables(profile, perf, subs, ingestion_time).items()})
