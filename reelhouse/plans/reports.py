"""The ten-query report pack over the gold tables.

Every input here is a gold aggregate (days, months x plans, titles, devices),
so these plans are small; the two ``OVER ()`` shares run on a handful of
aggregated rows.  Sorts that end in LIMIT get a unique tiebreak so the
result is deterministic, with NULL placement spelled out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_half_up, share_pct, sum_scaled


def q01_dau_last30(dau: DataFrame) -> DataFrame:
    """Latest 30 days: DAU, events, mean minutes, whole watch hours."""
    return (
        dau.select("watch_date", "daily_active_users", "total_watch_events", "avg_watch_mins",
                   F.expr("total_watch_mins div 60").alias("total_watch_hours"))
        .orderBy(F.col("watch_date").desc_nulls_last())
        .limit(30)
    )


def q02_mau(dau: DataFrame) -> DataFrame:
    """Per month: summed daily actives (user-days), events, mean of daily means, hours."""
    return (
        dau.groupBy(F.trunc("watch_date", "month").alias("month"))
        .agg(
            F.sum("daily_active_users").alias("monthly_active_users"),
            F.sum("total_watch_events").alias("monthly_watch_events"),
            avg_half_up("avg_watch_mins", 1, 1).alias("avg_daily_watch_mins"),
            F.expr("sum(total_watch_mins) div 60").alias("total_watch_hours"),
        )
        .orderBy(F.col("month").desc_nulls_last())
    )


def q03_revenue_by_plan(revenue: DataFrame) -> DataFrame:
    by_plan = revenue.groupBy("plan").agg(
        F.sum("monthly_revenue").alias("total_revenue"),
        F.sum("new_subscribers").alias("total_subscribers"),
        avg_half_up("avg_revenue_per_user", 2, 2).alias("avg_revenue_per_user"),
    )
    return (
        by_plan.withColumn("_all", F.sum("total_revenue").over(Window.partitionBy()))
        .withColumn("revenue_share_pct", share_pct("total_revenue", "_all", 1))
        .drop("_all")
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("plan").asc_nulls_last())
    )


def q04_monthly_revenue(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("month")
        .agg(F.sum("monthly_revenue").alias("total_revenue"),
             F.sum("new_subscribers").alias("total_subscribers"))
        .orderBy(F.col("month").desc_nulls_last())
        .limit(12)
    )


def q05_top10_content(top: DataFrame) -> DataFrame:
    return (
        top.orderBy(F.col("watch_hours").desc_nulls_last(), F.col("content_id").asc_nulls_last())
        .limit(10)
        .select("title", "type", "genre", "language", "rating", "total_views", "watch_hours",
                "unique_viewers", "avg_completion_pct")
    )


def q06_device_share(device: DataFrame) -> DataFrame:
    return (
        device.withColumn("_all", F.sum("total_sessions").over(Window.partitionBy()))
        .select("watch_device", "unique_users", "total_sessions", "avg_watch_mins",
                "avg_completion_pct",
                share_pct("total_sessions", "_all", 1).alias("session_share_pct"))
        .orderBy(F.col("total_sessions").desc_nulls_last())
    )


def q07_genre_performance(top: DataFrame) -> DataFrame:
    return (
        top.groupBy("genre")
        .agg(
            F.count(F.lit(1)).alias("total_titles"),
            avg_half_up("avg_completion_pct", 1, 1).alias("avg_completion_pct"),
            F.sum("total_views").alias("total_views"),
            sum_scaled("watch_hours", 1).alias("total_watch_hours"),
            F.sum("unique_viewers").alias("total_unique_viewers"),
        )
        .orderBy(F.col("avg_completion_pct").desc_nulls_last())
    )


def q08_type_performance(top: DataFrame) -> DataFrame:
    return (
        top.groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("total_titles"),
            F.sum("total_views").alias("total_views"),
            sum_scaled("watch_hours", 1).alias("total_watch_hours"),
            avg_half_up("avg_completion_pct", 1, 1).alias("avg_completion_pct"),
            avg_half_up("rating", 1, 1).alias("avg_rating"),
        )
        .orderBy(F.col("total_views").desc_nulls_last())
    )


def q09_day_vs_average(dau: DataFrame) -> DataFrame:
    """Top 20 days by DAU, labelled against the mean DAU over all days.

    The mean is an uncorrelated scalar subquery (computed once).  The test
    ``dau > sum / n`` is evaluated as ``dau * n > sum`` in integers.
    """
    total = dau.select(F.sum("daily_active_users")).scalar()
    n = dau.select(F.count("daily_active_users")).scalar()
    above = F.col("daily_active_users") * n > total
    return (
        dau.select("watch_date", "daily_active_users", "avg_watch_mins",
                   F.when(above, "Above Average").otherwise("Below Average").alias("performance"))
        .orderBy(F.col("daily_active_users").desc_nulls_last(), F.col("watch_date").asc_nulls_last())
        .limit(20)
    )


def q10_executive(revenue: DataFrame) -> DataFrame:
    """Platform totals over paid plans (``plan != 'free'`` also drops NULL plans)."""
    return revenue.where(F.col("plan") != "free").agg(
        F.sum("monthly_revenue").alias("total_platform_revenue"),
        F.sum("new_subscribers").alias("total_subscribers"),
        F.count_distinct("plan").alias("active_plans"),
        F.max("monthly_revenue").alias("peak_month_revenue"),
        F.min("monthly_revenue").alias("lowest_month_revenue"),
    )


def mau_distinct(profile: DataFrame) -> DataFrame:
    """True monthly active users: distinct viewers per month (q02 sums daily
    actives, i.e. counts user-days).  Reads the silver profile; the distinct
    aggregate is de-duplicated map-side on (month, user)."""
    return (
        profile.groupBy(F.trunc("watch_date", "month").alias("month"))
        .agg(F.count_distinct("user_id").alias("monthly_active_users"))
        .orderBy(F.col("month").desc_nulls_last())
    )


REPORTS = {
    "q01_dau_last30": ("dau_metrics", q01_dau_last30),
    "q02_mau": ("dau_metrics", q02_mau),
    "q03_revenue_by_plan": ("revenue_summary", q03_revenue_by_plan),
    "q04_monthly_revenue": ("revenue_summary", q04_monthly_revenue),
    "q05_top10_content": ("top_content", q05_top10_content),
    "q06_device_share": ("device_analytics", q06_device_share),
    "q07_genre_performance": ("top_content", q07_genre_performance),
    "q08_type_performance": ("top_content", q08_type_performance),
    "q09_day_vs_average": ("dau_metrics", q09_day_vs_average),
    "q10_executive": ("revenue_summary", q10_executive),
}


def run_reports(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: fn(gold[src]) for name, (src, fn) in REPORTS.items()}

