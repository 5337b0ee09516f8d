"""The report pack as SQL text over named gold tables.

``register_gold_views`` publishes the gold tables under their names (temp
views here; ``saveAsTable`` on a cluster catalog), and ``run_sql`` executes a
report with ``spark.sql``.  Catalyst plans these exactly like the DataFrame
forms in ``reports``.  Averages and shares use the exact HALF_UP integer
formula, written out in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import avg_half_up_sql, exact_sql, half_up_sql


def _avg(col: str, in_scale: int, out_scale: int) -> str:
    return avg_half_up_sql(col, in_scale, out_scale)


SQL = {
    "q01_dau_last30": """
SELECT watch_date, daily_active_users, total_watch_events, avg_watch_mins,
       total_watch_mins div 60 AS total_watch_hours
FROM dau_metrics
ORDER BY watch_date DESC
LIMIT 30""",
    "q02_mau": f"""
SELECT trunc(watch_date, 'MM') AS month,
       sum(daily_active_users) AS monthly_active_users,
       sum(total_watch_events) AS monthly_watch_events,
       {_avg('avg_watch_mins', 1, 1)} AS avg_daily_watch_mins,
       sum(total_watch_mins) div 60 AS total_watch_hours
FROM dau_metrics
GROUP BY trunc(watch_date, 'MM')
ORDER BY month DESC""",
    "q03_revenue_by_plan": f"""
SELECT plan,
       sum(monthly_revenue) AS total_revenue,
       sum(new_subscribers) AS total_subscribers,
       {_avg('avg_revenue_per_user', 2, 2)} AS avg_revenue_per_user,
       {half_up_sql('sum(monthly_revenue) * 100', 'sum(sum(monthly_revenue)) OVER ()', 1)}
         AS revenue_share_pct
FROM revenue_summary
GROUP BY plan
ORDER BY total_revenue DESC, plan""",
    "q04_monthly_revenue": """
SELECT month, sum(monthly_revenue) AS total_revenue, sum(new_subscribers) AS total_subscribers
FROM revenue_summary
GROUP BY month
ORDER BY month DESC
LIMIT 12""",
    "q05_top10_content": """
SELECT title, type, genre, language, rating, total_views, watch_hours, unique_viewers,
       avg_completion_pct
FROM top_content
ORDER BY watch_hours DESC NULLS LAST, content_id ASC NULLS LAST
LIMIT 10""",
    "q06_device_share": f"""
SELECT watch_device, unique_users, total_sessions, avg_watch_mins, avg_completion_pct,
       {half_up_sql('total_sessions * 100', 'sum(total_sessions) OVER ()', 1)} AS session_share_pct
FROM device_analytics
ORDER BY total_sessions DESC""",
    "q07_genre_performance": f"""
SELECT genre,
       count(*) AS total_titles,
       {_avg('avg_completion_pct', 1, 1)} AS avg_completion_pct,
       sum(total_views) AS total_views,
       CAST(sum({exact_sql('watch_hours')}) AS DOUBLE) AS total_watch_hours,
       sum(unique_viewers) AS total_unique_viewers
FROM top_content
GROUP BY genre
ORDER BY avg_completion_pct DESC""",
    "q08_type_performance": f"""
SELECT type,
       count(*) AS total_titles,
       sum(total_views) AS total_views,
       CAST(sum({exact_sql('watch_hours')}) AS DOUBLE) AS total_watch_hours,
       {_avg('avg_completion_pct', 1, 1)} AS avg_completion_pct,
       {_avg('rating', 1, 1)} AS avg_rating
FROM top_content
GROUP BY type
ORDER BY total_views DESC""",
    "q09_day_vs_average": """
SELECT watch_date, daily_active_users, avg_watch_mins,
       CASE WHEN daily_active_users * (SELECT count(daily_active_users) FROM dau_metrics)
                 > (SELECT sum(daily_active_users) FROM dau_metrics)
            THEN 'Above Average' ELSE 'Below Average' END AS performance
FROM dau_metrics
ORDER BY daily_active_users DESC, watch_date ASC
LIMIT 20""",
    "q10_executive": """
SELECT sum(monthly_revenue) AS total_platform_revenue,
       sum(new_subscribers) AS total_subscribers,
       count(DISTINCT plan) AS active_plans,
       max(monthly_revenue) AS peak_month_revenue,
       min(monthly_revenue) AS lowest_month_revenue
FROM revenue_summary
WHERE plan != 'free'""",
}


def register_gold_views(gold: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in gold.items():
        df.createOrReplaceTempView(prefix + name)


def run_sql(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(SQL[name])
