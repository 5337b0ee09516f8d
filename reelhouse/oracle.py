"""Independent SQL formulations of every registered query, for DuckDB.

The driver registers the provided tables as views and runs these texts next
to the Spark plans.  The domain derivation is the shared fixture text
(FIXTURES.md section 3); everything after it is written the way the
reference states it -- join first, then group; DISTINCT for identical
duplicates; ranking windows for top-N -- rather than mirroring the Spark
plans.  Exact HALF_UP rounding uses the same integer formula as the engine.
"""

from __future__ import annotations


def hu(num: str, den: str, scale: int) -> str:
    """DuckDB: ``num / den`` rounded HALF_UP (integral inputs) as DOUBLE."""
    p = 10 ** scale
    return (f"(CAST(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * "
            f"((2 * abs({num}) * {p} + ({den})) // nullif(2 * ({den}), 0)) AS DOUBLE) / {p})")


def avg_hu(col: str, in_scale: int, out_scale: int) -> str:
    """Mean rounded HALF_UP; fractional columns are summed as whole millionths."""
    if in_scale == 0:
        return hu(f"sum(CAST({col} AS HUGEINT))", f"count({col})", out_scale)
    return hu(f"sum(CAST(round({col} * 1000000) AS HUGEINT))", f"count({col}) * 1000000", out_scale)


def sum_1dp(col: str) -> str:
    return f"(CAST(sum(CAST(round({col} * 10) AS BIGINT)) AS DOUBLE) / 10)"


# -- domain derivation (fixture text) ----------------------------------------

DOMAIN = {
    "users": """
SELECT printf('USR%06d', c_custkey) AS user_id, c_name AS name,
  CASE WHEN c_custkey % 50 = 7 THEN concat('user', CAST(c_custkey AS VARCHAR(20)))
       WHEN c_custkey % 61 = 3 THEN NULL
       ELSE concat('user', CAST(c_custkey AS VARCHAR(20)), '@mail.test') END AS email,
  CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE CAST(16 + (c_custkey * 7) % 60 AS INT) END AS age,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
  CASE c_nationkey % 10 WHEN 0 THEN 'Maharashtra' WHEN 1 THEN 'Karnataka' WHEN 2 THEN 'Tamil Nadu'
    WHEN 3 THEN 'Delhi' WHEN 4 THEN 'Telangana' WHEN 5 THEN 'Gujarat' WHEN 6 THEN 'West Bengal'
    WHEN 7 THEN 'Rajasthan' WHEN 8 THEN 'Uttar Pradesh' ELSE 'Kerala' END AS region,
  CASE c_custkey % 5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' WHEN 2 THEN 'smart_tv'
    WHEN 3 THEN 'laptop' ELSE 'desktop' END AS device,
  DATE '2021-01-01' + CAST(c_custkey % 1000 AS INT) AS signup_date,
  c_custkey % 2 = 0 AS is_active,
  CASE c_custkey % 3 WHEN 0 THEN 'Hindi' WHEN 1 THEN 'English' ELSE 'Tamil' END AS preferred_lang
FROM customer""",
    "subscriptions": """
SELECT printf('SUB%08d', o_orderkey) AS subscription_id, printf('USR%06d', o_custkey) AS user_id,
  CASE WHEN o_orderkey % 40 = 9 THEN 'trial'
       WHEN o_orderpriority = '1-URGENT' THEN 'premium' WHEN o_orderpriority = '2-HIGH' THEN 'standard'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'basic' ELSE 'free' END AS plan,
  CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 40 = 3 THEN 0 WHEN o_orderkey % 4 = 0 THEN 30
    WHEN o_orderkey % 4 = 1 THEN 90 WHEN o_orderkey % 4 = 2 THEN 180 ELSE 365 END AS INT) AS end_date,
  CASE WHEN o_orderkey % 60 = 21 THEN -1 WHEN o_orderpriority = '1-URGENT' THEN 349
       WHEN o_orderpriority = '2-HIGH' THEN 199 WHEN o_orderpriority = '3-MEDIUM' THEN 99 ELSE 0 END AS amount_paid,
  CASE o_orderkey % 4 WHEN 0 THEN 'upi' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'debit_card' ELSE 'netbanking' END AS payment_method,
  o_orderkey % 2 = 0 AS auto_renew
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) o
WHERE rn = 1""",
    "content_catalog": """
SELECT printf('CNT%04d', p_partkey) AS content_id, p_name AS title,
  CASE WHEN p_partkey % 2 = 0 THEN 'movie' ELSE 'series' END AS type, p_type AS genre,
  CASE p_partkey % 3 WHEN 0 THEN 'Hindi' WHEN 1 THEN 'English' ELSE 'Tamil' END AS language,
  CAST(2015 + p_size % 10 AS INT) AS release_year, CAST(20 + p_size * 3 AS INT) AS duration_mins,
  (10 + p_partkey % 91) / 10e0 AS rating,
  CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST(1 + p_partkey % 5 AS INT) END AS num_seasons,
  p_partkey % 3 = 0 AS is_original
FROM part""",
    "watch_events": """
SELECT printf('EVT%09d', event_id) AS event_id,
  CASE WHEN event_id % 400 = 111 THEN NULL ELSE printf('USR%06d', user_id) END AS user_id,
  CASE WHEN event_id % 450 = 222 THEN NULL
       ELSE printf('CNT%04d', (event_id * 17) % (SELECT count(*) FROM part)) END AS content_id,
  ts + (event_id % 4) * 30 * INTERVAL '1' DAY AS watch_start_time,
  duration_mins,
  CASE WHEN event_id % 500 = 250 THEN 0 ELSE watched_mins END AS watched_mins,
  CASE WHEN event_id % 700 = 350 THEN 120e0 WHEN event_id % 350 = 17 THEN 100e0
       WHEN event_id % 90 = 41 THEN floor((watched_mins * 10000) / (1e0 * duration_mins)) / 100e0
       ELSE floor((watched_mins * 2000 + duration_mins) / (2e0 * duration_mins)) / 10e0 END AS completion_pct,
  CASE event_id % 5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' WHEN 2 THEN 'smart_tv'
    WHEN 3 THEN 'laptop' ELSE 'desktop' END AS device,
  CASE event_id % 10 WHEN 0 THEN 'Maharashtra' WHEN 1 THEN 'Karnataka' WHEN 2 THEN 'Tamil Nadu'
    WHEN 3 THEN 'Delhi' WHEN 4 THEN 'Telangana' WHEN 5 THEN 'Gujarat' WHEN 6 THEN 'West Bengal'
    WHEN 7 THEN 'Rajasthan' WHEN 8 THEN 'Uttar Pradesh' ELSE 'Kerala' END AS region,
  CAST(event_id % 11 AS INT) AS buffering_events,
  CASE event_id % 4 WHEN 0 THEN '480p' WHEN 1 THEN '720p' WHEN 2 THEN '1080p' ELSE '4K' END AS quality,
  CAST(ts AS DATE) + CAST((event_id % 4) * 30 AS INT) AS watch_date,
  CAST(hour(ts) AS INT) AS watch_hour
FROM (SELECT event_id, user_id, ts, CAST(30 + event_id % 151 AS INT) AS duration_mins,
             CAST(1 + (event_id * 13) % (30 + event_id % 151) AS INT) AS watched_mins FROM events) e""",
    "raw_watch_events": """
SELECT * FROM watch_events UNION ALL SELECT * FROM watch_events WHERE CAST(substr(event_id, 4) AS BIGINT) % 100 = 0""",
}

# -- layers ---------------------------------------------------------------------

LAYERS = {
    "b_users": "SELECT DISTINCT * FROM users",
    "b_subs": "SELECT DISTINCT * FROM subscriptions",
    "b_content": "SELECT DISTINCT * FROM content_catalog",
    "b_watch": "SELECT DISTINCT * FROM raw_watch_events",
    "profile": """
SELECT w.content_id, u.user_id, u.name, u.age, u.gender, u.region,
  u.device AS user_preferred_device, u.signup_date, u.is_active, u.preferred_lang,
  s.plan, s.amount_paid, s.start_date, s.end_date,
  w.event_id, w.watch_start_time, w.watched_mins, w.completion_pct, w.device AS watch_device,
  w.quality, w.buffering_events, w.watch_date, w.watch_hour,
  c.title, c.type, c.genre, c.language, c.rating,
  coalesce(w.completion_pct >= 90, false) AS is_completed,
  coalesce(s.plan = 'premium', false) AS is_premium_user,
  CASE WHEN u.age < 25 THEN '18-24' WHEN u.age < 35 THEN '25-34' WHEN u.age < 45 THEN '35-44'
       ELSE '45+' END AS age_group
FROM b_users u
LEFT JOIN b_subs s ON u.user_id = s.user_id
JOIN b_watch w ON u.user_id = w.user_id
LEFT JOIN b_content c ON w.content_id = c.content_id""",
    "perf": f"""
SELECT w.content_id, c.title, c.type, c.genre, c.language, c.rating,
  count(w.event_id) AS total_views,
  {avg_hu('w.completion_pct', 1, 1)} AS avg_completion_pct,
  CAST(sum(w.watched_mins) AS BIGINT) AS total_watch_mins,
  count(DISTINCT w.user_id) AS unique_viewers,
  {avg_hu('w.buffering_events', 0, 2)} AS avg_buffering
FROM b_watch w LEFT JOIN b_content c ON w.content_id = c.content_id
GROUP BY w.content_id, c.title, c.type, c.genre, c.language, c.rating""",
    "dau": f"""
SELECT watch_date,
  count(DISTINCT user_id) AS daily_active_users,
  count(event_id) AS total_watch_events,
  {avg_hu('watched_mins', 0, 1)} AS avg_watch_mins,
  {avg_hu('completion_pct', 1, 1)} AS avg_completion_pct,
  CAST(sum(watched_mins) AS BIGINT) AS total_watch_mins
FROM profile GROUP BY watch_date""",
    "revenue": f"""
SELECT strftime(start_date, '%Y-%m') AS month, plan,
  count(subscription_id) AS new_subscribers,
  CAST(sum(amount_paid) AS BIGINT) AS monthly_revenue,
  {avg_hu('amount_paid', 0, 2)} AS avg_revenue_per_user
FROM b_subs GROUP BY 1, 2""",
    "top": f"""
SELECT content_id, title, type, genre, language, rating, total_views, avg_completion_pct,
  total_watch_mins, unique_viewers, {hu('total_watch_mins', '60', 1)} AS watch_hours
FROM perf""",
    "device": f"""
SELECT watch_device,
  count(DISTINCT user_id) AS unique_users,
  count(event_id) AS total_sessions,
  {avg_hu('watched_mins', 0, 1)} AS avg_watch_mins,
  {avg_hu('completion_pct', 1, 1)} AS avg_completion_pct
FROM profile GROUP BY watch_device""",
}

ORDER = ["users", "subscriptions", "content_catalog", "watch_events", "raw_watch_events",
         "b_users", "b_subs", "b_content", "b_watch", "profile", "perf", "dau", "revenue",
         "top", "device"]

_ALL_CTES = {**DOMAIN, **LAYERS}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE (DuckDB inlines/prunes unused ones)."""
    parts = [f"{name} AS ({_ALL_CTES[name]})" for name in ORDER]
    for name, text in (extra or {}).items():
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


# -- composite queries -------------------------------------------------------

MEDALLION = {
    "bronze_users": "SELECT *, 'raw/users/users.csv' AS source_file, 'bronze' AS layer FROM b_users",
    "bronze_subscriptions": "SELECT *, 'raw/subscriptions/subscriptions.csv' AS source_file, "
                            "'bronze' AS layer FROM b_subs",
    "bronze_content": "SELECT *, 'raw/content_catalog/content_catalog.csv' AS source_file, "
                      "'bronze' AS layer FROM b_content",
    "bronze_watch_events": "SELECT *, 'raw/watch_events/watch_events.json' AS source_file, "
                           "'bronze' AS layer FROM b_watch",
    "user_watch_profile": "SELECT * FROM profile",
    "content_performance": "SELECT * FROM perf",
    "dau_metrics": "SELECT * FROM dau",
    "revenue_summary": "SELECT * FROM revenue",
    "top_content": "SELECT * FROM top",
    "device_analytics": "SELECT * FROM device",
}

REPORTS = {
    "q01_dau_last30": """
SELECT watch_date, daily_active_users, total_watch_events, avg_watch_mins,
  total_watch_mins // 60 AS total_watch_hours
FROM dau ORDER BY watch_date DESC LIMIT 30""",
    "q02_mau": f"""
SELECT CAST(date_trunc('month', watch_date) AS DATE) AS month,
  CAST(sum(daily_active_users) AS BIGINT) AS monthly_active_users,
  CAST(sum(total_watch_events) AS BIGINT) AS monthly_watch_events,
  {avg_hu('avg_watch_mins', 1, 1)} AS avg_daily_watch_mins,
  CAST(sum(total_watch_mins) // 60 AS BIGINT) AS total_watch_hours
FROM dau GROUP BY 1 ORDER BY month DESC""",
    "q03_revenue_by_plan": f"""
SELECT plan, CAST(sum(monthly_revenue) AS BIGINT) AS total_revenue,
  CAST(sum(new_subscribers) AS BIGINT) AS total_subscribers,
  {avg_hu('avg_revenue_per_user', 2, 2)} AS avg_revenue_per_user,
  {hu('sum(monthly_revenue) * 100', 'sum(sum(monthly_revenue)) OVER ()', 1)} AS revenue_share_pct
FROM revenue GROUP BY plan ORDER BY total_revenue DESC""",
    "q04_monthly_revenue": """
SELECT month, CAST(sum(monthly_revenue) AS BIGINT) AS total_revenue,
  CAST(sum(new_subscribers) AS BIGINT) AS total_subscribers
FROM revenue GROUP BY month ORDER BY month DESC LIMIT 12""",
    "q05_top10_content": """
SELECT title, type, genre, language, rating, total_views, watch_hours, unique_viewers,
  avg_completion_pct
FROM top ORDER BY watch_hours DESC NULLS LAST, content_id ASC NULLS LAST LIMIT 10""",
    "q06_device_share": f"""
SELECT watch_device, unique_users, total_sessions, avg_watch_mins, avg_completion_pct,
  {hu('total_sessions * 100', 'sum(total_sessions) OVER ()', 1)} AS session_share_pct
FROM device ORDER BY total_sessions DESC""",
    "q07_genre_performance": f"""
SELECT genre, count(*) AS total_titles,
  {avg_hu('avg_completion_pct', 1, 1)} AS avg_completion_pct,
  CAST(sum(total_views) AS BIGINT) AS total_views,
  {sum_1dp('watch_hours')} AS total_watch_hours,
  CAST(sum(unique_viewers) AS BIGINT) AS total_unique_viewers
FROM top GROUP BY genre ORDER BY avg_completion_pct DESC""",
    "q08_type_performance": f"""
SELECT type, count(*) AS total_titles, CAST(sum(total_views) AS BIGINT) AS total_views,
  {sum_1dp('watch_hours')} AS total_watch_hours,
  {avg_hu('avg_completion_pct', 1, 1)} AS avg_completion_pct,
  {avg_hu('rating', 1, 1)} AS avg_rating
FROM top GROUP BY type ORDER BY total_views DESC""",
    "q09_day_vs_average": """
SELECT watch_date, daily_active_users, avg_watch_mins,
  CASE WHEN daily_active_users > (SELECT avg(daily_active_users) FROM dau)
       THEN 'Above Average' ELSE 'Below Average' END AS performance
FROM dau ORDER BY daily_active_users DESC, watch_date ASC LIMIT 20""",
    "q10_executive": """
SELECT CAST(sum(monthly_revenue) AS BIGINT) AS total_platform_revenue,
  CAST(sum(new_subscribers) AS BIGINT) AS total_subscribers,
  count(DISTINCT plan) AS active_plans,
  max(monthly_revenue) AS peak_month_revenue,
  min(monthly_revenue) AS lowest_month_revenue
FROM revenue WHERE plan != 'free'""",
}




# -- data quality ---------------------------------------------------------------

DQ_CHECKS = [  # (check, table cte, table name, failing predicate)
    ("users_no_null_user_id", "b_users", "users", "user_id IS NULL"),
    ("users_valid_age", "b_users", "users", "(age < 18 OR age > 100 OR age IS NULL)"),
    ("users_valid_email", "b_users", "users", "(NOT contains(email, '@') OR email IS NULL)"),
    ("users_no_duplicates", "b_users", "users", None),
    ("watch_positive_duration", "b_watch", "watch_events", "(watched_mins <= 0 OR watched_mins IS NULL)"),
    ("watch_valid_completion_pct", "b_watch", "watch_events",
     "(completion_pct < 0 OR completion_pct > 100)"),
    ("watch_no_null_user_id", "b_watch", "watch_events", "user_id IS NULL"),
    ("watch_no_null_content_id", "b_watch", "watch_events", "content_id IS NULL"),
    ("subs_valid_amount", "b_subs", "subscriptions", "amount_paid < 0"),
    ("subs_valid_plan", "b_subs", "subscriptions",
     "plan NOT IN ('free', 'basic', 'standard', 'premium')"),
    ("subs_end_after_start", "b_subs", "subscriptions", "end_date <= start_date"),
]
DQ_KEYS = {"b_users": "user_id", "b_watch": "event_id", "b_subs": "subscription_id"}


def _dq_report_sql() -> str:
    rows = []
    for i, (name, cte, table, pred) in enumerate(DQ_CHECKS):
        if pred is None:
            failed = ("count(*) - count(DISTINCT user_id) - "
                      "CASE WHEN count(*) FILTER (WHERE user_id IS NULL) > 0 THEN 1 ELSE 0 END")
        else:
            failed = f"count(*) FILTER (WHERE {pred})"
        rows.append(f"SELECT '{name}' AS check_name, '{table}' AS \"table\", {i} AS check_order, "
                    f"CAST(count(*) AS BIGINT) AS t, CAST({failed} AS BIGINT) AS f FROM {cte}")
    return (
        "SELECT check_name, \"table\", t AS total_records, t - f AS passed, f AS failed, "
        f"CASE WHEN t > 0 THEN {hu('(t - f) * 100', 't', 1)} END AS pass_rate_pct, "
        "CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(check_order AS INT) AS check_order "
        "FROM (" + " UNION ALL ".join(rows) + ")"
    )


def _dq_quarantine_sql() -> str:
    parts = []
    for cte, table in (("b_users", "users"), ("b_watch", "watch_events"), ("b_subs", "subscriptions")):
        preds = [(n, p) for n, c, _, p in DQ_CHECKS if c == cte and p is not None]
        names = ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in preds)
        count = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for _, p in preds)
        parts.append(
            f"SELECT '{table}' AS \"table\", CAST({DQ_KEYS[cte]} AS VARCHAR) AS record_id, "
            f"concat_ws(',', {names}) AS failed_checks, CAST({count} AS INT) AS n_failed "
            f"FROM {cte} WHERE {count} > 0")
    return " UNION ALL ".join(parts)


DQ = {
    "dq_report": "SELECT * FROM dq",
    "dq_quarantine": _dq_quarantine_sql(),
    "dq_summary": """
SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks,
  count(*) FILTER (WHERE status = 'FAIL') AS failed_checks FROM dq""",
}
_ALL_CTES["dq"] = _dq_report_sql()
ORDER.append("dq")


# -- event path -------------------------------------------------------------------
# A message is dropped to an empty event when its envelope is a bare event
# without a user id (dispatch falls through) or its body is corrupt.

_LEVEL = ("CASE WHEN completion_pct >= 80 THEN 'HIGH' WHEN completion_pct >= 50 THEN 'MEDIUM' "
          "ELSE 'LOW' END")

_ALL_CTES.update({
    # one row for each payload of each delivery: a queue batch with a second record has two, without
    # ids of their own; a message without an id is known by its place in the queue
    "ev_raw": """
SELECT *, CAST(substr(event_id, 4) AS BIGINT) AS number FROM (SELECT DISTINCT * FROM raw_watch_events)""",
    "ev_sent": """
SELECT e.*, 0 AS copy, 0 AS late FROM ev_raw e
UNION ALL SELECT e.*, 1, 0 FROM ev_raw e WHERE number % 45 = 31
UNION ALL SELECT e.*, 1, 0 FROM ev_raw e WHERE number % 45 = 31 AND number % 135 = 121
UNION ALL SELECT e.*, 1, 5 FROM ev_raw e WHERE number % 100 = 0 AND number % 45 <> 31
UNION ALL SELECT e.*, 0, 0 FROM ev_raw e WHERE number % 100 = 50 AND number % 45 <> 31""",
    "ev_base": """
SELECT CASE WHEN number % 45 = 31
    THEN 'watch-events/' || CAST(number % 8 AS VARCHAR) || '/' || CAST(2 * number + copy AS VARCHAR) ELSE event_id END
    || CASE WHEN number % 40 = 2 THEN '#' || CAST(place AS VARCHAR) ELSE '' END AS event_id,
  CASE WHEN number % 300 = 7 OR number % 90 = 31 THEN NULL
       WHEN number % 200 = 13 THEN watch_start_time + INTERVAL 730 DAY
       WHEN number % 500 = 21 THEN TIMESTAMP '2099-01-01 00:00:00' ELSE watch_start_time END AS event_ts,
  date_trunc('second', watch_start_time + INTERVAL 1 MINUTE) + to_minutes(late) AS arrived_at,
  user_id, content_id, device, region, copy,
  CASE WHEN number % 40 = 2 THEN 85e0 ELSE completion_pct END AS completion_pct,
  CASE WHEN number % 40 = 2 THEN CAST(30 + place AS INT) ELSE watched_mins END AS watched_mins,
  ((number % 4 = 0 AND user_id IS NULL) OR number % 1000 = 999) AS dropped
FROM ev_sent, (VALUES (0), (1)) AS t(place) WHERE place = 0 OR number % 40 = 2""",
    "ev_proc": """
SELECT event_id AS request_id, event_ts, arrived_at,
  CASE WHEN dropped OR user_id IS NULL THEN 'UNKNOWN' ELSE user_id END AS user_id,
  CASE WHEN dropped OR content_id IS NULL THEN 'UNKNOWN' ELSE content_id END AS content_id,
  CAST(CASE WHEN dropped THEN 0 ELSE completion_pct END AS DOUBLE) AS completion_pct,
  CAST(CASE WHEN dropped THEN 0 ELSE watched_mins END AS INT) AS watched_mins,
  CASE WHEN dropped THEN 'unknown' ELSE device END AS device,
  CASE WHEN dropped THEN 'unknown' ELSE region END AS region
FROM ev_base""",
    "processed": f"""
SELECT request_id, event_ts, user_id, content_id, completion_pct, watched_mins, device, region,
  {_LEVEL} AS engagement_level,
  completion_pct >= 80 AS is_binge_watcher, completion_pct >= 50 AS is_engaged,
  strftime(date_trunc('second', coalesce(event_ts, arrived_at)), '%Y-%m-%d %H:%M:%S') AS processed_at,
  arrived_at,
  CAST((CASE WHEN completion_pct >= 80 THEN 1 ELSE 0 END)
       + (CASE WHEN completion_pct = 100 THEN 1 ELSE 0 END)
       + (CASE WHEN watched_mins > 120 THEN 1 ELSE 0 END) AS INT) AS notification_count,
  concat_ws(',', CASE WHEN completion_pct >= 80 THEN 'BINGE_WATCHER_BADGE' END,
                 CASE WHEN completion_pct = 100 THEN 'COMPLETION_REWARD' END,
                 CASE WHEN watched_mins > 120 THEN 'LONG_SESSION' END) AS notification_types,
  concat_ws('|',
    CASE WHEN completion_pct >= 80 THEN 'User ' || user_id || ' earned Binge Watcher badge!' END,
    CASE WHEN completion_pct = 100 THEN 'User ' || user_id || ' completed ' || content_id || '!' END,
    CASE WHEN watched_mins > 120
      THEN 'User ' || user_id || ' watched ' || CAST(watched_mins AS VARCHAR) || ' mins' END
  ) AS notification_text
FROM ev_proc""",
    "validated": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(content_id AS VARCHAR) AS content_id, completion_pct, watched_mins, device, region,
  'PASSED' AS validation_status
FROM ev_base
WHERE NOT dropped AND user_id IS NOT NULL AND content_id IS NOT NULL
  AND completion_pct BETWEEN 0 AND 100 AND watched_mins >= 0""",
    "scored": f"""
SELECT *,
  round(completion_pct * 0.6 + least(watched_mins / 120 * 100, 100) * 0.4, 1) AS engagement_score,
  {_LEVEL} AS engagement_level, completion_pct >= 80 AS should_notify
FROM validated""",
    # the queue may deliver an event again; what came first counts
    "store_rows": """
SELECT user_id, processed_at, content_id, completion_pct, watched_mins, engagement_level,
  is_binge_watcher, device, region, notification_count, request_id, event_ts, arrived_at
FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY arrived_at) AS delivery FROM processed)
WHERE delivery = 1""",
    "latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, processed_at,
                                 CASE WHEN event_ts IS NULL THEN request_id ELSE '' END
                               ORDER BY event_ts DESC, request_id DESC) AS rn
  FROM store_rows) WHERE rn = 1""",
    "top_user": """
SELECT user_id FROM (SELECT user_id, count(*) AS n FROM latest WHERE user_id != 'UNKNOWN'
                     GROUP BY user_id)
ORDER BY n DESC, user_id ASC LIMIT 1""",
})
ORDER.extend(["ev_raw", "ev_sent", "ev_base", "ev_proc", "processed", "validated", "scored", "store_rows", "latest",
              "top_user"])

_MISSING = ("'Missing required fields: [' || concat_ws(', ', "
            "CASE WHEN dropped OR user_id IS NULL THEN '''user_id''' END, "
            "CASE WHEN dropped OR content_id IS NULL THEN '''content_id''' END, "
            "CASE WHEN dropped THEN '''completion_pct''' END, "
            "CASE WHEN dropped THEN '''watched_mins''' END) || ']'")

EVENTS = {
    "event_processed": "SELECT * FROM processed",
    "event_validated": "SELECT * FROM validated",
    "event_scored": "SELECT * FROM scored",
    "event_routed": """
SELECT CASE engagement_level WHEN 'HIGH' THEN 'SEND_BINGE_NOTIFICATION'
         WHEN 'MEDIUM' THEN 'UPDATE_RECOMMENDATIONS' ELSE 'LOG_AND_EXIT' END AS action,
  CASE engagement_level WHEN 'HIGH' THEN 'Binge watcher detected: '
         WHEN 'MEDIUM' THEN 'Update recommendations for: ' ELSE 'Low engagement for: ' END
    || user_id AS message,
  engagement_score, event_id, user_id, engagement_level
FROM scored""",
    "event_errors": f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, 'ValidationError' AS error,
  'Event failed validation checks' AS cause,
  CASE WHEN dropped OR user_id IS NULL OR content_id IS NULL THEN {_MISSING}
       WHEN completion_pct < 0 OR completion_pct > 100
         THEN 'Invalid completion_pct: ' || CAST(completion_pct AS VARCHAR) || '. Must be 0-100.'
       ELSE 'Invalid watched_mins: ' || CAST(watched_mins AS VARCHAR) || '. Must be >= 0.' END AS detail
FROM ev_base
WHERE dropped OR user_id IS NULL OR content_id IS NULL
  OR NOT (completion_pct BETWEEN 0 AND 100) OR watched_mins < 0""",
    "engagement_store": "SELECT * FROM store_rows",
    "engagement_latest": "SELECT * FROM latest",
    "engagement_latest_compacted": "SELECT * FROM latest",
    "engagement_by_user": "SELECT * FROM latest WHERE user_id = (SELECT user_id FROM top_user)",
    "engagement_range": """
SELECT * FROM latest WHERE user_id = (SELECT user_id FROM top_user)
  AND processed_at BETWEEN
    (SELECT strftime(CAST(max(processed_at) AS TIMESTAMP) - INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S')
     FROM latest WHERE user_id = (SELECT user_id FROM top_user))
    AND (SELECT max(processed_at) FROM latest WHERE user_id = (SELECT user_id FROM top_user))""",
    "engagement_high_users": "SELECT DISTINCT user_id FROM latest WHERE engagement_level = 'HIGH'",
    "engagement_batch_status": """
SELECT copy + 1 AS version, 0 AS batch_id, 'SAVED' AS status, count(DISTINCT event_id) AS n_events, 0 AS n_rejected
FROM ev_base GROUP BY copy""",
}


# -- recommendations ----------------------------------------------------------------


def _values(rows: list[tuple]) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _reco_ctes() -> dict[str, str]:
    from .operators.recommend import AGE_PREFERENCES, CONTENT_BY_GENRE, REGION_LANGUAGES
    titles = [(g, i, t) for g, ts in CONTENT_BY_GENRE.items() for i, t in enumerate(ts)]
    prefs = [(a, i, g) for a, gs in AGE_PREFERENCES.items() for i, g in enumerate(gs)]
    langs = [(r, i, lang) for r, ls in REGION_LANGUAGES.items() for i, lang in enumerate(ls)]
    return {
        "rec_titles": f"SELECT * FROM ({_values(titles)}) t(genre, tpos, title)",
        "rec_prefs": f"SELECT * FROM ({_values(prefs)}) t(age_group, gpos, genre)",
        "rec_langs": f"SELECT * FROM ({_values(langs)}) t(region, lpos, language)",
        "rec_users": """
SELECT u.user_id, u.region, u.age,
  CASE WHEN coalesce(u.age, 25) < 25 THEN '18-24' WHEN coalesce(u.age, 25) < 35 THEN '25-34'
       WHEN coalesce(u.age, 25) < 45 THEN '35-44' ELSE '45+' END AS age_group,
  CASE WHEN u.region IN (SELECT region FROM rec_langs) THEN u.region ELSE 'default' END AS lang_region,
  coalesce(TRY_CAST(right(regexp_replace(u.user_id, '[^0-9]', '', 'g'), 9) AS BIGINT), 0) AS number
FROM users u""",
        "rec_cands": """
SELECT u.user_id, u.region, u.age, u.age_group, p.gpos, t.tpos, t.title, p.genre,
  75 + (u.number * 7 + p.gpos * 13 + t.tpos * 5) % 25 AS points,
  'CNT' || lpad(CAST(1 + (u.number * 31 + p.gpos * 7 + t.tpos) % 1000 AS VARCHAR), 4, '0') AS content_id,
  u.lang_region,
  (u.number + p.gpos + t.tpos) % (SELECT count(*) FROM rec_langs l WHERE l.region = u.lang_region) AS lpos
FROM rec_users u
JOIN rec_prefs p ON p.age_group = u.age_group AND p.gpos < 3
JOIN rec_titles t ON t.genre = p.genre AND t.tpos < 2""",
        "rec_ranked": """
SELECT c.*, l.language,
  row_number() OVER (PARTITION BY c.user_id ORDER BY c.points DESC, c.gpos, c.tpos) AS rank
FROM rec_cands c JOIN rec_langs l ON l.region = c.lang_region AND l.lpos = c.lpos""",
    }


_ALL_CTES.update(_reco_ctes())
ORDER.extend(["rec_titles", "rec_prefs", "rec_langs", "rec_users", "rec_cands", "rec_ranked"])

RECO = {
    "recommendations": """
SELECT user_id, region, age, age_group, CAST(rank AS INT) AS rank, content_id, title, genre, language,
  points / 100.0 AS match_score
FROM rec_ranked WHERE rank <= 5""",
    "catalog_stats": """
SELECT 'genre' AS kind, genre AS value, count(*) AS n FROM b_content GROUP BY genre
UNION ALL SELECT 'region', region, count(*) FROM users GROUP BY region""",
}


_COUNTS = {
    "bronze.users": "b_users", "bronze.subscriptions": "b_subs", "bronze.content_catalog": "b_content",
    "bronze.watch_events": "b_watch", "silver.user_watch_profile": "profile", "silver.content_performance": "perf",
    "gold.dau_metrics": "dau", "gold.revenue_summary": "revenue", "gold.top_content": "top",
    "gold.device_analytics": "device",
}
JOBS = {
    "bronze_events_array": "SELECT *, 'raw/watch_events/watch_events.json' AS source_file, 'bronze' AS layer FROM b_watch",
    "bronze_rerun": "SELECT *, 'raw/watch_events/watch_events.json' AS source_file, 'bronze' AS layer FROM b_watch",
    "bronze_merged": """
SELECT * REPLACE (CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 5 = 0 THEN buffering_events END AS buffering_events),
  'raw/watch_events/watch_events.json' AS source_file, 'bronze' AS layer FROM b_watch""",
    "state_dau_metrics": "SELECT * FROM dau",
    "state_top_content": "SELECT * FROM top",
    "state_device_analytics": "SELECT * FROM device",
    "job_quality_report": "SELECT * FROM dq",
    "job_quality_gate": """
SELECT bool_or(status = 'FAIL') AS stopped,
  CASE WHEN bool_or(status = 'FAIL') THEN CAST(count(*) FILTER (WHERE status = 'FAIL') AS VARCHAR) || ' of '
    || CAST(count(*) AS VARCHAR) || ' checks failed: ['
    || string_agg(chr(39) || check_name || chr(39), ', ' ORDER BY check_order) FILTER (WHERE status = 'FAIL') || ']'
  ELSE '' END AS message, count(*) FILTER (WHERE status = 'FAIL') AS n_failed FROM dq""",
    "bronze_events_untidy": """
SELECT *, 'raw/watch_events/watch_events.json' AS source_file, 'bronze' AS layer FROM b_watch
WHERE CAST(substr(event_id, 4) AS BIGINT) % 97 <> 5""",
    "bronze_rejected": """
SELECT '{"event_id": "' || event_id || '", "user_id":' AS record FROM raw_watch_events
WHERE CAST(substr(event_id, 4) AS BIGINT) % 97 = 5""",
    "job_row_counts": " UNION ALL ".join(
        [f"SELECT '{name}' AS output, count(*) AS n_rows, count(*) AS n_read FROM {cte}" for name, cte in _COUNTS.items()]
        + [f"SELECT 'bronze.rejected_{t}', 0, 0" for t in ("users", "subscriptions", "content_catalog", "watch_events")]
        + [f"SELECT 'quarantine.{t}', count(*), count(*) FROM ({_dq_quarantine_sql()}) WHERE \"table\" = '{t}'"
           for t in ("users", "watch_events", "subscriptions")]),
    "job_user_watch_profile": "SELECT * FROM profile",
    "job_top_content": "SELECT * FROM top",
    "job_quarantined_events": f"""
SELECT record_id AS event_id, string_split(failed_checks, ',') AS failed_checks FROM ({_dq_quarantine_sql()})
WHERE "table" = 'watch_events'""",
    "sql_functions": f"""
SELECT event_id, plan, age_group, {_LEVEL} AS level,
  round(completion_pct * 0.6 + least(watched_mins / 120 * 100, 100) * 0.4, 1) AS score FROM profile""",
    "engagement_store_sink": "SELECT * FROM store_rows",
}

EXTRA = {
    "mau_distinct": """
SELECT CAST(date_trunc('month', watch_date) AS DATE) AS month,
  count(DISTINCT user_id) AS monthly_active_users
FROM profile GROUP BY 1""",
}
# The SQL-text form of the report pack has the same expected results.
SQL_PACK = {f"sql_{name}": body for name, body in REPORTS.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in {**MEDALLION, **REPORTS, **DQ, **EVENTS, **RECO, **EXTRA, **JOBS, **SQL_PACK}.items():
        out[name] = with_ctes(body)
    return out
