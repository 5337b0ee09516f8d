"""Domain tables derived from the provided warehouse tables.

The engine's inputs are four raw tables -- users, subscriptions,
content_catalog, watch_events -- normally landed as CSV/JSON.  For testing and
benchmarking they are derived, with Spark, from the provided Parquet tables:

    users            <- customer
    subscriptions    <- orders (latest order per customer)
    content_catalog  <- part
    watch_events     <- events

so every downstream query's work grows with those tables.  The derivations
deliberately include dirty rows (NULL keys, bad ages, malformed e-mails,
invalid plans, negative amounts, zero-length periods, out-of-range
percentages) so the quality checks have something to find, and the raw event
feed repeats 1 % of its events to exercise key de-duplication.  Ids are text,
as in landed files; ``number_of`` gives the number an id was made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Id texts by kind of id.
IDS = {"user": "USR%06d", "subscription": "SUB%08d", "content": "CNT%04d", "event": "EVT%09d"}

# Regions the recommender knows by name, and the devices and qualities of events.
REGIONS = ["Maharashtra", "Karnataka", "Tamil Nadu", "Delhi", "Telangana",
           "Gujarat", "West Bengal", "Rajasthan", "Uttar Pradesh", "Kerala"]
DEVICES = ["mobile", "tablet", "smart_tv", "laptop", "desktop"]
QUALITIES = ["480p", "720p", "1080p", "4K"]
LANGS = ["Hindi", "English", "Tamil"]
GENDERS = ["M", "F", "Other"]
PAYMENT_METHODS = ["upi", "credit_card", "debit_card", "netbanking"]


def _pick(expr: str, values: list[str]) -> str:
    """``CASE <expr> WHEN 0 THEN v0 ... ELSE v_last END`` over a value list."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {arms} ELSE '{values[-1]}' END"


def _id(kind: str, expr: str) -> str:
    """The id text of a number (NULL stays NULL).  Padding is many times cheaper than formatting,
    which numbers of more digits and negative ones need."""
    prefix, width = IDS[kind][:3], int(IDS[kind][4:-1])
    number = f"CAST({expr} AS BIGINT)"
    return (f"CASE WHEN ({expr}) BETWEEN 0 AND {10 ** width - 1} THEN concat('{prefix}', lpad(CAST({number} AS STRING), {width}, '0')) "
            f"WHEN ({expr}) IS NOT NULL THEN format_string('{IDS[kind]}', {number}) END")


def number_of(col: str) -> str:
    """The number an id text was made from."""
    return f"CAST(substring({col}, 4) AS BIGINT)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        f"{_id('user', 'c_custkey')} AS user_id",
        "c_name AS name",
        "CASE WHEN c_custkey % 50 = 7 THEN concat('user', CAST(c_custkey AS STRING)) "
        "WHEN c_custkey % 61 = 3 THEN NULL "
        "ELSE concat('user', CAST(c_custkey AS STRING), '@mail.test') END AS email",
        "CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE CAST(16 + (c_custkey * 7) % 60 AS INT) END AS age",
        f"{_pick('c_custkey % 3', GENDERS)} AS gender",
        f"{_pick('c_nationkey % 10', REGIONS)} AS region",
        f"{_pick('c_custkey % 5', DEVICES)} AS device",
        "date_add(DATE '2021-01-01', CAST(c_custkey % 1000 AS INT)) AS signup_date",
        "c_custkey % 2 = 0 AS is_active",
        f"{_pick('c_custkey % 3', LANGS)} AS preferred_lang",
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription per customer: the latest order (date, then key).

    Chosen with a grouped max over a struct rather than a ranking window, so
    a customer holding a large share of orders is reduced map-side (partial
    aggregation) instead of being sorted inside one task.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    latest = (
        orders.groupBy("o_custkey")
        .agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("o"))
        .select("o_custkey", "o.*")
    )
    return latest.selectExpr(
        f"{_id('subscription', 'o_orderkey')} AS subscription_id",
        f"{_id('user', 'o_custkey')} AS user_id",
        "CASE WHEN o_orderkey % 40 = 9 THEN 'trial' "
        "WHEN o_orderpriority = '1-URGENT' THEN 'premium' "
        "WHEN o_orderpriority = '2-HIGH' THEN 'standard' "
        "WHEN o_orderpriority = '3-MEDIUM' THEN 'basic' ELSE 'free' END AS plan",
        "CAST(o_orderdate AS DATE) AS start_date",
        "date_add(CAST(o_orderdate AS DATE), CAST(CASE WHEN o_orderkey % 40 = 3 THEN 0 "
        "WHEN o_orderkey % 4 = 0 THEN 30 WHEN o_orderkey % 4 = 1 THEN 90 "
        "WHEN o_orderkey % 4 = 2 THEN 180 ELSE 365 END AS INT)) AS end_date",
        "CASE WHEN o_orderkey % 60 = 21 THEN -1 WHEN o_orderpriority = '1-URGENT' THEN 349 "
        "WHEN o_orderpriority = '2-HIGH' THEN 199 WHEN o_orderpriority = '3-MEDIUM' THEN 99 "
        "ELSE 0 END AS amount_paid",
        f"{_pick('o_orderkey % 4', PAYMENT_METHODS)} AS payment_method",
        "o_orderkey % 2 = 0 AS auto_renew",
    )


def content_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        f"{_id('content', 'p_partkey')} AS content_id",
        "p_name AS title",
        "CASE WHEN p_partkey % 2 = 0 THEN 'movie' ELSE 'series' END AS type",
        "p_type AS genre",
        f"{_pick('p_partkey % 3', LANGS)} AS language",
        "CAST(2015 + p_size % 10 AS INT) AS release_year",
        "CAST(20 + p_size * 3 AS INT) AS duration_mins",
        "(10 + p_partkey % 91) / 10.0D AS rating",
        "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST(1 + p_partkey % 5 AS INT) END AS num_seasons",
        "p_partkey % 3 = 0 AS is_original",
    )


def watch_events(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """One viewing event per ``events`` row (raw form: no derived date/hour), of those ``where`` picks.
    Titles come from the whole catalog, so they grow with ``part``."""
    titles = read_table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    e = read_table(spark, sf_dir, "events").where(where).withColumn("titles", titles).selectExpr(
        "event_id", "user_id", "ts", "titles",
        "CAST(30 + event_id % 151 AS INT) AS duration_mins",
        "CAST(1 + (event_id * 13) % (30 + event_id % 151) AS INT) AS watched_mins",
    )
    return e.selectExpr(
        f"{_id('event', 'event_id')} AS event_id",
        f"{_id('user', 'CASE WHEN event_id % 400 = 111 THEN NULL ELSE user_id END')} AS user_id",
        f"{_id('content', 'CASE WHEN event_id % 450 = 222 THEN NULL ELSE (event_id * 17) % titles END')} AS content_id",
        "ts + make_dt_interval(CAST((event_id % 4) * 30 AS INT)) AS watch_start_time",
        "duration_mins",
        "CASE WHEN event_id % 500 = 250 THEN 0 ELSE watched_mins END AS watched_mins",
        "CASE WHEN event_id % 700 = 350 THEN 120.0D WHEN event_id % 350 = 17 THEN 100.0D "
        "WHEN event_id % 90 = 41 THEN floor((watched_mins * 10000) / (1.0D * duration_mins)) / 100.0D "
        "ELSE floor((watched_mins * 2000 + duration_mins) / (2.0D * duration_mins)) / 10.0D "
        "END AS completion_pct",
        f"{_pick('event_id % 5', DEVICES)} AS device",
        f"{_pick('event_id % 10', REGIONS)} AS region",
        "CAST(event_id % 11 AS INT) AS buffering_events",
        f"{_pick('event_id % 4', QUALITIES)} AS quality",
    )


def raw_watch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as delivered: at-least-once, 1 % of events repeated."""
    return watch_events(spark, sf_dir).unionByName(watch_events(spark, sf_dir, "event_id % 100 = 0"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "users": users(spark, sf_dir),
        "subscriptions": subscriptions(spark, sf_dir),
        "content_catalog": content_catalog(spark, sf_dir),
        "watch_events": raw_watch_events(spark, sf_dir),
    }
