"""Registry of named outputs: ``name -> (spark, sf_dir) -> DataFrame``.

Every entry reads the provided tables (through the domain derivation) over
their full extent; nothing is sampled or capped except where a LIMIT is the
feature of the report.  Wall-clock stamp columns are dropped so outputs can
be compared between runs and engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .operators import recommend
from .plans import realtime, sql_pack
from .plans import reports as report_plan
from .functions.sql import register_sql_functions
from .plans.pipeline import (bronze_from_files, bronze_merged, bronze_rerun, events_from_arrays, events_from_untidy_lines,
                             gold_from_state, job_outputs, medallion, without_run_time)
from .plans.quality_job import quality_gate, quality_outputs
from .sources import tables

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(table: str) -> Query:
    """Land the derived raw table as files, then ingest it through the file scan."""
    return lambda spark, sf: without_run_time(bronze_from_files(spark, sf, table))


def _layer(layer: str, name: str) -> Query:
    return lambda spark, sf: without_run_time(getattr(medallion(spark, sf), layer)[name])


def _report(name: str) -> Query:
    return lambda spark, sf: medallion(spark, sf).reports()[name]


def _sql_report(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        sql_pack.register_gold_views(medallion(spark, sf).gold)
        return sql_pack.run_sql(spark, name)
    return run


def _mau_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return report_plan.mau_distinct(medallion(spark, sf).silver["user_watch_profile"])


def _dq(name: str) -> Query:
    return lambda spark, sf: without_run_time(quality_outputs(medallion(spark, sf).bronze)[name])


def _event_processed(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.flat_notifications(realtime.processed(spark, sf))


def _state(name: str) -> Query:
    """validate -> score -> route stages; nested/raw columns flattened for comparison."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = realtime.state_machine(spark, sf)[name]
        if name == "event_routed":
            out = out.select("action", "message", "engagement_score", "data.event_id",
                             "data.user_id", "data.engagement_level")
        if name == "event_errors":
            out = out.drop("raw")
        return without_run_time(out)
    return run


def _store(name: str) -> Query:
    """Replay the message feed through the stream into a fresh store, then read it."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return realtime.store_outputs(spark, realtime.stream_store(spark, sf))[name]
    return run


def _recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.recommend(medallion(spark, sf).bronze["users"])


def _catalog_stats(spark: SparkSession, sf: str) -> DataFrame:
    b = medallion(spark, sf).bronze
    return recommend.catalog_stats(b["content_catalog"], b["users"])


def _job_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What the jobs say they wrote, beside the rows of the written tables: one row for each table."""
    root, counts = job_outputs(spark, sf)
    out = None
    for name, n in sorted(counts.items()):
        layer, _, t = name.partition(".")
        path = (f"{root}/dq/failed_records/{t}" if layer == "quarantine" else
                f"{root}/{layer}/_rejected/{t.removeprefix('rejected_')}" if t.startswith("rejected_") else f"{root}/{layer}/{t}")
        row = tables.read(spark, path).agg(F.count(F.lit(1)).alias("n_read")).select(
            F.lit(name).alias("output"), F.lit(n).cast("long").alias("n_rows"), "n_read")
        out = row if out is None else out.unionByName(row)
    return out


def _job_table(path: str, *columns: str) -> Query:
    """A table the jobs wrote, read back from the lake."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        root, _ = job_outputs(spark, sf)
        df = without_run_time(tables.read(spark, f"{root}/{path}"))
        return df.select(*columns) if columns else df
    return run


def _sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """The engine's SQL functions over the profile."""
    register_sql_functions(spark)
    medallion(spark, sf).silver["user_watch_profile"].createOrReplaceTempView("profile_for_functions")
    return spark.sql("SELECT event_id, plan, age_group(age) AS age_group, engagement_level(completion_pct) AS level, "
                     "engagement_score(completion_pct, watched_mins) AS score FROM profile_for_functions")


QUERIES: dict[str, Query] = {
    # bronze (file ingest), silver, gold
    "bronze_users": _bronze("users"),
    "bronze_subscriptions": _bronze("subscriptions"),
    "bronze_content": _bronze("content_catalog"),
    "bronze_watch_events": _bronze("watch_events"),
    "bronze_events_array": lambda spark, sf: without_run_time(events_from_arrays(spark, sf)),
    "bronze_events_untidy": lambda spark, sf: without_run_time(events_from_untidy_lines(spark, sf)[0]),
    "bronze_rejected": lambda spark, sf: events_from_untidy_lines(spark, sf)[1].select("record"),
    "bronze_rerun": lambda spark, sf: without_run_time(bronze_rerun(spark, sf)).drop("source_path"),
    "bronze_merged": lambda spark, sf: without_run_time(bronze_merged(spark, sf)).drop("source_path"),
    "job_row_counts": _job_rows,
    "job_quality_report": _job_table("dq/reports", "check_name", "table", "total_records", "passed", "failed", "pass_rate_pct",
                                     "status", "check_order"),
    "job_quality_gate": quality_gate,
    "job_user_watch_profile": _job_table("silver/user_watch_profile"),
    "job_top_content": _job_table("gold/top_content"),
    "job_quarantined_events": _job_table("dq/failed_records/watch_events", "event_id", "failed_checks"),
    "sql_functions": _sql_functions,
    "user_watch_profile": _layer("silver", "user_watch_profile"),
    "content_performance": _layer("silver", "content_performance"),
    "dau_metrics": _layer("gold", "dau_metrics"),
    "revenue_summary": _layer("gold", "revenue_summary"),
    "top_content": _layer("gold", "top_content"),
    "device_analytics": _layer("gold", "device_analytics"),
    # gold from per-day state, after a second delivery of events
    **{f"state_{name}": (lambda spark, sf, n=name: without_run_time(gold_from_state(spark, sf, n)))
       for name in ("dau_metrics", "top_content", "device_analytics")},
    # report pack: DataFrame form, SQL-text form, distinct monthly users
    **{name: _report(name) for name in report_plan.REPORTS},
    **{f"sql_{name}": _sql_report(name) for name in sql_pack.SQL},
    "mau_distinct": _mau_distinct,
    # data quality
    "dq_report": _dq("dq_report"),
    "dq_quarantine": _dq("dq_quarantine"),
    "dq_summary": _dq("dq_summary"),
    # event path (batch form) and the streamed engagement store
    "event_processed": _event_processed,
    **{name: _state(name) for name in
       ("event_validated", "event_scored", "event_routed", "event_errors")},
    **{name: _store(name) for name in
       ("engagement_store", "engagement_latest", "engagement_by_user", "engagement_range",
        "engagement_high_users")},
    "engagement_latest_compacted": realtime.compacted_latest,
    "engagement_batch_status": lambda spark, sf: realtime.batch_statuses(spark, sf),
    "engagement_store_sink": lambda spark, sf: realtime.stored_once(spark, sf),
    # recommendations
    "recommendations": _recommendations,
    "catalog_stats": _catalog_stats,
}

ORACLE: dict[str, str] = oracle.oracle_sql()
