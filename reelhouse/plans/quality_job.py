"""Data-quality job over the bronze layer.

Writes the report and each table's quarantined rows partitioned by
(run_date, run_id) and returns the summary.  Runs accumulate like appends,
but each run replaces only its own partition, so rerunning a failed job with
the same logical run time does not duplicate its output.
With ``gate=True`` the job raises when any check failed, so a scheduler can
stop the downstream stages.

One scan per table: the per-check failure counts are collected as
``Observation`` metrics while the quarantine is being written, so the largest
table (events) is read once, not once for counting and again for the
quarantine.  Only a uniqueness check reads its key column a second time (it
needs a grouping the quarantine write does not do).  The report itself is the
eleven resulting rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import half_up
from ..operators import quality
from ..session import run_concurrently
from ..sources import tables
from ..sources.sinks import write_parquet

BRONZE_TABLES = ("users", "watch_events", "subscriptions")


def quality_outputs(bronze: dict[str, DataFrame], run_time: str = "") -> dict[str, DataFrame]:
    """Lazy report / summary / quarantine frames (one aggregation per table)."""
    checks = quality.default_checks()
    report = quality.check_report(bronze, checks, run_time)
    keys = {t: schemas.RAW[t][1] for t in BRONZE_TABLES}
    return {
        "dq_report": report,
        "dq_summary": quality.summary(report),
        "dq_quarantine": quality.quarantined(bronze, keys, checks),
    }


def _run_id(run_time: str) -> str:
    return "".join(ch for ch in run_time if ch.isdigit())


def _partition(run_date: str, run_id: str) -> str:
    """A run's own folder: a plain overwrite there also clears rows of an earlier attempt
    that a clean rerun no longer has."""
    return f"run_date={run_date}/run_id={run_id}"


def _table_job(df: DataFrame, table: str, checks: list, out: str, run_date: str, run_id: str):
    row_checks = [c for c in checks if isinstance(c, quality.Check)]
    uniques = [c for c in checks if isinstance(c, quality.UniqueCheck)]

    def run() -> dict[str, int]:
        obs = Observation(f"dq_{table}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("total"),
                              *[F.count_if(c.failing).alias(c.name) for c in row_checks])
        q = quality.quarantine(observed, row_checks)
        written = write_parquet(q, f"{out}/failed_records/{table}/{_partition(run_date, run_id)}")
        counts = {k: int(v) for k, v in obs.get.items()}
        counts["_quarantined"] = written
        for u in uniques:
            # distinct keys, NULL counted as a value (as select(k).distinct().count())
            keys = df.groupBy(u.key).agg(F.count(F.lit(1))).count()
            counts[u.name] = counts["total"] - keys
        return counts
    return run


def run(spark: SparkSession, bronze_dir: str, dq_dir: str, run_time: str,
        gate: bool = False) -> dict:
    run_date, run_id = run_time[:10], _run_id(run_time)
    bronze = {t: tables.read(spark, f"{bronze_dir}/{t}") for t in BRONZE_TABLES}
    checks = quality.default_checks()
    by_table: dict[str, list] = {}
    for c in checks:
        by_table.setdefault(c.table, []).append(c)
    counts = run_concurrently({t: _table_job(bronze[t], t, chs, dq_dir, run_date, run_id)
                               for t, chs in by_table.items()})
    rows = [(i, c.name, c.table, counts[c.table]["total"], counts[c.table][c.name])
            for i, c in enumerate(checks)]
    raw = spark.createDataFrame(rows, "check_order int, check_name string, table string, "
                                      "total long, failed long")
    report = raw.select(
        "check_name", "table", F.col("total").alias("total_records"),
        (F.col("total") - F.col("failed")).alias("passed"), "failed",
        F.when(F.col("total") > 0, half_up("(total - failed) * 100", "total", 1))
        .alias("pass_rate_pct"),
        F.when(F.col("failed") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit(run_time).alias("run_time"), "check_order",
    )
    write_parquet(report.coalesce(1), f"{dq_dir}/reports/{_partition(run_date, run_id)}")
    # The summary and gate come from the eleven counts already on the driver.
    failed = [name for _, name, _, _, n_failed in rows if n_failed]
    result = {"total_checks": len(rows), "passed_checks": len(rows) - len(failed),
              "failed_checks": len(failed),
              "quarantined_rows": {t: counts[t]["_quarantined"] for t in by_table}}
    if gate and failed:
        raise quality.QualityGateError(
            f"{len(failed)} of {len(rows)} checks failed: {failed}")
    return result


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of the bronze tables the jobs wrote: one row with its verdict, where it
    stops the chain the failed checks it names, and how many the written report has."""
    from .pipeline import job_outputs
    root, _ = job_outputs(spark, sf_dir)
    try:
        run(spark, f"{root}/bronze", f"{root}/gate", "2024-06-02 00:00:00", gate=True)
        stopped, message = False, ""
    except quality.QualityGateError as e:
        stopped, message = True, str(e)
    return spark.read.parquet(f"{root}/gate/reports").agg(F.count_if(F.col("status") == "FAIL").alias("n_failed")).select(
        F.lit(stopped).alias("stopped"), F.lit(message).alias("message"), "n_failed")
