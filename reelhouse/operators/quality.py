"""Declarative data-quality checks: one aggregation pass per table.

A check is a name, a table and a *failing* predicate.  Only rows where the
predicate is TRUE fail; NULL passes (so ``plan NOT IN (...)`` lets a NULL plan
through, while checks that must reject NULL say so with ``isNull``).

The reference runs one count job per check and a second job to write each
check's failing rows.  Here every check of a table is a ``count_if`` in a
single aggregate; the uniqueness check is folded into the same pass by
grouping on the key first (partial aggregation makes a hot key cheap); and the
quarantine is one filtered write per table whose rows carry the names of all
checks they failed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import VALID_PLANS, half_up


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    failing: Column


@dataclass(frozen=True)
class UniqueCheck:
    name: str
    table: str
    key: str


def default_checks() -> list[Check | UniqueCheck]:
    """The eleven checks, in report order (names are fixed values)."""
    c = F.col
    return [
        Check("users_no_null_user_id", "users", c("user_id").isNull()),
        Check("users_valid_age", "users", (c("age") < 18) | (c("age") > 100) | c("age").isNull()),
        Check("users_valid_email", "users", ~c("email").contains("@") | c("email").isNull()),
        UniqueCheck("users_no_duplicates", "users", "user_id"),
        Check("watch_positive_duration", "watch_events",
              (c("watched_mins") <= 0) | c("watched_mins").isNull()),
        Check("watch_valid_completion_pct", "watch_events",
              (c("completion_pct") < 0) | (c("completion_pct") > 100)),
        Check("watch_no_null_user_id", "watch_events", c("user_id").isNull()),
        Check("watch_no_null_content_id", "watch_events", c("content_id").isNull()),
        Check("subs_valid_amount", "subscriptions", c("amount_paid") < 0),
        Check("subs_valid_plan", "subscriptions", ~c("plan").isin(VALID_PLANS)),
        Check("subs_end_after_start", "subscriptions", c("end_date") <= c("start_date")),
    ]


def _by_table(checks):
    out: dict[str, list] = {}
    for ch in checks:
        out.setdefault(ch.table, []).append(ch)
    return out


def table_failures(df: DataFrame, checks: list) -> DataFrame:
    """One row: ``total`` plus one failing-row count per check (all BIGINT)."""
    row_checks = [c for c in checks if isinstance(c, Check)]
    uniques = [c for c in checks if isinstance(c, UniqueCheck)]
    if len({u.key for u in uniques}) > 1:
        raise ValueError("one uniqueness key per table")
    if not uniques:
        return df.agg(F.count(F.lit(1)).alias("total"),
                      *[F.count_if(c.failing).alias(c.name) for c in row_checks])
    key = uniques[0].key
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                  *[F.count_if(c.failing).alias(c.name) for c in row_checks])
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("_keys"),
        *[F.coalesce(F.sum(c.name), F.lit(0)).alias(c.name) for c in row_checks])
    return totals.select("total", *[c.name for c in row_checks],
                         *[(F.col("total") - F.col("_keys")).alias(u.name) for u in uniques])


def check_report(tables: dict[str, DataFrame], checks: list | None = None,
                 run_time: str = "") -> DataFrame:
    """The quality report: one row per check, in the reference's columns."""
    checks = checks or default_checks()
    order = {c.name: i for i, c in enumerate(checks)}
    parts = []
    for table, chs in _by_table(checks).items():
        counts = table_failures(tables[table], chs)
        names = [c.name for c in chs]
        long = counts.unpivot(["total"], names, "check_name", "failed")
        parts.append(long.withColumn("table", F.lit(table)))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    order_col = F.create_map(*[x for n, i in order.items() for x in (F.lit(n), F.lit(i))])
    return report.select(
        "check_name",
        "table",
        F.col("total").alias("total_records"),
        (F.col("total") - F.col("failed")).alias("passed"),
        F.col("failed"),
        F.when(F.col("total") > 0, half_up("(total - failed) * 100", "total", 1))
        .alias("pass_rate_pct"),
        F.when(F.col("failed") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit(run_time).alias("run_time"),
        order_col[F.col("check_name")].alias("check_order"),
    )


def summary(report: DataFrame) -> DataFrame:
    """Passed / failed / total checks over a report."""
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed_checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"),
    )


def quarantine(df: DataFrame, checks: list) -> DataFrame:
    """Rows failing at least one row-level check, with ``failed_checks``."""
    row_checks = [c for c in checks if isinstance(c, Check)]
    failed = F.array_compact(F.array(*[F.when(c.failing, F.lit(c.name)) for c in row_checks]))
    return df.withColumn("failed_checks", failed).where(F.size("failed_checks") > 0)


def quarantined(tables: dict[str, DataFrame], keys: dict[str, str],
                checks: list | None = None) -> DataFrame:
    """All quarantined rows of all tables in one narrow frame (table, record id, checks)."""
    checks = checks or default_checks()
    parts = []
    for table, chs in _by_table(checks).items():
        q = quarantine(tables[table], chs)
        parts.append(q.select(
            F.lit(table).alias("table"),
            F.col(keys[table]).cast("string").alias("record_id"),
            F.array_join("failed_checks", ",").alias("failed_checks"),
            F.size("failed_checks").alias("n_failed"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> None:
    """Raise if any check failed (the 'run the next stage only if passed' step)."""
    row = summary(report).first()
    if row["failed_checks"]:
        failed = [r["check_name"] for r in report.where(F.col("status") == "FAIL")
                  .select("check_name").collect()]
        raise QualityGateError(f"{row['failed_checks']} of {row['total_checks']} checks failed: {failed}")
