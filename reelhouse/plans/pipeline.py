"""Whole-chain assembly: raw -> bronze -> silver -> gold -> reports.

``medallion`` wires the layers lazily, so one action over any output lets
Catalyst optimise across layers (pruning columns the output never uses).
``run_jobs`` is the materialising form: each stage reads the previous
stage's Parquet, as separately scheduled jobs would.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import domain, files, tables
from ..session import new_scratch, run_concurrently
from . import bronze as bronze_plan
from . import gold as gold_plan
from . import gold_state
from . import reports as report_plan
from . import silver as silver_plan

RUN_TIME_COLUMNS = ("ingestion_timestamp", "silver_ingestion_time", "ingestion_time",
                    "run_time", "validated_at", "scored_at")


def now_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def without_run_time(df: DataFrame) -> DataFrame:
    """Drop wall-clock stamp columns (for comparisons)."""
    return df.drop(*[c for c in RUN_TIME_COLUMNS if c in df.columns])


@dataclass
class Medallion:
    raw: dict[str, DataFrame]
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]

    def reports(self) -> dict[str, DataFrame]:
        return report_plan.run_reports(self.gold)


def medallion(spark: SparkSession, sf_dir: str, ingestion_time: str | None = None) -> Medallion:
    t = ingestion_time or now_text()
    raw = domain.raw_tables(spark, sf_dir)
    bronze = bronze_plan.bronze_tables(raw, t)
    silver = silver_plan.silver_tables(bronze, t)
    gold = gold_plan.gold_tables(silver["user_watch_profile"], silver["content_performance"],
                                 bronze["subscriptions"], t)
    return Medallion(raw, bronze, silver, gold)


def land_raw(spark: SparkSession, sf_dir: str, raw_dir: str,
             tables: tuple[str, ...] | None = None) -> None:
    """Write the derived raw tables as landing files (CSV / JSON lines)."""
    raw = domain.raw_tables(spark, sf_dir)
    run_concurrently({t: (lambda t=t: files.write_raw(raw[t], f"{raw_dir}/{t}", t)) for t in tables or tuple(raw)})


def bronze_from_files(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Land one derived raw table as files, then ingest it through the file scan."""
    raw_dir = new_scratch(spark, f"raw-{table}")
    land_raw(spark, sf_dir, raw_dir, (table,))
    df = files.read_raw(spark, f"{raw_dir}/{table}", table)
    return bronze_plan.to_bronze(df, table, now_text())


def land_untidy_events(spark: SparkSession, sf_dir: str, raw_dir: str) -> None:
    """Events as JSON lines, some of them cut short (numbers with remainder 5 by 97)."""
    ev = domain.raw_watch_events(spark, sf_dir)
    whole = F.to_json(F.struct(*ev.columns), {"timestampNTZFormat": files.TS_TEXT})
    cut = F.concat(F.lit('{"event_id": "'), F.col("event_id"), F.lit('", "user_id":'))
    broken = F.expr(f"{domain.number_of('event_id')} % 97 = 5")
    ev.select(F.when(broken, cut).otherwise(whole).alias("value")).write.mode("overwrite").text(f"{raw_dir}/watch_events")


def events_from_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events ingested from files that each hold one JSON array."""
    raw_dir = new_scratch(spark, "raw-arrays")
    files.write_json_arrays(domain.raw_watch_events(spark, sf_dir), f"{raw_dir}/watch_events")
    raw, _ = bronze_plan.read_landed(spark, f"{raw_dir}/watch_events", "watch_events", json_array=True)
    return bronze_plan.to_bronze(raw.drop("source_path", "part"), "watch_events", now_text())


def events_from_untidy_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(bronze events, rejected records) of JSON lines some of which are broken."""
    raw_dir = new_scratch(spark, "raw-untidy")
    land_untidy_events(spark, sf_dir, raw_dir)
    raw, rejected = bronze_plan.read_landed(spark, f"{raw_dir}/watch_events", "watch_events")
    return bronze_plan.to_bronze(raw.drop("source_path"), "watch_events", now_text()), rejected


def _land_events(events: DataFrame, raw_dir: str, spark: SparkSession, sf_dir: str) -> None:
    run_concurrently({
        "others": lambda: land_raw(spark, sf_dir, raw_dir, ("users", "subscriptions", "content_catalog")),
        "events": lambda: files.write_raw(events, f"{raw_dir}/watch_events", "watch_events")})


def _day_before(events: DataFrame, which: str) -> DataFrame:
    """The events as first delivered: these a day earlier."""
    start = F.expr(f"CASE WHEN {domain.number_of('event_id')} % {which} THEN watch_start_time - INTERVAL 1 DAY ELSE watch_start_time END")
    return events.withColumn("watch_start_time", start)


def bronze_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events after the job ran on a first delivery (a third of the events missing, some of
    the others on another day) and again on the whole raw files."""
    root, raw = new_scratch(spark, "bronze-rerun"), domain.raw_watch_events(spark, sf_dir)
    first = _day_before(raw, "7 = 1").where(f"{domain.number_of('event_id')} % 3 <> 0")
    for name, events in (("first", first), ("second", raw)):
        _land_events(events, f"{root}/{name}", spark, sf_dir)
        bronze_plan.run(spark, f"{root}/{name}", f"{root}/bronze", now_text())
    return tables.read(spark, f"{root}/bronze/watch_events")


def bronze_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events after an increment of late and corrected events: numbers ending in 0 come
    late, those ending in 5 were a day earlier, and no first delivery says how often it buffered."""
    root, raw = new_scratch(spark, "bronze-merged"), domain.raw_watch_events(spark, sf_dir)
    number = domain.number_of("event_id")
    first = _day_before(raw, "10 = 5").withColumn("buffering_events", F.lit(None).cast("int"))
    _land_events(first.where(f"{number} % 10 <> 0"), f"{root}/first", spark, sf_dir)
    bronze_plan.run(spark, f"{root}/first", f"{root}/bronze", now_text())
    _land_events(raw.where(f"{number} % 5 = 0"), f"{root}/second", spark, sf_dir)
    bronze_plan.run(spark, f"{root}/second", f"{root}/bronze", now_text(), merge=True)
    return tables.read(spark, f"{root}/bronze/watch_events")


def gold_from_state(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A gold table made from state that met the events in two deliveries: the second has the last
    day, some events that come late (remainder 7 by 1009) and some that were a day earlier (5)."""
    root, raw = new_scratch(spark, "gold-state"), domain.raw_watch_events(spark, sf_dir)
    number, day = domain.number_of("event_id"), F.to_date("watch_start_time")
    last = raw.agg(F.max(day)).scalar()
    new = F.coalesce(day == last, F.lit(False)) | F.expr(f"{number} % 1009 = 7")
    deliveries = {"first": _day_before(raw, "1009 = 5").where(~new), "second": raw.where(new | F.expr(f"{number} % 1009 = 5"))}
    run_concurrently({n: (lambda n=n: _land_events(deliveries[n], f"{root}/{n}", spark, sf_dir)) for n in deliveries})
    for name in ("first", "second"):
        bronze_plan.run(spark, f"{root}/{name}", f"{root}/bronze", now_text(), merge=name == "second")
        gold_state.run(spark, f"{root}/bronze", f"{root}/state", f"{root}/gold", now_text())
    return spark.read.parquet(f"{root}/gold/{table}")


def job_outputs(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """Land the raw tables, run the three ETL jobs and the quality job; returns the lake's
    folder and the rows each job says it wrote."""
    from . import quality_job
    root = new_scratch(spark, "lake")
    land_raw(spark, sf_dir, f"{root}/raw")
    counts = {f"{layer}.{t}": n for layer, tables in run_jobs(spark, f"{root}/raw", root).items() for t, n in tables.items()}
    dq = quality_job.run(spark, f"{root}/bronze", f"{root}/dq", "2024-06-01 00:00:00")
    counts |= {f"quarantine.{t}": n for t, n in dq["quarantined_rows"].items()}
    return root, counts


def run_jobs(spark: SparkSession, raw_dir: str, out_dir: str) -> dict[str, dict[str, int]]:
    """Run the three ETL jobs in order over landed raw files."""
    t = now_text()
    counts = {"bronze": bronze_plan.run(spark, raw_dir, f"{out_dir}/bronze", t)}
    counts["silver"] = silver_plan.run(spark, f"{out_dir}/bronze", f"{out_dir}/silver", t)
    counts["gold"] = gold_plan.run(spark, f"{out_dir}/silver", f"{out_dir}/bronze",
                                   f"{out_dir}/gold", t)
    return counts
