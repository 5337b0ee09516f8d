"""Raw -> bronze: key de-duplication, safe typed casts, audit columns.

One generic transform driven by the declared schemas.  Casts use
``try_cast`` (Spark 4 runs ANSI, where a plain cast of ``'abc'`` to INT fails
the whole job); unparseable cells become NULL and are caught by the quality
checks instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedupe import dedupe_by_key
from ..session import new_scratch, run_concurrently
from ..sources import files, tables
from ..sources.sinks import write_parquet


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast every column to its declared type with ``try_cast`` (as SQL text:
    one expression list instead of a chain of column-object calls).  Columns
    outside the declared schema (lineage such as ``source_path``) pass through."""
    schema, _ = schemas.RAW[table]
    have = {f.name: f.dataType for f in df.schema.fields}   # one schema round-trip
    exprs = []
    for f in schema.fields:
        if have[f.name] != f.dataType:
            exprs.append(f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`")
        else:
            exprs.append(f"`{f.name}`")
    declared = set(schema.fieldNames())
    exprs += [f"`{c}`" for c in have if c not in declared]
    return df.selectExpr(*exprs)


def to_bronze(df: DataFrame, table: str, ingestion_time: str) -> DataFrame:
    """Bronze form of one raw table (lazy)."""
    _, key = schemas.RAW[table]
    out = typed(dedupe_by_key(df, key), table)
    if table == "watch_events":
        out = out.withColumns({
            "watch_date": F.to_date("watch_start_time"),
            "watch_hour": F.hour("watch_start_time"),
        })
    return out.withColumns({
        "ingestion_timestamp": F.lit(ingestion_time),
        "source_file": F.lit(schemas.SOURCE_FILES[table]),
        "layer": F.lit("bronze"),
    })


def bronze_tables(raw: dict[str, DataFrame], ingestion_time: str) -> dict[str, DataFrame]:
    return {t: to_bronze(df, t, ingestion_time) for t, df in raw.items()}


def read_landed(spark: SparkSession, path: str, table: str, json_array: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw rows with ``source_path``, rejected rows) of one landed table."""
    raw = files.read_raw(spark, path, table, multiline=json_array, keep_rejected=True)
    return files.split_rejected(raw.withColumn("source_path", files.source_file_column()), schemas.RAW[table][1])


def ingest_files(spark: SparkSession, raw_dir: str, ingestion_time: str,
                 json_array: bool = False) -> dict[str, DataFrame]:
    """Bronze frames straight from landed raw files under ``raw_dir/<table>``,
    with ``source_path``: the file each surviving row was read from."""
    return {t: to_bronze(read_landed(spark, f"{raw_dir}/{t}", t, json_array)[0], t, ingestion_time)
            for t in schemas.RAW}


def run(spark: SparkSession, raw_dir: str, bronze_dir: str, ingestion_time: str,
        json_array: bool = False, merge: bool = False) -> dict[str, int]:
    """Job: land every raw table in ``bronze_dir`` as Parquet; returns row counts,
    and ``rejected_<table>`` for rows that did not parse, kept in ``_rejected/<table>``.

    Events are partitioned by ``watch_date``; a rebalance on it gives each date
    few files and splits a date that is too large for one task.  A run replaces its
    tables.  With ``merge`` the raw events are an increment: each replaces the event
    of its id, wherever that was, and only dates that change are rewritten
    (``sources/tables``).  Rows that did not parse are counted while the others are
    written; a table is read again only if it has any.
    """
    def job(table: str):
        def land() -> tuple[int, int]:
            path = f"{raw_dir}/{table}"
            raw = files.read_raw(spark, path, table, multiline=json_array, keep_rejected=True)
            bad = Observation()
            seen = raw.withColumn("source_path", files.source_file_column()).observe(
                bad, F.count_if(F.col(files.REJECTED).isNotNull()).alias("n"))
            rows, rejected = files.split_rejected(seen, schemas.RAW[table][1])
            df = to_bronze(rows, table, ingestion_time)
            out = f"{bronze_dir}/{table}"
            if table != "watch_events":
                n = write_parquet(df, out)
            elif merge:
                staged = new_scratch(spark, "increment")
                write_parquet(df, staged)
                n, _ = tables.merge(spark.read.schema(df.schema).parquet(staged), out, "watch_date", "event_id")
            else:
                n = tables.replace(df, out, "watch_date")
            if bad.get["n"]:
                _, rejected = read_landed(spark, path, table, json_array)
            else:
                rejected = spark.createDataFrame([], rejected.schema)
            return n, write_parquet(rejected, f"{bronze_dir}/_rejected/{table}")
        return land

    counts = run_concurrently({t: job(t) for t in schemas.RAW})
    return {t: n for t, (n, _) in counts.items()} | {f"rejected_{t}": n for t, (_, n) in counts.items()}
