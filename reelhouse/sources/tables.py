"""Parquet tables partitioned by a column and replaced by versions.

``<table>/v=<tag>/<column>=<value>`` holds the partitions one write made; a commit in
``<table>/_versions`` names, for each value, the version that holds it.  A write makes
new folders and then one commit, so readers see the table before it or after it, a
failed write leaves nothing to see, and partitions that lost their last row are gone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from .sinks import write_parquet

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _state(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    version = versions.head(spark, f"{path}/_versions")
    return version, versions.read(spark, f"{path}/_versions", version) if version else None


def _read(spark: SparkSession, path: str, state: dict, values: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    folders = [f"{path}/v={tag}/{state['column']}={value}" for value, tag in sorted(state["partitions"].items())
               if values is None or value in values]
    if not folders:
        return spark.createDataFrame([], schema)
    if values is None and state["whole"]:
        folders = [f"{path}/v={state['whole']}"]        # one write made it all: one folder to list
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last commit has it; a folder without commits is read as plain Parquet."""
    version, state = _state(spark, path)
    return _read(spark, path, state) if version else spark.read.parquet(path)


def _write(df: DataFrame, path: str, column: str) -> tuple[int, dict[str, str]]:
    """Write partitions of a new tag: (rows, the tag of each value)."""
    tag = uuid.uuid4().hex[:12]
    rows = write_parquet(df.hint("rebalance", F.col(column)), f"{path}/v={tag}", partition_by=[column])
    folders = versions.glob(df.sparkSession, f"{path}/v={tag}/{column}=*")
    return rows, {f.rpartition("=")[2]: tag for f in folders}


def _commit(spark: SparkSession, path: str, version: int, schema: T.StructType, column: str, partitions: dict,
            whole: bool = False, source: dict | None = None) -> bool:
    """``whole``: the partitions are all that one write made; ``source``: what they were derived from."""
    return versions.commit(spark, f"{path}/_versions", version,
                           {"schema": json.loads(schema.json()), "column": column, "partitions": partitions,
                            "whole": next(iter(partitions.values()), None) if whole else None, "source": source})


def replace(df: DataFrame, path: str, column: str) -> int:
    """The table becomes ``df``; returns its rows."""
    spark = df.sparkSession
    rows, partitions = _write(df, path, column)
    for _ in range(10):
        if _commit(spark, path, _state(spark, path)[0] + 1, df.schema, column, partitions, whole=True):
            return rows
    raise versions.CommitConflict(path)


def merge(new: DataFrame, path: str, column: str, key: str) -> tuple[int, list[str]]:
    """Upsert ``new`` (one row a key, stored) by key: a row goes from the partition it was in to the
    one it belongs to now.  Only partitions that hold a key of ``new``, or get one, are rewritten;
    they are found by reading the key column alone.  Returns rows of ``new`` and these partitions."""
    spark = new.sparkSession
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION)).alias("value")
    for _ in range(10):
        version, state = _state(spark, path)
        if not version:
            rows, partitions = _write(new, path, column)
            if _commit(spark, path, 1, new.schema, column, partitions, whole=True):
                return rows, sorted(partitions)
            continue
        keys = new.select(F.col(key).alias("_key"))
        held = _read(spark, path, state)
        was_in = held.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(value)
        touched = {r.value for r in was_in.union(new.select(value)).distinct().collect()}      # dates
        kept = _read(spark, path, state, touched).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        columns = T.StructType.fromJson(state["schema"]).fieldNames()
        _, partitions = _write(kept.unionByName(new.select(*columns)), path, column)
        partitions |= {v: tag for v, tag in state["partitions"].items() if v not in touched}
        if _commit(spark, path, version + 1, T.StructType.fromJson(state["schema"]), column, partitions):
            return new.count(), sorted(touched)
    raise versions.CommitConflict(path)


def derive(spark: SparkSession, source: str, path: str, column: str, make: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Bring the table at ``path`` up to ``source``, a table of the same partitions, where each partition
    is ``make`` of the source's rows of that value.  The commit keeps the source's versions, and only
    values whose version differs are read and written; values the source lost go.  Returns these values."""
    for _ in range(10):
        of, held = _state(spark, source)
        if not of:
            raise ValueError(f"{source} has no commit")
        version, state = _state(spark, path)
        known = (state["source"] or {}) if version else {}
        changed = {v for v in known.keys() | held["partitions"].keys() if known.get(v) != held["partitions"].get(v)}
        if version and not changed:
            return []
        rows = make(_read(spark, source, held, None if len(changed) == len(held["partitions"]) and not known else changed))
        _, partitions = _write(rows, path, column)
        kept = {v: tag for v, tag in state["partitions"].items() if v not in changed} if version else {}
        if _commit(spark, path, version + 1, rows.schema, column, kept | partitions, whole=not kept, source=held["partitions"]):
            return sorted(changed)
    raise versions.CommitConflict(path)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the versions the last commit does not name (and readers no longer use); returns how many."""
    version, state = _state(spark, path)
    if not version:
        return 0
    used = set(state["partitions"].values())
    old = [f for f in versions.glob(spark, f"{path}/v=*") if f.rpartition("=")[2] not in used]
    for folder in old:
        versions.delete(spark, folder)
    return len(old)
