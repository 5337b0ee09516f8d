"""Keyed engagement store: append-only batches, a commit log and a latest-by-key view.

Parquet has no MERGE, so every attempt of a micro-batch writes its own folder
``run=<r>/batch_id=<n>/attempt=<a>``; ``r`` identifies the writing stream by its
checkpoint.  A batch counts once the log (``_log``, ``sources/versions``) has it: a
commit names its folder with the number of its rows, and is put only if absent, so
writers cannot overwrite each other's and a replayed batch is committed once.
Every ``CHECKPOINT`` commits one also carries the whole state, so finding the live
batches reads a bounded number of small files however long the history is.

``_ids`` holds the request ids of batches written in sink mode, in buckets by hash,
sorted and with Bloom filters.  It is part of the commit, and outlives the batches:
``vacuum`` deletes data that a snapshot includes, never ids.

Readers first see each event once: of the deliveries of a request id (an event's id or
its position in the source) the one that arrived first counts.  The latest view has
one row per (user_id, processed_at), ordered by event time then request id, so the
answer does not depend on how events were batched.  Events without a time of their
own are stamped with their arrival and never replace each other: their key is the
request id.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from ..sources.sinks import write_parquet
from .dedupe import dedupe_by_key, latest_by_key

STORE_KEY = ["user_id", "processed_at"]
STORE_COLUMNS = ["user_id", "processed_at", "content_id", "completion_pct", "watched_mins",
                 "engagement_level", "is_binge_watcher", "device", "region",
                 "notification_count", "request_id", "event_ts", "arrived_at"]
STORE_SCHEMA = ("user_id string, processed_at string, content_id string, completion_pct double, watched_mins int, "
                "engagement_level string, is_binge_watcher boolean, device string, region string, "
                "notification_count int, request_id string, event_ts timestamp_ntz, arrived_at timestamp_ntz")
BUCKETS = 64                # of a snapshot, by user
ID_BUCKETS = 64             # of the id index, by request id
CHECKPOINT = 16
SAVED = "SAVED"


class Batch(NamedTuple):
    run: str
    batch_id: int
    path: str


def run_id(checkpoint_dir: str) -> str:
    """Stable id of a stream: the same checkpoint always maps to the same id."""
    return hashlib.sha1(checkpoint_dir.rstrip("/").encode()).hexdigest()[:16]


def _log_dir(store_dir: str) -> str:
    return f"{store_dir}/_log"


def _apply(state: dict, action: dict) -> dict:
    if "add" in action:
        entry = action["add"]
        key = f"{entry['run']}/{entry['batch_id']}"
        state["live"][key] = entry["path"]
        state["last"][entry["run"]] = entry["batch_id"]
        state["ids" if entry["ids"] else "bare"][key] = entry["ids"] or entry["path"]
    for key in action.get("remove", []):
        state["live"].pop(key, None)
    if "fold" in action:
        for key in action["fold"]["keys"]:
            state["ids"].pop(key, None)
            state["bare"].pop(key, None)
        state["ids"]["base"] = action["fold"]["path"]
    return state


def _state(spark: SparkSession, store_dir: str) -> tuple[int, dict]:
    """The last commit's number and what it leaves: live batches, the last batch of each run, the
    folders of the id index, and batches whose ids are not in it yet."""
    log = _log_dir(store_dir)
    last = versions.head(spark, log)
    state, newer, version = {"live": {}, "last": {}, "ids": {}, "bare": {}}, [], last
    while version:
        content = versions.read(spark, log, version)
        if "state" in content:
            state = content["state"]
            break
        newer.append(content["action"])
        version -= 1
    for action in reversed(newer):
        _apply(state, action)
    return last, state


def _commit(spark: SparkSession, store_dir: str, make: Callable[[dict], dict | None]) -> bool:
    """Commit what ``make`` wants done on the current state, if anything; on top of whoever was first."""
    for _ in range(100):
        version, state = _state(spark, store_dir)
        action = make(state)
        if action is None:
            return False
        content = {"action": action}
        if (version + 1) % CHECKPOINT == 0:
            content["state"] = _apply(state, action)
        if versions.commit(spark, _log_dir(store_dir), version + 1, content):
            return True
    raise versions.CommitConflict(store_dir)


class Written(NamedTuple):
    path: str
    ids: str | None
    rows: int


def write_batch(batch: DataFrame, store_dir: str, batch_id: int, run: str, index: bool = False) -> Written:
    """Write an attempt of a batch, with ``index`` also its ids; it counts once ``commit_batch`` has it."""
    place = f"run={run}/batch_id={batch_id}/attempt={uuid.uuid4().hex[:8]}"
    rows = write_parquet(batch.select(*STORE_COLUMNS), f"{store_dir}/{place}")
    ids = None
    if index:
        ids = f"{store_dir}/_ids/{place}"
        spark = batch.sparkSession
        _write_ids(_rows(spark, [f"{store_dir}/{place}"]).select("request_id"), ids)
    return Written(f"{store_dir}/{place}", ids, rows)


def commit_batch(spark: SparkSession, store_dir: str, batch_id: int, run: str, written: Written, rejected: int = 0) -> bool:
    """Add a written batch and its save status to the log; False if the batch is in it already."""
    entry = {"run": run, "batch_id": batch_id, "path": written.path, "ids": written.ids, "rows": written.rows,
             "rejected": rejected, "status": SAVED, "saved_at": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")}
    return _commit(spark, store_dir, lambda state: None if state["last"].get(run, -1) >= batch_id else {"add": entry})


def committed(spark: SparkSession, store_dir: str) -> list[Batch]:
    """The live batches, in order."""
    _, state = _state(spark, store_dir)
    return sorted(Batch(key.rpartition("/")[0], int(key.rpartition("/")[2]), path) for key, path in state["live"].items())


def statuses(spark: SparkSession, store_dir: str) -> DataFrame:
    """The save status of every batch ever committed: version, run, batch_id, status, n_events, n_rejected, saved_at."""
    entry = "struct<run: string, batch_id: int, rows: long, rejected: long, status: string, saved_at: string>"
    log = spark.read.schema(f"action struct<add: {entry}>").json(f"{_log_dir(store_dir)}/*.json")
    version = F.regexp_extract(F.col("_metadata.file_name"), "([0-9]+)", 1).cast("int").alias("version")
    return log.where("action.add is not null").select(
        version, "action.add.run", "action.add.batch_id", "action.add.status", F.col("action.add.rows").alias("n_events"),
        F.col("action.add.rejected").alias("n_rejected"), "action.add.saved_at")


# -- the id index ---------------------------------------------------------------

def id_bucket(request_id: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(request_id), F.lit(ID_BUCKETS)).cast("int")


def _write_ids(ids: DataFrame, path: str) -> None:
    rows = ids.where("request_id is not null").distinct().withColumn("id_bucket", id_bucket(F.col("request_id")))
    rows.hint("rebalance", F.col("id_bucket")).sortWithinPartitions("id_bucket", "request_id").write.mode("overwrite").partitionBy(
        "id_bucket").option("parquet.bloom.filter.enabled#request_id", "true").parquet(path)


def stored_ids(spark: SparkSession, store_dir: str, buckets: list[int] | None = None) -> DataFrame:
    """request_id of all events the store has or had; of these buckets of the index alone.  Batches
    that are not in the index yet are read themselves, their id column only."""
    _, state = _state(spark, store_dir)
    out = spark.createDataFrame([], "request_id string")
    if state["ids"]:
        index = spark.read.schema("request_id string, id_bucket int").option("basePath", f"{store_dir}/_ids").parquet(
            *state["ids"].values())
        if buckets is not None:
            index = index.where(F.col("id_bucket").isin(buckets))
        out = index.select("request_id")
    if state["bare"]:
        out = out.unionByName(_rows(spark, list(state["bare"].values())).select("request_id"))
    return out


def is_committed(spark: SparkSession, store_dir: str, batch_id: int, run: str) -> bool:
    return _state(spark, store_dir)[1]["last"].get(run, -1) >= batch_id


def _fold_ids(spark: SparkSession, store_dir: str, keys: list[str]) -> None:
    """One index folder in place of the base and these batches' own."""
    _, state = _state(spark, store_dir)
    keys = [k for k in keys if k in state["ids"] or k in state["bare"]]
    if not keys:
        return
    parts = [state["ids"][k] for k in [*keys, "base"] if k in state["ids"]]
    ids = _rows(spark, [state["bare"][k] for k in keys if k in state["bare"]]).select("request_id")
    for part in parts:
        ids = ids.unionByName(spark.read.schema("request_id string").parquet(part).select("request_id"))
    path = f"{store_dir}/_ids/run=base/batch_id=0/attempt={uuid.uuid4().hex[:8]}"
    _write_ids(ids, path)
    _commit(spark, store_dir, lambda now: {"fold": {"keys": keys, "path": path}}
            if now["ids"].get("base") == state["ids"].get("base") else None)


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], STORE_SCHEMA)


def _identity() -> F.Column:
    """The request id; rows without one (no id and no position) are told apart by their values."""
    return F.coalesce("request_id", F.concat(F.lit("\u0001"), F.sha2(F.to_json(F.struct(*STORE_COLUMNS)), 256)))


def once(rows: DataFrame) -> DataFrame:
    """Every event once: the delivery that arrived first."""
    return dedupe_by_key(rows.select(*STORE_COLUMNS, _identity().alias("_id")), "_id", ["arrived_at"]).select(*STORE_COLUMNS)


def read_store(spark: SparkSession, store_dir: str) -> DataFrame:
    """Every stored event once: repeated deliveries that landed in several batches collapse."""
    return once(_rows(spark, [b.path for b in committed(spark, store_dir)]))


def latest(store: DataFrame) -> DataFrame:
    """One row per key of events that come once, last write wins (by event time, then request id)."""
    undated = F.when(F.col("event_ts").isNull(), _identity()).otherwise("")
    rows = store.select(*STORE_COLUMNS, undated.alias("_undated"))
    return latest_by_key(rows, [*STORE_KEY, "_undated"], ["event_ts", "request_id"]).select(*STORE_COLUMNS)


def _snapshot(spark: SparkSession, snapshot_dir: str) -> tuple[int, dict[str, int]]:
    """The last complete snapshot: its version and, for each stream run, the last batch it includes."""
    marks = versions.glob(spark, f"{snapshot_dir}/v=*/_SUCCESS")
    complete = sorted(int(m.rsplit("/", 2)[1].partition("=")[2]) for m in marks)
    for v in reversed(complete):
        got = versions.glob(spark, f"{snapshot_dir}/included/v={v}/_SUCCESS")
        if got:
            rows = spark.read.text(f"{snapshot_dir}/included/v={v}").collect()     # one row
            return v, json.loads(rows[0]["value"])
    return 0, {}


def _newer(batches: list[Batch], through: dict[str, int]) -> list[Batch]:
    return [b for b in batches if b.batch_id > through.get(b.run, -1)]


def compact(spark: SparkSession, store_dir: str, snapshot_dir: str) -> int:
    """Fold the committed batches after the last snapshot into a new one; returns its version.

    Reads the last snapshot and newer batches only.  A run's batches count up to
    the first one that is missing, so one completed later is still newer.  The new
    version gets its own directory, one partition for each bucket of users, and
    then its own list of included batches; until that list is complete, readers
    keep the version before.
    """
    version, through = _snapshot(spark, snapshot_dir)
    included, upto = [], dict(through)
    for b in _newer(committed(spark, store_dir), through):
        if b.batch_id == upto.get(b.run, -1) + 1:
            included.append(b)
            upto[b.run] = b.batch_id
    if not included:
        return version
    rows = _rows(spark, [b.path for b in included])
    if version:
        rows = rows.unionByName(spark.read.parquet(f"{snapshot_dir}/v={version}").select(*STORE_COLUMNS))
    _fold_ids(spark, store_dir, [f"{b.run}/{b.batch_id}" for b in included])
    new = version + 1
    (latest(once(rows)).withColumn("user_bucket", user_bucket(F.col("user_id")))
     .repartition("user_bucket").sortWithinPartitions("user_bucket", "user_id", "processed_at")
     .write.mode("overwrite").partitionBy("user_bucket").parquet(f"{snapshot_dir}/v={new}"))
    spark.range(1).select(F.lit(json.dumps(upto)).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(f"{snapshot_dir}/included/v={new}")
    return new


def vacuum(spark: SparkSession, store_dir: str, snapshot_dir: str) -> int:
    """Delete batches the last snapshot includes, and older snapshots; returns how many batches.
    Their ids stay in the index."""
    version, through = _snapshot(spark, snapshot_dir)
    old = [b for b in committed(spark, store_dir) if b.batch_id <= through.get(b.run, -1)]
    _fold_ids(spark, store_dir, [f"{b.run}/{b.batch_id}" for b in old])
    if old:
        _commit(spark, store_dir, lambda state: {"remove": [f"{b.run}/{b.batch_id}" for b in old]})
    for path in [b.path for b in old] + [p for v in range(1, version) for p in versions.glob(spark, f"{snapshot_dir}/v={v}")]:
        versions.delete(spark, path)
    return len(old)


def user_bucket(user_id) -> F.Column:
    return F.pmod(F.xxhash64(user_id), F.lit(BUCKETS)).cast("int")


def read_latest(spark: SparkSession, store_dir: str, snapshot_dir: str | None = None,
                user_id: str | None = None) -> DataFrame:
    """Latest-by-key view = last snapshot + batches written after it.  With ``user_id``, of
    one user: the snapshot is read from that user's bucket alone."""
    version, through = _snapshot(spark, snapshot_dir) if snapshot_dir else (0, {})
    rows = _rows(spark, [b.path for b in _newer(committed(spark, store_dir), through)])
    snap = spark.read.parquet(f"{snapshot_dir}/v={version}") if version else None
    if user_id is not None:
        rows = rows.where(F.col("user_id") == user_id)
        if snap is not None:
            bucket = spark.range(1).select(user_bucket(F.lit(user_id))).first()[0]
            snap = snap.where((F.col("user_bucket") == bucket) & (F.col("user_id") == user_id))
    if snap is not None:
        rows = snap.select(*STORE_COLUMNS).unionByName(rows)
    return latest(once(rows))


def events_of_user(view: DataFrame, user_id: str | F.Column) -> DataFrame:
    """All events of one user (partition-key query)."""
    return view.where(F.col("user_id") == user_id)


def events_in_range(view: DataFrame, user_id: str | F.Column, start: str, end: str) -> DataFrame:
    """One user's events with ``start <= processed_at <= end`` (sort-key range)."""
    return events_of_user(view, user_id).where(F.col("processed_at").between(start, end))


def recent_events(view: DataFrame, user_id: str | F.Column, days: int = 30) -> DataFrame:
    """One user's events in the ``days`` before their latest event (a sort-key
    range whose bounds come from the data: scalar subqueries, no driver trip)."""
    mine = events_of_user(view, user_id)
    end = mine.select(F.max("processed_at")).scalar()
    start = F.date_format(F.to_timestamp(end) - F.expr(f"INTERVAL {int(days)} DAYS"),
                          "yyyy-MM-dd HH:mm:ss")
    return mine.where(F.col("processed_at").between(start, end))


def high_engagement_users(view: DataFrame) -> DataFrame:
    return view.where(F.col("engagement_level") == "HIGH").select("user_id").distinct()


def busiest_user(view: DataFrame) -> F.Column:
    """Scalar subquery: the user with the most stored events (ties: smallest
    id), ignoring the UNKNOWN sentinel of events without a user."""
    counts = view.where(F.col("user_id") != "UNKNOWN").groupBy("user_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.min_by("user_id", F.struct(-F.col("n"), F.col("user_id")))).scalar()
