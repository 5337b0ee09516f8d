"""Structured Streaming path: stream = batch, replay safety, de-duplication."""
import datetime
import os

from pyspark.sql import functions as F

from reelhouse.operators import events as ev
from reelhouse.operators import store
from reelhouse.plans import realtime
from reelhouse.streaming.engagement import first_deliveries, located, parsed_events, run_engagement_stream
from reelhouse.streaming.feed import land_feed
from tests.conftest import SF001

STORE_COLS = [c for c in store.STORE_COLUMNS]


def _batch_latest(spark):
    rows = ev.process_events(parsed_events(realtime.feed(spark, SF001)))
    return store.latest(store.once(rows))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _written(spark, store_dir):
    """The rows as the batches wrote them, with their run and batch."""
    return spark.read.parquet(store_dir)


def test_stream_equals_batch_and_loses_nothing(spark, tmp_dir):
    """The feed has late, undated and 2099 events: all are stored, in any number of batches."""
    feed = realtime.feed(spark, SF001)
    land_feed(feed.repartition(5), f"{tmp_dir}/feed")
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt", max_files_per_trigger=1)
    assert _written(spark, f"{tmp_dir}/store").select("batch_id").distinct().count() >= 2   # several micro-batches
    rows = store.read_store(spark, f"{tmp_dir}/store")
    sent = parsed_events(feed).where("parse_error is null").select("event_id").distinct()
    assert rows.count() == rows.select("request_id").distinct().count() == sent.count()
    assert rows.where("event_ts is null").count() > 0 and rows.where("event_ts > '2098-01-01'").count() > 0
    assert rows.where("event_ts > '2026-01-01' AND event_ts < '2090-01-01'").count() > 0
    assert rows.where("processed_at is null").count() == 0
    assert _same(store.latest(rows), _batch_latest(spark))


def test_sink_mode_stores_each_event_once(spark, tmp_dir):
    land_feed(realtime.feed(spark, SF001).repartition(4), f"{tmp_dir}/feed")
    for ckpt in ("a", "b"):                                   # the second run delivers everything again
        run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                              f"{tmp_dir}/ckpt_{ckpt}", dedupe="sink", max_files_per_trigger=1)
    rows = _written(spark, f"{tmp_dir}/store")
    assert rows.count() == rows.select("request_id").distinct().count() == store.read_store(spark, f"{tmp_dir}/store").count()


def test_replay_is_idempotent(spark, tmp_dir):
    land_feed(realtime.feed(spark, SF001).repartition(3), f"{tmp_dir}/feed")
    args = (f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt")
    run_engagement_stream(spark, *args, dedupe="none", max_files_per_trigger=1)
    first = store.latest(store.read_store(spark, f"{tmp_dir}/store")).cache()
    n_first = first.count()
    # restart on the same checkpoint: nothing new is processed
    run_engagement_stream(spark, *args, dedupe="none")
    assert [(b.batch_id) for b in store.committed(spark, f"{tmp_dir}/store")] == [0, 1, 2]
    # a full replay on a new checkpoint writes under its own run; readers collapse the repeats
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt2", dedupe="none", max_files_per_trigger=1)
    assert len({b.run for b in store.committed(spark, f"{tmp_dir}/store")}) == 2
    again = store.latest(store.read_store(spark, f"{tmp_dir}/store"))
    assert again.count() == n_first and _same(again, first)


def test_dead_letters_for_unparseable_numbers(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/feed")
    with open(f"{tmp_dir}/feed/a.txt", "w") as f:
        f.write('{"event_id": "1", "event_time": "2024-01-01 00:00:00.000000", "user_id": "u", '
                '"completion_pct": "lots"}\n')
        f.write('{"event_id": "2", "event_time": "2024-01-01 00:00:01.000000", "user_id": "u", '
                '"completion_pct": 90, "watched_mins": 30}\n')
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt", fmt="text")
    dead = spark.read.parquet(f"{tmp_dir}/dead")
    assert [r["request_id"] for r in dead.collect()] == ["1"]
    st = store.read_store(spark, f"{tmp_dir}/store").collect()
    assert [(r["request_id"], r["engagement_level"], r["processed_at"]) for r in st] == \
        [("2", "HIGH", "2024-01-01 00:00:01")]


def test_store_reads(spark):
    view = _batch_latest(spark)
    top = store.busiest_user(view)
    u = store.events_of_user(view, top)
    assert u.select("user_id").distinct().count() == 1
    rng = store.events_in_range(view, top, "2024-02-01 00:00:00", "2024-02-29 23:59:59")
    assert rng.where(~F.col("processed_at").startswith("2024-02")).count() == 0
    hi = store.high_engagement_users(view)
    assert hi.count() == view.where("engagement_level = 'HIGH'").select("user_id").distinct().count()


def test_compaction_counts_committed_batches_only(spark, tmp_dir):
    land_feed(realtime.feed(spark, SF001).repartition(4), f"{tmp_dir}/feed")
    args = (f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt")
    run_engagement_stream(spark, *args, max_files_per_trigger=1)
    assert _same(store.latest(store.read_store(spark, f"{tmp_dir}/store")), _batch_latest(spark))
    # an attempt that is written but not committed is not seen
    lost = store.write_batch(store.read_store(spark, f"{tmp_dir}/store").limit(3).withColumn("request_id", F.lit("x")),
                             f"{tmp_dir}/store", 0, "other")
    assert store.compact(spark, f"{tmp_dir}/store", f"{tmp_dir}/snap") == 1
    assert store.read_store(spark, f"{tmp_dir}/store").where("request_id = 'x'").count() == 0 and lost.rows == 3
    view = lambda **k: store.read_latest(spark, f"{tmp_dir}/store", f"{tmp_dir}/snap", **k)
    assert _same(view(), _batch_latest(spark))
    # nothing new: no new snapshot; batches it includes may go
    assert store.compact(spark, f"{tmp_dir}/store", f"{tmp_dir}/snap") == 1
    assert store.vacuum(spark, f"{tmp_dir}/store", f"{tmp_dir}/snap") == 4
    assert store.committed(spark, f"{tmp_dir}/store") == [] and _same(view(), _batch_latest(spark))
    # a new run after it; one user is read from that user's bucket
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt2", dedupe="none")
    assert _same(view(), _batch_latest(spark))
    user = _batch_latest(spark).where("user_id <> 'UNKNOWN'").first()["user_id"]
    one = view(user_id=user)
    assert _same(one, _batch_latest(spark).where(F.col("user_id") == user))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(user_bucket" in plan


def test_stream_routes_like_batch(spark, tmp_dir):
    land_feed(realtime.feed(spark, SF001).repartition(4), f"{tmp_dir}/feed")
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt", dedupe="none", max_files_per_trigger=2,
                          routed_dir=f"{tmp_dir}/sm")
    streamed = spark.read.parquet(f"{tmp_dir}/sm/routed").select(
        "action", "message", "engagement_score", "data.event_id", "data.user_id")
    routed, rejected = ev.state_machine(ev.parse_envelopes(located(realtime.feed(spark, SF001))))
    batch = routed.select("action", "message", "engagement_score", "data.event_id", "data.user_id")
    assert _same(streamed, batch)
    s_rej = spark.read.parquet(f"{tmp_dir}/sm/rejected").select("request_id", "error", "detail")
    assert _same(s_rej, rejected.select("request_id", "error", "detail"))


def test_flood_of_copies_is_combined_map_side(spark, tmp_dir):
    """One event delivered 3,000 times across files and batches: stored once,
    and the de-duplication aggregates map-side before its shuffle."""
    import contextlib
    import io
    import json as _json
    os.makedirs(f"{tmp_dir}/feed")
    hot = _json.dumps({"event_id": "42", "event_time": "2024-01-01 00:00:00.000000", "user_id": "u1",
                       "content_id": "c", "completion_pct": 90, "watched_mins": 30})
    for f in range(3):
        with open(f"{tmp_dir}/feed/part-{f}.txt", "w") as out:
            for i in range(1000):
                out.write(hot + "\n")
            out.write(_json.dumps({"event_id": f"x{f}", "event_time": "2024-01-01 00:00:01.000000",
                                   "user_id": "u2", "completion_pct": 10, "watched_mins": 5}) + "\n")
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt", max_files_per_trigger=1, fmt="text")
    rows = store.read_store(spark, f"{tmp_dir}/store")
    assert sorted(r["request_id"] for r in rows.collect()) == ["42", "x0", "x1", "x2"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        first_deliveries(parsed_events(spark.read.text(f"{tmp_dir}/feed"))).explain()
    plan = buf.getvalue()
    assert plan.index("Exchange") < plan.rindex("partial_min")


def test_kafka_source_is_gated(spark):
    import pytest

    from reelhouse.streaming.engagement import ConnectorMissing, kafka_messages
    try:
        df = kafka_messages(spark, "localhost:9092", "watch-events")
    except ConnectorMissing:
        return                                   # no connector in this environment
    assert df.columns == ["value", "arrived_at"]               # connector present: nothing is started
    pytest.skip("Kafka connector present")


def test_envelope_cases_across_files_stream_equals_batch(spark, tmp_dir):
    """Hand-written envelope cases spread over several files, with repeats
    across files: the stream's store equals the batch transform, once each."""
    import json as _json
    ev_ = {"user_id": "USR1", "content_id": "CNT9", "completion_pct": 85, "watched_mins": 127,
           "device": "smart_tv", "region": "Karnataka"}

    def with_meta(i, body):
        return dict(body, event_id=str(i), event_time=f"2024-01-01 00:00:{i:02d}.000000")
    msgs = [
        _json.dumps(with_meta(1, ev_)),
        _json.dumps({"event_id": "2", "event_time": "2024-01-01 00:00:02.000000",
                     "queryStringParameters": {k: str(v) for k, v in ev_.items()}}),
        _json.dumps({"Records": [{"body": _json.dumps(with_meta(3, ev_))},
                                 {"body": _json.dumps(with_meta(4, dict(ev_, completion_pct=100)))}]}),
        _json.dumps({"event_id": "5", "event_time": "2024-01-01 00:00:05.000000",
                     "body": _json.dumps(dict(ev_, watched_mins="127.9"))}),
        _json.dumps({"event_id": "6", "event_time": "2024-01-01 00:00:06.000000", "body": "{bad"}),
        _json.dumps({"event_id": "7", "event_time": "2024-01-01 00:00:07.000000"}),
        "not json at all",
    ]
    os.makedirs(f"{tmp_dir}/feed")
    files = [msgs[:4], msgs[3:], msgs[::2]]           # repeats across files
    for n, lines in enumerate(files):
        with open(f"{tmp_dir}/feed/events_{n:02d}.json", "w") as f:
            f.write("\n".join(lines) + "\n")
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead",
                          f"{tmp_dir}/ckpt", max_files_per_trigger=1, fmt="text")
    rows = store.read_store(spark, f"{tmp_dir}/store")
    streamed = store.latest(rows)
    batch_in = spark.createDataFrame([(m,) for m in msgs], "value string")
    batch = ev.process_events(parsed_events(batch_in)).select(*STORE_COLS).drop("arrived_at")
    # the two payloads without a time (not JSON, a body that is not) are stamped with their file's arrival
    assert rows.where("event_ts is null AND processed_at is null").count() == 0
    dated = "event_ts is not null"
    assert _same(streamed.where(dated).drop("arrived_at"), batch.where(dated).distinct())
    ids = sorted(r["request_id"] for r in streamed.collect())
    # the text that is no event comes at two positions, so it is two
    assert ids[:7] == ["1", "2", "3", "4", "5", "6", "7"]
    assert [i.rsplit("/", 2)[1:] for i in ids[7:]] == [["events_01.json", "3"], ["events_02.json", "3"]]


NAMELESS = '{"user_id": "u1", "content_id": "c1", "completion_pct": 85, "watched_mins": 127}'


def _stream(spark, tmp_dir, label, files, **options):
    """Run the stream over message files of (value, arrived_at[, offset]) rows; returns the store's folder."""
    for n, rows in enumerate(files):
        df = spark.createDataFrame([(v, a, *rest) for v, a, *rest in rows],
                                   "value string, arrived string" + (", offset long" if len(rows[0]) == 3 else ""))
        df = df.withColumn("arrived_at", F.col("arrived").cast("timestamp_ntz")).drop("arrived")
        if "offset" in df.columns:
            df = df.withColumns({"topic": F.lit("t"), "partition": F.lit(0)})
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{label}/feed/{n}")
    out = f"{tmp_dir}/{label}"
    run_engagement_stream(spark, f"{out}/feed/*", f"{out}/store", f"{out}/dead", f"{out}/ckpt", **options)
    return f"{out}/store"


def test_equal_messages_without_id_are_events_of_their_own(spark, tmp_dir):
    """One batch or two, by queue offset or by file and row; one position read twice is one event."""
    t = ["2024-01-01 00:00:01", "2024-01-01 00:00:01.5", "2024-01-01 00:00:09"]
    queue = [[(NAMELESS, t[0], 7), (NAMELESS, t[1], 8)], [(NAMELESS, t[0], 7), (NAMELESS, t[2], 9)]]
    plain = [[r[:2] for r in f] for f in queue]
    for label, files, want in (("q", queue, ["t/0/7", "t/0/8", "t/0/9"]), ("f", plain, None)):
        for trigger in (None, 1):
            for mode in ("batch", "sink", "none"):
                path = _stream(spark, tmp_dir, f"{label}{trigger}{mode}", files, max_files_per_trigger=trigger, dedupe=mode)
                rows = store.read_store(spark, path)
                ids = sorted(r["request_id"] for r in rows.collect())
                assert ids == want if want else len(set(ids)) == 4
                # three arrive in two seconds: none replaces another
                assert store.latest(rows).count() == len(ids)


def test_an_undated_event_delivered_again_is_stored_once_as_it_first_came(spark, tmp_dir):
    event = NAMELESS.replace("{", '{"event_id": "e1", ', 1)
    first, again = (event, "2024-01-01 00:00:00", 1), (event, "2024-01-01 00:05:00", 2)
    for label, files in (("one", [[again, first]]), ("two", [[again], [first]]), ("three", [[first], [again], [first]])):
        path = _stream(spark, tmp_dir, label, files, max_files_per_trigger=1)
        rows = store.read_store(spark, path)
        assert [(r["request_id"], r["processed_at"]) for r in rows.collect()] == [("e1", "2024-01-01 00:00:00")], label
        store.compact(spark, path, f"{tmp_dir}/{label}/snap")
        assert store.read_latest(spark, path, f"{tmp_dir}/{label}/snap").count() == 1


def test_any_batching_gives_the_same_store(spark, tmp_dir):
    feed = realtime.feed(spark, SF001)
    seen = []
    for files, trigger in ((1, None), (3, 1), (5, 2)):
        root = f"{tmp_dir}/{files}"
        land_feed(feed.repartition(files), f"{root}/feed")
        run_engagement_stream(spark, f"{root}/feed", f"{root}/store", f"{root}/dead", f"{root}/ckpt", max_files_per_trigger=trigger)
        rows = store.read_store(spark, f"{root}/store")
        seen.append((rows, store.latest(rows)))
    for rows, view in seen[1:]:
        assert _same(rows, seen[0][0]) and _same(view, seen[0][1])
    nameless = seen[0][0].where("request_id like 'watch-events/%'")
    assert nameless.count() > 20 and nameless.where("event_ts is null").count() > 10


def test_lines_of_text_files_are_known_by_file_and_number(spark, tmp_dir):
    """However the files are split into tasks."""
    os.makedirs(f"{tmp_dir}/feed")
    for name, n in (("a", 300), ("b", 7)):
        with open(f"{tmp_dir}/feed/{name}", "w") as f:
            f.writelines(f"{NAMELESS[:-1]}, \"region\": \"{name}{k}\"}}\n" for k in range(n))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in ("3k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = spark.read.schema("value string").text(f"{tmp_dir}/feed").select(
                "value", F.lit(None).cast("timestamp_ntz").alias("arrived_at"), F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"))
            assert (lines.select("_block").distinct().count() > 3) == (size == "3k")
            found.append(sorted((r["value"].rsplit('"', 2)[1], r["position"].rsplit("/", 2)[1:]) for r in located(lines).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1] == sorted((f"{f}{k}", [f, str(k)]) for f, n in (("a", 300), ("b", 7)) for k in range(n))
    run_engagement_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/store", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", fmt="text")
    view = store.latest(store.read_store(spark, f"{tmp_dir}/store"))
    assert view.count() == 307                       # one user, one arrival for each file


def test_kafka_rows_become_messages_with_their_position(spark):
    from reelhouse.streaming.engagement import from_kafka
    rows = spark.createDataFrame([(None, bytearray(NAMELESS.encode()), "watch", 3, 41, "2024-01-01 00:00:05", 0)],
                                 "key binary, value binary, topic string, partition int, offset long, ts string, timestampType int")
    rows = rows.withColumn("timestamp", F.col("ts").cast("timestamp")).drop("ts")
    got = ev.process_events(parsed_events(from_kafka(rows))).first()
    assert (got["request_id"], got["user_id"], got["processed_at"]) == ("watch/3/41", "u1", "2024-01-01 00:00:05")


def _rows_for(spark, *ids):
    rows = [(f"u{i}", "2024-01-01 00:00:00", i) for i in ids]
    df = spark.createDataFrame(rows, "user_id string, processed_at string, request_id string")
    have = {f.split()[0]: f.split()[1] for f in store.STORE_SCHEMA.split(", ")}
    return df.select(*[c if c in df.columns else F.lit(None).cast(have[c]).alias(c) for c in store.STORE_COLUMNS])


def test_two_writers_lose_no_batch_and_the_log_is_read_from_its_checkpoint(spark, tmp_dir, monkeypatch):
    import threading

    from reelhouse.sources import versions
    path, done = f"{tmp_dir}/store", []

    def write(run):
        for n in range(10):
            w = store.write_batch(_rows_for(spark, f"{run}{n}"), path, n, run)
            done.append(store.commit_batch(spark, path, n, run, w))
            assert not store.commit_batch(spark, path, n, run, w)      # a replay is committed once
    threads = [threading.Thread(target=write, args=(r,)) for r in ("a", "b", "c")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done == [True] * 30 and store.read_store(spark, path).count() == 30
    seen = store.statuses(spark, path)
    assert seen.count() == 30 and seen.agg(F.sum("n_events")).first()[0] == 30
    assert [r.version for r in seen.orderBy("version").collect()] == list(range(1, 31))
    read, text = [], versions.read_text
    monkeypatch.setattr(versions, "read_text", lambda s, p: read.append(p) or text(s, p))
    assert len(store.committed(spark, path)) == 30
    assert len(read) <= store.CHECKPOINT + 1


def test_sink_mode_reads_its_buckets_and_remembers_what_vacuum_deleted(spark, tmp_dir):
    from reelhouse.streaming.engagement import not_stored
    path = f"{tmp_dir}/store"
    for n, ids in enumerate((("a", "b", "c"), ("d", "e"))):
        w = store.write_batch(_rows_for(spark, *ids), path, n, "r", index=n == 0)
        store.commit_batch(spark, path, n, "r", w)
    batch = spark.createDataFrame([("a",), ("e",), ("new",), (None,)], "event_id string")
    left = lambda: sorted(str(r.event_id) for r in not_stored(spark, batch, path).collect())
    assert left() == ["None", "new"]
    store.compact(spark, path, f"{tmp_dir}/snap")
    assert left() == ["None", "new"] and store.vacuum(spark, path, f"{tmp_dir}/snap") == 2
    assert store.committed(spark, path) == [] and left() == ["None", "new"]
    plan = not_stored(spark, batch, path)._jdf.queryExecution().executedPlan().toString()
    assert "id_bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "request_id:string" in plan and "content_id" not in plan
    # a replay of a batch whose data is gone is skipped too
    assert store.is_committed(spark, path, 1, "r") and not store.is_committed(spark, path, 2, "r")


def test_feed_of_the_compacted_view_is_made_once_and_no_batch_is_cached(spark, tmp_dir, monkeypatch):
    rows = [(k, datetime.datetime(2024, 1, 1 + k % 9, k % 24), k % 7, "view", 1.0, "{}") for k in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmp_dir}/events.parquet")
    spark.range(9).selectExpr("id AS p_partkey").write.parquet(f"{tmp_dir}/part.parquet")
    landed, cached = [], []
    frame = type(spark.range(1))
    land, persist = realtime.land_feed, frame.persist
    monkeypatch.setattr(realtime, "land_feed", lambda feed, path: (landed.append(path), land(feed, path))[1])
    monkeypatch.setattr(frame, "persist", lambda df, *a: (cached.append(1), persist(df, *a))[1])
    got = realtime.compacted_latest(spark, tmp_dir).collect()
    assert len(landed) == 1 and not cached
    want = realtime.store_outputs(spark, realtime.stream_store(spark, tmp_dir))["engagement_latest"].collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) >= 40
