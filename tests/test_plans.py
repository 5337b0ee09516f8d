"""Plan-level properties: JVM-only expressions, pushdown / pruning, skew splitting."""
import contextlib
import datetime as dt
import io

import pytest

import __spark_entry__ as E
from reelhouse import catalog
from reelhouse.plans import silver
from tests.conftest import SF001

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonMapInArrow")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


NON_STREAM = sorted(n for n in catalog.QUERIES if not n.startswith("engagement_"))


@pytest.mark.parametrize("name", NON_STREAM)
def test_no_python_in_plan(spark, name):
    text = plan_text(E.queries()[name](spark, SF001), "extended")
    assert not [p for p in PYTHON_NODES if p in text]


def test_scans_are_pruned_and_filters_pushed(spark):
    from reelhouse.plans.pipeline import medallion
    m = medallion(spark, SF001, "t")
    text = plan_text(m.gold["device_analytics"])
    # the events scan reads only the columns the device report needs
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    ev_scan = [s for s in scans if "event_id" in s and "ts" in s]
    assert ev_scan and "props" not in ev_scan[0] and "event_type" not in ev_scan[0]
    assert "PushedFilters" in text
    q10 = plan_text(E.queries()["q10_executive"](spark, SF001))
    assert "customer" not in q10 and "events.parquet" not in q10   # only orders is read


@pytest.mark.parametrize("hot", ["user", "title"])
def test_hot_key_join_is_split(spark, hot):
    """One user (or one title) holds a third of all events: with broadcast
    off, AQE splits the hot partition of the sort-merge join instead of giving
    it to one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        d, t = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 1)
        users = spark.createDataFrame(
            [(u, f"n{u}", "e@x", 30, "M", "Delhi", "tv", d, True, "Hindi") for u in range(200)],
            "user_id long, name string, email string, age int, gender string, region string, "
            "device string, signup_date date, is_active boolean, preferred_lang string")
        subs = spark.createDataFrame([(u, u, "basic", d, d, 99, "upi", True) for u in range(200)],
                                     "subscription_id long, user_id long, plan string, start_date date, "
                                     "end_date date, amount_paid int, payment_method string, "
                                     "auto_renew boolean")
        def ids(i):
            hot_row = i % 3 == 0
            user = 0 if hot == "user" and hot_row else i % 200
            title = 0 if hot == "title" and hot_row else i % 50
            return user, title
        rows = [(i, *ids(i), t, 10, 50.0, "tv", "4K", 1, d, 1) for i in range(6000)]
        watch = spark.createDataFrame(rows, "event_id long, user_id long, content_id long, "
                                            "watch_start_time timestamp_ntz, watched_mins int, "
                                            "completion_pct double, device string, quality string, "
                                            "buffering_events int, watch_date date, watch_hour int")
        content = spark.createDataFrame([(c, f"T{c}", "movie", "Drama", "Hindi", 7.0) for c in range(50)],
                                        "content_id long, title string, type string, genre string, "
                                        "language string, rating double")
        prof = silver.user_watch_profile(users, subs, watch.repartition(8), content, "t")
        out = prof.select("event_id", "user_id", "title")
        assert len(out.collect()) == 6000
        text = plan_text(out, "simple")
        assert "isFinalPlan=true" in text
        joins = [line for line in text.replace(" ", "").splitlines() if "SortMergeJoin(skew=true)" in line]
        key = "user_id" if hot == "user" else "content_id"
        assert any(key in line for line in joins), text
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bronze_events_date_filter_reaches_scan(spark, tmp_dir):
    """The events table the job writes is partitioned by date: a date predicate picks folders."""
    from reelhouse.plans import bronze
    from reelhouse.plans.pipeline import land_raw
    from reelhouse.sources import tables
    land_raw(spark, SF001, f"{tmp_dir}/raw")
    bronze.run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", "t")
    q = tables.read(spark, f"{tmp_dir}/bronze/watch_events").where("watch_date >= DATE'2024-03-01'") \
        .select("event_id", "watch_date")
    text = plan_text(q)
    pruned = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert pruned and "watch_date" in pruned[0]
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "user_id" not in schema


def test_no_forced_broadcasts(spark):
    """With both broadcast thresholds disabled, no registered plan broadcasts:
    every broadcast in normal runs is the planner's size-checked choice, never
    a hint on a table that grows with the data."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in NON_STREAM:
            text = plan_text(E.queries()[name](spark, SF001), "simple")
            assert "BroadcastExchange" not in text and "BroadcastHashJoin" not in text, name
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


UNUSED_SOURCE_COLUMNS = ["props:", "event_type:", "value:", "c_acctbal:", "c_mktsegment:",
                         "o_totalprice:", "o_orderstatus:", "p_brand:", "p_retailprice:"]


def test_scans_never_read_unused_source_columns(spark):
    for name in NON_STREAM:
        text = plan_text(E.queries()[name](spark, SF001))
        schemas_read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
        assert schemas_read, name
        for line in schemas_read:
            assert not [c for c in UNUSED_SOURCE_COLUMNS if c in line], (name, line)


def test_store_reads_neither_broadcast_nor_run_python(spark, tmp_dir):
    """The engagement outputs: one replay, a compaction, then every read pattern's plan."""
    from reelhouse.operators import store
    from reelhouse.plans import realtime
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    path = realtime.stream_store(spark, SF001)
    store.compact(spark, path, f"{tmp_dir}/snapshot")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        reads = realtime.store_outputs(spark, path) | {"compacted": store.read_latest(spark, path, f"{tmp_dir}/snapshot")}
        for name, df in reads.items():
            text = plan_text(df, "simple")
            assert "BroadcastExchange" not in text and not [p for p in PYTHON_NODES if p in text], name
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
