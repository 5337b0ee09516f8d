"""Gold from per-day state equals the full rebuild and reads only the dates that changed (A2, A4, A5)."""
import pytest
from pyspark.sql import functions as F

from reelhouse.plans import gold, gold_state, silver
from reelhouse.sources import tables

EVENTS = ("event_id string, user_id string, content_id string, watch_start_time timestamp, watched_mins int, completion_pct double, "
          "device string, quality string, buffering_events int, watch_hour int, d string")


def _events(spark, rows):
    full = [(i, u, c, None, m, p, dev, "4K", b, 1, d) for i, u, c, m, p, dev, b, d in rows]
    return spark.createDataFrame(full, EVENTS).withColumn("watch_date", F.col("d").cast("date")).drop("d")


def _dimensions(spark, root, plans):
    spark.createDataFrame([(u, u, 30, "f", "x", "tv", None, True, "en") for u in ("u1", "u2", "u3")],
                          "user_id string, name string, age int, gender string, region string, device string, signup_date date, "
                          "is_active boolean, preferred_lang string").write.mode("overwrite").parquet(f"{root}/users")
    spark.createDataFrame([(f"s{k}", u, "Basic", 100, None, None) for k, u in enumerate(plans)],
                          "subscription_id string, user_id string, plan string, amount_paid int, start_date date, end_date date"
                          ).write.mode("overwrite").parquet(f"{root}/subscriptions")
    spark.createDataFrame([("c1", "One", "film", "drama", "en", 4.0), ("c2", "Two", "film", "drama", "en", 3.0)],
                          "content_id string, title string, type string, genre string, language string, rating double"
                          ).write.mode("overwrite").parquet(f"{root}/content_catalog")


def _rebuilt(spark, root):
    b = {t: tables.read(spark, f"{root}/{t}") for t in ("users", "subscriptions", "watch_events", "content_catalog")}
    s = silver.silver_tables(b, "t")
    return gold.gold_tables(s["user_watch_profile"], s["content_performance"], b["subscriptions"], "t")


def _same(spark, root, state):
    full, got = _rebuilt(spark, root), gold_state.gold_tables(spark, root, state, "t")
    for name, df in full.items():
        assert got[name].columns == df.columns and [f.dataType for f in got[name].schema] == [f.dataType for f in df.schema], name
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, df.collect())), name


FIRST = [("a", "u1", "c1", 10, 50.05, "tv", 1, "2024-01-01"), ("b", "u1", "c1", 20, float("nan"), "tv", 2, "2024-01-01"),
         ("c", "u2", "c2", None, 12.345, "phone", None, "2024-01-02"), ("d", "u9", "c9", 5, 99.0, None, 0, "2024-01-02"),
         ("e", None, None, 7, None, "tv", 3, "2024-01-03"), ("f", "u3", "c1", 9, 33.3, "tv", 1, None)]


def test_state_equals_the_rebuild_and_reads_changed_dates_only(spark, tmp_dir):
    root, state = f"{tmp_dir}/bronze", f"{tmp_dir}/state"
    _dimensions(spark, root, ["u1", "u1", "u2"])
    tables.replace(_events(spark, FIRST), f"{root}/watch_events", "watch_date")
    assert len(gold_state.refresh(spark, root, state)["activity"]) == 4
    _same(spark, root, state)
    assert gold_state.refresh(spark, root, state) == {"activity": [], "viewing": []}

    # a late event, one that moves to a new day (its old day keeps a row), and one that empties its day
    second = [("g", "u2", "c1", 3, 1.0, "tv", 1, "2024-01-01"), ("c", "u2", "c2", 4, 2.0, "tv", None, "2024-01-05"),
              ("e", "u3", "c2", 8, 3.0, "tv", 3, "2024-01-05")]
    new = _events(spark, second)
    new.write.parquet(f"{tmp_dir}/new")
    tables.merge(spark.read.schema(new.schema).parquet(f"{tmp_dir}/new"), f"{root}/watch_events", "watch_date", "event_id")
    assert gold_state.refresh(spark, root, state)["viewing"] == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"]
    _same(spark, root, state)
    assert {str(r.watch_date) for r in tables.read(spark, f"{state}/viewing").select("watch_date").distinct().collect()} == {
        "None", "2024-01-01", "2024-01-02", "2024-01-05"}

    # a late subscription needs no date again
    _dimensions(spark, root, ["u1", "u3", "u3", "u3"])
    assert gold_state.refresh(spark, root, state)["activity"] == []
    _same(spark, root, state)


def test_empty_and_missing_events(spark, tmp_dir):
    root, state = f"{tmp_dir}/bronze", f"{tmp_dir}/state"
    _dimensions(spark, root, [])
    with pytest.raises(ValueError):
        tables.derive(spark, f"{root}/watch_events", f"{state}/x", "watch_date", lambda df: df)
    tables.replace(_events(spark, FIRST).where("false"), f"{root}/watch_events", "watch_date")
    gold_state.refresh(spark, root, state)
    _same(spark, root, state)
    tables.replace(_events(spark, FIRST), f"{root}/watch_events", "watch_date")
    gold_state.refresh(spark, root, state)
    _same(spark, root, state)


def test_ids_are_padded_and_repeats_picked_by_number(spark, tmp_dir):
    """No text is formatted, or read back, for each event to find the repeated ones."""
    from reelhouse.sources import domain
    odd = spark.sql("SELECT * FROM VALUES (-5L), (0L), (7L), (999999L), (1000000L), (123456789012L), (NULL) t(n)")
    formatted = "CASE WHEN n IS NOT NULL THEN format_string('USR%06d', n) END"
    assert odd.where(f"NOT ({domain._id('user', 'n')} <=> {formatted})").count() == 0
    events = [(None if k == 5 else k * 50 - 200, None, k, "view", 1.0, "{}") for k in range(12)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmp_dir}/events.parquet")
    spark.range(3).selectExpr("id AS p_partkey").write.parquet(f"{tmp_dir}/part.parquet")
    raw = domain.raw_watch_events(spark, tmp_dir)
    ev = domain.watch_events(spark, tmp_dir)
    want = ev.unionByName(ev.where(f"{domain.number_of('event_id')} % 100 = 0"))
    assert raw.exceptAll(want).count() == want.exceptAll(raw).count() == 0
    assert "substring" not in raw._jdf.queryExecution().optimizedPlan().toString()
