"""Versioned tables: whole replacement, upsert by key across date partitions, two writers."""
import json
import os
import threading

from pyspark.sql import functions as F

from reelhouse.plans import bronze
from reelhouse.sources import tables, versions

SCHEMA = "event_id string, n int, watch_date date"


def rows_of(df):
    return sorted(((r["event_id"], r["n"], str(r["watch_date"])) for r in df.collect()), key=str)


def frame(spark, tmp_dir, name, rows):
    df = spark.createDataFrame(rows, "event_id string, n int, d string").selectExpr("event_id", "n", "CAST(d AS DATE) AS watch_date")
    df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
    return spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/{name}")


def _event(i, day):
    return {"event_id": i, "user_id": "u", "content_id": "c", "watch_start_time": f"2024-01-{day} 10:00:00",
            "duration_mins": 10, "watched_mins": 5, "completion_pct": 50.0, "device": "tv", "region": "Delhi",
            "buffering_events": 1, "quality": "4K"}


def _land(root, events):
    for t in ("users", "subscriptions", "content_catalog"):
        os.makedirs(f"{root}/{t}", exist_ok=True)
    os.makedirs(f"{root}/watch_events")
    with open(f"{root}/watch_events/e.json", "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)


def test_a_rerun_leaves_nothing_of_the_run_before(spark, tmp_dir):
    _land(f"{tmp_dir}/one", [_event("a", "01"), _event("b", "01"), _event("c", "02")])
    _land(f"{tmp_dir}/two", [_event("a", "02"), _event("d", "02")])
    assert bronze.run(spark, f"{tmp_dir}/one", f"{tmp_dir}/bronze", "t")["watch_events"] == 3
    assert bronze.run(spark, f"{tmp_dir}/two", f"{tmp_dir}/bronze", "t")["watch_events"] == 2
    got = tables.read(spark, f"{tmp_dir}/bronze/watch_events")
    assert sorted((r.event_id, str(r.watch_date)) for r in got.collect()) == [("a", "2024-01-02"), ("d", "2024-01-02")]
    assert tables.vacuum(spark, f"{tmp_dir}/bronze/watch_events") == 1 and got.count() == 2


def test_an_increment_keeps_the_other_rows_of_its_dates(spark, tmp_dir):
    _land(f"{tmp_dir}/one", [_event("a", "01"), _event("b", "01"), _event("c", "02"), _event("x", "05")])
    _land(f"{tmp_dir}/two", [_event("a", "02"), _event("late", "02"), _event("new", "03")])
    bronze.run(spark, f"{tmp_dir}/one", f"{tmp_dir}/bronze", "t")
    assert bronze.run(spark, f"{tmp_dir}/two", f"{tmp_dir}/bronze", "t", merge=True)["watch_events"] == 3
    got = tables.read(spark, f"{tmp_dir}/bronze/watch_events")
    assert sorted((r.event_id, str(r.watch_date)[-2:]) for r in got.collect()) == [
        ("a", "02"), ("b", "01"), ("c", "02"), ("late", "02"), ("new", "03"), ("x", "05")]


def test_merge_rewrites_touched_partitions_only(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    first = [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-03"), ("d", 1, None), (None, 1, "2024-01-03")]
    assert tables.merge(frame(spark, tmp_dir, "f", first), path, "watch_date", "event_id")[0] == 5
    before = versions.read(spark, f"{path}/_versions", 1)["partitions"]
    held = tables.read(spark, path)
    # a moves and leaves its date empty, d gets a date, the null key is one key
    n, touched = tables.merge(frame(spark, tmp_dir, "s", [("a", 2, "2024-01-03"), ("d", 2, "2024-01-04"), (None, 2, None)]),
                              path, "watch_date", "event_id")
    assert n == 3 and touched == ["2024-01-01", "2024-01-03", "2024-01-04", tables.NULL_PARTITION]
    after = versions.read(spark, f"{path}/_versions", 2)["partitions"]
    assert after["2024-01-02"] == before["2024-01-02"] and "2024-01-01" not in after
    assert rows_of(tables.read(spark, path)) == sorted(
        [("a", 2, "2024-01-03"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-03"), ("d", 2, "2024-01-04"), (None, 2, "None")], key=str)
    # readers of the version before still have it; an empty increment and an empty table are fine
    assert len(rows_of(held)) == 5
    assert tables.merge(frame(spark, tmp_dir, "e", []), path, "watch_date", "event_id") == (0, [])
    assert tables.replace(frame(spark, tmp_dir, "e", []), path, "watch_date") == 0 and tables.read(spark, path).count() == 0


def test_finding_partitions_reads_the_key_alone_and_dates_are_pruned(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.replace(frame(spark, tmp_dir, "f", [(str(k), k, f"2024-01-{1 + k % 9:02d}") for k in range(50)]), path, "watch_date")
    table = tables.read(spark, path)
    keys = spark.createDataFrame([("7",)], "_key string")
    was_in = table.join(keys, F.col("event_id").eqNullSafe(F.col("_key")), "left_semi").select("watch_date")
    plan = was_in._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:string>" in plan
    one = table.where("watch_date = DATE'2024-01-03'")
    assert "PartitionFilters: [isnotnull(watch_date" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 6


def test_two_writers_lose_nothing(spark, tmp_dir):
    path, done = f"{tmp_dir}/t", []
    frames = [frame(spark, tmp_dir, f"w{k}", [(f"{k}-{i}", k, f"2024-01-0{1 + i}") for i in range(3)]) for k in range(4)]
    threads = [threading.Thread(target=lambda f=f: done.append(tables.merge(f, path, "watch_date", "event_id"))) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 4 and tables.read(spark, path).count() == 12
    assert versions.head(spark, f"{path}/_versions") == 4


def test_put_if_absent_has_one_winner(spark, tmp_dir):
    won = []
    threads = [threading.Thread(target=lambda k=k: versions.put_if_absent(spark, f"{tmp_dir}/x/1.json", str(k)) and won.append(k))
               for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and versions.read_text(spark, f"{tmp_dir}/x/1.json") == str(won[0])
    # the head is found from any earlier hint
    for v in (2, 3):
        assert versions.commit(spark, f"{tmp_dir}/log", v - 1, {"v": v})
    versions.write_text(spark, f"{tmp_dir}/log/_head", "1")
    assert versions.head(spark, f"{tmp_dir}/log") == 2 and not versions.commit(spark, f"{tmp_dir}/log", 2, {})


def test_rows_and_rejects_of_clean_files_are_one_scan(spark, tmp_dir, monkeypatch):
    """Rejected rows are counted by the write itself; only a table that has some is read again."""
    _land(f"{tmp_dir}/raw", [_event("a", "01"), _event("b", "01")])
    again, seen, read = [], [], bronze.read_landed
    monkeypatch.setattr(bronze, "read_landed", lambda s, path, table, *a: again.append(table) or read(s, path, table, *a))
    seen.append(bronze.run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", "t")["rejected_watch_events"])
    assert again == []
    with open(f"{tmp_dir}/raw/watch_events/broken.json", "w") as f:
        f.write('{"event_id": "x", \n')
    seen.append(bronze.run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", "t")["rejected_watch_events"])
    assert seen == [0, 1] and again == ["watch_events"]
    rejected = spark.read.parquet(f"{tmp_dir}/bronze/_rejected/watch_events").first()
    assert rejected["record"].startswith('{"event_id": "x"') and rejected["source_path"].endswith("broken.json")
