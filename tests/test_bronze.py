"""Raw file scans, safe casts and key de-duplication."""
import json
import os

from reelhouse.plans import bronze
from reelhouse.sources import files

USERS_CSV = """user_id,name,email,age,gender,region,device,signup_date,is_active,preferred_lang
1,User_1,user1@ottmail.com,25,M,Delhi,mobile,2021-03-04,true,Hindi
2,User_2,user2@ottmail.com,abc,F,Kerala,tablet,2022-01-01,false,Tamil
2,User_2,user2@ottmail.com,abc,F,Kerala,tablet,2022-01-01,false,Tamil
3,User_3,,40,Other,Gujarat,laptop,not-a-date,maybe,English
"""
SUBS_CSV = """subscription_id,user_id,plan,start_date,end_date,amount_paid,payment_method,auto_renew
10,1,premium,2023-01-01,2023-02-01,349,upi,true
11,2,basic,2023-01-05,2023-04-05,,card,false
"""
CONTENT_CSV = """content_id,title,type,genre,language,release_year,duration_mins,rating,num_seasons,is_original
5,Movie_Title_5,movie,Drama,Hindi,2019,120,7.5,,true
6,Show_Title_6,series,Comedy,English,2020,45,8.1,3,false
6,Show_Title_6,series,Comedy,English,2020,45,8.1,3,false
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_scan_safe_casts_and_dedupe(spark, tmp_dir):
    _write(f"{tmp_dir}/users/users.csv", USERS_CSV)
    df = bronze.to_bronze(files.read_raw(spark, f"{tmp_dir}/users", "users"), "users", "t0")
    rows = {r["user_id"]: r for r in df.collect()}
    assert sorted(rows) == ["1", "2", "3"]                  # duplicate key collapsed
    assert rows["2"]["age"] is None                      # 'abc' -> NULL, job survives ANSI mode
    assert rows["3"]["signup_date"] is None and rows["3"]["is_active"] is None
    assert rows["3"]["email"] is None                    # empty cell
    assert rows["1"]["age"] == 25 and rows["1"]["is_active"] is True
    assert rows["1"]["layer"] == "bronze" and rows["1"]["source_file"] == "raw/users/users.csv"


def test_csv_empty_amount_and_seasons(spark, tmp_dir):
    _write(f"{tmp_dir}/subscriptions/s.csv", SUBS_CSV)
    _write(f"{tmp_dir}/content_catalog/c.csv", CONTENT_CSV)
    subs = bronze.to_bronze(files.read_raw(spark, f"{tmp_dir}/subscriptions", "subscriptions"),
                            "subscriptions", "t0")
    got = {r["subscription_id"]: r["amount_paid"] for r in subs.collect()}
    assert got == {"10": 349, "11": None}
    content = bronze.to_bronze(files.read_raw(spark, f"{tmp_dir}/content_catalog", "content_catalog"),
                               "content_catalog", "t0")
    got = {r["content_id"]: (r["num_seasons"], r["rating"]) for r in content.collect()}
    assert got == {"5": (None, 7.5), "6": (3, 8.1)}


def test_json_array_scan_date_hour(spark, tmp_dir):
    events = [
        {"event_id": "7", "user_id": "1", "content_id": "5", "watch_start_time": "2024-01-02 21:15:00",
         "duration_mins": 120, "watched_mins": 60, "completion_pct": 50.0, "device": "tv",
         "region": "Delhi", "buffering_events": 1, "quality": "4K"},
        {"event_id": "7", "user_id": "1", "content_id": "5", "watch_start_time": "2024-01-02 21:15:00",
         "duration_mins": 120, "watched_mins": 60, "completion_pct": 50.0, "device": "tv",
         "region": "Delhi", "buffering_events": 1, "quality": "4K"},
        {"event_id": "8", "user_id": "2", "content_id": "6", "watch_start_time": "yesterday",
         "duration_mins": "x", "watched_mins": 10, "completion_pct": "12.5", "device": "tv",
         "region": "Kerala", "buffering_events": 0, "quality": "720p"},
    ]
    _write(f"{tmp_dir}/watch_events/watch_events.json", json.dumps(events, indent=2))
    raw = files.read_raw(spark, f"{tmp_dir}/watch_events", "watch_events", multiline=True)
    df = bronze.to_bronze(raw, "watch_events", "t0")
    rows = {r["event_id"]: r for r in df.collect()}
    assert sorted(rows) == ["7", "8"]
    assert str(rows["7"]["watch_date"]) == "2024-01-02" and rows["7"]["watch_hour"] == 21
    assert rows["8"]["watch_date"] is None and rows["8"]["watch_hour"] is None
    assert rows["8"]["duration_mins"] is None and rows["8"]["completion_pct"] == 12.5


def test_dedupe_is_deterministic_and_idempotent(spark):
    from reelhouse.operators.dedupe import dedupe_by_key, latest_by_key
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1), (None, "x", 1), (None, "y", 0)],
                               "k int, v string, o int")
    first = sorted(map(tuple, dedupe_by_key(df, "k").collect()), key=str)
    assert first == sorted([(1, "a", 9), (2, "z", 1), (None, "x", 1)], key=str)
    last = {r["k"]: r["v"] for r in latest_by_key(df, "k", ["o"]).collect()}
    assert last == {1: "a", 2: "z", None: "x"}
    again = sorted(map(tuple, dedupe_by_key(dedupe_by_key(df, "k"), "k").collect()), key=str)
    assert again == first


def test_land_and_ingest_roundtrip(spark, tmp_dir):
    from reelhouse.plans.pipeline import land_raw, medallion
    from tests.conftest import SF001
    land_raw(spark, SF001, tmp_dir)
    frames = bronze.ingest_files(spark, tmp_dir, "t0")
    mem = medallion(spark, SF001, "t0").bronze
    for t in frames:
        assert frames[t].where("source_path IS NULL").count() == 0
        a = frames[t].drop("ingestion_timestamp", "source_path")
        b = mem[t].drop("ingestion_timestamp")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t


def test_csv_header_order_is_checked(spark, tmp_dir):
    import pytest
    swapped = USERS_CSV.replace("user_id,name,", "name,user_id,", 1)
    _write(f"{tmp_dir}/users/users.csv", swapped)
    with pytest.raises(Exception):
        files.read_raw(spark, f"{tmp_dir}/users", "users").collect()


def test_array_files_are_parsed_from_memory_like_multiline(spark, tmp_dir):
    """Good, pretty-printed, broken and empty files: the rows multiLine gives, without its reads for every number."""
    row = {"event_id": "e1", "user_id": 7, "duration_mins": 120, "completion_pct": 12.50, "device": "a\u2028b, ]"}
    texts = ["[" + json.dumps(row).replace("12.5", "12.50") + ",\n{\"event_id\": \"e2\", \"completion_pct\": 1e1}]",
             json.dumps([row, {"event_id": "e3"}], indent=2), json.dumps({"event_id": "e4"}), "[]", "", "  \n", "[{\"event_id\": \"e5\"}, null]",
             "[{\"event_id\": \"e6\"}, {\"event_id\":", "[1, 2]", "nonsense\n[]", "\n\n[{\"event_id\": \"e7\", \"region\": {\"a\": [1.0, 2]}}]\n"]
    for k, text in enumerate(texts):
        _write(f"{tmp_dir}/watch_events/{k}.json", text)
    from reelhouse import schemas
    raw = files.read_raw(spark, f"{tmp_dir}/watch_events", "watch_events", multiline=True, keep_rejected=True)
    fields = schemas.as_strings(schemas.RAW["watch_events"][0]).add(files.REJECTED, "string")
    want = spark.read.schema(fields).option("columnNameOfCorruptRecord", files.REJECTED).json(f"{tmp_dir}/watch_events", multiLine=True)
    rows = lambda df: sorted(map(tuple, df.withColumn("f", files.source_file_column()).collect()), key=repr)
    assert rows(raw) == rows(want) and {r["event_id"] for r in raw.collect()} >= {"e1", "e2", "e3", "e4", "e7"}
    assert [r[0] for r in raw.where("event_id = 'e1'").select("completion_pct").distinct().orderBy("completion_pct").collect()] == ["12.5", "12.50"]
    options = raw._jdf.queryExecution().analyzed().collectLeaves().head().relation().options()
    assert options.get("multiLine").isEmpty() and options.get("multiline").isEmpty()
