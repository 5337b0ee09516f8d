"""The job CLI end to end at sf0.001: every stage, the stream and compaction."""
import contextlib
import io

from reelhouse import jobs
from reelhouse.plans import realtime
from reelhouse.plans.pipeline import land_raw
from reelhouse.streaming.feed import land_feed
from tests.conftest import SF001


def run(argv):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        jobs.main(argv)
    return buf.getvalue()


def test_all_jobs(spark, tmp_dir):
    land_raw(spark, SF001, f"{tmp_dir}/raw")
    land_feed(realtime.feed(spark, SF001), f"{tmp_dir}/feed")
    lake = f"{tmp_dir}/lake"
    assert '"watch_events"' in run(["raw-to-bronze", "--raw", f"{tmp_dir}/raw", "--out", lake])
    assert '"user_watch_profile"' in run(["bronze-to-silver", "--out", lake])
    assert '"dau_metrics"' in run(["silver-to-gold", "--out", lake])
    assert '"total_checks": 11' in run(["data-quality", "--out", lake])
    assert "q10_executive" in run(["reports", "--name", "q10_executive", "--out", lake])
    run(["stream", "--source", f"{tmp_dir}/feed", "--out", lake])
    assert '"snapshot"' in run(["compact", "--out", lake])
    assert '"recommendations"' in run(["recommend", "--out", lake])
    gold = spark.read.parquet(f"{lake}/gold/dau_metrics")
    assert gold.count() > 0
    latest = spark.read.parquet(f"{lake}/engagement/snapshot/v=*")
    assert latest.count() > 0
    routed = spark.read.parquet(f"{lake}/engagement/state_machine/routed")
    assert set(r["action"] for r in routed.select("action").distinct().collect()) <= {
        "SEND_BINGE_NOTIFICATION", "UPDATE_RECOMMENDATIONS", "LOG_AND_EXIT"}


def test_reference_format_files_reach_the_profile(spark, tmp_dir):
    """Text ids (USR..., uuid, CNT...), a JSON array with a broken file beside it, and their profile rows."""
    import json
    import os
    users = "user_id,name,email,age,gender,region,device,signup_date,is_active,preferred_lang\n" + "".join(
        f"USR{k:06d},User_{k},user{k}@ottmail.com,30,F,Delhi,mobile,2022-01-01,True,Hindi\n" for k in (1, 2))
    subs = ("subscription_id,user_id,plan,start_date,end_date,amount_paid,payment_method,auto_renew\n"
            "0b7d5a0e-58a0-4a52-9d7c-0d5b7cf0b001,USR000001,premium,2023-01-01,2023-02-01,349,upi,True\n")
    content = ("content_id,title,type,genre,language,release_year,duration_mins,rating,num_seasons,is_original\n"
               "CNT0001,Movie_Title_1,movie,Drama,Hindi,2019,120,7.5,,True\n")
    event = {"event_id": "6f1c1a52-2a4e-4a86-9a53-1f0f8c6d7e01", "user_id": "USR000001", "content_id": "CNT0001",
             "watch_start_time": "2024-01-02 21:15:00", "duration_mins": 120, "watched_mins": 60, "completion_pct": 50.25,
             "device": "mobile", "region": "Delhi", "buffering_events": 1, "quality": "4K"}
    for name, text in (("users", users), ("subscriptions", subs), ("content_catalog", content),
                       ("watch_events", json.dumps([event, dict(event, event_id="two", user_id="USR000002")], indent=2))):
        os.makedirs(f"{tmp_dir}/raw/{name}")
        with open(f"{tmp_dir}/raw/{name}/{name}", "w") as f:
            f.write(text)
    with open(f"{tmp_dir}/raw/watch_events/broken", "w") as f:
        f.write('[{"event_id": "x", ')
    lake = f"{tmp_dir}/lake"
    counts = json.loads(run(["raw-to-bronze", "--raw", f"{tmp_dir}/raw", "--out", lake, "--json-array"]))
    assert counts["watch_events"] == 2 and counts["rejected_watch_events"] == 1
    run(["bronze-to-silver", "--out", lake])
    rows = {r["event_id"]: r for r in spark.read.parquet(f"{lake}/silver/user_watch_profile").collect()}
    assert {k: (r["user_id"], r["plan"], r["title"], str(r["watch_date"])) for k, r in rows.items()} == {
        event["event_id"]: ("USR000001", "premium", "Movie_Title_1", "2024-01-02"),
        "two": ("USR000002", None, "Movie_Title_1", "2024-01-02")}


def test_clean_rerun_clears_its_quarantine(spark, tmp_dir):
    from reelhouse.plans import quality_job
    t = "2024-05-01 00:00:00"
    for age in (5, 30):
        for name, row in (("users", ("u1", age, "a@b")), ("watch_events", ("e1", "u1", "c", 10, 50.0)),
                          ("subscriptions", ("s1", 10, "free", "2023-01-01", "2023-02-01"))):
            schema = {"users": "user_id string, age int, email string",
                      "watch_events": "event_id string, user_id string, content_id string, watched_mins int, completion_pct double",
                      "subscriptions": "subscription_id string, amount_paid int, plan string, start_date string, end_date string"}
            spark.createDataFrame([row], schema[name]).write.mode("overwrite").parquet(f"{tmp_dir}/bronze/{name}")
        quality_job.run(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/dq", t)
        assert spark.read.parquet(f"{tmp_dir}/dq/failed_records/users").count() == (1 if age == 5 else 0)
