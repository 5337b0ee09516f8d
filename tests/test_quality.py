"""Data-quality framework (Q1-Q15)."""
import pytest

from reelhouse.operators import quality
from reelhouse.plans.pipeline import medallion
from reelhouse.plans.quality_job import quality_outputs
from tests.conftest import SF01

# Expected (total, passed) at sf0.01, from the fixture description.
EXPECTED = {
    "users_no_null_user_id": (1500, 1500), "users_valid_age": (1500, 1435),
    "users_valid_email": (1500, 1446), "users_no_duplicates": (1500, 1500),
    "watch_positive_duration": (10000, 9980), "watch_valid_completion_pct": (10000, 9986),
    "watch_no_null_user_id": (10000, 9975), "watch_no_null_content_id": (10000, 9978),
    "subs_valid_amount": (1500, 1471), "subs_valid_plan": (1500, 1455),
    "subs_end_after_start": (1500, 1456),
}


def test_report_matches_expected_counts(spark):
    out = quality_outputs(medallion(spark, SF01, "t").bronze, "t")
    rows = {r["check_name"]: r for r in out["dq_report"].collect()}
    assert {k: (r["total_records"], r["passed"]) for k, r in rows.items()} == EXPECTED
    for r in rows.values():
        assert r["passed"] + r["failed"] == r["total_records"]
        assert r["status"] == ("PASS" if r["failed"] == 0 else "FAIL")
    assert rows["users_valid_age"]["pass_rate_pct"] == 95.7
    assert rows["watch_no_null_user_id"]["pass_rate_pct"] == 99.8   # 99.75 rounds HALF_UP
    s = out["dq_summary"].first()
    assert (s["total_checks"], s["passed_checks"], s["failed_checks"]) == (11, 2, 9)


def test_quarantine_lists_every_failed_check(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, None, "b@x"), (None, 50, "c@x"), (4, 30, "d@x")],
                               "user_id long, age int, email string")
    checks = [c for c in quality.default_checks() if c.table == "users"]
    q = {r["user_id"]: r["failed_checks"] for r in quality.quarantine(df, checks).collect()}
    assert q == {1: ["users_valid_age", "users_valid_email"], 2: ["users_valid_age"],
                 None: ["users_no_null_user_id"]}


def test_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([(1, 30, "a@x"), (1, 30, "a@x"), (None, 30, "b@x"), (None, 30, "c@x")],
                               "user_id long, age int, email string")
    checks = [c for c in quality.default_checks() if c.table == "users"]
    rep = {r["check_name"]: r for r in quality.check_report({"users": df}, checks).collect()}
    # distinct keys {1, NULL} = 2 of 4 rows
    assert rep["users_no_duplicates"]["failed"] == 2
    assert rep["users_no_null_user_id"]["failed"] == 2


def test_empty_table_passes_with_null_rate(spark):
    empty = spark.createDataFrame([], "subscription_id long, amount_paid int, plan string, "
                                      "start_date date, end_date date")
    checks = [c for c in quality.default_checks() if c.table == "subscriptions"]
    rows = quality.check_report({"subscriptions": empty}, checks).collect()
    assert len(rows) == 3
    assert all(r["status"] == "PASS" and r["pass_rate_pct"] is None and r["total_records"] == 0
               for r in rows)


def test_null_semantics(spark):
    df = spark.createDataFrame([(1, None, None, None, None)],
                               "subscription_id long, amount_paid int, plan string, "
                               "start_date date, end_date date")
    checks = [c for c in quality.default_checks() if c.table == "subscriptions"]
    rows = quality.check_report({"subscriptions": df}, checks).collect()
    assert all(r["failed"] == 0 for r in rows)   # NULL amount/plan/dates pass


def test_gate_raises(spark):
    out = quality_outputs(medallion(spark, SF01, "t").bronze, "t")
    with pytest.raises(quality.QualityGateError):
        quality.gate(out["dq_report"])
    ok = out["dq_report"].where("status = 'PASS'")
    quality.gate(ok)


def test_quality_job_writes_report_and_quarantine(spark, tmp_dir):
    from reelhouse.plans import quality_job
    from reelhouse.plans.pipeline import land_raw, run_jobs
    from tests.conftest import SF001
    land_raw(spark, SF001, f"{tmp_dir}/raw")
    run_jobs(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out")
    res = quality_job.run(spark, f"{tmp_dir}/out/bronze", f"{tmp_dir}/dq", "2026-01-02 03:04:05")
    assert res["total_checks"] == 11
    rep = spark.read.parquet(f"{tmp_dir}/dq/reports")
    assert rep.count() == 11 and rep.select("run_date").distinct().count() == 1
    q = spark.read.parquet(f"{tmp_dir}/dq/failed_records/users")
    assert q.count() == res["quarantined_rows"]["users"] > 0
    assert "failed_checks" in q.columns


def test_single_pass_job_report_equals_lazy_report(spark, tmp_dir):
    from reelhouse.plans import quality_job
    from reelhouse.sources.sinks import write_parquet
    bronze = medallion(spark, SF01, "t").bronze
    for t in ("users", "watch_events", "subscriptions"):
        write_parquet(bronze[t], f"{tmp_dir}/bronze/{t}")
    quality_job.run(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/dq", "2026-01-02 03:04:05")
    cols = ["check_name", "table", "total_records", "passed", "failed", "pass_rate_pct", "status",
            "check_order"]
    job = spark.read.parquet(f"{tmp_dir}/dq/reports").select(*cols)
    lazy = quality_outputs(bronze, "x")["dq_report"].select(*cols)
    assert job.exceptAll(lazy).count() == 0 and lazy.exceptAll(job).count() == 0


def test_quality_job_gate(spark, tmp_dir):
    from reelhouse.plans import quality_job
    from reelhouse.sources.sinks import write_parquet
    bronze = medallion(spark, SF01, "t").bronze
    for t in ("users", "watch_events", "subscriptions"):
        write_parquet(bronze[t], f"{tmp_dir}/bronze/{t}")
    with pytest.raises(quality.QualityGateError):
        quality_job.run(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/dq", "2026-01-02 03:04:05", gate=True)
    res = quality_job.run(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/dq2", "2026-01-02 03:04:05")
    assert (res["total_checks"], res["passed_checks"], res["failed_checks"]) == (11, 2, 9)


def test_quality_job_rerun_replaces_its_own_output(spark, tmp_dir):
    from reelhouse.plans import quality_job
    from reelhouse.sources.sinks import write_parquet
    from tests.conftest import SF001
    bronze = medallion(spark, SF001, "t").bronze
    for t in ("users", "watch_events", "subscriptions"):
        write_parquet(bronze[t], f"{tmp_dir}/bronze/{t}")
    args = (spark, f"{tmp_dir}/bronze", f"{tmp_dir}/dq")
    first = quality_job.run(*args, "2026-01-02 03:04:05")
    quality_job.run(*args, "2026-01-02 03:04:05")            # rerun of the same run
    rep = spark.read.parquet(f"{tmp_dir}/dq/reports")
    q = spark.read.parquet(f"{tmp_dir}/dq/failed_records/users")
    assert rep.count() == 11 and q.count() == first["quarantined_rows"]["users"]
    quality_job.run(*args, "2026-01-02 09:00:00")            # a later run the same day
    rep = spark.read.parquet(f"{tmp_dir}/dq/reports")
    assert rep.count() == 22 and rep.select("run_date").distinct().count() == 1
