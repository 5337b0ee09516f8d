"""Session helpers: shared folder from the cluster setting, scratch folders, concurrency."""
from reelhouse.session import new_scratch, run_concurrently, shared_dir


def test_shared_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = shared_dir(spark)
    assert configured and root.rstrip("/").endswith(configured.rstrip("/").split(":")[-1].rstrip("/"))


def test_scratch_folders_are_fresh(spark):
    a, b = new_scratch(spark, "t"), new_scratch(spark, "t")
    assert a != b and a.startswith(shared_dir(spark))


def test_run_concurrently_returns_every_result(spark):
    jobs = {f"j{i}": (lambda i=i: spark.range(1000 * (i + 1)).count()) for i in range(4)}
    assert run_concurrently(jobs) == {"j0": 1000, "j1": 2000, "j2": 3000, "j3": 4000}
    assert run_concurrently({"one": lambda: 7}) == {"one": 7}
