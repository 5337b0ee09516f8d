"""Recommendations: structure, ordering, lookups with defaults."""
from reelhouse.operators import recommend as rec


def test_top5_per_user(spark):
    users = spark.createDataFrame([(1, "Karnataka", 22), (2, "Goa", None), (3, "Delhi", 50)],
                                  "user_id long, region string, age int")
    rows = rec.recommend(users).collect()
    by = {}
    for r in rows:
        by.setdefault(r["user_id"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 5, 2: 5, 3: 5}
    for uid, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        scores = [r["match_score"] for r in rs]
        assert scores == sorted(scores, reverse=True)
        assert all(0.75 <= s <= 0.99 for s in scores)
        group = rs[0]["age_group"]
        genres = rec.AGE_PREFERENCES[group][:3]
        for r in rs:
            assert r["genre"] in genres
            assert r["title"] in rec.CONTENT_BY_GENRE[r["genre"]][:2]
            langs = rec.REGION_LANGUAGES.get(r["region"], rec.REGION_LANGUAGES["default"])
            assert r["language"] in langs
            assert r["content_id"].startswith("CNT") and len(r["content_id"]) == 7
    assert by[1][0]["age_group"] == "18-24"
    assert by[2][0]["age_group"] == "25-34"     # missing age -> request default 25
    assert by[3][0]["age_group"] == "45+"


def test_limit(spark):
    users = spark.createDataFrame([(7, "Kerala", 30)], "user_id long, region string, age int")
    assert rec.recommend(users, limit=2).count() == 2
    assert rec.recommend(users, limit=10).count() == 6    # only 3 genres x 2 titles exist


def test_catalog_stats(spark):
    content = spark.createDataFrame([(1, "Drama"), (2, "Comedy"), (3, "Drama")],
                                    "content_id long, genre string")
    users = spark.createDataFrame([("Delhi",), ("Goa",), ("Delhi",)], "region string")
    got = sorted(map(tuple, rec.catalog_stats(content, users).collect()))
    assert got == [("genre", "Comedy", 1), ("genre", "Drama", 2), ("region", "Delhi", 2), ("region", "Goa", 1)]


def test_any_id_and_requests_without_a_user(spark):
    users = spark.createDataFrame([("6f1c1a52-2a4e-4a86-9a53-1f0f8c6d7e01", "Delhi", 20), ("x", "Goa", 50), (None, None, None),
                                   ("9" * 30, "Kerala", 40)], "user_id string, region string, age int")
    assert rec.recommend(users).count() == 20
    asked = rec.recommend_for(spark, "Kerala", 22, limit=3).collect()
    assert [r["rank"] for r in asked] == [1, 2, 3] and {r["age_group"] for r in asked} == {"18-24"}
    assert rec.recommend_for(spark).count() == 5
