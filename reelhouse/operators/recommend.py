"""Per-user title recommendations and catalog statistics.

Each user row is one request (region, age; a missing age means 25).  The
candidate set is fixed-size per user -- the first three preferred genres of
the user's age band times the first two titles of each genre -- so the whole
operator is a narrow per-row plan: map lookups (with the ``default`` region
fallback), ``transform``/``flatten`` to expand candidates, ``array_sort`` +
``slice`` for the top-N, ``posexplode`` for rows.  No join, no shuffle, and
the lookup tables are literals of known, fixed size compiled into the plan.

The reference draws match scores, languages and content ids at random.  Here
they are deterministic functions of (user, genre position, title position):
a score in [0.75, 0.99] at two decimals, a language from the region's list,
and an id ``CNT0001``..``CNT1000``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import age_group

# -- fixed values: the recommender's lookup tables ------------------------------
CONTENT_BY_GENRE = {
    "Action": ["Movie_Title_1", "Movie_Title_45", "Show_Title_78"],
    "Comedy": ["Movie_Title_12", "Show_Title_34", "Movie_Title_67"],
    "Drama": ["Show_Title_5", "Movie_Title_23", "Show_Title_89"],
    "Thriller": ["Movie_Title_8", "Show_Title_15", "Movie_Title_92"],
    "Romance": ["Show_Title_21", "Movie_Title_56", "Show_Title_43"],
    "Documentary": ["Movie_Title_33", "Show_Title_61", "Movie_Title_17"],
    "Sci-Fi": ["Movie_Title_72", "Show_Title_28", "Movie_Title_41"],
    "Horror": ["Movie_Title_19", "Show_Title_53", "Movie_Title_86"],
}
AGE_PREFERENCES = {
    "18-24": ["Action", "Sci-Fi", "Horror", "Comedy"],
    "25-34": ["Thriller", "Drama", "Action", "Comedy"],
    "35-44": ["Drama", "Documentary", "Romance", "Thriller"],
    "45+": ["Documentary", "Drama", "Romance", "Comedy"],
}
FALLBACK_GENRES = ["Action", "Drama"]
REGION_LANGUAGES = {
    "Karnataka": ["Kannada", "Hindi", "English"],
    "Tamil Nadu": ["Tamil", "Hindi", "English"],
    "Maharashtra": ["Marathi", "Hindi", "English"],
    "Delhi": ["Hindi", "English"],
    "Kerala": ["Malayalam", "Hindi", "English"],
    "Telangana": ["Telugu", "Hindi", "English"],
    "default": ["Hindi", "English"],
}
DEFAULT_AGE = 25
DEFAULT_LIMIT = 5
GENRES_PER_USER = 3
TITLES_PER_GENRE = 2


def _literal_map(d: dict[str, list[str]]) -> Column:
    """A MAP<STRING, ARRAY<STRING>> literal (bounded, compiled into the plan)."""
    kv = []
    for k, vs in d.items():
        kv += [F.lit(k), F.array(*[F.lit(v) for v in vs])]
    return F.create_map(*kv)


def user_number(user_id: Column) -> Column:
    """A number for any id: its last nine digits, 0 without digits or without an id."""
    digits = F.right(F.regexp_replace(user_id.cast("string"), "[^0-9]", ""), F.lit(9))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def candidates(number: Column, region: Column, group: Column) -> Column:
    """ARRAY<STRUCT> of the 6 candidates, fields ordered for sorting:
    (neg_points, genre_pos, title_pos, ...)."""
    genres = F.coalesce(F.element_at(_literal_map(AGE_PREFERENCES), group),
                        F.array(*[F.lit(g) for g in FALLBACK_GENRES]))
    lang_map = _literal_map(REGION_LANGUAGES)
    langs = F.coalesce(F.element_at(lang_map, region), F.element_at(lang_map, F.lit("default")))
    titles = _literal_map(CONTENT_BY_GENRE)

    def per_title(genre, gi):
        def build(title, ti):
            points = F.lit(75) + F.pmod(number * 7 + gi * 13 + ti * 5, F.lit(25))
            return F.struct(
                (-points).alias("neg_points"),
                gi.alias("genre_pos"),
                ti.alias("title_pos"),
                F.format_string("CNT%04d", F.lit(1) + F.pmod(number * 31 + gi * 7 + ti, F.lit(1000)))
                .alias("content_id"),
                title.alias("title"),
                genre.alias("genre"),
                F.element_at(langs, F.lit(1) + F.pmod(number + gi + ti, F.size(langs)).cast("int"))
                .alias("language"),
                (points / F.lit(100.0)).alias("match_score"),
            )
        return F.transform(F.slice(F.coalesce(F.element_at(titles, genre), F.array().cast("array<string>")),
                                   1, TITLES_PER_GENRE), build)

    return F.flatten(F.transform(F.slice(genres, 1, GENRES_PER_USER), per_title))


def recommend(users: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Top-``limit`` titles per user, one row per (user, rank)."""
    group = age_group(F.coalesce(F.col("age"), F.lit(DEFAULT_AGE)))
    cands = candidates(user_number(F.col("user_id")), F.col("region"), group)
    top = F.slice(F.array_sort(cands), 1, limit)
    return users.select(
        "user_id", "region", "age", group.alias("age_group"),
        F.posexplode(top).alias("pos", "c"),
    ).select(
        "user_id", "region", "age", "age_group",
        (F.col("pos") + 1).alias("rank"),
        "c.content_id", "c.title", "c.genre", "c.language", "c.match_score",
    )


def recommend_for(spark: SparkSession, region: str | None = None, age: int | None = None,
                  limit: int = DEFAULT_LIMIT) -> DataFrame:
    """One request that names a region, an age and a limit, and no user."""
    request = spark.range(1).select(F.lit(None).cast("string").alias("user_id"), F.lit(region).cast("string").alias("region"),
                                    F.lit(age).cast("int").alias("age"))
    return recommend(request, limit)


def catalog_stats(content: DataFrame, users: DataFrame) -> DataFrame:
    """Catalog size and vocabularies, one row for each value: (kind, value, n) with the
    titles of each genre and the users of each region.  Genres and regions are counted
    map-side first and stay rows, whatever their number."""
    genres = content.groupBy(F.col("genre").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("genre").alias("kind"), "value", "n")
    regions = users.groupBy(F.col("region").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("region").alias("kind"), "value", "n")
    return genres.unionByName(regions)
