"""Small tables with the awkward cases every operator must take."""
import random

import duckdb

from tools.check_oracle import canon

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def documents(spark, rows, extra=False):
    """Documents of (doc_id, text, source); ``extra`` adds columns whose names operators use inside."""
    data = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(data, DOCS)
    if extra:
        for c in ("id", "row", "key", "n", "words", "run", "runs", "size", "token", "node", "kept"):
            df = df.withColumn(c, df["doc_id"] * 0)
    return df


def awkward(seed=1):
    """Copies, near copies, shared passages, null and blank texts, a null id, unicode, a long text."""
    rng = random.Random(seed)
    base = sentence(rng, 120, 5000)
    passage = sentence(rng, 40, 5000)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base, "a"), (2, base, "b"), (3, " ".join(near), "a"), (4, None, "a"), (5, "", "b"), (6, " \n\t ", None),
            (7, sentence(rng, 30, 5000) + "\n" + passage + " " + sentence(rng, 30, 5000), "b"),
            (8, passage, "c"), (9, sentence(rng, 15) + " " + passage, None), (10, "one two three", "c"),
            (11, "ONE two THREE", "c"), (12, "Été à l’école — «naïve» 数据 test x", "a"),
            (13, sentence(rng, 5000, 20000), "a"), (14, "For " * 300, "b"), (15, base.upper(), "c")]
    rows += [(20 + k, sentence(rng, 60, 3000), "abc"[k % 3]) for k in range(20)]
    return rows


def same(df, sql, **tables):
    """Whether a result equals DuckDB's for ``sql`` over the given (Spark) tables."""
    con = duckdb.connect()
    for name, t in tables.items():
        arrow = t.toArrow()  # noqa: F841  (DuckDB reads it by name)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM arrow")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    got = [tuple(r) for r in df.select(*cols).collect()]
    want = res.fetchall()
    assert canon(cols, got) == canon(cols, want)
    return got
