"""Command-line jobs (one per pipeline stage), for ``spark-submit`` or python.

    python -m reelhouse.jobs raw-to-bronze   --raw DIR --out DIR [--json-array] [--merge]
    python -m reelhouse.jobs bronze-to-silver --out DIR
    python -m reelhouse.jobs silver-to-gold  --out DIR
    python -m reelhouse.jobs refresh-gold    --out DIR
    python -m reelhouse.jobs data-quality    --out DIR [--gate]
    python -m reelhouse.jobs reports         --out DIR [--name q01_dau_last30]
    python -m reelhouse.jobs stream          --source DIR --out DIR [--continuous]
                                             [--kafka-bootstrap HOST:PORT --kafka-topic T]
    python -m reelhouse.jobs compact         --out DIR
    python -m reelhouse.jobs recommend       --out DIR [--limit 5]

``--out`` is the lake root holding ``bronze/ silver/ state/ gold/ dq/ engagement/``.
The master, executor sizing and partition counts come from spark-submit.
"""

from __future__ import annotations

import argparse
import json

from .plans import bronze, gold, gold_state, quality_job, silver, sql_pack
from .plans.pipeline import now_text
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="reelhouse.jobs")
    ap.add_argument("job", choices=["raw-to-bronze", "bronze-to-silver", "silver-to-gold",
                                    "refresh-gold", "data-quality", "reports", "stream", "compact", "recommend"])
    ap.add_argument("--raw")
    ap.add_argument("--source")
    ap.add_argument("--out", required=True)
    ap.add_argument("--name")
    ap.add_argument("--gate", action="store_true")
    ap.add_argument("--continuous", action="store_true")
    ap.add_argument("--limit", type=int, default=5)
    ap.add_argument("--dedupe", choices=["batch", "sink", "none"], default="batch")
    ap.add_argument("--source-format", choices=["parquet", "text"], default="parquet")
    ap.add_argument("--json-array", action="store_true", help="raw JSON files are arrays, not lines")
    ap.add_argument("--merge", action="store_true", help="the raw events are an increment: upsert them by id")
    ap.add_argument("--run-time", help="logical run time 'yyyy-MM-dd HH:mm:ss' (default: now)")
    ap.add_argument("--kafka-bootstrap")
    ap.add_argument("--kafka-topic")
    a = ap.parse_args(argv)

    spark = build_session(app_name=f"reelhouse-{a.job}")
    out, t = a.out.rstrip("/"), a.run_time or now_text()
    result: object
    if a.job == "raw-to-bronze":
        result = bronze.run(spark, a.raw, f"{out}/bronze", t, json_array=a.json_array, merge=a.merge)
    elif a.job == "bronze-to-silver":
        result = silver.run(spark, f"{out}/bronze", f"{out}/silver", t)
    elif a.job == "silver-to-gold":
        result = gold.run(spark, f"{out}/silver", f"{out}/bronze", f"{out}/gold", t)
    elif a.job == "refresh-gold":
        result = gold_state.run(spark, f"{out}/bronze", f"{out}/state", f"{out}/gold", t)
    elif a.job == "data-quality":
        result = quality_job.run(spark, f"{out}/bronze", f"{out}/dq", t, gate=a.gate)
    elif a.job == "reports":
        sql_pack.register_gold_views({n: spark.read.parquet(f"{out}/gold/{n}") for n in
                                      ("dau_metrics", "revenue_summary", "top_content",
                                       "device_analytics")})
        names = [a.name] if a.name else list(sql_pack.SQL)
        for n in names:
            print(f"-- {n}")
            sql_pack.run_sql(spark, n).show(truncate=False)
        result = {"reports": names}
    elif a.job == "stream":
        from .streaming.engagement import kafka_messages, run_engagement_stream
        messages = (kafka_messages(spark, a.kafka_bootstrap, a.kafka_topic)
                    if a.kafka_bootstrap else None)
        q = run_engagement_stream(spark, a.source, f"{out}/engagement/store",
                                  f"{out}/engagement/dead_letters", f"{out}/engagement/checkpoint",
                                  dedupe=a.dedupe, fmt=a.source_format,
                                  available_now=not a.continuous,
                                  routed_dir=f"{out}/engagement/state_machine",
                                  messages=messages)
        if a.continuous:
            q.awaitTermination()
        result = {"stream": "done"}
    elif a.job == "compact":
        from .operators import store
        result = {"snapshot": store.compact(spark, f"{out}/engagement/store",
                                            f"{out}/engagement/snapshot")}
    else:
        from .operators.recommend import recommend
        from .sources.sinks import write_parquet
        users = spark.read.parquet(f"{out}/bronze/users")
        result = {"recommendations": write_parquet(recommend(users, a.limit),
                                                   f"{out}/recommendations")}
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
