"""Structured Streaming wiring for the event path.

    readStream (messages, each with its position in the source)
      -> foreachBatch: parse envelopes -> extract fields
                       repeated deliveries removed             [at-least-once input]
                       processor records -> keyed store (a folder of this attempt)
                       parse failures   -> dead letters (batch_id=<n>, overwrite)
                       commit           -> the store's log; the batch counts from here

The per-row rules are the same transforms the batch form uses, so a replay of
a feed through the stream gives the same store as one batch run.  A batch
replayed from the checkpoint is skipped if the log has it, and otherwise replaces
what it wrote.

No event is lost for its time: nothing here has a watermark, so late, undated
and future-dated events are stored like any other.  An event is known by its id, or
by where its message stands in the source: topic, partition and offset of a queue,
else file and row.  So equal messages without an id are events of their own, and
the store does not depend on how messages were batched.  Repeated deliveries are
removed by that key in the sink: within a batch by an aggregate that combines copies
in each map task, across batches by the store (readers collapse them), or
before the write by an anti-join with the store's id index (``dedupe="sink"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import store
from ..operators.dedupe import dedupe_by_key


POSITION = "concat_ws('/', topic, partition, offset)"


def located(messages: DataFrame) -> DataFrame:
    """Adds ``position`` from topic, partition and offset where the messages have them.  Lines of
    text files (``message_stream``) get their file and number in it, however the file was split."""
    if "position" in messages.columns:
        return messages
    if {"topic", "partition", "offset"} <= set(messages.columns):
        queue = F.when(F.col("offset").isNotNull(), F.expr(POSITION))
        row = F.concat_ws("/", "_file", "_row") if "_row" in messages.columns else F.lit(None).cast("string")
        return messages.withColumn("position", F.coalesce(queue, row)).drop("_file", "_row")
    if "_block" not in messages.columns:
        return messages
    # the lines of a block are neighbours in one task, so their places there count them
    lines = messages.withColumn("_at", F.monotonically_increasing_id())
    blocks = lines.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_lines"))
    before = F.sum("_lines").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_lines")
    return lines.join(blocks, ["_file", "_block"]).select(
        "value", "arrived_at", F.concat_ws("/", "_file", F.col("_before") + F.col("_at") - F.col("_first")).alias("position"))


def parsed_events(messages: DataFrame) -> DataFrame:
    return ev.extract_fields(ev.parse_envelopes(located(messages)))


def _dedupe_key():
    """Event id (or source position); without either a digest of the message and its arrival."""
    return F.coalesce(F.col("event_id"),
                      F.sha2(F.concat_ws("\u0001", F.to_json("p"), F.col("raw"), F.col("arrived_at").cast("string")), 256))


def first_deliveries(batch: DataFrame) -> DataFrame:
    """One row for each event of a batch; copies are combined in each map task."""
    return dedupe_by_key(batch.withColumn("_dedupe_key", _dedupe_key()), "_dedupe_key", ["arrived_at"]).drop("_dedupe_key")


def not_stored(spark: SparkSession, batch: DataFrame, store_dir: str) -> DataFrame:
    """The events of a batch the store never had.  Of the id index only the buckets the batch's own
    ids fall in are read (``store.ID_BUCKETS`` numbers at most come to the driver)."""
    buckets = [r.b for r in batch.where("event_id is not null").select(store.id_bucket(F.col("event_id")).alias("b")).distinct().collect()]
    seen = store.stored_ids(spark, store_dir, sorted(buckets)).withColumnRenamed("request_id", "_seen")
    return batch.join(seen, F.col("event_id") == F.col("_seen"), "left_anti")


# A landed message file: what a queue delivers.  A file without the queue's columns has rows
# known by file and row.
MESSAGE = "value STRING, arrived_at TIMESTAMP_NTZ, topic STRING, partition INT, offset BIGINT"


def message_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """File source of messages: Parquet files (``MESSAGE``), or text files with one message
    a line, which arrive when their file was written.  In production this is a Kafka
    source (``kafka_messages``); same downstream plan."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        lines = reader.schema("value STRING").text(source_dir)
        return lines.select("value", F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("arrived_at"),
                            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    rows = reader.schema(MESSAGE).parquet(source_dir)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


class ConnectorMissing(RuntimeError):
    pass


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None
                   ) -> DataFrame:
    """Production source: one message per Kafka record value, arrived at the record's
    timestamp.  Needs the ``spark-sql-kafka`` connector on the classpath (``--packages``)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    try:
        stream = reader.load()
    except Exception as e:  # the connector is a separate package
        if "kafka" in str(e).lower():
            raise ConnectorMissing(
                "Kafka source unavailable: add the spark-sql-kafka connector to the "
                "session (spark.jars.packages) or use a file source") from e
        raise
    return from_kafka(stream)


def from_kafka(records: DataFrame) -> DataFrame:
    """Messages of the connector's rows (key, value, topic, partition, offset, timestamp, timestampType)."""
    return records.selectExpr("CAST(value AS STRING) AS value", "CAST(timestamp AS TIMESTAMP_NTZ) AS arrived_at",
                              "topic", "partition", "offset")


def run_engagement_stream(spark: SparkSession, source_dir: str, store_dir: str,
                          dead_letter_dir: str, checkpoint_dir: str, dedupe: str = "batch",
                          max_files_per_trigger: int | None = None,
                          available_now: bool = True, timeout_s: float | None = None,
                          routed_dir: str | None = None, messages: DataFrame | None = None,
                          fmt: str = "parquet"):
    """Start the stream; with ``available_now`` run to the end of the input.

    ``dedupe``: ``"batch"`` (default) removes repeats inside a micro-batch;
    repeats across batches are collapsed by the store's readers.  ``"sink"``
    also leaves out events the store already holds, so the store has one row
    for each event id.  ``"none"`` relies on the readers alone.

    ``messages`` replaces the file source (e.g. ``kafka_messages(...)``).
    With ``routed_dir`` each batch also runs validate -> score -> route and
    writes ``routed/`` (partitioned by action) and ``rejected/`` (validation
    and processing errors) under ``run=<r>/batch_id=<n>``.
    """
    if dedupe not in ("batch", "sink", "none"):
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    if messages is None:
        messages = message_stream(spark, source_dir, fmt, max_files_per_trigger)
    run = store.run_id(checkpoint_dir)

    def sink(arrived: DataFrame, batch_id: int) -> None:
        spark = arrived.sparkSession
        if store.is_committed(spark, store_dir, batch_id, run):
            return                      # replayed after its commit: all it writes is there
        batch = parsed_events(arrived)
        if dedupe != "none":
            batch = first_deliveries(batch)
        # A batch is cached only where it is read again anyway; else a second pass makes dead letters.
        kept = batch.persist() if dedupe == "sink" or routed_dir else batch
        try:
            if dedupe == "sink":
                batch = not_stored(spark, batch, store_dir)
            # Parse failures are counted while the store batch is written; the (rare)
            # dead-letter write then reads the batch again only if needed.
            obs = Observation()
            observed = batch.observe(obs, F.count_if(F.col("parse_error").isNotNull()).alias("bad"))
            written = store.write_batch(ev.process_events(observed), store_dir, batch_id, run, index=dedupe == "sink")
            bad = obs.get["bad"]
            if bad:
                ev.processor_errors(batch).write.mode("overwrite") \
                    .parquet(f"{dead_letter_dir}/run={run}/batch_id={batch_id}")
            if routed_dir:
                routed, rejected = ev.state_machine(batch)
                routed.write.mode("overwrite").partitionBy("action") \
                    .parquet(f"{routed_dir}/routed/run={run}/batch_id={batch_id}")
                rejected.write.mode("overwrite") \
                    .parquet(f"{routed_dir}/rejected/run={run}/batch_id={batch_id}")
            store.commit_batch(spark, store_dir, batch_id, run, written, bad)
        finally:
            kept.unpersist()

    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination(timeout_s)
    return query
