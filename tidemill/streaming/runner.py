"""The change stream, from files or Kafka, into lake tables and the feed's state: one code path
for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import change_feed, dead_letters, envelope, retry
from tidemill.operators.lake import LakeTable
from tidemill.sources.messages import read_stream

FEED_SCHEMA = "topic string, part_no int, log_offset bigint, msg_key string, op string, lsn bigint, ts_ms bigint, before string, after string, received_at timestamp_ntz"


def run_lake(
    spark: SparkSession, source: dict, tables: dict[str, LakeTable], checkpoint: str, available_now: bool = True, seconds: int = 10, name: str = "lake",
    quarantine: str | None = None, dlq_topic: str = "dlq", wait: float = 1.0,
):
    """Start a stream of change messages into lake tables.

    Each micro-batch is kept while the tables take their share of it. A batch that is done again
    after a failure has the number the tables already hold and is not applied twice. With a quarantine folder, what
    a table refuses again and again is written there as dead letters of that table's messages, under the batch's number, and the
    stream goes on; what may work later is tried until it does. Without one the stream stops at the first failure."""

    def take(t: LakeTable, batch: DataFrame, number: int) -> None:
        if quarantine is None:
            t.apply(batch, number)
            return

        def set_aside(e: Exception) -> None:
            letters = dead_letters.to_quarantine(envelope.of_table(batch, t.table), F.lit(str(e)), dlq_topic)
            letters.write.mode("overwrite").parquet(f"{quarantine}/{t.table}-{number:012d}")

        retry.run(lambda: t.apply(batch, number), set_aside, base=wait)

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for t in tables.values():
                take(t, batch, number)
        finally:
            batch.unpersist()

    w = read_stream(spark, source).writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{seconds} seconds")).start()


def run_feed(spark: SparkSession, path: str, store: change_feed.BucketedState, fields: Sequence[str], checkpoint: str, files_per_batch: int = 1):
    """The same for the parsed feed's files and the bucketed state."""
    raw = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)

    def each(batch: DataFrame, number: int) -> None:
        store.apply(change_feed.parse_messages(batch, fields), number)

    return raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
