"""Messages that could not be handled: quarantine, replay, archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text

MAX_REPLAYS = 5
ERROR_SENT, ERROR_KEPT = 500, 2000


def header(name: str, default: str | None = None) -> Column:
    """A header's value as text; of several the last, the default if there is none."""
    last = F.element_at(F.filter("headers", lambda h: h["key"] == name), -1)
    at = F.when(F.exists(F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>")), lambda h: h["key"] == name), last["value"].cast("string"))
    return F.coalesce(at, F.lit(default)) if default is not None else at


def to_quarantine(messages: DataFrame, error: Column, dlq_topic: str) -> DataFrame:
    """Messages with the headers that say where they came from and what went wrong."""
    h = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
    again = header("replay_count", "0") if "headers" in messages.columns else F.lit("0")
    heads = F.array(
        h("source_topic", F.col("topic")), h("source_partition", F.col("partition")), h("source_offset", F.col("offset")),
        h("error", F.substring(text.redact(error), 1, ERROR_SENT)), h("replay_count", again),
    )
    return messages.select(F.lit(dlq_topic).alias("topic"), "key", "value", heads.alias("headers"))


def split_replay(dlq: DataFrame, ends: DataFrame, max_replays: int = MAX_REPLAYS, limit: int | None = None) -> DataFrame:
    """Dead letters below the ends noted at the start, with fate: replay, archive or skip; with a limit, the first so many
    by partition and offset.

    ends: partition, end. replay sends the message to its source topic with the count raised by
    one; archive keeps it after max_replays; a letter that doesn't name its topic is skipped."""
    d = dlq.join(ends, "partition").where(F.col("offset") < F.col("end")).drop("end")
    d = d.withColumns({"source_topic": header("source_topic"), "error": header("error", ""), "replay_count": F.coalesce(header("replay_count", "0").try_cast("int"), F.lit(0))})
    if limit is not None:
        d = d.orderBy("partition", "offset").limit(limit)
    fate = F.when(F.col("source_topic").isNull(), "skip").when(F.col("replay_count") >= max_replays, "archive").otherwise("replay")
    return d.withColumn("fate", fate)


def replayed(letters: DataFrame) -> DataFrame:
    """Messages for their source topics, the count raised."""
    heads = F.concat(F.filter("headers", lambda h: h["key"] != "replay_count"), F.array(F.struct(F.lit("replay_count").alias("key"), (F.col("replay_count") + 1).cast("string").cast("binary").alias("value"))))
    return letters.where("fate = 'replay'").select(F.col("source_topic").alias("topic"), "key", "value", heads.alias("headers"))


def archived(letters: DataFrame) -> DataFrame:
    return letters.where("fate = 'archive'").select(
        "source_topic", F.col("partition").alias("dlq_partition"), F.col("offset").alias("dlq_offset"), "replay_count", F.substring("error", 1, ERROR_KEPT).alias("error"), F.col("value").alias("payload")
    )
