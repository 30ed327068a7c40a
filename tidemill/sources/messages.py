"""Change messages as rows (topic, partition, offset, key, value), from files or from Kafka."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, key binary, value binary"


def topic_pattern(tables: list[str]) -> str:
    """Topics of the tables, as a pattern for subscription."""
    return r"cdc\.public\.(" + "|".join(re.escape(t) for t in tables) + ")"


def kafka_options(servers: str, tables: list[str], per_trigger: int | None = None, fail_on_loss: bool = True) -> dict[str, str]:
    o = {"kafka.bootstrap.servers": servers, "subscribePattern": topic_pattern(tables), "startingOffsets": "earliest", "failOnDataLoss": str(fail_on_loss).lower()}
    return o | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def read_stream(spark: SparkSession, source: dict) -> DataFrame:
    """source: {"path": folder, "files_per_batch": n} or {"kafka": options}."""
    if "kafka" in source:
        return spark.readStream.format("kafka").options(**source["kafka"]).load().select("topic", "partition", "offset", "key", "value")
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if source.get("files_per_batch"):
        r = r.option("maxFilesPerTrigger", source["files_per_batch"])
    return r.parquet(source["path"])


def read_batch(spark: SparkSession, source: dict, ends: dict[str, dict[int, int]] | None = None) -> DataFrame:
    """Everything there is now; with ends (topic -> partition -> offset) only messages before them."""
    if "kafka" in source:
        o = dict(source["kafka"]) | ({"endingOffsets": json.dumps(ends)} if ends else {"endingOffsets": "latest"})
        return spark.read.format("kafka").options(**o).load().select("topic", "partition", "offset", "key", "value")
    df = spark.read.schema(MESSAGE_SCHEMA).parquet(source["path"])
    if ends:
        rows = [(t, p, e) for t, ps in ends.items() for p, e in ps.items()]  # one per topic and partition
        df = df.join(F.broadcast(spark.createDataFrame(rows, "topic string, partition int, _end bigint")), ["topic", "partition"]).where("offset < _end").drop("_end")
    return df
