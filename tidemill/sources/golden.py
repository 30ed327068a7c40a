"""Labelled queries in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "query string, tenant_id string, expected_pks array<struct<source_table: string, source_pk: string>>"


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query, tenant_id, expected_pks). Blank lines are skipped; a line that is no such
    object, or a file without any, is an error that names the line. query_id is the line's number.

    A labelled set is small: it is read whole, in one partition, so that lines can be numbered."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("_n", "line"))
    q = lines.where(F.trim("line") != "").select((F.col("_n") + 1).alias("query_id"), F.from_json("line", SCHEMA).alias("_q"))
    bad = q.where("_q.query IS NULL OR _q.expected_pks IS NULL").orderBy("query_id").limit(1).collect()
    if bad:
        raise ValueError(f"{path}, line {bad[0].query_id}: no labelled query")
    if not q.limit(1).collect():
        raise ValueError(f"{path}: no labelled queries")
    return q.select("query_id", "_q.query", F.coalesce("_q.tenant_id", F.lit("default")).alias("tenant_id"), "_q.expected_pks")
