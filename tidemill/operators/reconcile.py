"""Source against index, by key sets or by counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = ["tenant_id", "source_table"]


def exact(source: DataFrame, indexed: DataFrame) -> DataFrame:
    """Per tenant and table: source rows, indexed keys, missing, orphan and their sum. Keys are
    counted once; tagged keys are united and grouped, so neither side is joined."""
    tag = lambda d, n: d.select(*GROUP, F.col("source_pk").cast("string").alias("source_pk"), F.lit(n).alias("_side"))
    both = tag(source, 1).unionByName(tag(indexed, 2)).groupBy(*GROUP, "source_pk").agg(F.bit_or("_side").alias("_s"))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    s = F.col("_s")
    return both.groupBy(*GROUP).agg(
        n(s != 2).alias("source_rows"), n(s != 1).alias("indexed_pks"), n(s == 1).alias("missing"), n(s == 2).alias("orphan"), n(s != 3).alias("drift")
    )


def approximate(source: DataFrame, indexed: DataFrame) -> DataFrame:
    """The same from counts alone: what one side has more than the other."""
    a = source.groupBy(*GROUP).agg(F.count_distinct("source_pk").alias("source_rows"))
    b = indexed.groupBy(*GROUP).agg(F.count_distinct("source_pk").alias("indexed_pks"))
    j = a.join(b, GROUP, "full_outer").na.fill(0, ["source_rows", "indexed_pks"])
    d = F.col("source_rows") - F.col("indexed_pks")
    return j.withColumns({"missing": F.greatest(d, F.lit(0)), "orphan": F.greatest(-d, F.lit(0))}).withColumn("drift", F.col("missing") + F.col("orphan"))


def preflight(source: DataFrame, indexed: DataFrame) -> DataFrame:
    """(check, ok): what must hold before a report means anything. One pass over either side's keys."""
    n = lambda d: d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source_pk").isNull() | F.col("tenant_id").isNull()).alias("no_key"))
    s, i = n(source).select(F.col("n").alias("s"), F.col("no_key").alias("sk")), n(indexed).select(F.col("n").alias("i"), F.col("no_key").alias("ik"))
    tables = lambda d, c: d.agg(F.array_sort(F.collect_set("source_table")).alias(c))  # noqa: E731  # a handful of names
    one = lambda d: d.withColumn("_k", F.lit(1))
    g = one(s).join(one(i), "_k").join(one(tables(source, "st")), "_k").join(one(tables(indexed, "it")), "_k")
    checks = (("source has rows", F.col("s") > 0), ("index has rows", F.col("i") > 0), ("source keys are whole", F.col("sk") == 0), ("index keys are whole", F.col("ik") == 0), ("index tables are known", F.size(F.array_except("it", "st")) == 0))
    return g.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), ok.alias("ok")) for c, ok in checks])).alias("_c")).select("_c.*")


def totals(report: DataFrame) -> DataFrame:
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return report.agg(*[s(c).alias(c) for c in ("source_rows", "indexed_pks", "missing", "orphan", "drift")]).withColumn("in_sync", F.col("drift") == 0)
