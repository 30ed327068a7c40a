"""Counters, histograms, quantiles, rates, backlogs and alerts over logs of actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper bounds of the delay histogram, in seconds.
BOUNDS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 300.0, 600.0, 1800.0)
INF = float("inf")


def action_counts(log: DataFrame, *by: str) -> DataFrame:
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def delay_histogram(log: DataFrame, delay: Column, *by: str) -> DataFrame:
    """Cumulative counts per bound, the last without limit. Negative delays count as 0, null ones not.
    One pass: a sum per bound, then one row per bound."""
    d = F.greatest(delay, F.lit(0.0))
    sums = [F.sum(F.when(d <= b, 1).otherwise(0)).cast("bigint").alias(f"_{i}") for i, b in enumerate((*BOUNDS, INF))]
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"_{i}").alias("n")) for i, b in enumerate((*BOUNDS, INF))])).alias("_b")
    return log.where(delay.isNotNull()).groupBy(*by).agg(*sums).select(*by, rows).select(*by, "_b.le", "_b.n")


def histogram_quantile(hist: DataFrame, q: float, *by: str) -> DataFrame:
    """Linear interpolation within the bucket that holds the quantile; in the last bucket the
    greatest finite bound; null over nothing."""
    w = Window.partitionBy(*by).orderBy("le")
    h = hist.withColumns({"_lo": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "_below": F.coalesce(F.lag("n").over(w), F.lit(0)), "_all": F.max("n").over(Window.partitionBy(*by))})
    goal = F.col("_all") * q
    at = h.where((F.col("n") >= goal) & (F.col("_all") > 0)).groupBy(*by).agg(F.min_by(F.struct("le", "n", "_lo", "_below", "_all"), "le").alias("_b")).select(*by, "_b.*")
    inside = F.col("_lo") + (F.col("le") - F.col("_lo")) * (goal - F.col("_below")) / (F.col("n") - F.col("_below"))
    value = F.when(F.col("le") == INF, F.col("_lo")).when(F.col("n") == F.col("_below"), F.col("le")).otherwise(inside)
    return at.select(*by, value.alias("quantile"))


def rates(log: DataFrame, at: str, *by: str, minutes: int = 5) -> DataFrame:
    """Events a second in windows of some minutes."""
    w = F.window(F.col(at).cast("timestamp"), f"{minutes} minutes")
    n = log.groupBy(w.alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *by, (F.col("n") / (60.0 * minutes)).alias("rate"))


def ledger(log: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """(topic, partition, last_offset): never less than what is stored."""
    rows = log.select("topic", "partition", F.col("offset").alias("last_offset"))
    if stored is not None:
        rows = rows.unionByName(stored.select("topic", "partition", "last_offset"))
    return rows.groupBy("topic", "partition").agg(F.max("last_offset").alias("last_offset"))


def backlog(ends: DataFrame, committed: DataFrame, *by: str) -> DataFrame:
    """Messages not yet handled: ends (by, end) less committed (by, last), 0 if none is; by the partition if nothing is given."""
    j = ends.join(committed, list(by or ["partition"]), "left")
    return j.agg(F.sum(F.col("end") - F.coalesce("last", F.lit(0))).cast("bigint").alias("backlog"))


def lag_bytes(current: Column, confirmed: Column) -> Column:
    return F.coalesce(current - confirmed, F.lit(0))


def gauges_at_end(log: DataFrame, at: str, bad: Column, minutes: int = 10, slot_minutes: int = 1440, alive_minutes: int = 1440) -> DataFrame:
    """One row of what is true at the end of a log: dead letters a second in the last ``minutes``, whether every
    topic has had a message in the last ``slot_minutes`` (1 or 0), and how many topics in the last ``alive_minutes``."""
    end = log.agg(F.max(at).alias("_end")).withColumn("_k", F.lit(1))
    ago = lambda m: F.col("_end") - F.make_dt_interval(mins=F.lit(m))
    per = log.groupBy("topic").agg(F.max(at).alias("_last"), F.lit(1).alias("_k")).join(end, "_k")  # a row per topic
    slots = per.agg(F.min((F.col("_last") > ago(slot_minutes)).cast("int")).alias("slot_active"), F.sum((F.col("_last") > ago(alive_minutes)).cast("int")).cast("int").alias("up"))
    lately = log.where(bad).withColumn("_k", F.lit(1)).join(F.broadcast(end), "_k").where(F.col(at) > ago(minutes))  # one row
    rate = lately.agg((F.count(F.lit(1)) / (60.0 * minutes)).alias("dead_letter_rate"))
    return rate.join(slots, F.lit(True))


#: When a gauge calls for attention.
ALERTS = (
    ("delay_p99", "delay_p99 > 60"),
    ("dead_letter_rate", "dead_letter_rate > 0"),
    ("dead_letter_backlog", "dead_letter_backlog > 100"),
    ("slot_inactive", "slot_active = 0"),
    ("slot_lag", "slot_lag_bytes > 268435456"),
    ("worker_down", "up = 0"),
)


def alerts(gauges: DataFrame) -> DataFrame:
    """(alert, firing) from one row of gauges; a missing gauge fires nothing."""
    rows = [F.struct(F.lit(n).alias("alert"), F.coalesce(F.expr(e), F.lit(False)).alias("firing")) for n, e in ALERTS]
    return gauges.select(F.explode(F.array(*rows)).alias("_a")).select("_a.*")
