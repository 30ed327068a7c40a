"""Differences between two copies of a data set, cell by cell.

Both sides are unpivoted to (key, field, value) rows with a sign, one group per cell
finds the cells that do not cancel, and one group per key turns them into findings.
Both groups combine on the map side, so a key with a third of all rows costs one
partial row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRESENCE = ""
MISSING, ORPHAN = "missing", "orphan"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns.

    Null order values are oldest; rows that tie take the greatest ``keep`` values, so the
    choice does not depend on arrival. Null keys form a group of their own."""
    best = F.max(F.struct(*order, *[F.col(c) for c in keep if c not in order])).alias("_best")
    wide = df.groupBy(*keys).agg(best)
    return wide.select(*keys, *[F.col("_best")[c].alias(c) for c in keep])


def _cells(df: DataFrame, keys: Sequence[str], fields: Sequence[str], side: int) -> DataFrame:
    cell = lambda name, value: F.struct(F.lit(name).alias("field_name"), value.cast("string").alias("value"))
    cells = F.explode(F.array(cell(PRESENCE, F.lit(None)), *[cell(f, F.col(f)) for f in fields]))
    return (
        df.select(*keys, cells.alias("_cell"))
        .select(*keys, "_cell.field_name", "_cell.value", F.lit(side).alias("_side"))
    )


def diff_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field_name) for every difference between ``left`` and ``right``.

    field_name is ``missing`` for a key only on the left, ``orphan`` for one only on the
    right, else the name of a field of which some row of the key has another value than the
    other side. Null equals null and differs from every value, keys included; values are
    compared as strings, exactly. Repeated rows count once. An empty side makes every key of
    the other one missing or orphan. Fields beyond ``keys`` and ``fields`` are not read.
    Names beginning with an underscore are reserved for the operator."""
    if PRESENCE in fields or set(keys) & set(fields):
        raise ValueError("fields need names of their own")
    both = _cells(left, keys, fields, 1).unionByName(_cells(right, keys, fields, -1))
    has = lambda side: F.max(F.when(F.col("_side") == side, 1).otherwise(0))
    net: Column = has(1) - has(-1)
    open_cells = both.groupBy(*keys, "field_name", "value").agg(net.alias("_net")).where("_net <> 0")
    # what is left is small: keys and cells that did not cancel
    per_key = open_cells.groupBy(*keys).agg(
        F.max(F.when(F.col("field_name") == PRESENCE, F.col("_net"))).alias("_presence"),
        F.collect_set(F.when(F.col("field_name") != PRESENCE, F.col("field_name"))).alias("_fields"),
    )
    found = (
        F.when(F.col("_presence") == 1, F.array(F.lit(MISSING)))
        .when(F.col("_presence") == -1, F.array(F.lit(ORPHAN)))
        .otherwise(F.col("_fields"))
    )
    return per_key.select(*keys, F.explode(found).alias("field_name"))


def drift_counts(found: DataFrame, groups: Sequence[str]) -> DataFrame:
    """missing and orphan keys per group, from the rows of ``diff_cells``."""
    n = lambda what: F.sum(F.when(F.col("field_name") == what, 1).otherwise(0)).cast("bigint")
    return found.groupBy(*groups).agg(n(MISSING).alias("missing"), n(ORPHAN).alias("orphan"))
