"""References that lead nowhere.

Parent and child keys are united in long form with a tag, grouped by parent table and
key, and the groups without a parent's tag are kept. The group is an aggregate with map
side combining, never a window, so a parent key that a third of all children name costs
no more than any other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["parent_table", "tenant_id", "parent_key"]
#: A key with more than this share of the children is joined by a broadcast list, which for
#: that reason holds at most this many keys.
HOT_KEYS = 1024


@dataclass(frozen=True)
class Child:
    """A table with references; each value is a column or SQL expression over ``rows``."""

    name: str
    rows: DataFrame
    parent_table: str
    parent_key: str
    child_key: str
    at: str
    tenant: str = "tenant_id"


def child_rows(children: Sequence[Child]) -> DataFrame:
    """Long form of the references. A null reference refers to nothing and is left out."""
    parts = [
        c.rows.select(
            F.expr(c.parent_table).cast("string").alias("parent_table"),
            F.expr(c.tenant).alias("tenant_id"),
            F.expr(c.parent_key).cast("string").alias("parent_key"),
            F.lit(c.name).alias("child_table"),
            F.expr(c.child_key).cast("string").alias("child_key"),
            F.coalesce(F.date_format(F.expr(c.at), "yyyy-MM"), F.lit("unknown")).alias("period"),
        )
        for c in children
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("parent_key IS NOT NULL")


def parent_rows(parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Long form of the records that exist: table name -> (rows, key expression)."""
    out = None
    for name, (df, key) in parents.items():
        p = df.select(F.lit(name).alias("parent_table"), "tenant_id", F.expr(key).cast("string").alias("parent_key"))
        out = p if out is None else out.unionByName(p)
    return out


def orphan_groups(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parent keys named by children and present nowhere, with the children's counts by period.

    Columns: KEY, period, n_refs. Repeated child rows count as often as they are stored."""
    tagged = children.select(*KEY, "period", F.lit(0).alias("_parent")).unionByName(
        parents.select(*KEY, F.lit(None).cast("string").alias("period"), F.lit(1).alias("_parent"))
    )
    by_period = tagged.groupBy(*KEY, "period").agg(
        F.max("_parent").alias("_parent"), F.sum(1 - F.col("_parent")).alias("_n")
    )
    per_key = by_period.groupBy(*KEY).agg(
        F.max("_parent").alias("_parent"),
        # one entry per period of the key: bounded by the calendar, not by the rows
        F.collect_list(F.struct("period", "_n")).alias("_periods"),
    )
    return (
        per_key.where("_parent = 0")
        .select(*KEY, F.explode("_periods").alias("_p"))
        .select(*KEY, "_p.period", F.col("_p._n").cast("bigint").alias("n_refs"))
    )


def orphan_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """(child_table, child_key, period) of every child whose reference leads nowhere.

    Each (child_table, child_key) once; of several periods the smallest. The order in which
    parents and children came does not matter. A null tenant equals a null tenant only.
    Hot orphan keys (more than one HOT_KEYS-th of all children, so fewer than HOT_KEYS of
    them) are matched by a broadcast list and the rest by a shuffle join, so no task gets
    the children of one hot key."""
    lost = orphan_groups(parents, children).groupBy(*KEY).agg(F.sum("n_refs").alias("_n"))
    limit = children.count() // HOT_KEYS
    packed = F.to_json(F.struct(*KEY), {"ignoreNullFields": "false"})
    kids = children.select(packed.alias("_k"), "child_table", "child_key", "period")
    lost = lost.select(packed.alias("_k"), "_n")
    hot = F.broadcast(lost.where(F.col("_n") > limit).select("_k"))
    cold = lost.where(F.col("_n") <= limit).select("_k")
    found = kids.join(hot, "_k", "left_semi").unionByName(
        kids.join(hot, "_k", "left_anti").join(cold, "_k", "left_semi")
    )
    return found.groupBy("child_table", "child_key").agg(F.min("period").alias("period"))


def orphan_report(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Orphan references per parent table and period: keys and references."""
    return (
        orphan_groups(parents, children)
        .groupBy("parent_table", "period")
        .agg(F.count(F.lit(1)).alias("lost_keys"), F.sum("n_refs").cast("bigint").alias("lost_refs"))
    )
