"""A change feed of inserts, updates and deletes, folded into the current state of a table.

The state is kept in buckets by key hash, copy on write: changes are reduced per key, routed
to their buckets, merged with the files of the touched buckets only, written as replacement
files, and a new manifest makes them the current version.

What is stored per key is a *mergeable* summary: every part of it is a maximum, so folding is
commutative, associative and idempotent. Repeated, late and out-of-order messages, and any
division into batches, give the same state, and a key that changes very often is reduced on
the map side before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.bucket_store import BucketStore

#: What a connector writes for a large value that did not change, plain and in base64.
UNAVAILABLE = ("__debezium_unavailable_value", "X19kZWJleml1bV91bmF2YWlsYWJsZV92YWx1ZQ==")
CHANGE_OPS = ("r", "c", "u", "d")
KEY = ["source_table", "id"]
BY_LSN, BY_CLOCK = "lsn", "clock"


def parse_messages(feed: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Row changes of a raw feed (topic, part_no, log_offset, msg_key, op, lsn, ts_ms, before, after).

    Tombstones and messages that are no row change are left out, as are changes whose row is
    named neither by an image nor by msg_key. The images are read as maps, so missing and extra
    fields, numbers written as text and images that are no JSON object need no schema.
    Per field there is at most one observation: the value of ``after`` if present and available,
    else that of ``before`` unless it is null there (a reduced image says nothing)."""
    m = "map<string,string>"
    parsed = feed.where(F.col("op").isin(*CHANGE_OPS)).select(
        F.substring_index("topic", ".", -1).alias("source_table"),
        "op", "lsn", "ts_ms", "part_no", "log_offset",
        F.from_json("before", m).alias("_b"),
        F.from_json("after", m).alias("_a"),
        F.from_json("msg_key", m).alias("_k"),
    )
    ident = F.coalesce(*[F.expr(f"try_cast(trim({s}['id']) AS bigint)") for s in ("_a", "_b", "_k")])

    def seen(f: str) -> Column:
        after, before = F.col("_a")[f], F.col("_b")[f]
        told = F.map_contains_key("_a", F.lit(f)) & ~F.coalesce(after.isin(*UNAVAILABLE), F.lit(False))
        if f == "tenant_id":  # never null in a table: a null in an image is a gap
            told = told & after.isNotNull()
        return (
            F.when(F.coalesce(told, F.lit(False)), F.struct(F.lit(1).alias("phase"), after.alias("value")))
            .when(before.isNotNull() & ~before.isin(*UNAVAILABLE), F.struct(F.lit(0).alias("phase"), before.alias("value")))
        )

    return parsed.select(
        "source_table", ident.alias("id"), "op", "lsn", "ts_ms", "part_no", "log_offset", *[seen(f).alias(f) for f in fields]
    ).where("id IS NOT NULL")


def _place(order: str) -> list[Column]:
    """Where a change stands among the changes of its row."""
    first = "lsn" if order == BY_LSN else "ts_ms"
    return [F.coalesce(F.col(first), F.lit(-(2**63))).alias("at"), F.col("log_offset").alias("off"), F.col("part_no").alias("part")]


def summarise(changes: DataFrame, fields: Sequence[str], keys: Sequence[str] = KEY) -> DataFrame:
    """One mergeable summary per key, for either order of its changes."""
    out = [F.max(F.col("lsn").isNull()).alias("no_lsn")]
    for o in (BY_LSN, BY_CLOCK):
        place = F.struct(*_place(o))
        out += [
            F.max(F.struct(*_place(o), "op", "ts_ms")).alias(f"last_{o}"),
            F.max(F.when(F.col("op") == "d", place)).alias(f"gone_{o}"),
        ]
        for f in fields:
            seen = F.struct(*_place(o), F.col(f)["phase"].alias("phase"), F.col(f)["value"].alias("value"))
            out.append(F.max(F.when(F.col(f).isNotNull(), seen)).alias(f"{f}_{o}"))
    return changes.groupBy(*keys).agg(*out)


def current_rows(state: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(source_table, id, fields, ts_ms) of the rows that exist after their last change.

    The changes of a row follow lsn, then log_offset; if any of them has no lsn, all follow
    ts_ms, then log_offset. A field has its last observed value since the row last came into
    being, or null if there is none."""
    pick = lambda name: F.when(F.col("no_lsn"), F.col(f"{name}_{BY_CLOCK}")).otherwise(F.col(f"{name}_{BY_LSN}"))
    s = state.select(*KEY, pick("last").alias("_last"), pick("gone").alias("_gone"), *[pick(f).alias(f) for f in fields])
    place = lambda f: F.struct(*[F.col(f)[x].alias(x) for x in ("at", "off", "part")])
    since = lambda f: F.when(F.col("_gone").isNull() | (place(f) > F.col("_gone")), F.col(f)["value"])
    return s.where(F.col("_last.op") != "d").select(*KEY, *[since(f).alias(f) for f in fields], F.col("_last.ts_ms").alias("ts_ms"))


class BucketedState(BucketStore):
    """Stored summaries of a feed: every batch merged takes the greater of every part."""

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str], buckets: int = 16):
        self.fields = list(fields)
        place = "at: bigint, off: bigint, part: int"
        parts = ["source_table string", "id bigint", "no_lsn boolean"]
        for o in (BY_LSN, BY_CLOCK):
            parts += [f"last_{o} struct<{place}, op: string, ts_ms: bigint>", f"gone_{o} struct<{place}>"]
            parts += [f"{f}_{o} struct<{place}, phase: int, value: string>" for f in self.fields]
        super().__init__(spark, path, KEY, ", ".join(parts), buckets)

    def reduced(self, changes: DataFrame) -> DataFrame:
        return summarise(changes, self.fields)

    def newer(self, column: str, base: Column, delta: Column, base_row: Column, delta_row: Column) -> Column:
        return F.greatest(base, delta)

    def current(self, version: int | None = None) -> DataFrame:
        return current_rows(self.rows(version), self.fields)
