"""Change messages: envelope, image choice, repair, position, action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.change_feed import UNAVAILABLE

UNKNOWN_TENANT = "__unknown__"
_text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
_id = T.StructField("id", T.LongType())
ROWS = {
    "article": T.StructType([_id, *_text("tenant_id", "title", "body", "status", "updated_at")]),
    "product": T.StructType([_id, *_text("tenant_id", "name", "description", "status", "updated_at")]),
    "comment": T.StructType([_id, *_text("tenant_id"), T.StructField("article_id", T.LongType()), *_text("body", "updated_at")]),
}


def envelope_type(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row), T.StructField("after", row), T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()), T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())])),
    ])


def as_messages(feed: DataFrame) -> DataFrame:
    """The feed's columns put back into messages (topic, partition, offset, key, value); a null op is a tombstone."""
    q = lambda c: F.coalesce(F.to_json(F.struct(F.col(c).alias("x"))), F.lit("{}"))
    num = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    op = F.regexp_extract(q("op"), r'^\{"x":(.*)\}$', 1)
    value = F.concat(
        F.lit('{"before":'), F.coalesce("before", F.lit("null")), F.lit(',"after":'), F.coalesce("after", F.lit("null")),
        F.lit(',"op":'), op, F.lit(',"ts_ms":'), num("ts_ms"), F.lit(',"source":{"lsn":'), num("lsn"), F.lit("}}"),
    )
    return feed.select(
        "topic", F.col("part_no").alias("partition"), F.col("log_offset").alias("offset"),
        F.col("msg_key").cast("binary").alias("key"), F.when(F.col("op").isNotNull(), value).cast("binary").alias("value"),
    )


def of_table(messages: DataFrame, table: str) -> DataFrame:
    return messages.where(F.substring_index("topic", ".", -1) == table)


def parse(messages: DataFrame, row: T.StructType) -> DataFrame:
    """topic, partition, offset and the envelope's columns. Tombstones and values without op are left out;
    a value that is no JSON, or a field of another type, is null."""
    return (
        messages.where("value IS NOT NULL")
        .select("topic", "partition", "offset", F.from_json(F.col("value").cast("string"), envelope_type(row)).alias("_e"))
        .where("_e.op IS NOT NULL")
        .select("topic", "partition", "offset", "_e.*")
    )


def repaired(after: Column, before: Column) -> Column:
    """The value of after, or of before where after only says that it did not change."""
    return F.when(after.isin(*UNAVAILABLE), before).otherwise(after)


def event_position(lsn: Column, ts_ms: Column, offset: Column) -> Column:
    """A string that sorts as (lsn or else ts_ms, offset)."""
    return F.format_string("%020d:%020d", F.coalesce(lsn, ts_ms, F.lit(0)), offset)


def flatten(parsed: DataFrame, row: T.StructType, drop_unknown: bool = True) -> DataFrame:
    """One row image per message: of a delete the one before, else the one after with values that did
    not change taken from before; a null tenant becomes UNKNOWN_TENANT; rows without id are left out."""
    gone = F.col("op") == "d"

    def pick(f: T.StructField) -> Column:
        after, before = F.col(f"after.{f.name}"), F.col(f"before.{f.name}")
        c = F.when(gone, before).otherwise(repaired(after, before) if isinstance(f.dataType, T.StringType) else after)
        return (F.coalesce(c, F.lit(UNKNOWN_TENANT)) if f.name == "tenant_id" else c).alias(f.name)

    flat = parsed.select(
        *[pick(f) for f in row], "op", "partition", "offset",
        F.coalesce("source.lsn", "ts_ms", F.lit(0)).alias("position"),
        event_position(F.col("source.lsn"), F.col("ts_ms"), F.col("offset")).alias("event_pos"),
        gone.alias("is_deleted"),
    )
    return flat.where("id IS NOT NULL") if drop_unknown else flat


def latest(flat: DataFrame, keys: tuple[str, ...] = ("tenant_id", "id")) -> DataFrame:
    """The last change of every key by position, then offset. As an aggregate, not a window, so
    that a key with very many changes is reduced before the shuffle."""
    rest = [c for c in flat.columns if c not in (*keys, "position", "offset")]
    best = F.max_by(F.struct(*rest, "position", "offset"), F.struct("position", "offset", "partition"))
    return flat.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def split_keys(flat: DataFrame, keys: tuple[str, ...] = ("tenant_id", "id")) -> DataFrame:
    """Keys whose changes lie in more than one partition, where their order is not defined."""
    n = F.countDistinct("partition").alias("partitions")
    return flat.groupBy(*keys).agg(n).where("partitions > 1")


def assert_one_partition(flat: DataFrame) -> None:
    bad = split_keys(flat).limit(1).collect()
    if bad:
        raise ValueError(f"changes of {bad[0].tenant_id}/{bad[0].id} lie in {bad[0].partitions} partitions")


def merge(current: DataFrame, changes: DataFrame, keys: tuple[str, ...] = ("tenant_id", "id")) -> DataFrame:
    """current with one change per key applied: deletes remove, others replace or insert."""
    keep = current.join(changes.select(*keys), list(keys), "left_anti")
    return keep.unionByName(changes.where("op <> 'd'").select(*current.columns))


def changelog(parsed: DataFrame, row: T.StructType) -> DataFrame:
    """Signed row images: -1 for what a message takes back, +1 for what it states."""
    minus = F.when(F.col("op").isin("u", "d") & F.col("before.id").isNotNull(), F.struct(F.lit(-1).alias("sign"), F.col("before").alias("r")))
    plus = F.when(F.col("op").isin("r", "c", "u") & F.col("after.id").isNotNull(), F.struct(F.lit(1).alias("sign"), F.col("after").alias("r")))
    return parsed.select("offset", "partition", F.explode(F.array_compact(F.array(minus, plus))).alias("_s")).select("offset", "partition", "_s.sign", *[F.col(f"_s.r.{f}").alias(f) for f in row.names])


def action(table: Column, op: Column, after_id: Column, before_id: Column, has_document: Column, source_row: Column, blank: Column, same_hash: Column) -> Column:
    """What a message does to the vector index.

    A change only says that the row be looked up: the source row as it is now counts. Without it, or
    with blank text, the document is deleted; with the stored hash only its metadata are refreshed."""
    return (
        F.when(~has_document | ~op.isin("r", "c", "u", "d"), "ignored")
        .when(op == "d", F.when(before_id.isNull(), "ignored").otherwise("deleted"))
        .when(after_id.isNull(), "ignored")
        .when(~source_row | blank, "deleted")
        .when(same_hash, "metadata_refreshed")
        .otherwise("upserted")
    )
