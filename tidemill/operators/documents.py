"""From source rows to chunk rows, set by set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import ids, text
from tidemill.model import TableSpec

ROW_KEY = ["tenant_id", "source_table", "source_pk"]


def source_documents(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One document per source row: its fields' text; blank says that the row has no document."""
    body = text.document_text(*[F.col(f) for f in spec.fields])
    status = F.col("status") if "status" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        "tenant_id", F.lit(spec.name).alias("source_table"), F.col(spec.key).cast("string").alias("source_pk"),
        F.col(spec.title).alias("title"), status.alias("status"), body.alias("text"), text.is_blank(body).alias("blank"),
    )


def child_texts(children: DataFrame, fk: str, body: str, order: str = "id", limit: int = text.MAX_DOC_CHARS, salts: int = 16) -> DataFrame:
    """(tenant_id, source_pk, extra, n): the non-empty child texts of each parent, in order, joined by line ends.

    Since a document is cut to ``limit`` characters, of a parent's texts only those in order are
    taken that begin within the limit. A parent with very many children is first cut down within
    each of ``salts`` shares of them, so that no task gets all; what is collected per parent is
    bounded by the limit and one text."""
    pk = F.col(fk).cast("string").alias("source_pk")
    kids = children.where(F.col(fk).isNotNull() & (F.col(body) != "")).select("tenant_id", pk, F.col(order).alias("_o"), F.col(body).alias("_t"))
    kids = kids.withColumns({"_n": F.length("_t") + 1, "_salt": F.pmod(F.xxhash64("_o", "_t"), F.lit(salts))})
    for keys in (["tenant_id", "source_pk", "_salt"], ["tenant_id", "source_pk"]):
        before = Window.partitionBy(*keys).orderBy("_o", "_t").rowsBetween(Window.unboundedPreceding, -1)
        kids = kids.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < limit)
    parts = F.array_sort(F.collect_list(F.struct("_o", "_t")))
    return (
        kids.groupBy("tenant_id", "source_pk")
        .agg(parts.alias("_p"))
        .select("tenant_id", "source_pk", F.array_join(F.transform("_p", lambda x: x["_t"]), "\n").alias("extra"), F.size("_p").alias("n"))
    )


def enriched(docs: DataFrame, extras: DataFrame) -> DataFrame:
    """Documents with their children's text appended; the tenants must agree."""
    d = docs.join(extras, ["tenant_id", "source_pk"], "left")
    return d.withColumn("text", F.when(F.coalesce(F.col("n"), F.lit(0)) > 0, F.concat_ws("\n", "text", "extra")).otherwise(F.col("text"))).drop("extra", "n")


def hashed(docs: DataFrame, max_chars: int = text.MAX_DOC_CHARS) -> DataFrame:
    cut = text.truncate(F.col("text"), max_chars)
    return docs.withColumn("text", cut).withColumn("text_hash", text.text_hash(F.col("text")))


def metadata_of() -> Column:
    return F.to_json(F.struct("status", "title"), {"ignoreNullFields": "false"})


def parent_keys(parsed: DataFrame, fk: str, parents: DataFrame, upper_fk: str | None = None, upper: DataFrame | None = None) -> DataFrame:
    """(tenant_id, source_pk) of the existing parents, or parents' parents, of changed children.

    parents: rows with tenant_id and id and, for a second level, upper_fk, which names rows of upper. A reference to a row that does
    not exist, at either level, leads to nothing."""
    own = parents.select("tenant_id", F.col("id").cast("string").alias("source_pk"), *([F.col(upper_fk).cast("string").alias("_up")] if upper_fk else []))
    found = parents_to_rebuild(parsed, fk).join(own.distinct(), ["tenant_id", "source_pk"])
    if not upper_fk:
        return found.select("tenant_id", "source_pk").distinct()
    top = upper.select("tenant_id", F.col("id").cast("string").alias("source_pk")).distinct()
    return found.select("tenant_id", F.col("_up").alias("source_pk")).distinct().join(top, ["tenant_id", "source_pk"], "left_semi")


def chunk_rows(docs: DataFrame, size: int = 400, overlap: int = 50) -> DataFrame:
    """Rows of the vector table without vectors: one per chunk of every document that isn't blank."""
    c = docs.where(~F.col("blank")).select(*ROW_KEY, "text_hash", metadata_of().alias("metadata"), F.posexplode(text.windows(F.col("text"), size, overlap)).alias("chunk_index", "content"))
    name = (F.col("tenant_id"), F.col("source_table"), F.col("source_pk"), F.col("chunk_index"))
    return c.withColumn("vector_id", ids.vector_id(*name)).withColumn("point_id", ids.point_id(*name))


def stored_hashes(vectors: DataFrame) -> DataFrame:
    """The stored hash of every row key; of several the greatest."""
    return vectors.groupBy(*ROW_KEY).agg(F.max("text_hash").alias("stored_hash"))


def plan_sync(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """action per row key: upserted, metadata_refreshed, or deleted where nothing should be stored.

    docs need text_hash and blank. A stored key without document is deleted."""
    j = docs.join(stored, ROW_KEY, "full_outer")
    act = (
        F.when(F.col("text_hash").isNull() | F.col("blank"), F.when(F.col("stored_hash").isNotNull(), "deleted").otherwise("ignored"))
        .when(F.col("stored_hash") == F.col("text_hash"), "metadata_refreshed")
        .otherwise("upserted")
    )
    return j.select(*ROW_KEY, act.alias("action"))


def replace_rows(vectors: DataFrame, keys: DataFrame, new: DataFrame) -> DataFrame:
    """The vector table with all chunks of the keys gone and the new ones in their place."""
    return vectors.join(keys.select(*ROW_KEY).distinct(), ROW_KEY, "left_anti").unionByName(new)


def refresh_metadata(vectors: DataFrame, meta: DataFrame) -> DataFrame:
    """metadata of the given row keys replaced; all else as it was."""
    m = meta.select(*ROW_KEY, F.col("metadata").alias("_m"), F.lit(True).alias("_has"))
    cols: list[Column] = [F.when(F.col("_has"), F.col("_m")).otherwise(F.col("metadata")).alias(c) if c == "metadata" else F.col(c) for c in vectors.columns]
    return vectors.join(m, ROW_KEY, "left").select(*cols)


def moved_tenants(parsed: DataFrame, table: str) -> DataFrame:
    """Row keys under a tenant that a change says the row has left."""
    b, a = F.col("before.tenant_id"), F.col("after.tenant_id")
    return parsed.where(b.isNotNull() & a.isNotNull() & (b != a)).select(
        b.alias("tenant_id"), F.lit(table).alias("source_table"), F.coalesce("before.id", "after.id").cast("string").alias("source_pk")
    ).distinct()


def parents_to_rebuild(parsed: DataFrame, fk: str) -> DataFrame:
    """(tenant_id, source_pk) of the parents that child changes name, deletes by their image before."""
    img = lambda f: F.coalesce(F.col(f"after.{f}"), F.col(f"before.{f}"))
    return parsed.select(img("tenant_id").alias("tenant_id"), img(fk).cast("string").alias("source_pk")).where("source_pk IS NOT NULL").distinct()
