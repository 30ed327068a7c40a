"""Exact top-k similarity search, reranking, citation numbers, index statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import text, vectors

#: Most queries that are sent to all executors at once; more are joined by a shuffle on the tenant.
BROADCAST_QUERIES = 4096


def usable(vectors_df: DataFrame, dim: int = 512) -> DataFrame:
    return vectors_df.where(vectors.is_usable(F.col("embedding"), dim))


def top_k(queries: DataFrame, items: DataFrame, k: int, status: str | None = None) -> DataFrame:
    """The k nearest items of every query within the query's tenant, exactly.

    queries: query_id, tenant_id, vector; items: rows of the vector table. Adds rank and score, the
    cosine rounded to 4 places; ranks follow the exact cosine, ties the smaller vector_id. With
    status only items of that metadata status count. Queries are few; items may be many: each
    task keeps the best k of a query before anything is shuffled."""
    if status is not None:
        items = items.where(F.get_json_object("metadata", "$.status") == status)
    q = queries.select("query_id", "tenant_id", F.col("vector").alias("_q"), vectors.norm(F.col("vector")).alias("_qn"))
    if queries.limit(BROADCAST_QUERIES + 1).count() <= BROADCAST_QUERIES:
        q = F.broadcast(q)
    i = items.withColumn("_n", vectors.norm(F.col("embedding")))
    sim = F.round(vectors.dot(F.col("_q"), F.col("embedding")) / (F.col("_qn") * F.col("_n")), 12)
    scored = i.join(q, "tenant_id").select("query_id", "tenant_id", "vector_id", "source_table", "source_pk", "chunk_index", "content", "metadata", sim.alias("_s"))
    w = Window.partitionBy("query_id").orderBy(F.desc("_s"), "vector_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("score", F.round("_s", 4)).drop("_s")


def rerank(hits: DataFrame, score: Column, n: int) -> DataFrame:
    """The best n hits of every query by a second score, rounded to 4 places; ties keep the first order."""
    w = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "rank")
    return hits.withColumn("rerank_score", F.round(score, 4)).withColumn("new_rank", F.row_number().over(w)).where(F.col("new_rank") <= n)


def numbered(hits: DataFrame, rank: str = "rank") -> DataFrame:
    """Hits with citation numbers n = 1, 2, ... in rank order."""
    return hits.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(rank)))


def contexts(sources: DataFrame) -> DataFrame:
    """(query_id, context): the numbered sources of a query as one text."""
    title = F.get_json_object("metadata", "$.title")
    block = F.struct("n", text.context_block(F.col("n"), title, F.col("content")).alias("t"))
    blocks = F.transform(F.array_sort(F.collect_list(block)), lambda b: b["t"])  # at most k blocks
    return sources.groupBy("query_id").agg(F.array_join(blocks, "\n\n").alias("context"))


def stats(items: DataFrame) -> DataFrame:
    return items.groupBy("source_table", "tenant_id").agg(F.count(F.lit(1)).alias("vectors"))


def facets(items: DataFrame, tenant: str) -> DataFrame:
    return items.where(F.col("tenant_id") == tenant).groupBy("source_table").agg(F.count(F.lit(1)).alias("vectors"))


def tenant_view(items: DataFrame, tenant: str | None) -> DataFrame:
    """Only the tenant's rows; none without a tenant."""
    return items.where(F.lit(False)) if tenant is None else items.where(F.col("tenant_id") == tenant)


def tenant_of_key(keys: dict[str, str], key: str | None) -> str:
    """The tenant of an access key; a missing or unknown key is refused."""
    if not key or key not in keys:
        raise PermissionError("unknown key")
    return keys[key]


def key_of_tenant(keys: dict[str, str]) -> dict[str, str]:
    """The first key of every tenant."""
    out: dict[str, str] = {}
    for k, t in keys.items():
        out.setdefault(t, k)
    return out
