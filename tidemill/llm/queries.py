"""Queries of the text and vector problems, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import garble, leak, neighbours, pack, split
from tidemill.sources.tables import table


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_table, item_key, text) of every article body and stored vector content."""
    a = table(spark, sf_dir, "article").select(F.lit("article").alias("item_table"), F.col("id").cast("string").alias("item_key"), F.col("body").alias("text"))
    v = table(spark, sf_dir, "doc_vectors").select(F.lit("doc_vectors").alias("item_table"), F.col("vector_id").alias("item_key"), F.col("content").alias("text"))
    return a.unionByName(v)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.oversized(_items(spark, sf_dir), "text").distinct()


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all items; versions of an item are told apart by the hash of their text."""
    items = _items(spark, sf_dir).withColumn("text_hash", F.sha2("text", 256))
    return split.split_items(items.dropDuplicates(["item_table", "item_key", "text_hash"]), "text")


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "doc_vectors"), "tenant_id", "vector_id", "embedding")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_pairs(_near(spark, sf_dir))


def p2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_rows(_near(spark, sf_dir)).withColumnRenamed("grp", "tenant_id")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def p6_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.utilisation(p6_containers(spark, sf_dir))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", "passage")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items: the documents that hold each and the largest share held."""
    found = _leaks(spark, sf_dir)
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("share").alias("share"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return garble.find_garbled(docs, "text").where("n_garbled > 0 AND (restored IS NOT NULL)").select("doc_id")


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled documents, each with its text as it was meant as far as that is known."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return garble.find_garbled(docs, "text").where("n_garbled > 0").select("doc_id", "n_garbled", "restorable", "restored")


def queries() -> dict:
    return {
        f.__name__: f
        for f in (p1_found, p1_pieces, p2_found, p2_neighbours, p6_containers, p6_utilisation, p7_found, p7_items, p8_found, p8_restored)
    }


_P2 = """
WITH v AS (
  SELECT vector_id, any_value(tenant_id) AS tenant_id, any_value(CAST(embedding AS DOUBLE[])) AS e
  FROM doc_vectors
  WHERE len(embedding) = 512 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
  GROUP BY vector_id
), ranked AS (
  SELECT a.vector_id AS id, b.vector_id AS other, row_number() OVER (PARTITION BY a.vector_id
           ORDER BY round(list_cosine_similarity(a.e, b.e), 12) DESC, b.vector_id) AS n
  FROM v a JOIN v b ON a.tenant_id = b.tenant_id AND a.vector_id <> b.vector_id
)
SELECT DISTINCT least(id, other) AS vector_id_a, greatest(id, other) AS vector_id_b FROM ranked WHERE n <= 5
"""

_P1 = r"""
SELECT DISTINCT item_table, item_key FROM (
  SELECT 'article' AS item_table, CAST(id AS VARCHAR) AS item_key, body AS text FROM article
  UNION ALL SELECT 'doc_vectors', vector_id, content FROM doc_vectors)
WHERE length(regexp_replace(text, '^[\s\x{85}\x{1c}-\x{1f}\v\pZ]+|[\s\x{85}\x{1c}-\x{1f}\v\pZ]+$', '', 'g')) > 400
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": _P1, "p2_found": _P2}
