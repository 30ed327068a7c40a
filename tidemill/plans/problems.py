"""Queries of the general data problems, with their SQL.

p3: two copies compared, p4: change feed applied, p5: references that lead nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import change_feed, diff, references
from tidemill.session import fresh_dir
from tidemill.sources.tables import table

INDEX_KEY = ["source_table", "tenant_id", "source_pk"]
INDEX_FIELDS = ["title", "status", "text_hash"]
FEED_FIELDS = ["tenant_id", "title", "body", "status", "name", "description", "article_id", "updated_at"]


def indexed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of article and product as the index should know them."""
    out = None
    for name, title, text in (("article", "title", "body"), ("product", "name", "description")):
        rows = table(spark, sf_dir, name).select(
            F.lit(name).alias("source_table"),
            "tenant_id",
            F.col("id").cast("string").alias("source_pk"),
            F.col(title).alias("title"),
            "status",
            F.sha2(F.concat_ws("\n", title, text), 256).alias("text_hash"),
            "updated_at",
        )
        one = diff.latest_per_key(rows, INDEX_KEY, ["updated_at"], INDEX_FIELDS)
        out = one if out is None else out.unionByName(one)
    return out


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = F.from_json("metadata", "title string, status string")
    return table(spark, sf_dir, "doc_vectors").select(*INDEX_KEY, meta["title"].alias("title"), meta["status"].alias("status"), "text_hash")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = diff.diff_cells(indexed_source(spark, sf_dir), index_rows(spark, sf_dir), INDEX_KEY, INDEX_FIELDS)
    return found.select("source_table", "tenant_id", "source_pk", "field_name")


def p3_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's missing and orphan counts of every tenant and table that has differences."""
    return diff.drift_counts(p3_found(spark, sf_dir), ["tenant_id", "source_table"])


def feed_state(spark: SparkSession, sf_dir: str) -> change_feed.BucketedState:
    """The feed in a bucketed store in the shared folder: the snapshot rows as base, the other messages merged into its buckets."""
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    store = change_feed.BucketedState(spark, fresh_dir(spark, "feed"), FEED_FIELDS, buckets)
    feed = table(spark, sf_dir, "cdc_to_iceberg")
    snapshot = F.col("op").eqNullSafe("r")
    for part in (feed.where(snapshot), feed.where(~snapshot)):
        store.apply(change_feed.parse_messages(part, FEED_FIELDS))
    return store


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_state(spark, sf_dir).current().select("source_table", "id", "tenant_id", "ts_ms")


def p4_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that exist, each with its last values."""
    return feed_state(spark, sf_dir).current()


def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parents = references.parent_rows({t: (table(spark, sf_dir, t), "id") for t in ("article", "product")})
    children = references.child_rows([
        references.Child("article_comment", table(spark, sf_dir, "article_comment"), "'article'", "article_id", "id", "updated_at"),
        references.Child("doc_vectors", table(spark, sf_dir, "doc_vectors"), "source_table", "source_pk", "vector_id", "updated_at"),
    ])
    return parents, children


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_children(*_references(spark, sf_dir))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(*_references(spark, sf_dir))


_P3 = """
WITH src AS (
  SELECT source_table, tenant_id, source_pk,
         arg_max({'title': title, 'status': status, 'text_hash': h}, updated_at) AS v
  FROM (
    SELECT 'article' AS source_table, tenant_id, CAST(id AS VARCHAR) AS source_pk, title, status,
           sha256(concat_ws(chr(10), title, body)) AS h, updated_at FROM article
    UNION ALL
    SELECT 'product', tenant_id, CAST(id AS VARCHAR), name, status,
           sha256(concat_ws(chr(10), name, description)), updated_at FROM product)
  GROUP BY ALL
), idx AS (
  SELECT DISTINCT source_table, tenant_id, source_pk, metadata->>'title' AS title,
         metadata->>'status' AS status, text_hash FROM doc_vectors
), both_sides AS (
  SELECT s.source_table, s.tenant_id, s.source_pk,
         bool_or(i.title IS DISTINCT FROM s.v.title) AS d_title,
         bool_or(i.status IS DISTINCT FROM s.v.status) AS d_status,
         bool_or(i.text_hash IS DISTINCT FROM s.v.text_hash) AS d_hash
  FROM src s JOIN idx i USING (source_table, tenant_id, source_pk) GROUP BY ALL
), found AS (
  SELECT source_table, tenant_id, source_pk, 'missing' AS field_name FROM src s
    ANTI JOIN idx i USING (source_table, tenant_id, source_pk)
  UNION ALL
  SELECT DISTINCT source_table, tenant_id, source_pk, 'orphan' FROM idx i
    ANTI JOIN src s USING (source_table, tenant_id, source_pk)
  UNION ALL SELECT source_table, tenant_id, source_pk, 'title' FROM both_sides WHERE d_title
  UNION ALL SELECT source_table, tenant_id, source_pk, 'status' FROM both_sides WHERE d_status
  UNION ALL SELECT source_table, tenant_id, source_pk, 'text_hash' FROM both_sides WHERE d_hash
)
"""

_P4 = """
WITH msg AS (
  SELECT split_part(topic, '.', -1) AS source_table, op, lsn, ts_ms, log_offset, part_no,
         TRY_CAST(coalesce("after"->>'id', "before"->>'id', msg_key->>'id') AS BIGINT) AS id,
         "after"->>'tenant_id' AS t_after, "before"->>'tenant_id' AS t_before
  FROM cdc_to_iceberg WHERE op IN ('r', 'c', 'u', 'd')
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source_table, id ORDER BY
              CASE WHEN no_lsn THEN ts_ms ELSE lsn END, log_offset, part_no) AS n
  FROM (SELECT *, bool_or(lsn IS NULL) OVER (PARTITION BY source_table, id) AS no_lsn FROM msg WHERE id IS NOT NULL)
), lives AS (
  SELECT *, max(CASE WHEN op = 'd' THEN n ELSE 0 END) OVER (PARTITION BY source_table, id) AS gone FROM ordered
)
SELECT source_table, id, arg_max(coalesce(t_after, t_before), n) AS tenant_id, arg_max(ts_ms, n) AS ts_ms
FROM lives WHERE n > gone GROUP BY source_table, id
"""

def _p4_rows() -> str:
    """Every field's last observation since the row last came into being; arg_max skips nulls."""
    ph = ", ".join(f"'{u}'" for u in change_feed.UNAVAILABLE)

    def seen(f: str) -> str:
        a, b = f"(\"after\"->>'{f}')", f"(\"before\"->>'{f}')"
        told = f"json_exists(\"after\", '$.{f}') AND coalesce({a} NOT IN ({ph}), TRUE)" + (f" AND {a} IS NOT NULL" if f == "tenant_id" else "")
        return f"CASE WHEN coalesce({told}, FALSE) THEN {{'v': {a}}} WHEN {b} IS NOT NULL AND {b} NOT IN ({ph}) THEN {{'v': {b}}} END AS {f}"

    fields = ", ".join(f"arg_max({f}, n).v AS {f}" for f in FEED_FIELDS)
    head, _, _ = _P4.partition("SELECT source_table, id, arg_max")
    head = head.replace('"before"->>\'tenant_id\' AS t_before', '"before"->>\'tenant_id\' AS t_before, ' + ", ".join(seen(f) for f in FEED_FIELDS))
    return head + f"SELECT source_table, id, {fields}, arg_max(ts_ms, n) AS ts_ms FROM lives WHERE n > gone GROUP BY source_table, id"


_P5 = """
WITH child AS (
  SELECT 'article_comment' AS child_table, CAST(id AS VARCHAR) AS child_key, tenant_id,
         'article' AS parent_table, CAST(article_id AS VARCHAR) AS parent_key, updated_at
  FROM article_comment WHERE article_id IS NOT NULL
  UNION ALL
  SELECT 'doc_vectors', vector_id, tenant_id, source_table, source_pk, updated_at FROM doc_vectors
), parent AS (
  SELECT 'article' AS parent_table, tenant_id, CAST(id AS VARCHAR) AS parent_key FROM article
  UNION SELECT 'product', tenant_id, CAST(id AS VARCHAR) FROM product
), lost AS (
  SELECT *, coalesce(strftime(updated_at, '%Y-%m'), 'unknown') AS period
  FROM child ANTI JOIN parent USING (parent_table, tenant_id, parent_key)
)
"""


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_drift, p4_found, p4_rows, p5_found, p5_report)}


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _P3 + "SELECT * FROM found",
        "p3_drift": _P3 + """SELECT tenant_id, source_table, CAST(count(*) FILTER (field_name = 'missing') AS BIGINT) AS missing,
            CAST(count(*) FILTER (field_name = 'orphan') AS BIGINT) AS orphan FROM found GROUP BY ALL""",
        "p4_found": _P4,
        "p4_rows": _p4_rows(),
        "p5_found": _P5 + "SELECT child_table, child_key, min(period) AS period FROM lost GROUP BY ALL",
        "p5_report": _P5 + """SELECT parent_table, period, count(DISTINCT (tenant_id, parent_key)) AS lost_keys,
            count(*) AS lost_refs FROM lost GROUP BY ALL""",
    }
