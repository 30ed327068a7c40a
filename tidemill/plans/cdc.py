"""Queries over the change feed: parsing, current state, lake tables, streams, actions."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from tidemill.operators import documents, envelope
from tidemill.operators.change_feed import UNAVAILABLE
from tidemill.operators.lake import LakeTable
from tidemill.session import fresh_dir
from tidemill.sources.tables import table
from tidemill.streaming.runner import run_lake

FIELDS = {t: [f for f in r.names if f not in ("id", "tenant_id")] for t, r in envelope.ROWS.items()}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.as_messages(table(spark, sf_dir, "cdc_to_iceberg"))


def parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return envelope.parse(envelope.of_table(messages(spark, sf_dir), name), envelope.ROWS[name])


def flat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return envelope.flatten(parsed(spark, sf_dir, name), envelope.ROWS[name])


def cdc_topic_table(spark, sf_dir):
    t = F.substring_index("topic", ".", -1).alias("source_table")
    return messages(spark, sf_dir).groupBy(t).agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("value").isNull()).alias("tombstones"))


def cdc_parse_envelope(spark, sf_dir):
    return parsed(spark, sf_dir, "article").select(
        "partition", "offset", "op", "ts_ms", F.col("source.lsn").alias("lsn"), F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"), F.col("after.title").alias("title")
    )


def cdc_image_select(spark, sf_dir):
    return flat(spark, sf_dir, "article").select("partition", "offset", "op", "id", "tenant_id", "title", "status", "updated_at")


def cdc_toast_repair(spark, sf_dir):
    """Values that a message left out because they did not change, as repaired."""
    p = parsed(spark, sf_dir, "product").where(F.col("after.description").isin(*UNAVAILABLE) & (F.col("op") != "d"))
    return p.select("partition", "offset", F.col("after.id").alias("id"), envelope.repaired(F.col("after.description"), F.col("before.description")).alias("description"))


def over_tables(one: Callable[[str], DataFrame]) -> DataFrame:
    """A frame per source table, united under the table's name."""
    return reduce(DataFrame.unionByName, [one(t).withColumn("source_table", F.lit(t)) for t in envelope.ROWS])


def cdc_null_tenant(spark, sf_dir):
    return over_tables(lambda t: flat(spark, sf_dir, t).where(F.col("tenant_id") == envelope.UNKNOWN_TENANT).select("partition", "offset", "id"))


def cdc_event_pos(spark, sf_dir):
    return over_tables(lambda t: flat(spark, sf_dir, t).select("partition", "offset", "position", "event_pos"))


def cdc_event_keys(spark, sf_dir):
    return over_tables(lambda t: parsed(spark, sf_dir, t).select("partition", "offset", "op", F.coalesce("after.id", "before.id").alias("pk")))


def cdc_latest_state(spark, sf_dir):
    return envelope.latest(flat(spark, sf_dir, "article")).where("op <> 'd'").select(*envelope.ROWS["article"].names)


def cdc_precombine(spark, sf_dir):
    last = F.max_by("is_deleted", "event_pos").alias("is_deleted")
    return over_tables(lambda t: flat(spark, sf_dir, t).groupBy("tenant_id", "id").agg(F.max("event_pos").alias("event_pos"), last))


def cdc_merge_apply(spark, sf_dir):
    """Snapshot rows with the last of all later changes merged."""
    f, cols = flat(spark, sf_dir, "product"), envelope.ROWS["product"].names
    base = envelope.latest(f.where("op = 'r'")).select(*cols)
    return envelope.merge(base, envelope.latest(f.where("op <> 'r'")))


def cdc_partition_offenders(spark, sf_dir):
    """Keys whose changes would lie in several partitions if the log were dealt by offset and not by key, and those of the log as it is."""
    as_is = over_tables(lambda t: envelope.split_keys(flat(spark, sf_dir, t)))
    dealt = over_tables(lambda t: envelope.split_keys(flat(spark, sf_dir, t).withColumn("partition", F.pmod("offset", F.lit(5)).cast("int"))))
    return as_is.withColumn("log", F.lit("as it is")).unionByName(dealt.withColumn("log", F.lit("dealt by offset")))


def cdc_changelog_retraction(spark, sf_dir):
    """Net count of every row image key after all that was stated and taken back."""
    c = over_tables(lambda t: envelope.changelog(parsed(spark, sf_dir, t), envelope.ROWS[t]).select("tenant_id", "id", "sign"))
    return c.groupBy("source_table", "tenant_id", "id").agg(F.sum("sign").alias("net"), F.count_if(F.col("sign") < 0).alias("taken_back"))


def cdc_table_counts(spark, sf_dir):
    out = None
    for t in envelope.ROWS:
        n = envelope.latest(flat(spark, sf_dir, t).select("tenant_id", "id", "op", "partition", "offset", "position")).where("op <> 'd'")
        one = n.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("source_table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def cdc_point_lookup(spark, sf_dir):
    return cdc_latest_state(spark, sf_dir).where("tenant_id = 'default'").select("id", F.coalesce("status", F.lit("PRESENT")).alias("status"))


def _lake(spark: SparkSession, name: str) -> LakeTable:
    return LakeTable(spark, fresh_dir(spark, f"lake-{name}"), name, guard=True)


def cdc_lake_batches(spark, sf_dir):
    """The feed in three batches by arrival, merged one by one: as if in one."""
    feed, t = table(spark, sf_dir, "cdc_to_iceberg"), _lake(spark, "comment")
    for part in ("received_at < '2025-03-01'", "received_at >= '2025-03-01' AND received_at < '2025-08-01'", "received_at >= '2025-08-01' OR received_at IS NULL"):
        t.apply(envelope.as_messages(feed.where(part)))
    return t.current()


def cdc_lake_replay(spark, sf_dir):
    """The whole feed merged twice: the second time is of no effect."""
    t = _lake(spark, "product")
    for _ in range(2):
        t.apply(messages(spark, sf_dir))
    return t.current()


def cdc_lake_maintenance(spark, sf_dir):
    """Rows, versions and files after three batches that together are the whole feed, compaction and expiry: small buckets become
    one file, versions younger than a week stay, and what an hour from now is older than an hour goes but for the last two."""
    feed, out = table(spark, sf_dir, "cdc_to_iceberg"), None
    for name in envelope.ROWS:
        t = _lake(spark, name)
        for n in range(3):
            t.apply(envelope.as_messages(feed.where(F.pmod("log_offset", F.lit(3)) == n)))
        before = sum(map(len, t.manifest()["files"].values()))
        t.compact()
        after = sum(map(len, t.manifest()["files"].values()))
        week, hour, now = 168 * 3_600_000, 3_600_000, int(time.time() * 1000)
        young, dropped = t.expire(keep=2, older_than_ms=now - week), t.expire(keep=2, older_than_ms=now + hour)
        one = t.current().agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("source_table"), "n", F.lit(before > after).alias("fewer_files"), F.lit(after).cast("bigint").alias("files"),
            F.lit(young).cast("bigint").alias("young_dropped"), F.lit(dropped).cast("bigint").alias("dropped"), F.lit(len(t.versions())).cast("bigint").alias("versions"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def stream_lake(spark, sf_dir):
    """The same messages as files, through Structured Streaming in several micro-batches."""
    path, t = fresh_dir(spark, "stream"), _lake(spark, "article")
    messages(spark, sf_dir).repartition(4, "topic", "partition").write.parquet(f"{path}/in")
    q = run_lake(spark, {"path": f"{path}/in", "files_per_batch": 2}, {"article": t}, f"{path}/checkpoint", name=f"lake_{path[-12:]}")
    q.awaitTermination()
    return t.current()


def cdc_actions(spark, sf_dir):
    """What each change does to the index when its row is looked up in the source: counts by table."""
    from tidemill.plans.index import current_sources

    src = documents.hashed(current_sources(spark, sf_dir)).select(*documents.ROW_KEY, "text_hash", "blank")
    stored = documents.stored_hashes(table(spark, sf_dir, "doc_vectors"))
    out = None
    for name in ("article", "product", "comment"):
        p = parsed(spark, sf_dir, name).select(
            "op", F.col("after.id").alias("a"), F.col("before.id").alias("b"), F.coalesce("after.tenant_id", F.lit("default")).alias("tenant_id"),
            F.lit(name).alias("source_table"), F.col("after.id").cast("string").alias("source_pk"),
        )
        out = p if out is None else out.unionByName(p)
    j = out.join(src, documents.ROW_KEY, "left").join(stored, documents.ROW_KEY, "left")
    same = F.coalesce(F.col("text_hash") == F.col("stored_hash"), F.lit(False))
    act = envelope.action(F.col("source_table"), F.col("op"), F.col("a"), F.col("b"), F.col("source_table") != "comment", F.col("text_hash").isNotNull(), F.coalesce("blank", F.lit(True)), same)
    return j.groupBy("source_table", act.alias("action")).agg(F.count(F.lit(1)).alias("n"))


def cdc_moved_tenants(spark, sf_dir):
    return over_tables(lambda t: documents.moved_tenants(parsed(spark, sf_dir, t), t).drop("source_table"))


def cdc_parents_to_rebuild(spark, sf_dir):
    return documents.parents_to_rebuild(parsed(spark, sf_dir, "comment"), "article_id")


def _sql(name: str) -> str:
    """Flattened messages of a table in SQL: flat."""
    num = lambda side, f: f"CASE WHEN json_type(\"{side}\", '$.{f}') IN ('UBIGINT', 'BIGINT') THEN CAST(\"{side}\"->>'{f}' AS BIGINT) END"
    cols = []
    for f in envelope.ROWS[name].names:
        if f in ("id", "article_id"):
            cols.append(f"CASE WHEN op = 'd' THEN {num('before', f)} ELSE {num('after', f)} END AS {f}")
        else:
            ph = ", ".join(f"'{u}'" for u in UNAVAILABLE)
            a, b = f"(\"after\"->>'{f}')", f"(\"before\"->>'{f}')"
            c = f"CASE WHEN op = 'd' OR {a} IN ({ph}) THEN {b} ELSE {a} END"
            cols.append((f"coalesce({c}, '__unknown__')" if f == "tenant_id" else c) + f" AS {f}")
    return f"""
WITH parsed AS (
  SELECT *, part_no AS "partition", log_offset AS "offset", {num('after', 'id')} AS after_id, {num('before', 'id')} AS before_id
  FROM cdc_to_iceberg WHERE topic = 'cdc.public.{name}' AND op IS NOT NULL
), flat AS (
  SELECT * FROM (SELECT "partition", "offset", op, coalesce(lsn, ts_ms, 0) AS position,
    printf('%020d:%020d', coalesce(lsn, ts_ms, 0), "offset") AS event_pos, op = 'd' AS is_deleted, {", ".join(cols)} FROM parsed) WHERE id IS NOT NULL
), latest AS (
  SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY tenant_id, id ORDER BY position DESC, "offset" DESC, "partition" DESC) = 1
)
"""


def _current(name: str) -> str:
    return _sql(name) + f"""SELECT {", ".join(envelope.ROWS[name].names)} FROM flat
        QUALIFY row_number() OVER (PARTITION BY tenant_id, id ORDER BY event_pos DESC, "partition" DESC) = 1 AND NOT is_deleted"""


NAMES = (
    cdc_topic_table, cdc_parse_envelope, cdc_image_select, cdc_toast_repair, cdc_null_tenant, cdc_event_pos, cdc_event_keys, cdc_latest_state, cdc_precombine,
    cdc_merge_apply, cdc_partition_offenders, cdc_changelog_retraction, cdc_table_counts, cdc_point_lookup, cdc_lake_batches, cdc_lake_replay,
    cdc_lake_maintenance, stream_lake, cdc_actions, cdc_moved_tenants, cdc_parents_to_rebuild,
)


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


def oracle_sql() -> dict[str, str]:
    a, p, c = _sql("article"), _sql("product"), _sql("comment")
    every = lambda q: " UNION ALL ".join(f"SELECT *, '{t}' AS source_table FROM ({_sql(t)} {q})" for t in envelope.ROWS)
    blank = r"regexp_replace(t, '[\s\v\x{85}\x{1c}-\x{1f}\pZ]+', '', 'g') = ''"
    return {
        "cdc_topic_table": "SELECT split_part(topic, '.', -1) AS source_table, count(*) AS messages, count(*) FILTER (op IS NULL) AS tombstones FROM cdc_to_iceberg GROUP BY 1",
        "cdc_parse_envelope": a + "SELECT \"partition\", \"offset\", op, ts_ms, lsn, before_id, after_id, \"after\"->>'title' AS title FROM parsed",
        "cdc_image_select": a + 'SELECT "partition", "offset", op, id, tenant_id, title, status, updated_at FROM flat',
        "cdc_toast_repair": p + f"""SELECT "partition", "offset", after_id AS id, "before"->>'description' AS description FROM parsed
            WHERE op <> 'd' AND ("after"->>'description') IN ('{UNAVAILABLE[0]}', '{UNAVAILABLE[1]}')""",
        "cdc_null_tenant": every('SELECT "partition", "offset", id FROM flat WHERE tenant_id = \'__unknown__\''),
        "cdc_event_pos": every('SELECT "partition", "offset", position, event_pos FROM flat'),
        "cdc_event_keys": every('SELECT "partition", "offset", op, coalesce(after_id, before_id) AS pk FROM parsed'),
        "cdc_latest_state": a + "SELECT id, tenant_id, title, body, status, updated_at FROM latest WHERE op <> 'd'",
        "cdc_precombine": every("SELECT tenant_id, id, max(event_pos) AS event_pos, arg_max(is_deleted, event_pos) AS is_deleted FROM flat GROUP BY ALL"),
        "cdc_merge_apply": p + """, late AS (SELECT * FROM flat WHERE op <> 'r'
              QUALIFY row_number() OVER (PARTITION BY tenant_id, id ORDER BY position DESC, "offset" DESC, "partition" DESC) = 1),
            base AS (SELECT * FROM flat WHERE op = 'r'
              QUALIFY row_number() OVER (PARTITION BY tenant_id, id ORDER BY position DESC, "offset" DESC, "partition" DESC) = 1)
            SELECT id, tenant_id, name, description, status, updated_at FROM base ANTI JOIN late USING (tenant_id, id)
            UNION ALL SELECT id, tenant_id, name, description, status, updated_at FROM late WHERE op <> 'd'""",
        "cdc_partition_offenders": every("""SELECT tenant_id, id, 'as it is' AS log, count(DISTINCT "partition") AS partitions FROM flat GROUP BY ALL HAVING partitions > 1
            UNION ALL SELECT tenant_id, id, 'dealt by offset', count(DISTINCT "offset" % 5) AS partitions FROM flat GROUP BY ALL HAVING partitions > 1"""),
        "cdc_changelog_retraction": every("""SELECT tenant_id, id, CAST(sum(sign) AS BIGINT) AS net, count(*) FILTER (sign < 0) AS taken_back FROM (
              SELECT -1 AS sign, "before"->>'tenant_id' AS tenant_id, before_id AS id FROM parsed WHERE op IN ('u', 'd') AND before_id IS NOT NULL
              UNION ALL SELECT 1, "after"->>'tenant_id', after_id FROM parsed WHERE op IN ('r', 'c', 'u') AND after_id IS NOT NULL) GROUP BY ALL"""),
        "cdc_table_counts": " UNION ALL ".join(f"SELECT * FROM ({_sql(t)} SELECT '{t}' AS source_table, count(*) AS n FROM latest WHERE op <> 'd')" for t in envelope.ROWS),
        "cdc_point_lookup": a + "SELECT id, coalesce(status, 'PRESENT') AS status FROM latest WHERE op <> 'd' AND tenant_id = 'default'",
        "cdc_lake_batches": _current("comment"),
        "cdc_lake_replay": _current("product"),
        # three merges and one rewrite are four versions, of which the last two stay
        "cdc_lake_maintenance": " UNION ALL ".join(
            f"SELECT '{t}' AS source_table, count(*) AS n, TRUE AS fewer_files, CAST(1 AS BIGINT) AS files, CAST(0 AS BIGINT) AS young_dropped, CAST(4 - 2 AS BIGINT) AS dropped, CAST(2 AS BIGINT) AS versions FROM ({_current(t)})" for t in envelope.ROWS),
        "stream_lake": _current("article"),
        "cdc_moved_tenants": every("""SELECT DISTINCT "before"->>'tenant_id' AS tenant_id, CAST(coalesce(before_id, after_id) AS VARCHAR) AS source_pk
            FROM parsed WHERE ("before"->>'tenant_id') <> ("after"->>'tenant_id')"""),
        "cdc_parents_to_rebuild": c + """SELECT DISTINCT coalesce("after"->>'tenant_id', "before"->>'tenant_id') AS tenant_id,
            coalesce("after"->>'article_id', "before"->>'article_id') AS source_pk FROM parsed WHERE source_pk IS NOT NULL""",
        "cdc_actions": f"""
            WITH src AS (SELECT source_table, tenant_id, source_pk, sha256(t) AS h, {blank} AS blank FROM (
                SELECT 'article' AS source_table, tenant_id, CAST(id AS VARCHAR) AS source_pk, arg_max(concat_ws(chr(10), title, body), updated_at) AS t FROM article GROUP BY ALL
                UNION ALL SELECT 'product', tenant_id, CAST(id AS VARCHAR), arg_max(concat_ws(chr(10), name, description), updated_at) FROM product GROUP BY ALL)),
            stored AS (SELECT source_table, tenant_id, source_pk, max(text_hash) AS sh FROM doc_vectors GROUP BY ALL),
            msg AS ({" UNION ALL ".join(f"SELECT * FROM ({_sql(t)} SELECT op, after_id, before_id, coalesce(" + '"after"->>' + f"'tenant_id', 'default') AS tenant_id, '{t}' AS source_table, CAST(after_id AS VARCHAR) AS source_pk FROM parsed)" for t in envelope.ROWS)})
            SELECT source_table, CASE WHEN source_table = 'comment' OR op NOT IN ('r', 'c', 'u', 'd') THEN 'ignored'
                WHEN op = 'd' THEN CASE WHEN before_id IS NULL THEN 'ignored' ELSE 'deleted' END
                WHEN after_id IS NULL THEN 'ignored' WHEN h IS NULL OR blank THEN 'deleted'
                WHEN h = sh THEN 'metadata_refreshed' ELSE 'upserted' END AS action, count(*) AS n
            FROM msg LEFT JOIN src USING (source_table, tenant_id, source_pk) LEFT JOIN stored USING (source_table, tenant_id, source_pk) GROUP BY ALL""",
    }
