"""Queries over documents, the vector table, retrieval quality, reconciliation and operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import ids, text, vectors
from tidemill.model import INDEX_KEYS, TABLES
from tidemill.operators import dead_letters, diff, documents, metrics, quality, reconcile, search
from tidemill.plans.cdc import _sql as feed_sql
from tidemill.plans.cdc import messages, parsed
from tidemill.session import fresh_dir, ship
from tidemill.sources.golden import read_golden
from tidemill.sources.tables import table
from tidemill.sources.vector_store import VectorStore

# --- documents ---------------------------------------------------------------------------


def current_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of article and product as they are now: of several rows of a key the latest."""
    out = None
    for name in ("article", "product"):
        spec = TABLES[name]
        cols = [*spec.fields, "status"]
        rows = diff.latest_per_key(table(spark, sf_dir, name), ["tenant_id", "id"], ["updated_at"], cols)
        d = documents.source_documents(rows, spec)
        out = d if out is None else out.unionByName(d)
    return out


def doc_source_text(spark, sf_dir):
    return current_sources(spark, sf_dir).select(*documents.ROW_KEY, "text", "blank")


def doc_text_hash(spark, sf_dir):
    return documents.hashed(current_sources(spark, sf_dir)).select(*documents.ROW_KEY, "text_hash")


def doc_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.text_hash(text.truncate(F.col("text"), 1000)).alias("hash"), F.length(text.truncate(F.col("text"), 1000)).alias("n"))


def doc_blank(spark, sf_dir):
    d = table(spark, sf_dir, "article_comment").select("id", "tenant_id", text.is_blank(F.col("body")).alias("blank"))
    return d.where("blank").distinct()


def doc_chunks(spark, sf_dir):
    c = F.posexplode(text.windows(F.col("text"))).alias("chunk_index", "content")
    return table(spark, sf_dir, "documents").select("doc_id", c)


def _chunks(spark, sf_dir, size=400, overlap=50):
    return documents.chunk_rows(documents.hashed(current_sources(spark, sf_dir)), size, overlap)


def doc_vector_ids(spark, sf_dir):
    return _chunks(spark, sf_dir).select(*documents.ROW_KEY, "chunk_index", "vector_id")


def doc_point_ids(spark, sf_dir):
    return _chunks(spark, sf_dir).select("vector_id", "point_id")


def _enriched(spark, sf_dir):
    docs = current_sources(spark, sf_dir).where("source_table = 'article'")
    comments = table(spark, sf_dir, "article_comment").select("id", "tenant_id", "article_id", "body").distinct()
    return documents.hashed(documents.enriched(docs, documents.child_texts(comments, "article_id", "body")))


def doc_enrich_children(spark, sf_dir):
    return _enriched(spark, sf_dir).select(*documents.ROW_KEY, "text_hash", F.length("text").alias("n"))


def _sync(spark, sf_dir):
    docs = documents.hashed(current_sources(spark, sf_dir))
    return documents.plan_sync(docs, documents.stored_hashes(table(spark, sf_dir, "doc_vectors")))


def doc_sync_plan(spark, sf_dir):
    return _sync(spark, sf_dir)


def doc_sync_counts(spark, sf_dir):
    return metrics.action_counts(_sync(spark, sf_dir), "source_table", "action")


def doc_replace_rows(spark, sf_dir):
    """The vector table after the sync: changed rows' chunks replaced, deleted rows' chunks gone."""
    cols = [*documents.ROW_KEY, "chunk_index", "text_hash", "content"]
    old = table(spark, sf_dir, "doc_vectors").select("vector_id", *cols).dropDuplicates(["vector_id"])
    plan = _sync(spark, sf_dir).where("action IN ('upserted', 'deleted')")
    new = _chunks(spark, sf_dir).join(plan.where("action = 'upserted'"), documents.ROW_KEY, "left_semi")
    return documents.replace_rows(old, plan, new.select("vector_id", *cols)).select("vector_id", "text_hash")


def doc_refresh_metadata(spark, sf_dir):
    """Stored chunks whose metadata are not those of the source row, with what they become."""
    docs = current_sources(spark, sf_dir).where("NOT blank").select(*documents.ROW_KEY, F.to_json(F.struct("status", "title"), {"ignoreNullFields": "false"}).alias("metadata"))
    old = table(spark, sf_dir, "doc_vectors").select("vector_id", *documents.ROW_KEY, "metadata").dropDuplicates(["vector_id"])
    m = F.from_json("metadata", "status string, title string")
    return documents.refresh_metadata(old, docs).select("vector_id", m["status"].alias("status"), m["title"].alias("title"))


def doc_delete_rows(spark, sf_dir):
    """What is left of the vector table without the rows whose source row is gone."""
    gone = _sync(spark, sf_dir).where("action = 'deleted'")
    old = table(spark, sf_dir, "doc_vectors").select("vector_id", *documents.ROW_KEY)
    return old.join(gone, documents.ROW_KEY, "left_anti").select("vector_id").distinct()


def doc_index_versions(spark, sf_dir):
    """Chunks that each set of index settings makes of the current sources."""
    meta = F.from_json("metadata", "chunk_size int, chunk_overlap int")
    out = None
    for r in table(spark, sf_dir, "index_metadata").select("name", meta.alias("m")).orderBy("name").collect():  # a row per index
        n = _chunks(spark, sf_dir, r.m.chunk_size, r.m.chunk_overlap).agg(F.count(F.lit(1)).alias("chunks")).select(F.lit(r.name).alias("name"), "chunks")
        out = n if out is None else out.unionByName(n)
    return out if out is not None else spark.createDataFrame([], "name string, chunks bigint")


# --- vectors -----------------------------------------------------------------------------


def _items(spark, sf_dir):
    v = table(spark, sf_dir, "doc_vectors").dropDuplicates(["vector_id"])
    return search.usable(v)


def vec_unusable(spark, sf_dir):
    v = table(spark, sf_dir, "doc_vectors")
    return v.where(~vectors.is_usable(F.col("embedding"), 512)).select("vector_id", F.coalesce(F.size("embedding"), F.lit(-1)).alias("n")).distinct()


def _label_items(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    vid = F.format_string("%08d", "vec_id").alias("vector_id")
    return e.select(
        vid, "vec_id", F.col("label").cast("string").alias("tenant_id"), "embedding", F.lit("embeddings").alias("source_table"), F.col("vec_id").cast("string").alias("source_pk"),
        F.lit(0).alias("chunk_index"), F.concat(F.lit("item "), F.col("vec_id")).alias("content"), F.to_json(F.struct(F.when(F.col("vec_id") % 3 == 0, "draft").otherwise("published").alias("status"), F.concat(F.lit("T"), F.col("vec_id")).alias("title"))).alias("metadata"),
    )


def _hits(spark, sf_dir, k, status=None):
    i = _label_items(spark, sf_dir)
    q = i.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "tenant_id", F.col("embedding").alias("vector"))
    return search.top_k(q, i.drop("vec_id"), k, status)


def vec_topk(spark, sf_dir):
    return _hits(spark, sf_dir, 5).select("query_id", "rank", "vector_id", "score")


def vec_topk_status(spark, sf_dir):
    return _hits(spark, sf_dir, 5, "published").select("query_id", "rank", "vector_id", "score")


def vec_rerank(spark, sf_dir):
    h = search.rerank(_hits(spark, sf_dir, 12), (F.col("source_pk").cast("int") % 7) / 7.0, 4)
    return h.select("query_id", F.col("new_rank").alias("rank"), "vector_id", "rerank_score")


def rag_context(spark, sf_dir):
    return search.contexts(search.numbered(_hits(spark, sf_dir, 4)))


def vec_stats(spark, sf_dir):
    return search.stats(table(spark, sf_dir, "doc_vectors"))


def vec_facets(spark, sf_dir):
    return search.facets(table(spark, sf_dir, "doc_vectors"), "default")


def vec_tenant_view(spark, sf_dir):
    return search.tenant_view(table(spark, sf_dir, "doc_vectors"), "t001").select("vector_id", "source_pk").distinct()


def vec_embed(spark, sf_dir):
    """Documents' vectors by the stand-in model."""
    ship(spark)
    e = vectors.embed(F.col("text"), vectors.hashed_words(64))
    return table(spark, sf_dir, "documents").select("doc_id", e.alias("v")).select("doc_id", F.round(vectors.norm(F.col("v")), 4).alias("length"))


# --- quality -----------------------------------------------------------------------------


def _expected(spark, sf_dir):
    i = _label_items(spark, sf_dir)
    q = i.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "tenant_id")
    e = i.where("vec_id % 11 < 2").select("tenant_id", "source_table", "source_pk")
    return q.join(e, "tenant_id", "left").select("query_id", "source_table", "source_pk")


def _retrieval(spark, sf_dir):
    return quality.retrieval(_hits(spark, sf_dir, 20), _expected(spark, sf_dir), 5)


def eval_retrieval(spark, sf_dir):
    return _retrieval(spark, sf_dir).select("query_id", "n_expected", F.round("recall", 6).alias("recall"), F.round("reciprocal_rank", 6).alias("reciprocal_rank"))


def eval_report(spark, sf_dir):
    m = quality.means(_retrieval(spark, sf_dir), "recall", "reciprocal_rank")
    return m.select("n", F.round("mean_recall", 6).alias("mean_recall"), F.round("mean_reciprocal_rank", 6).alias("mean_reciprocal_rank"))


def eval_golden(spark, sf_dir):
    """Labelled queries written as JSON lines and read again: expected rows, and whether they exist."""
    path = fresh_dir(spark, "golden")
    e = table(spark, sf_dir, "eval_item")
    e.select("query", "tenant_id", "expected_pks").coalesce(1).sortWithinPartitions("query", "tenant_id").write.json(path)
    g = read_golden(spark, path).select("query", "tenant_id", F.explode("expected_pks").alias("_e")).select("query", "tenant_id", "_e.*")
    have = current_sources(spark, sf_dir).select(*documents.ROW_KEY, F.lit(True).alias("_has"))
    return g.join(have, documents.ROW_KEY, "left").select("query", *documents.ROW_KEY, F.coalesce("_has", F.lit(False)).alias("present"))


def _answers(spark, sf_dir):
    """Passages with marks that cite their expected rows, some of them out of range."""
    mark = F.concat(F.lit("$1 ["), (F.col("item_id") % 4).cast("string"), F.lit(", 1]"))
    marked = F.regexp_replace(F.col("passage"), F.lit("([.。])"), mark)
    answer = F.when(F.col("item_id") % 5 == 0, F.col("passage")).otherwise(marked)
    return table(spark, sf_dir, "eval_item").select("item_id", answer.alias("answer"), F.size("expected_pks").alias("n_sources"))


def _citations(spark, sf_dir):
    return quality.citation_measures(_answers(spark, sf_dir), F.col("answer"), F.sequence(F.lit(1), F.col("n_sources")).cast("array<bigint>"))


def eval_citations(spark, sf_dir):
    return _citations(spark, sf_dir).select("item_id", "n_citations", "n_valid", "n_sentences", "coverage", "cited_sentences")


def eval_generation_report(spark, sf_dir):
    m = quality.means(_citations(spark, sf_dir), "coverage", "cited_sentences")
    return m.select("n", F.round("mean_coverage", 6).alias("mean_coverage"), F.round("mean_cited_sentences", 6).alias("mean_cited_sentences"))


# --- reconciliation ----------------------------------------------------------------------


def _keys(spark, sf_dir):
    src = None
    for name in ("article", "product"):
        k = table(spark, sf_dir, name).select("tenant_id", F.lit(name).alias("source_table"), F.col("id").cast("string").alias("source_pk"))
        src = k if src is None else src.unionByName(k)
    return src, table(spark, sf_dir, "doc_vectors").select(*documents.ROW_KEY)


def reconcile_exact(spark, sf_dir):
    return reconcile.exact(*_keys(spark, sf_dir))


def reconcile_approx(spark, sf_dir):
    return reconcile.approximate(*_keys(spark, sf_dir))


def reconcile_totals(spark, sf_dir):
    return reconcile.totals(reconcile.exact(*_keys(spark, sf_dir)))


def reconcile_history(spark, sf_dir):
    """The last recorded run of every tenant and table."""
    d = table(spark, sf_dir, "drift_row")
    last = F.max_by(F.struct("run_no", "source_rows", "indexed_pks", "missing", "orphan"), "run_no").alias("_r")
    return d.groupBy("tenant_id", "source_table").agg(last).select("tenant_id", "source_table", "_r.*")


# --- operations --------------------------------------------------------------------------


def _log(spark, sf_dir):
    f = table(spark, sf_dir, "cdc_to_iceberg")
    return f.select(
        F.substring_index("topic", ".", -1).alias("source_table"), "topic", F.col("part_no").alias("partition"), F.col("log_offset").alias("offset"), "op", "received_at",
        ((F.unix_micros(F.col("received_at").cast("timestamp")) - F.col("ts_ms") * 1000) / 1e6).alias("delay"),
    )


def ops_action_counts(spark, sf_dir):
    return metrics.action_counts(_log(spark, sf_dir).where("op IS NOT NULL"), "source_table", "op")


def ops_delay_histogram(spark, sf_dir):
    return metrics.delay_histogram(_log(spark, sf_dir), F.col("delay"), "source_table")


def ops_delay_quantiles(spark, sf_dir):
    h = metrics.delay_histogram(_log(spark, sf_dir), F.col("delay"), "source_table")
    out = None
    for q in (0.5, 0.99):
        d = metrics.histogram_quantile(h, q, "source_table").select("source_table", F.lit(q).alias("q"), F.round("quantile", 6).alias("seconds"))
        out = d if out is None else out.unionByName(d)
    return out


def ops_rates(spark, sf_dir):
    r = metrics.rates(_log(spark, sf_dir), "received_at", "source_table")
    return r.withColumn("rate", F.round("rate", 9))


def ops_ledger(spark, sf_dir):
    log = _log(spark, sf_dir)
    return metrics.ledger(log, metrics.ledger(log.where("received_at < '2025-06-01'")))


def ops_backlog(spark, sf_dir):
    log, by = _log(spark, sf_dir), ("topic", "partition")
    ends = log.groupBy(*by).agg((F.max("offset") + 1).alias("end"))
    done = log.where("received_at < '2025-06-01'").groupBy(*by).agg((F.max("offset") + 1).alias("last"))
    return metrics.backlog(ends, done, *by)


def ops_slot_lag(spark, sf_dir):
    f = table(spark, sf_dir, "cdc_to_iceberg")
    g = f.groupBy("topic").agg(F.max("lsn").alias("cur"), F.max(F.when(F.col("received_at") < "2025-06-01", F.col("lsn"))).alias("done"))
    return g.select("topic", metrics.lag_bytes(F.col("cur"), F.col("done")).alias("lag_bytes"))


def ops_chunks_embedded(spark, sf_dir):
    return _chunks(spark, sf_dir).groupBy("source_table").agg(F.count(F.lit(1)).alias("chunks"))


def ops_alerts(spark, sf_dir):
    h = metrics.delay_histogram(_log(spark, sf_dir), F.col("delay"))
    p99 = metrics.histogram_quantile(h, 0.99).select(F.col("quantile").alias("delay_p99"))
    back = ops_backlog(spark, sf_dir).select(F.col("backlog").alias("dead_letter_backlog"))
    lag = ops_slot_lag(spark, sf_dir).agg(F.max("lag_bytes").alias("slot_lag_bytes"))
    one = lambda d: d.withColumn("_k", F.lit(1))  # noqa: E731  # one row each
    g = one(p99).join(one(back), "_k").join(one(lag), "_k")
    return metrics.alerts(g.join(one(metrics.gauges_at_end(_log(spark, sf_dir), "received_at", F.col("op").isNull())), "_k"))


def ops_gauges(spark, sf_dir):
    return metrics.gauges_at_end(_log(spark, sf_dir), "received_at", F.col("op").isNull(), minutes=1440)


def ops_rates_by_action(spark, sf_dir):
    """Messages a second in windows of five minutes by table and kind; dead letters are those without an op."""
    r = metrics.rates(_log(spark, sf_dir).withColumn("action", F.coalesce("op", F.lit("dead letter"))), "received_at", "source_table", "action")
    return r.withColumn("rate", F.round("rate", 9))


def reconcile_preflight(spark, sf_dir):
    return reconcile.preflight(*_keys(spark, sf_dir))


def dlq_replay_limited(spark, sf_dir):
    """The first letters only, as a careful replay takes them."""
    d = _letters(spark, sf_dir)
    s = dead_letters.split_replay(d, d.groupBy("partition").agg(F.max("offset").alias("end")), limit=20)
    return s.select("partition", "offset", "source_topic", "fate")


def cdc_parents_existing(spark, sf_dir):
    """The existing articles that changed comments belong to."""
    return documents.parent_keys(parsed(spark, sf_dir, "comment"), "article_id", table(spark, sf_dir, "article"))


def vec_sink_sync(spark, sf_dir):
    """The vector table, loaded into the sink and synchronised with the current source rows in one commit."""
    store = VectorStore(spark, fresh_dir(spark, "vectors"))
    rows = _items(spark, sf_dir)
    store.load(rows)
    docs = documents.hashed(current_sources(spark, sf_dir))
    gone = rows.select(*documents.ROW_KEY).distinct().join(docs, documents.ROW_KEY, "left_anti")
    ends = _log(spark, sf_dir).groupBy("topic", "partition").agg(F.max("offset").alias("n")).collect()  # a row per partition
    store.sync(docs, vectors.hashed_words(512), ledger={f"{r.topic}/{r.partition}": r.n for r in ends}, gone=gone)
    m = F.from_json("metadata", "status string, title string")
    return store.rows().select("vector_id", "text_hash", m["status"].alias("status"), m["title"].alias("title"))


# --- dead letters ------------------------------------------------------------------------


def _letters(spark, sf_dir):
    """Messages that are no row change, as dead letters that were replayed 0 to 6 times."""
    h = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
    m = messages(spark, sf_dir)
    bad = m.where("value IS NULL").withColumn("headers", F.array(h("replay_count", F.col("offset") % 7)))
    err = F.concat(F.lit("cannot reach postgres://app:s3cret"), F.col("offset"), F.lit("@db/x password = hunter"), F.col("offset"))
    q = dead_letters.to_quarantine(bad, err, "cdc.dlq")
    at = dead_letters.header("source_offset").cast("bigint")
    heads = F.when(at % 10 == 9, F.filter("headers", lambda x: x["key"] != "source_topic")).otherwise(F.col("headers"))
    return q.withColumns({"partition": dead_letters.header("source_partition").cast("int"), "offset": at}).withColumn("headers", heads)


def dlq_route(spark, sf_dir):
    d = _letters(spark, sf_dir)
    return d.select("partition", "offset", *[dead_letters.header(k).alias(k) for k in ("source_topic", "replay_count", "error")])


def _split(spark, sf_dir):
    d = _letters(spark, sf_dir)
    return dead_letters.split_replay(d, d.groupBy("partition").agg(F.max("offset").alias("end")))


def dlq_replay_split(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


def dlq_replayed(spark, sf_dir):
    r = dead_letters.replayed(_split(spark, sf_dir)).withColumn("replay_count", dead_letters.header("replay_count").cast("int"))
    return r.select("topic", F.col("key").cast("string").alias("key"), "replay_count")


def dlq_archived(spark, sf_dir):
    return dead_letters.archived(_split(spark, sf_dir)).drop("payload")


def record_keys(spark, sf_dir):
    k = F.concat(F.lit("[ tenant_id, "), F.col("name"), F.lit(" ]"))
    return table(spark, sf_dir, "index_metadata").select("name", text.record_key(k).alias("record_key"))


def index_settings(spark, sf_dir):
    m = F.from_json("metadata", "model string, dim int, distance string, chunk_size int, chunk_overlap int")
    return table(spark, sf_dir, "index_metadata").select("name", *[m[k].alias(k) for k in INDEX_KEYS])


def queries() -> dict:
    names = """doc_source_text doc_text_hash doc_truncate doc_blank doc_chunks doc_vector_ids doc_point_ids doc_enrich_children doc_sync_plan doc_sync_counts
        doc_replace_rows doc_refresh_metadata doc_delete_rows doc_index_versions vec_unusable vec_topk vec_topk_status vec_rerank rag_context vec_stats vec_facets
        vec_tenant_view vec_embed eval_retrieval eval_report eval_golden eval_citations eval_generation_report reconcile_exact reconcile_approx reconcile_totals
        reconcile_history ops_action_counts ops_delay_histogram ops_delay_quantiles ops_rates ops_ledger ops_backlog ops_slot_lag ops_chunks_embedded ops_alerts
        ops_gauges ops_rates_by_action reconcile_preflight dlq_replay_limited cdc_parents_existing vec_sink_sync dlq_route dlq_replay_split dlq_replayed dlq_archived record_keys index_settings"""
    return {n: globals()[n] for n in names.split()}


# --- SQL ---------------------------------------------------------------------------------

_SPACE = r"[\s\v\x{85}\x{1c}-\x{1f}\pZ]+"
_STRIP = lambda t: f"regexp_replace({t}, '^{_SPACE}|{_SPACE}$', '', 'g')"
_DOCS = f"""WITH docs AS (SELECT *, {_STRIP('text')} AS stripped, {_STRIP('text')} = '' AS blank, sha256(text) AS text_hash FROM (
  SELECT tenant_id, 'article' AS source_table, CAST(id AS VARCHAR) AS source_pk, v.title AS title, v.status AS status, concat_ws(chr(10), v.title, v.body) AS text
    FROM (SELECT tenant_id, id, arg_max({{'title': title, 'body': body, 'status': status}}, updated_at) AS v FROM article GROUP BY ALL)
  UNION ALL SELECT tenant_id, 'product', CAST(id AS VARCHAR), v.name, v.status, concat_ws(chr(10), v.name, v.description)
    FROM (SELECT tenant_id, id, arg_max({{'name': name, 'description': description, 'status': status}}, updated_at) AS v FROM product GROUP BY ALL)))
"""


def _windows(source: str, keys: str, size: int = 400, step: int = 350) -> str:
    return f"""SELECT {keys}, CAST(i AS INT) AS chunk_index, substring(stripped, CAST(i * {step} + 1 AS BIGINT), {size}) AS content FROM (
        SELECT *, unnest(range(0, CAST(greatest(ceil((length(stripped) - {size}) / {step}), 0) AS BIGINT) + 1)) AS i FROM {source} WHERE stripped <> '')"""


_CHUNKS = _DOCS + f", chunks AS ({_windows('docs', 'tenant_id, source_table, source_pk, text_hash')}), named AS (SELECT *, concat(tenant_id, ':', source_table, ':', source_pk, ':', chunk_index) AS nm FROM chunks)\n"
_SYNC = _DOCS + """, stored AS (SELECT tenant_id, source_table, source_pk, max(text_hash) AS sh FROM doc_vectors GROUP BY ALL),
sync AS (SELECT tenant_id, source_table, source_pk, CASE WHEN text_hash IS NULL OR blank THEN CASE WHEN sh IS NOT NULL THEN 'deleted' ELSE 'ignored' END
  WHEN sh = text_hash THEN 'metadata_refreshed' ELSE 'upserted' END AS action FROM docs FULL JOIN stored USING (tenant_id, source_table, source_pk))
"""
_HITS = """WITH item AS (SELECT printf('%08d', vec_id) AS vector_id, vec_id, CAST(label AS VARCHAR) AS tenant_id, CAST(embedding AS DOUBLE[]) AS e,
    CASE WHEN vec_id % 3 = 0 THEN 'draft' ELSE 'published' END AS status FROM embeddings),
scored AS (SELECT q.vec_id AS query_id, i.vec_id, i.vector_id, i.status, round(list_cosine_similarity(q.e, i.e), 12) AS s
  FROM item q JOIN item i USING (tenant_id) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vector_id) AS INT) AS rank, round(s, 4) AS score FROM scored)
"""
_EVAL = _HITS + """, want AS (SELECT DISTINCT q.vec_id AS query_id, i.vec_id AS pk FROM item q LEFT JOIN (SELECT * FROM item WHERE vec_id % 11 < 2) i USING (tenant_id) WHERE q.vec_id % 50 = 0),
per AS (SELECT w.query_id, count(w.pk) AS n_expected, CASE WHEN count(w.pk) > 0 THEN count(r.vec_id) FILTER (r.rank <= 5) / count(w.pk) ELSE 0.0 END AS recall, coalesce(1.0 / min(r.rank), 0.0) AS rr
  FROM want w LEFT JOIN (SELECT * FROM ranked WHERE rank <= 20) r ON r.query_id = w.query_id AND r.vec_id = w.pk GROUP BY w.query_id)
"""
_CITE = r"""WITH a AS (SELECT item_id, CASE WHEN item_id % 5 = 0 THEN passage ELSE regexp_replace(passage, '([.。])', '\1 [' || (item_id % 4) || ', 1]', 'g') END AS answer, len(expected_pks) AS n FROM eval_item),
b AS (SELECT *, list_transform(flatten(list_transform(regexp_extract_all(answer, '\[(\d+(?:\s*,\s*\d+)*)\]', 1), lambda m: string_split(m, ','))), lambda x: CAST(trim(x) AS BIGINT)) AS c,
  list_filter(string_split(regexp_replace(trim(answer), '([。！？!?.])\s*', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') AS s FROM a),
m AS (SELECT item_id, CAST(len(c) AS INT) AS n_citations, CAST(len(list_filter(c, lambda x: x BETWEEN 1 AND n)) AS INT) AS n_valid, CAST(len(s) AS INT) AS n_sentences,
  CASE WHEN len(c) > 0 THEN round(len(list_filter(c, lambda x: x BETWEEN 1 AND n)) / len(c), 4) ELSE 0.0 END AS coverage,
  CASE WHEN len(s) > 0 THEN round(len(list_filter(s, lambda x: regexp_matches(x, '\[(\d+(?:\s*,\s*\d+)*)\]'))) / len(s), 4) ELSE 0.0 END AS cited_sentences FROM b)
"""
_KEYS = """WITH src AS (SELECT DISTINCT tenant_id, 'article' AS source_table, CAST(id AS VARCHAR) AS source_pk FROM article UNION SELECT tenant_id, 'product', CAST(id AS VARCHAR) FROM product),
idx AS (SELECT DISTINCT tenant_id, source_table, source_pk FROM doc_vectors),
j AS (SELECT tenant_id, source_table, s.source_pk AS a, i.source_pk AS b FROM src s FULL JOIN idx i USING (tenant_id, source_table, source_pk)),
exact AS (SELECT tenant_id, source_table, count(a) AS source_rows, count(b) AS indexed_pks, count(*) FILTER (b IS NULL) AS missing, count(*) FILTER (a IS NULL) AS orphan,
  count(*) FILTER (a IS NULL OR b IS NULL) AS drift FROM j GROUP BY ALL)
"""
_LOG = """WITH lg AS (SELECT split_part(topic, '.', -1) AS source_table, topic, part_no AS "partition", log_offset AS "offset", op, received_at, (epoch_us(received_at) - ts_ms * 1000) / 1e6 AS delay FROM cdc_to_iceberg)
"""
_BOUNDS = "(VALUES " + ", ".join(f"({b}::DOUBLE)" for b in metrics.BOUNDS) + ", ('inf'::DOUBLE)) bounds(le)"
_HIST = _LOG + f""", hist AS (SELECT source_table, le, count(*) FILTER (greatest(delay, 0.0) <= le) AS n FROM (SELECT * FROM lg WHERE delay IS NOT NULL), {_BOUNDS} GROUP BY ALL),
cum AS (SELECT *, coalesce(lag(le) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS below, max(n) OVER (PARTITION BY source_table) AS total FROM hist WINDOW w AS (PARTITION BY source_table ORDER BY le))
"""
_BACK = """SELECT CAST(sum(e - coalesce(d, 0)) AS BIGINT) AS backlog FROM (SELECT topic, "partition", max("offset") + 1 AS e,
    max("offset") FILTER (received_at < '2025-06-01') + 1 AS d FROM lg GROUP BY 1, 2)"""
_USABLE = """SELECT DISTINCT vector_id, tenant_id, source_table, source_pk, text_hash, metadata FROM doc_vectors WHERE coalesce(len(embedding) = 512
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)), FALSE)"""


def _gauges(minutes: int) -> str:
    return f"""SELECT (SELECT count(*) / ({minutes} * 60.0::DOUBLE) FROM lg WHERE op IS NULL AND received_at > (SELECT max(received_at) FROM lg) - INTERVAL {minutes} MINUTE) AS dead_letter_rate,
        CAST(min(CAST(alive AS INT)) AS INT) AS slot_active, CAST(sum(CAST(alive AS INT)) AS INT) AS up
        FROM (SELECT topic, max(received_at) > (SELECT max(received_at) FROM lg) - INTERVAL 1440 MINUTE AS alive FROM lg GROUP BY 1)"""


_LAG = "SELECT topic, coalesce(max(lsn) - max(lsn) FILTER (received_at < '2025-06-01'), 0) AS lag_bytes FROM cdc_to_iceberg GROUP BY 1"
_DLQ = """WITH d AS (SELECT part_no AS "partition", log_offset AS "offset", msg_key, CASE WHEN log_offset % 10 <> 9 THEN topic END AS source_topic, CAST(log_offset % 7 AS VARCHAR) AS replay_count,
  'cannot reach postgres://app:***@db/x password = ***' AS error FROM cdc_to_iceberg WHERE op IS NULL),
s AS (SELECT *, CASE WHEN source_topic IS NULL THEN 'skip' WHEN CAST(replay_count AS INT) >= 5 THEN 'archive' ELSE 'replay' END AS fate FROM d JOIN (SELECT "partition", max("offset") AS e FROM d GROUP BY 1) USING ("partition") WHERE "offset" < e)
"""


def oracle_sql() -> dict[str, str]:
    key = "tenant_id, source_table, source_pk"
    ns = ids.POINT_NAMESPACE.replace("-", "")
    uuid = f"""(SELECT *, sha1(from_hex('{ns}') || encode(nm)) AS h FROM named)"""
    quantile = "CASE WHEN le = 'inf' THEN lo WHEN n = below THEN le ELSE lo + (le - lo) * (total * q - below) / (n - below) END"
    return {
        "doc_source_text": _DOCS + f"SELECT {key}, text, blank FROM docs",
        "doc_text_hash": _DOCS + f"SELECT {key}, text_hash FROM docs",
        "doc_truncate": "SELECT doc_id, sha256(substring(text, 1, 1000)) AS hash, CAST(length(substring(text, 1, 1000)) AS INT) AS n FROM documents",
        "doc_blank": f"SELECT DISTINCT id, tenant_id, TRUE AS blank FROM article_comment WHERE body IS NULL OR {_STRIP('body')} = ''",
        "doc_chunks": f"WITH d AS (SELECT doc_id, {_STRIP('text')} AS stripped FROM documents) " + _windows("d", "doc_id"),
        "doc_vector_ids": _CHUNKS + f"SELECT {key}, chunk_index, sha256(nm) AS vector_id FROM named",
        "doc_point_ids": _CHUNKS + f"""SELECT sha256(nm) AS vector_id, concat(substring(h, 1, 8), '-', substring(h, 9, 4), '-5', substring(h, 14, 3), '-',
            substring('89ab', CAST(instr('0123456789abcdef', substring(h, 17, 1)) - 1 AS BIGINT) % 4 + 1, 1), substring(h, 18, 3), '-', substring(h, 21, 12)) AS point_id FROM {uuid}""",
        "doc_enrich_children": _DOCS + f""", c AS (SELECT tenant_id, CAST(article_id AS VARCHAR) AS source_pk, string_agg(body, chr(10) ORDER BY id) AS extra FROM
            (SELECT DISTINCT id, tenant_id, article_id, body FROM article_comment WHERE body <> '' AND article_id IS NOT NULL) GROUP BY ALL),
            e AS (SELECT {key}, substring(concat_ws(chr(10), text, extra), 1, 200000) AS t FROM docs LEFT JOIN c USING (tenant_id, source_pk) WHERE source_table = 'article')
            SELECT {key}, sha256(t) AS text_hash, CAST(length(t) AS INT) AS n FROM e""",
        "doc_sync_plan": _SYNC + "SELECT * FROM sync",
        "doc_sync_counts": _SYNC + "SELECT source_table, action, count(*) AS n FROM sync GROUP BY ALL",
        "doc_replace_rows": _SYNC.replace("WITH docs", "WITH docs") + f""", chunks AS ({_windows('docs', key + ', text_hash')})
            SELECT DISTINCT vector_id, text_hash FROM doc_vectors ANTI JOIN (SELECT * FROM sync WHERE action IN ('upserted', 'deleted')) USING ({key})
            UNION ALL SELECT sha256(concat(tenant_id, ':', source_table, ':', source_pk, ':', chunk_index)), text_hash FROM chunks SEMI JOIN (SELECT * FROM sync WHERE action = 'upserted') USING ({key})""",
        "doc_refresh_metadata": _DOCS + f"""SELECT DISTINCT vector_id, CASE WHEN d.source_pk IS NOT NULL THEN d.status ELSE metadata->>'status' END AS status,
            CASE WHEN d.source_pk IS NOT NULL THEN d.title ELSE metadata->>'title' END AS title FROM doc_vectors LEFT JOIN (SELECT * FROM docs WHERE NOT blank) d USING ({key})""",
        "doc_delete_rows": _SYNC + f"SELECT DISTINCT vector_id FROM doc_vectors ANTI JOIN (SELECT * FROM sync WHERE action = 'deleted') USING ({key})",
        "doc_index_versions": _DOCS + """, m AS (SELECT name, CAST(metadata->>'chunk_size' AS BIGINT) AS size, CAST(metadata->>'chunk_size' AS BIGINT) - CAST(metadata->>'chunk_overlap' AS BIGINT) AS step FROM index_metadata)
            SELECT name, CAST(sum(CAST(greatest(ceil((length(stripped) - size) / step), 0) AS BIGINT) + 1) AS BIGINT) AS chunks FROM m, docs WHERE stripped <> '' GROUP BY name""",
        "vec_unusable": """SELECT DISTINCT vector_id, CAST(coalesce(len(embedding), -1) AS INT) AS n FROM doc_vectors WHERE NOT coalesce(len(embedding) = 512
            AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)), FALSE)""",
        "vec_topk": _HITS + "SELECT query_id, rank, vector_id, score FROM ranked WHERE rank <= 5",
        "vec_topk_status": _HITS + """SELECT query_id, CAST(n AS INT) AS rank, vector_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vector_id) AS n FROM ranked WHERE status = 'published') WHERE n <= 5""",
        "vec_rerank": _HITS + """SELECT query_id, CAST(n AS INT) AS rank, vector_id, rerank_score FROM (SELECT *, round((vec_id % 7) / 7.0::DOUBLE, 4) AS rerank_score,
            row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS n FROM ranked WHERE rank <= 12) WHERE n <= 4""",
        "rag_context": _HITS + "SELECT query_id, string_agg('[' || rank || '] T' || vec_id || chr(10) || 'item ' || vec_id, chr(10) || chr(10) ORDER BY rank) AS context FROM ranked WHERE rank <= 4 GROUP BY 1",
        "vec_stats": "SELECT source_table, tenant_id, count(*) AS vectors FROM doc_vectors GROUP BY ALL",
        "vec_facets": "SELECT source_table, count(*) AS vectors FROM doc_vectors WHERE tenant_id = 'default' GROUP BY ALL",
        "vec_tenant_view": "SELECT DISTINCT vector_id, source_pk FROM doc_vectors WHERE tenant_id = 't001'",
        "eval_retrieval": _EVAL + "SELECT query_id, n_expected, round(recall, 6) AS recall, round(rr, 6) AS reciprocal_rank FROM per",
        "eval_report": _EVAL + "SELECT count(*) AS n, round(avg(recall), 6) AS mean_recall, round(avg(rr), 6) AS mean_reciprocal_rank FROM per",
        "eval_golden": f"""SELECT query, tenant_id, e.source_table AS source_table, e.source_pk AS source_pk, EXISTS (SELECT 1 FROM (SELECT tenant_id AS t, 'article' AS s, CAST(id AS VARCHAR) AS p FROM article
            UNION SELECT tenant_id, 'product', CAST(id AS VARCHAR) FROM product) WHERE t = tenant_id AND s = e.source_table AND p = e.source_pk) AS present
            FROM (SELECT query, tenant_id, unnest(expected_pks) AS e FROM eval_item)""",
        "eval_citations": _CITE + "SELECT * FROM m",
        "eval_generation_report": _CITE + "SELECT count(*) AS n, round(avg(coverage), 6) AS mean_coverage, round(avg(cited_sentences), 6) AS mean_cited_sentences FROM m",
        "reconcile_exact": _KEYS + "SELECT * FROM exact",
        "reconcile_approx": _KEYS + """SELECT tenant_id, source_table, source_rows, indexed_pks, greatest(source_rows - indexed_pks, 0) AS missing, greatest(indexed_pks - source_rows, 0) AS orphan,
            abs(source_rows - indexed_pks) AS drift FROM exact""",
        "reconcile_totals": _KEYS + "SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("source_rows", "indexed_pks", "missing", "orphan", "drift")) + ", sum(drift) = 0 AS in_sync FROM exact",
        "reconcile_history": "SELECT tenant_id, source_table, run_no, source_rows, indexed_pks, missing, orphan FROM drift_row QUALIFY row_number() OVER (PARTITION BY tenant_id, source_table ORDER BY run_no DESC) = 1",
        "ops_action_counts": _LOG + "SELECT source_table, op, count(*) AS n FROM lg WHERE op IS NOT NULL GROUP BY ALL",
        "ops_delay_histogram": _HIST + "SELECT source_table, le, n FROM hist",
        "ops_delay_quantiles": _HIST + f"""SELECT source_table, q, round({quantile}, 6) AS seconds FROM cum, (VALUES (0.5::DOUBLE), (0.99::DOUBLE)) qs(q) WHERE n >= total * q
            QUALIFY row_number() OVER (PARTITION BY source_table, q ORDER BY le) = 1""",
        "ops_rates": _LOG + "SELECT time_bucket(INTERVAL 5 MINUTE, received_at, TIMESTAMP '1970-01-01') AS window_start, source_table, round(count(*) / 300.0::DOUBLE, 9) AS rate FROM lg GROUP BY ALL",
        "ops_ledger": 'SELECT topic, part_no AS "partition", max(log_offset) AS last_offset FROM cdc_to_iceberg GROUP BY ALL',
        "ops_backlog": _LOG + _BACK,
        "ops_slot_lag": _LAG,
        "ops_chunks_embedded": _CHUNKS + "SELECT source_table, count(*) AS chunks FROM chunks GROUP BY 1",
        "ops_alerts": _HIST.replace("hist AS (SELECT source_table, le", "hist AS (SELECT 'all' AS source_table, le") + f"""
            SELECT 'delay_p99' AS alert, coalesce((SELECT {quantile} FROM cum, (VALUES (0.99::DOUBLE)) qs(q) WHERE n >= total * q ORDER BY le LIMIT 1) > 60, FALSE) AS firing
            UNION ALL SELECT 'dead_letter_rate', (SELECT dead_letter_rate > 0 FROM ({_gauges(10)})) UNION ALL SELECT 'dead_letter_backlog', coalesce(({_BACK}) > 100, FALSE) UNION ALL SELECT 'slot_inactive', (SELECT slot_active = 0 FROM ({_gauges(10)}))
            UNION ALL SELECT 'slot_lag', (SELECT max(lag_bytes) FROM ({_LAG})) > 268435456 UNION ALL SELECT 'worker_down', (SELECT up = 0 FROM ({_gauges(10)}))""",
        "ops_gauges": _LOG + _gauges(1440),
        "ops_rates_by_action": _LOG + "SELECT time_bucket(INTERVAL 5 MINUTE, received_at, TIMESTAMP '1970-01-01') AS window_start, source_table, coalesce(op, 'dead letter') AS action, round(count(*) / 300.0::DOUBLE, 9) AS rate FROM lg GROUP BY ALL",
        "reconcile_preflight": """WITH s AS (SELECT 'article' AS t, tenant_id, CAST(id AS VARCHAR) AS k FROM article UNION ALL SELECT 'product', tenant_id, CAST(id AS VARCHAR) FROM product)
            SELECT 'source has rows' AS "check", (SELECT count(*) FROM s) > 0 AS ok UNION ALL SELECT 'index has rows', (SELECT count(*) FROM doc_vectors) > 0
            UNION ALL SELECT 'source keys are whole', (SELECT count(*) FROM s WHERE tenant_id IS NULL OR k IS NULL) = 0
            UNION ALL SELECT 'index keys are whole', (SELECT count(*) FROM doc_vectors WHERE tenant_id IS NULL OR source_pk IS NULL) = 0
            UNION ALL SELECT 'index tables are known', NOT EXISTS (SELECT 1 FROM doc_vectors WHERE source_table NOT IN (SELECT t FROM s))""",
        "dlq_replay_limited": _DLQ + 'SELECT "partition", "offset", source_topic, fate FROM s ORDER BY "partition", "offset" LIMIT 20',
        "cdc_parents_existing": feed_sql("comment") + """SELECT DISTINCT tenant_id, source_pk FROM (SELECT coalesce("after"->>'tenant_id', "before"->>'tenant_id') AS tenant_id,
            coalesce("after"->>'article_id', "before"->>'article_id') AS source_pk FROM parsed) SEMI JOIN (SELECT tenant_id, CAST(id AS VARCHAR) AS source_pk FROM article) USING (tenant_id, source_pk)""",
        "vec_sink_sync": _SYNC.replace("FROM doc_vectors", f"FROM ({_USABLE})") + f""", chunks AS ({_windows('docs', key + ', text_hash, status, title')})
            SELECT vector_id, v.text_hash AS text_hash, CASE WHEN action = 'metadata_refreshed' THEN d.status ELSE metadata->>'status' END AS status,
                CASE WHEN action = 'metadata_refreshed' THEN d.title ELSE metadata->>'title' END AS title
            FROM ({_USABLE}) v JOIN sync USING ({key}) LEFT JOIN docs d USING ({key}) WHERE action = 'metadata_refreshed'
            UNION ALL SELECT sha256(concat(tenant_id, ':', source_table, ':', source_pk, ':', chunk_index)), text_hash, status, title FROM chunks SEMI JOIN (SELECT * FROM sync WHERE action = 'upserted') USING ({key})""",
        "dlq_route": _DLQ + 'SELECT "partition", "offset", source_topic, replay_count, error FROM d',
        "dlq_replay_split": _DLQ + "SELECT fate, count(*) AS n FROM s GROUP BY 1",
        "dlq_replayed": _DLQ + "SELECT source_topic AS topic, msg_key AS key, CAST(replay_count AS INT) + 1 AS replay_count FROM s WHERE fate = 'replay'",
        "dlq_archived": _DLQ + 'SELECT source_topic, "partition" AS dlq_partition, "offset" AS dlq_offset, CAST(replay_count AS INT) AS replay_count, error FROM s WHERE fate = \'archive\'',
        "record_keys": "SELECT name, 'tenant_id,' || name AS record_key FROM index_metadata",
        "index_settings": "SELECT name, metadata->>'model' AS model, CAST(metadata->>'dim' AS INT) AS dim, metadata->>'distance' AS distance, CAST(metadata->>'chunk_size' AS INT) AS chunk_size, CAST(metadata->>'chunk_overlap' AS INT) AS chunk_overlap FROM index_metadata",
    }
