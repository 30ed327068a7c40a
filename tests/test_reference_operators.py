import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.functions import ids, text, vectors
from tidemill.model import TABLES, Settings, TableSpec, index_problems, schema_problems
from tidemill.operators import dead_letters, documents, envelope, metrics, quality, reconcile, search
from tidemill.operators.lake import LakeTable, probe_arguments
from tidemill.session import fresh_dir
from tidemill.sources import golden, messages
from tidemill.streaming.runner import run_lake


def scalar(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col(F.col("x"))).first()[0]


@pytest.mark.parametrize("t", ["", "  　\n", "short", "x" * 400, "ab " * 400, "中文" * 700, "a" * 1000])
def test_windows_rebuild(spark, t):
    w, s = scalar(spark, text.windows, t), t.strip()
    assert (w == []) if not s else (w[0] + "".join(x[50:] for x in w[1:]) == s and all(len(x) <= 400 for x in w))


def test_windows_null_and_bad_overlap(spark):
    assert scalar(spark, text.windows, None) is None
    with pytest.raises(ValueError):
        text.windows(F.col("x"), 50, 50)


def test_ids(spark):
    df = spark.createDataFrame([("t1", "article", "7", 0), ("租户", "product", "12", 3)], "t string, s string, p string, c int")
    ns = uuid.UUID(ids.POINT_NAMESPACE)
    for r in df.select("*", ids.vector_id(*map(F.col, "tspc")).alias("v"), ids.point_id(*map(F.col, "tspc")).alias("u")).collect():
        import hashlib

        name = f"{r.t}:{r.s}:{r.p}:{r.c}"
        assert r.v == hashlib.sha256(name.encode()).hexdigest() and r.u == str(uuid.uuid5(ns, name))


def test_citations_and_sentences(spark):
    assert scalar(spark, text.citations, "a [1, 2]. b [2][10] [x]") == [1, 2, 2, 10]
    assert scalar(spark, text.sentences, "One. Two! 三。四？ ") == ["One.", "Two!", "三。", "四？"]
    assert scalar(spark, text.citations, "none") == []


def test_redact_and_keys(spark):
    assert scalar(spark, text.redact, "password = abc at postgres://u:pw@h/db") == "password = *** at postgres://u:***@h/db"
    assert scalar(spark, text.redact, "GET /x?token=a1b2&page=2 pwd='two words' API_KEY: \"k\"") == "GET /x?token=***&page=2 pwd=*** API_KEY: ***"
    assert scalar(spark, text.redact, "https://h/p?a=b@c and passwords change") == "https://h/p?a=b@c and passwords change"
    assert scalar(spark, text.record_key, "[tenant_id, id]") == "tenant_id,id" and scalar(spark, text.record_key, None) == ""


def test_document_text_keeps_empty_fields(spark):
    df = spark.createDataFrame([("0", ""), (None, "x"), ("", "x"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(text.document_text(F.col("a"), F.col("b"))).collect()] == ["0\n", "x", "\nx", ""]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([nan, 1.0],), ([inf, 1.0],), ([1.0],), (None,), ([None, 1.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.is_usable(F.col("v"), 2)).collect()] == [True, False, False, False, False, False, False]
    assert df.select(vectors.cosine(F.col("v"), F.col("v"))).first()[0] == pytest.approx(1)


def test_embedding_plug_in(spark):
    df = spark.createDataFrame([("alpha",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(vectors.embed(F.col("t"), vectors.hashed_words(8), batch=1)).collect()]
    assert got[1] is None and sum(x * x for x in got[0]) == pytest.approx(1)


def test_settings_and_schemas(spark):
    Settings().check()
    with pytest.raises(ValueError, match="overlap.*positive.*backend"):
        Settings(chunk_overlap=400, dim=0, backend="x").check()
    assert Settings().problems({"a": TableSpec("a")}) == ["a: fields must not be empty"]
    assert schema_problems(TABLES["article"], spark.createDataFrame([], "id bigint, title string").schema) == ["article: no column body", "article: no column tenant_id"]
    assert index_problems({"model": "m", "dim": 3}, {"model": "n", "dim": 3})[-1] == "model is 'm', wanted 'n'"


def test_probe_arguments():
    assert [probe_arguments(a) for a in ([], ["7"], ["t", "7"])] == [("default", None), ("default", "7"), ("t", "7")]


MSG = "topic string, partition int, offset bigint, key binary, value binary"


def message(off, body, part=0):
    return ("cdc.public.article", part, off, None, None if body is None else bytearray(body.encode()))


def art(i, title, tenant='"t"', body='"b"'):
    return f'{{"id":{i},"tenant_id":{tenant},"title":"{title}","body":{body},"status":"s","updated_at":"u","extra":1}}'


ROWS = [
    message(1, f'{{"op":"c","before":null,"after":{art(1, "one")},"ts_ms":5,"source":{{"lsn":100}}}}'),
    message(2, None),
    message(3, "no json"),
    message(4, '{"after":null}'),
    message(5, f'{{"op":"u","before":{art(1, "one", body=chr(34) + "kept" + chr(34))},"after":{art(1, "two", body=chr(34) + "__debezium_unavailable_value" + chr(34))},"source":{{"lsn":101}}}}'),
    message(6, f'{{"op":"c","before":null,"after":{art(2, "x", "null")},"ts_ms":7}}'),
    message(7, f'{{"op":"d","before":{art(3, "y")},"after":null,"ts_ms":8}}'),
    message(8, '{"op":"d","before":null,"after":null,"ts_ms":9}'),
]


def test_envelope(spark, rows):
    row = envelope.ROWS["article"]
    flat = envelope.flatten(envelope.parse(spark.createDataFrame(ROWS, MSG), row), row)
    got = {r.offset: r for r in flat.collect()}
    assert sorted(got) == [1, 5, 6, 7]
    assert got[5].body == "kept" and got[6].tenant_id == "__unknown__" and got[7].is_deleted
    assert got[1].event_pos == "%020d:%020d" % (100, 1) and got[6].position == 7
    assert sorted((r.id, r.title) for r in envelope.latest(flat).where("op <> 'd'").collect()) == [(1, "two"), (2, "x")]


def test_partition_guard(spark):
    row = envelope.ROWS["article"]
    bad = [message(1, f'{{"op":"c","after":{art(1, "a")}}}', 0), message(2, f'{{"op":"u","after":{art(1, "b")}}}', 1)]
    with pytest.raises(ValueError, match="t/1"):
        envelope.assert_one_partition(envelope.flatten(envelope.parse(spark.createDataFrame(bad, MSG), row), row))


def test_changelog(spark):
    row = envelope.ROWS["article"]
    c = envelope.changelog(envelope.parse(spark.createDataFrame(ROWS, MSG), row), row)
    assert sorted((r.offset, r.sign, r.id) for r in c.collect()) == [(1, 1, 1), (5, -1, 1), (5, 1, 1), (6, 1, 2), (7, -1, 3)]


def test_lake_and_stream_agree(spark, rows):
    base, t = fresh_dir(spark, "s"), LakeTable(spark, fresh_dir(spark, "l"), "article", buckets=2)
    for n, r in enumerate(ROWS):
        spark.createDataFrame([r], MSG).coalesce(1).write.mode("append").parquet(f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        run_lake(spark, {"path": f"{base}/in", "files_per_batch": 3}, {"article": t}, f"{base}/cp", name=f"q{base[-6:]}").awaitTermination()
    assert sorted((r.tenant_id, r.id, r.title, r.body) for r in t.current().collect()) == [("__unknown__", 2, "x", "b"), ("t", 1, "two", "kept")]
    assert t.probe("t", 1) == "s" and t.probe("t", 9) == "ABSENT" and t.probe("t") == "1"
    late = message(9, f'{{"op":"u","before":null,"after":{art(1, "stale")},"source":{{"lsn":50}}}}')
    t.apply(spark.createDataFrame([late], MSG))
    assert t.current().where("id = 1").first().title == "two"
    assert t.compact() >= 1 and t.current().count() == 2


def test_bounded_batch_read(spark):
    p = fresh_dir(spark, "b")
    spark.createDataFrame(ROWS, MSG).write.parquet(p)
    assert messages.read_batch(spark, {"path": p}).count() == 8
    assert messages.read_batch(spark, {"path": p}, {"cdc.public.article": {0: 4}}).count() == 3
    assert messages.kafka_options("h:9", ["article", "product"])["subscribePattern"] == r"cdc\.public\.(article|product)"


def test_enrichment_is_by_tenant_and_order(spark):
    kids = spark.createDataFrame([(2, "t", 1, "b"), (1, "t", 1, "a"), (3, "u", 1, "no"), (4, "t", 1, ""), (5, "t", 1, None), (6, "t", None, "x")], "id int, tenant_id string, article_id int, body string")
    docs = spark.createDataFrame([("t", "article", "1", "T"), ("t", "article", "2", "U")], "tenant_id string, source_table string, source_pk string, text string")
    got = {r.source_pk: r.text for r in documents.enriched(docs, documents.child_texts(kids, "article_id", "body")).collect()}
    assert got == {"1": "T\na\nb", "2": "U"}


def test_plan_sync(spark):
    docs = spark.createDataFrame([("t", "a", "1", "h1", False), ("t", "a", "2", "h2", False), ("t", "a", "3", "h", True), ("t", "a", "5", "h", True)], "tenant_id string, source_table string, source_pk string, text_hash string, blank boolean")
    stored = spark.createDataFrame([("t", "a", "1", "h1"), ("t", "a", "3", "x"), ("t", "a", "4", "x")], "tenant_id string, source_table string, source_pk string, stored_hash string")
    got = {r.source_pk: r.action for r in documents.plan_sync(docs, stored).collect()}
    assert got == {"1": "metadata_refreshed", "2": "upserted", "3": "deleted", "4": "deleted", "5": "ignored"}


def test_search_ranks_and_isolation(spark):
    items = spark.createDataFrame(
        [("a", "t", [1.0, 0.0]), ("b", "t", [1.0, 0.0]), ("c", "t", [0.0, 1.0]), ("z", "u", [1.0, 0.0])], "vector_id string, tenant_id string, embedding array<float>"
    ).selectExpr("*", "'x' AS source_table", "vector_id AS source_pk", "0 AS chunk_index", "vector_id AS content", """'{"status":"s","title":null}' AS metadata""")
    q = spark.createDataFrame([(1, "t", [2.0, 0.0])], "query_id int, tenant_id string, vector array<float>")
    hits = search.top_k(q, items, 3)
    assert [(r.vector_id, r.rank, r.score) for r in hits.orderBy("rank").collect()] == [("a", 1, 1.0), ("b", 2, 1.0), ("c", 3, 0.0)]
    assert search.top_k(q, items, 3, status="other").count() == 0
    re = search.rerank(hits, F.when(F.col("vector_id") == "c", 0.9).otherwise(0.1), 2)
    assert [r.vector_id for r in re.orderBy("new_rank").collect()] == ["c", "a"]
    assert search.contexts(search.numbered(hits)).first().context.startswith("[1] \na\n\n[2] \nb")
    assert search.tenant_view(items, None).count() == 0
    with pytest.raises(PermissionError):
        search.tenant_of_key({"k": "t"}, "no")
    assert search.key_of_tenant({"k1": "t", "k2": "t"}) == {"t": "k1"}


def test_retrieval_measures(spark):
    hits = spark.createDataFrame([(1, 1, "a", "9"), (1, 2, "a", "1"), (1, 3, "a", "1"), (2, 3, "a", "5"), (3, 1, "a", "x")], "query_id int, rank int, source_table string, source_pk string")
    exp = spark.createDataFrame([(1, "a", "1"), (1, "a", "2"), (2, "a", "5"), (4, "a", "7")], "query_id int, source_table string, source_pk string")
    got = {r.query_id: (r.recall, round(r.reciprocal_rank, 3)) for r in quality.retrieval(hits, exp, 2).collect()}
    assert got == {1: (0.5, 0.5), 2: (0.0, 0.333), 4: (0.0, 0.0)}
    assert tuple(quality.means(spark.createDataFrame([], "x double"), "x").first()) == (0, 0.0)


def test_citation_measures(spark):
    df = spark.createDataFrame([("A [1]. B [5].", [1, 2]), ("none.", [1]), ("", [1])], "a string, n array<bigint>")
    got = [(r.n_citations, r.n_valid, r.coverage, r.cited_sentences) for r in quality.citation_measures(df, F.col("a"), F.col("n")).collect()]
    assert got == [(2, 1, 0.5, 1.0), (0, 0, 0.0, 0.0), (0, 0, 0.0, 0.0)]


def test_reconcile(spark, rows):
    k = "tenant_id string, source_table string, source_pk string"
    src = spark.createDataFrame([("t", "a", "1"), ("t", "a", "2"), ("t", "a", "2")], k)
    idx = spark.createDataFrame([("t", "a", "2"), ("t", "a", "3"), ("t", "a", "3"), ("u", "a", "1")], k)
    assert rows(reconcile.exact(src, idx)) == [("t", "a", 2, 2, 1, 1, 2), ("u", "a", 0, 1, 0, 1, 1)]
    assert rows(reconcile.approximate(src, idx)) == [("t", "a", 2, 2, 0, 0, 0), ("u", "a", 0, 1, 0, 1, 1)]
    assert tuple(reconcile.totals(reconcile.exact(src.limit(0), idx.limit(0))).first()) == (0, 0, 0, 0, 0, True)


def test_histogram_and_alerts(spark):
    log = spark.createDataFrame([(-1.0,), (0.3,), (70.0,), (5000.0,), (None,)], "d double")
    h = metrics.delay_histogram(log, F.col("d"))
    assert {r.le: r.n for r in h.collect()}[0.1] == 1 and h.orderBy(F.desc("le")).first().n == 4
    assert metrics.histogram_quantile(h, 0.99).first()[0] == 1800.0
    assert metrics.histogram_quantile(h, 0.5).first()[0] == pytest.approx(0.5)
    g = spark.createDataFrame([(61.0, 0.0, 101, 1, None, 1)], "delay_p99 double, dead_letter_rate double, dead_letter_backlog int, slot_active int, slot_lag_bytes bigint, up int")
    assert {r.alert for r in metrics.alerts(g).where("firing").collect()} == {"delay_p99", "dead_letter_backlog"}


def test_ledger_and_backlog(spark, rows):
    log = spark.createDataFrame([("t", 0, 5), ("t", 0, 3), ("t", 1, 1)], "topic string, partition int, offset bigint")
    old = spark.createDataFrame([("t", 0, 9)], "topic string, partition int, last_offset bigint")
    assert rows(metrics.ledger(log, old)) == [("t", 0, 9), ("t", 1, 1)]
    ends = spark.createDataFrame([(0, 10), (1, 4)], "partition int, end bigint")
    assert metrics.backlog(ends, spark.createDataFrame([(0, 7)], "partition int, last bigint")).first()[0] == 7


def test_dead_letters(spark):
    m = spark.createDataFrame([("src", 0, 1, None, bytearray(b"v"))], MSG)
    q = dead_letters.to_quarantine(m, F.lit("password=x " + "e" * 900), "dlq").withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")})
    ends = spark.createDataFrame([(0, 5)], "partition int, end bigint")
    s = dead_letters.split_replay(q, ends)
    r = s.first()
    assert (r.fate, r.replay_count, len(r.error), r.error[:12]) == ("replay", 0, 500, "password=***")
    again = dead_letters.replayed(s).withColumns({"partition": F.lit(0), "offset": F.lit(1).cast("bigint")})
    assert again.select(dead_letters.header("replay_count")).first()[0] == "1" and again.first().topic == "src"
    assert dead_letters.split_replay(again, ends, max_replays=1).first().fate == "archive"
    none = q.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))
    assert dead_letters.split_replay(none, ends).first().fate == "skip"
    assert dead_letters.split_replay(q.withColumn("offset", F.lit(5).cast("bigint")), ends).count() == 0


def test_golden(spark, tmp_path):
    p = tmp_path / "g.jsonl"
    p.write_text('{"query":"q","expected_pks":[{"source_table":"a","source_pk":"1"}]}\n\n{"query":"r","tenant_id":"t","expected_pks":[]}\n')
    assert [(r.query_id, r.tenant_id) for r in golden.read_golden(spark, str(p)).collect()] == [(1, "default"), (3, "t")]
    p.write_text('{"query":"q","expected_pks":[]}\nbad\n')
    with pytest.raises(ValueError, match="line 2"):
        golden.read_golden(spark, str(p))
    p.write_text("\n")
    with pytest.raises(ValueError):
        golden.read_golden(spark, str(p))


def test_lake_refuses_split_keys(spark):
    """The guard fails the batch before anything is committed."""
    from tidemill.operators.lake import LakeTable
    from tidemill.session import fresh_dir

    row = '{"op":"u","after":{"id":1,"tenant_id":"t"},"source":{"lsn":%d}}'
    two = [("cdc.public.article", p, o, b"1", (row % o).encode()) for p, o in ((0, 1), (1, 2))]
    t = LakeTable(spark, fresh_dir(spark, "lake"), "article", buckets=2)
    with pytest.raises(ValueError, match="several partitions: t/1: 0 and 1"):
        t.apply(spark.createDataFrame(two, MSG))
    assert t.versions() == []
    assert t.apply(spark.createDataFrame(two[:1], MSG)) == 1
    loose = LakeTable(spark, fresh_dir(spark, "lake"), "article", buckets=2, guard=False)
    assert loose.apply(spark.createDataFrame(two, MSG)) == 1


def test_production_secrets():
    from tidemill.model import Settings

    bad = lambda v: Settings(production=True, secrets={"dsn": v}, placeholders=("replace me",)).problems()
    assert bad("postgres://app:app@h/db") and bad("") and bad("replace me") and not bad("postgres://app:Kq83-x@h/db")
