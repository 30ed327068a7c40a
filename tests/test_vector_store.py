import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import vectors
from tidemill.operators import dead_letters, documents, envelope
from tidemill.operators.lake import LakeTable
from tidemill.session import fresh_dir
from tidemill.sources.vector_store import VectorStore
from tidemill.streaming.runner import run_lake

DOC = "tenant_id string, source_table string, source_pk string, title string, status string, text string, blank boolean"


def docs(spark, *rows):
    return documents.hashed(spark.createDataFrame([("t", "article", k, "T" + k, s, x, not x) for k, s, x in rows], DOC))


def contents(store):
    return {(r.source_pk, r.chunk_index): (r.content, r.metadata) for r in store.rows().collect()}


def test_rows_are_replaced_refreshed_and_deleted_in_one_commit(spark):
    store, model = VectorStore(spark, fresh_dir(spark, "v"), dim=8, buckets=4), vectors.hashed_words(8)
    assert store.sync(docs(spark, ("1", "a", "x" * 700), ("2", "a", "two"), ("3", "a", "three"), ("4", "a", "")), model, ledger={"c/0": 7}) == {"upserted": 3}
    assert store.ledger() == {"c/0": 7} and len(contents(store)) == 4
    counts = store.sync(docs(spark, ("1", "a", "short now"), ("2", "b", "two"), ("3", "a", "")), model, ledger={"c/0": 5, "c/1": 2})
    assert counts == {"upserted": 1, "metadata_refreshed": 1, "deleted": 1}
    assert store.ledger() == {"c/0": 7, "c/1": 2}  # never less than what is stored
    got = contents(store)
    assert {k: v[0] for k, v in got.items()} == {("1", 0): "short now", ("2", 0): "two"} and '"b"' in got["2", 0][1]
    assert store.sync(docs(spark, ("2", "b", "two")), model, gone=docs(spark, ("1", "a", "y"))) == {"deleted": 1, "metadata_refreshed": 1}
    assert set(contents(store)) == {("2", 0)} and store.manifest()["version"] == 3
    assert store.sync(docs(spark), model) == {} and store.manifest()["version"] == 3  # nothing to say, nothing committed
    assert store.sync(docs(spark), model, ledger={"c/1": 9}) == {} and store.ledger()["c/1"] == 9


def test_unusable_embeddings_commit_nothing(spark):
    path = fresh_dir(spark, "v")
    store = VectorStore(spark, path, dim=8)
    for model in (vectors.hashed_words(7), lambda texts: np.full((len(texts), 8), np.nan)):
        with pytest.raises(Exception, match="unusable embedding of"):
            store.sync(docs(spark, ("1", "a", "one")), model)
    assert store.versions() == []
    store.sync(docs(spark, ("1", "a", "one")), vectors.hashed_words(8))
    with pytest.raises(ValueError, match="vectors of 8"):
        VectorStore(spark, path, dim=16)
    with pytest.raises(ValueError, match="not empty"):
        store.load(store.rows())


def test_two_levels_of_parents(spark):
    p = spark.sql("SELECT named_struct('tenant_id', 't', 'article_id', x) AS after, named_struct('tenant_id', 't', 'article_id', x) AS before FROM VALUES (1L), (2L), (9L), (NULL) AS v(x)")
    parents = spark.createDataFrame([("t", 1, 10), ("t", 2, 20), ("u", 9, 10)], "tenant_id string, id bigint, up bigint")
    assert sorted(r.source_pk for r in documents.parent_keys(p, "article_id", parents).collect()) == ["1", "2"]
    upper = spark.createDataFrame([("t", 10)], "tenant_id string, id bigint")
    assert [r.source_pk for r in documents.parent_keys(p, "article_id", parents, "up", upper).collect()] == ["10"]


def test_refused_batches_are_set_aside(spark):
    path = fresh_dir(spark, "s")
    row = '{"op":"u","after":{"id":1,"tenant_id":"t"},"source":{"lsn":%d}}'
    two = [("cdc.public.article", p, o, b"1", (row % o).encode()) for p, o in ((0, 1), (1, 2))]
    good = ("cdc.public.product", 0, 3, b"1", (row % 3).encode())
    schema = "topic string, partition int, offset bigint, key binary, value binary"
    spark.createDataFrame([*two, good], schema).coalesce(1).write.parquet(f"{path}/in")
    tables = {n: LakeTable(spark, f"{path}/{n}", n, buckets=2) for n in ("article", "product")}
    run_lake(spark, {"path": f"{path}/in"}, tables, f"{path}/cp", quarantine=f"{path}/dlq", wait=0.0).awaitTermination()
    letters = spark.read.parquet(f"{path}/dlq/article-*").select("*", dead_letters.header("error").alias("error"), dead_letters.header("source_offset").alias("at")).collect()
    assert sorted(r["at"] for r in letters) == ["1", "2"] and all("several partitions" in r.error for r in letters)
    assert tables["product"].current().count() == 1 and tables["article"].versions() == []
    assert envelope.of_table(spark.read.parquet(f"{path}/in"), "product").where(F.col("offset") == 3).count() == 1
