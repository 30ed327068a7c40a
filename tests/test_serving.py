import pytest
from pyspark.sql import functions as F

from tidemill import serving
from tidemill.__main__ import main
from tidemill.functions import vectors
from tidemill.operators import retry
from tidemill.operators.lake import LakeTable
from tidemill.session import fresh_dir


def test_retry_policy():
    waits, left = [], [ConnectionError(), ConnectionError(), ValueError(), ValueError(), ValueError("last")]

    def step():
        raise left.pop(0)

    assert str(retry.run(step, lambda e: e, sleep=waits.append)) == "last" and waits == [2, 4, 1, 2]
    assert retry.wait_before(9, True) == 30 and retry.run(lambda: 5, None) == 5
    assert [retry.status_of_failure(s) for s in (422, 429, 502, None)] == [400, 503, 503, 503]


def test_search_and_answers(spark):
    model = vectors.hashed_words(16)
    items = spark.createDataFrame([("v1", "t", "red pump"), ("v2", "t", "blue box"), ("v3", "u", "red pump")], "vector_id string, tenant_id string, content string").selectExpr("*", "'article' AS source_table", "vector_id AS source_pk", "0 AS chunk_index", "'{\"title\":\"T\",\"status\":\"s\"}' AS metadata")
    items = items.withColumn("embedding", vectors.embed(F.col("content"), model))
    q = spark.createDataFrame([(1, "key-t", "red pump"), (2, "key-w", "red pump")], "query_id int, access_key string, text string")
    keys = {"key-t": "t", "key-w": "w"}
    found = serving.hits(q, items, keys, model, serving.Request(top_k=1))
    assert [(r.query_id, r.vector_id) for r in found.collect()] == [(1, "v1")]
    a = {r.query_id: (r.answer, r.context) for r in serving.answers(q, found, lambda t, c: F.concat(t, F.lit(": [1]"))).collect()}
    assert a == {1: ("red pump: [1]", "[1] T\nred pump"), 2: (serving.NO_ANSWER, "")}
    with pytest.raises(PermissionError):
        serving.hits(q, items, {"key-t": "t"}, model, serving.Request())
    with pytest.raises(ValueError, match="top_k.*top_n"):
        serving.hits(q, items, keys, model, serving.Request(top_k=51, top_n=0))


def test_command_line(spark, capsys):
    p, store = fresh_dir(spark, "m"), fresh_dir(spark, "store")
    body = '{"op":"c","before":null,"after":{"id":1,"tenant_id":"t","title":"a","status":"ok"},"source":{"lsn":1}}'
    spark.createDataFrame([("cdc.public.article", 0, 1, None, bytearray(body.encode()))], "topic string, partition int, offset bigint, key binary, value binary").write.parquet(p)
    assert main(["lake-batch", p, store, "article"]) == 0 and main(["lake-stream", p, store, "article"]) == 0
    main(["lake-get", store, "article", "t", "1"])
    assert capsys.readouterr().out.strip().endswith("ok")
    assert main(["lake-maintain", store, "article", "--keep", "1"]) == 0
    assert LakeTable(spark, f"{store}/article", "article").versions()[-1] >= 2
