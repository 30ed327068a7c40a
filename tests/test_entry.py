import __spark_entry__ as entry


def test_registry():
    q, sql = entry.queries(), entry.oracle_sql()
    assert {"p3_found", "p4_found", "p5_found"} <= set(q) and set(sql) <= set(q)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["source_table", "id", "tenant_id", "ts_ms"] and df.count() > 0
