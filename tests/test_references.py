from tidemill.operators import references as ref

P = "tenant_id string, id bigint"
C = "tenant_id string, pid bigint, ck string, at timestamp_ntz"


def setup(spark, parents, children):
    import datetime

    rows = [(t, p, k, a and datetime.datetime.fromisoformat(a)) for t, p, k, a in children]
    par = ref.parent_rows({"p": (spark.createDataFrame(parents, P), "id")})
    kid = ref.child_rows([ref.Child("c", spark.createDataFrame(rows, C), "'p'", "pid", "ck", "at")])
    return par, kid


def test_orphans_by_period(spark, rows):
    par, kid = setup(spark, [("a", 1), ("b", 2)], [("a", 1, "k1", "2025-01-02"), ("a", 2, "k2", "2025-01-03"), ("a", 2, "k3", None), ("b", 2, "k4", None), ("a", None, "k5", None)])
    assert rows(ref.orphan_children(par, kid)) == [("c", "k2", "2025-01"), ("c", "k3", "unknown")]
    assert rows(ref.orphan_report(par, kid)) == [("p", "2025-01", 1, 1), ("p", "unknown", 1, 1)]


def test_repeats_nulls_and_empty(spark, rows):
    par, kid = setup(spark, [], [("a", 9, "k", "2025-02-01"), ("a", 9, "k", "2025-02-01"), (None, 9, "n", None)])
    assert rows(ref.orphan_children(par, kid)) == [("c", "k", "2025-02"), ("c", "n", "unknown")]
    par, kid = setup(spark, [("a", 1)], [])
    assert rows(ref.orphan_children(par, kid)) == []


def test_hot_parent_key(spark):
    par = ref.parent_rows({"p": (spark.createDataFrame([("a", 1)], P), "id")})
    kids = spark.range(30000).selectExpr("'a' AS tenant_id", "if(id % 3 = 0, 77, if(id % 3 = 1, 1, id + 100)) AS pid", "cast(id AS string) AS ck", "timestamp_ntz'2025-03-01' AS at")
    kid = ref.child_rows([ref.Child("c", kids, "'p'", "pid", "ck", "at")])
    assert ref.orphan_children(par, kid).count() == 20000
    assert ref.orphan_report(par, kid).first().lost_refs == 20000


def test_table_named_by_a_column(spark, rows):
    par = ref.parent_rows({"p": (spark.createDataFrame([("a", 1)], P), "id"), "q": (spark.createDataFrame([("a", 2)], P), "id")})
    kids = spark.createDataFrame([("a", "p", "1", "x1"), ("a", "q", "1", "x2"), ("a", "q ", "2", "x3"), ("a", "q", "02", "x4"), ("a", None, "2", "x5")], "tenant_id string, t string, pk string, ck string")
    kid = ref.child_rows([ref.Child("c", kids, "t", "pk", "ck", "timestamp_ntz'2025-01-01'")])
    assert [r[1] for r in rows(ref.orphan_children(par, kid))] == ["x2", "x3", "x4", "x5"]
