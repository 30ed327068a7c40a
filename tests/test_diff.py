from tidemill.operators import diff

S = "k string, t string, v string, w string"


def found(spark, left, right, fields=("v", "w")):
    l, r = spark.createDataFrame(left, S), spark.createDataFrame(right, S)
    return sorted(tuple(x) for x in diff.diff_cells(l, r, ["k", "t"], fields).collect())


def test_kinds_of_difference(spark):
    left = [("1", "a", "x", "y"), ("2", "a", "x", "y"), ("3", "a", None, "y")]
    right = [("1", "a", "x", "z"), ("3", "a", None, "y"), ("4", "a", "x", "y")]
    assert found(spark, left, right) == [("1", "a", "w"), ("2", "a", "missing"), ("4", "a", "orphan")]


def test_any_row_of_a_key_counts(spark):
    left = [("1", "a", "x", "y")]
    right = [("1", "a", "x", "y"), ("1", "a", "x", "y"), ("1", "a", "q", "y")]
    assert found(spark, left, right) == [("1", "a", "v")]


def test_null_differs_from_value_and_equals_null(spark):
    assert found(spark, [("1", "a", None, None)], [("1", "a", "", None)]) == [("1", "a", "v")]
    assert found(spark, [(None, "a", "x", "y")], [(None, "a", "x", "y")]) == []


def test_empty_sides(spark):
    assert found(spark, [], []) == []
    assert found(spark, [("1", "a", "x", "y")] * 2, []) == [("1", "a", "missing")]
    assert found(spark, [], [("1", "a", "x", "y")]) == [("1", "a", "orphan")]


def test_extra_columns_and_names_of_results(spark):
    l = spark.createDataFrame([("1", "x", "q")], "k string, v string, missing string")
    r = spark.createDataFrame([("1", "x", 5)], "k string, v string, orphan int")
    assert diff.diff_cells(l, r, ["k"], ["v"]).collect() == []


def test_hot_key(spark):
    left = spark.range(20000).selectExpr("'h' AS k", "'x' AS v")
    right = spark.range(20000).selectExpr("'h' AS k", "if(id = 7, 'y', 'x') AS v")
    assert [tuple(r) for r in diff.diff_cells(left, right, ["k"], ["v"]).collect()] == [("h", "v")]


def test_latest_per_key_nulls_and_ties(spark):
    df = spark.createDataFrame([("1", None, "old"), ("1", 5, "b"), ("1", 5, "c"), ("2", None, "n"), (None, 1, "z")], "k string, at int, v string")
    got = {r.k: r.v for r in diff.latest_per_key(df, ["k"], ["at"], ["v"]).collect()}
    assert got == {"1": "c", "2": "n", None: "z"}


def test_drift_counts(spark):
    f = spark.createDataFrame([("a", "missing"), ("a", "orphan"), ("a", "v"), ("b", "v")], "g string, field_name string")
    assert sorted(tuple(r) for r in diff.drift_counts(f, ["g"]).collect()) == [("a", 1, 1), ("b", 0, 0)]
