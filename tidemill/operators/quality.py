"""Retrieval and citation measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text


def retrieval(hits: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """Per query: recall among the first k, and the reciprocal rank of the first hit among all.

    hits: query_id, rank, source_table, source_pk; expected: query_id, source_table, source_pk. An
    expected row found in several chunks counts once for recall; nothing expected gives 0."""
    e = expected.select("query_id", "source_table", "source_pk").distinct()
    want = e.groupBy("query_id").agg(F.count(F.when(F.col("source_pk").isNotNull(), 1)).alias("n_expected"))
    found = hits.join(e, ["query_id", "source_table", "source_pk"], "left_semi").groupBy("query_id").agg(
        F.count_distinct(F.when(F.col("rank") <= k, F.struct("source_table", "source_pk"))).alias("n_found"), F.min("rank").alias("first")
    )
    recall = F.when(F.col("n_expected") > 0, F.coalesce("n_found", F.lit(0)) / F.col("n_expected")).otherwise(0.0)
    return want.join(found, "query_id", "left").select("query_id", "n_expected", recall.alias("recall"), F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"))


def means(df: DataFrame, *cols: str) -> DataFrame:
    """The number of rows and the mean of each column, 0 over none."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in cols])


def citation_measures(answers: DataFrame, answer: Column, source_numbers: Column) -> DataFrame:
    """Adds n_citations, n_valid, n_sentences, coverage and cited_sentences (both 0 over none).

    source_numbers: the numbers a citation may name."""
    c, s = text.citations(answer), text.sentences(answer)
    d = answers.withColumns({"_c": c, "_s": s, "_n": source_numbers})
    valid = F.size(F.filter("_c", lambda x: F.array_contains(F.col("_n"), x)))
    cited = F.size(F.filter("_s", lambda x: x.rlike(text.CITATION)))
    share = lambda a, b: F.when(b > 0, F.round(a / b, 4)).otherwise(0.0)
    return d.withColumns({
        "n_citations": F.size("_c"), "n_valid": valid, "n_sentences": F.size("_s"),
        "coverage": share(valid, F.size("_c")), "cited_sentences": share(cited, F.size("_s")),
    }).drop("_c", "_s", "_n")
