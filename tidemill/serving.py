"""Search and cited answers for sets of questions.

The tenant comes from the access key, never from the question. Models are plug-ins: a function
from texts to vectors, an optional reranker, an optional writer of answers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import vectors
from tidemill.operators import search
from tidemill.session import ship

NO_ANSWER = "The knowledge base has nothing on this."
QUERY_PREFIX = ""


@dataclass(frozen=True)
class Request:
    """Bounds of what may be asked for; all problems are reported at once."""

    top_k: int = 5
    top_n: int = 4
    status: str | None = None
    rerank: bool = False

    def check(self) -> None:
        bad = [m for ok, m in ((1 <= self.top_k <= 50, "top_k must be 1 to 50"), (1 <= self.top_n <= 10, "top_n must be 1 to 10")) if not ok]
        if bad:
            raise ValueError("; ".join(bad))


def hits(questions: DataFrame, items: DataFrame, keys: dict[str, str], model: Callable[[list[str]], np.ndarray], request: Request, score: Column | None = None, prefix: str = QUERY_PREFIX) -> DataFrame:
    """The top_k hits of every question (query_id, access_key, text); with a score, the best top_n by it.

    A question with a missing or unknown key is refused."""
    request.check()
    ship(questions.sparkSession)
    known = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv]) if keys else F.create_map()
    if questions.where(F.col("access_key").isNull() | ~F.col("access_key").isin(list(keys))).limit(1).count():
        raise PermissionError("unknown key")
    q = questions.select("query_id", known[F.col("access_key")].alias("tenant_id"), vectors.embed(F.col("text"), model, prefix=prefix).alias("vector"))
    found = search.top_k(q, items, request.top_k, request.status)
    if request.rerank and score is not None:
        return search.rerank(found, score, request.top_n).drop("rank").withColumnRenamed("new_rank", "rank")
    return found


def answers(questions: DataFrame, found: DataFrame, write: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(query_id, answer, context): ``write`` makes an answer of question and context; without hits a fixed one.

    Nothing leaves the session unless the given ``write`` sends it."""
    ctx = search.contexts(search.numbered(found))
    j = questions.select("query_id", "text").join(ctx, "query_id", "left")
    answer = write(F.col("text"), F.col("context")) if write else F.lit(None).cast("string")
    return j.select("query_id", F.when(F.col("context").isNull(), NO_ANSWER).otherwise(answer).alias("answer"), F.coalesce("context", F.lit("")).alias("context"))
