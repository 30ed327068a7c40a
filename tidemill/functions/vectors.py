"""Vector functions as Column expressions, and the embedding plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double; null for an all-zero vector or unequal lengths."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n)


def is_usable(v: Column, dim: int) -> Column:
    """Of the right length, all entries finite numbers, not all zero."""
    d = lambda x: x.cast("double")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(d(x)) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def is_finite(v: Column) -> Column:
    """No entry is null, not a number or infinite."""
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def embed(text: Column, model: Callable[[list[str]], np.ndarray], batch: int = 64, prefix: str = "") -> Column:
    """Vectors of texts by a model called with at most ``batch`` texts, scaled to length 1.
    The prefix is for queries. Null texts get null."""

    @F.pandas_udf("array<float>")
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            out, texts = [None] * len(b), [(i, prefix + t) for i, t in enumerate(b) if t is not None]
            for k in range(0, len(texts), batch):
                part = texts[k : k + batch]
                v = np.asarray(model([t for _, t in part]), dtype=np.float64)
                v = v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)
                for (i, _), x in zip(part, v):
                    out[i] = x.astype(np.float32).tolist()
            yield pd.Series(out, dtype=object)

    return f(text)


def hashed_words(dim: int = 512) -> Callable[[list[str]], np.ndarray]:
    """A stand-in for a model: signed counts of hashed words. It knows nothing of meaning."""

    def model(texts: list[str]) -> np.ndarray:
        import xxhash

        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            for w in t.lower().split() or [""]:
                h = xxhash.xxh64_intdigest(w)
                out[i, h % dim] += 1 if h >> 63 else -1
        return out

    return model
