"""Splitting oversized texts at natural boundaries, by recursive bisection.

A text longer than the limit is cut at the strongest boundary near its middle; halves still
longer than the limit less the overlap are cut again; then each piece but the first is given
the last ``overlap`` characters of the piece before it. Lengths are code points. The Python
part returns cut positions only; the pieces are made from the column itself."""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import ship

LIMIT, OVERLAP = 400, 50

#: Boundaries, strongest first; a cut may stand at the end of a match.
_BOUNDARIES = [
    re.compile(p)
    for p in (
        r"(?:\r?\n[^\S\n]*){2,}|[\x0c\u2029]",  # paragraph
        r"\r?\n|[\x0b\x85\u2028]|\r",  # line
        r"[.!?…‽؟।]+[\"'”’»)\]]*\s+|[。！？｡]+[”’」』）)\"']*",  # sentence
        r"[,;:]\s+|[，；：、]|\s[–—-]\s",  # clause
        r"\s+|\u200b",  # word
        r"(?:[^\w\s\u0300-\u036f\u200b-\u200d\ufe0e\ufe0f]|_)+",  # punctuation within an unbroken run
    )
]


def _joined(text: str, c: int) -> bool:
    """Whether a cut at c would part what is shown as one character."""
    a, b = text[c - 1], text[c]
    return (
        b in "\u200c\u200d\ufe0e\ufe0f" or a == "\u200d" or "\U0001f3fb" <= b <= "\U0001f3ff" or (a == "\r" and b == "\n")
        or ("\U0001f1e6" <= a <= "\U0001f1ff" and "\U0001f1e6" <= b <= "\U0001f1ff") or unicodedata.category(b)[0] == "M"
    )


def cut_positions(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int] | None:
    """[begin, cut, ..., end] in the text, its outer white space left out; [] if that is all of it, None for None."""
    if text is None:
        return None
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    begin, end = len(text) - len(text.lstrip()), len(text.rstrip())
    if begin >= end:
        return []
    if end - begin <= limit:
        return [begin, end]
    cap = limit - overlap
    places = [[m.end() for m in p.finditer(text, begin, end) if begin < m.end() < end] for p in _BOUNDARIES]
    cuts, todo = [begin, end], [(begin, end)]
    while todo:
        s, e = todo.pop()
        if e - s <= cap:
            continue
        mid, low = (s + e) // 2, s + max(1, min(overlap, (e - s) // 4)) if s == begin else s + 1
        quarter = max(1, (e - s) // 4)
        c = _best(places, mid, max(low, mid - quarter), min(e - 1, mid + quarter)) or _best(places, mid, low, e - 1)
        if c is None:
            near = (x for d in range(min(mid - low, e - 1 - mid, 256) + 1) for x in (mid - d, mid + d))
            c = next((x for x in near if not _joined(text, x)), mid)
        cuts.append(c)
        todo += [(s, c), (c, e)]
    return sorted(cuts)


def _best(places: list[list[int]], mid: int, low: int, high: int) -> int | None:
    """The strongest boundary in low..high, of these the nearest to mid."""
    for at in places:
        i = bisect.bisect_left(at, mid)
        near = [x for x in at[max(0, i - 1) : i + 1] if low <= x <= high]
        if near:
            return min(near, key=lambda x: abs(x - mid))
    return None


def cuts(text: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    """Column form of ``cut_positions``."""

    @F.pandas_udf("array<int>")
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([cut_positions(t, limit, overlap) for t in b], dtype=object)

    return f(text)


def split_items(df: DataFrame, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """df's columns but ``text``, and chunk_index, n_chunks, start, piece: one row per piece.

    start is where the piece's own part begins in the text (0-based), after the overlap.
    Taking ``overlap`` characters off every piece but the first and joining gives the text
    without its outer Unicode white space. A text within the limit is one piece; a null, empty
    or blank text has none. Repeated rows are split alike. A run without any boundary is cut in
    the middle, not between a character and the marks that belong to it; nothing is dropped."""
    keep = [c for c in df.columns if c != text]
    clash = {"chunk_index", "n_chunks", "start", "piece", "_cuts", "_i"} & set(keep)
    if clash:
        raise ValueError(f"rename {sorted(clash)} first")
    ship(df.sparkSession)
    one = df.withColumn("_cuts", cuts(F.col(text), limit, overlap)).where("size(_cuts) > 1")
    row = one.select(*keep, text, "_cuts", F.explode(F.sequence(F.lit(0), F.size("_cuts") - 2)).alias("_i"))
    start, stop = F.col("_cuts")[F.col("_i")], F.col("_cuts")[F.col("_i") + 1]
    lead = F.when(F.col("_i") == 0, start).otherwise(F.greatest(start - overlap, F.col("_cuts")[0]))
    return row.select(
        *keep, F.col("_i").alias("chunk_index"), (F.size("_cuts") - 1).alias("n_chunks"), start.alias("start"),
        F.substring(F.col(text), lead + 1, stop - lead).alias("piece"),
    )


def oversized(df: DataFrame, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """df's columns but ``text`` of the rows that are split into more than one piece.

    Texts not longer than the limit before trimming aren't handed to Python."""
    keep = [c for c in df.columns if c != text]
    ship(df.sparkSession)
    long = df.where(F.length(text) > limit)
    return long.withColumn("_cuts", cuts(F.col(text), limit, overlap)).where("size(_cuts) > 2").select(*keep)
