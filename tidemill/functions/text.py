"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the sense of Unicode, as a character class of Java's patterns.
_SET = r"\s\x{85}\x{1c}-\x{1f}\p{Z}"
SPACE = f"[{_SET}]"
MAX_DOC_CHARS = 200_000
#: Citation marks such as [1] or [1, 2], and the ends of sentences.
CITATION = r"\[(\d+(?:\s*,\s*\d+)*)\]"
SENTENCE_END = r"(?<=[。！？!?.])\s*"


def strip(c: Column) -> Column:
    """Without outer Unicode white space."""
    # from the right only at the beginning of a run, so that padded texts cost no more than others
    return F.regexp_replace(c, rf"^{SPACE}+|(?<!{SPACE}){SPACE}+$", "")


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(c.rlike(f"[^{_SET}]"), F.lit(False))


def document_text(*fields: Column) -> Column:
    """Fields joined by line ends; null fields are left out, empty ones are not."""
    return F.concat_ws("\n", *fields)


def truncate(c: Column, n: int = MAX_DOC_CHARS) -> Column:
    return F.substring(c, 1, n)


def text_hash(c: Column) -> Column:
    """Hex SHA-256 of the text as it is, before any trimming."""
    return F.sha2(c, 256)


def windows(c: Column, size: int = 400, overlap: int = 50) -> Column:
    """Array of fixed windows of the stripped text, ``size - overlap`` apart; blank gives an empty array.
    The last window is the first that reaches the end."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")
    step = size - overlap

    def cut(t: Column) -> Column:
        last = F.greatest(F.ceil((F.length(t) - size) / step).cast("int"), F.lit(0))
        return F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(t, i * step + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    # the text is stripped once: within the lambda it is a variable
    return F.when(c.isNotNull(), F.transform(F.array(strip(c)), cut)[0])


def citations(c: Column) -> Column:
    """Numbers cited in a text, in order, repeated ones included."""
    marks = F.regexp_extract_all(c, F.lit(CITATION), F.lit(1))
    return F.transform(F.flatten(F.transform(marks, lambda m: F.split(m, ","))), lambda x: F.trim(x).cast("bigint"))


def sentences(c: Column) -> Column:
    """Sentences of a text, blank ones left out."""
    return F.filter(F.split(strip(c), SENTENCE_END), lambda s: ~is_blank(s))


def context_block(n: Column, title: Column, content: Column) -> Column:
    return F.concat(F.lit("["), n.cast("string"), F.lit("] "), F.coalesce(title, F.lit("")), F.lit("\n"), content)


def redact(c: Column) -> Column:
    """Credentials in messages and addresses made unreadable."""
    named = r"""(?i)\b((?:pass(?:word|wd)|pwd|secret|(?:access_?)?token|api_?key)["']?\s*[=:]\s*)(?:"[^"]*"|'[^']*'|[^\s&,;"']+)"""
    c = F.regexp_replace(c, named, "$1***")
    return F.regexp_replace(c, r"(?<=://)([^\s:/?#@]*):[^\s/?#@]*(?=@)", "$1:***")


def record_key(c: Column) -> Column:
    """A record key without spaces and outer brackets; null gives an empty string."""
    return F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")), r"^[\[\]]+|[\[\]]+$", "")
