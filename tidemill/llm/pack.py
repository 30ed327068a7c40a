"""Filling containers of fixed capacity with texts sized in tokens, by local search.

Texts are sized with a public tokenizer and cut only if they exceed a container by themselves.
Items are dealt to groups of bounded size; each group is first packed in the order its items come and then
improved by moving and exchanging items (one for one, two for one, one for two) between underfull bins, every
step of which raises the sum of squared fills, until bins run empty. The bins that are still underfull
are emptied into fewer, new groups and packed again."""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import ship, written

CAPACITY = 2048
#: A vocabulary file of a public tokenizer, as ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how that vocabulary's tokenizer parts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_to_capacity(text: str | None, capacity: int, vocabulary: str = VOCABULARY) -> list[tuple[int, int, int]]:
    """(begin, end, tokens) of the pieces of a text: one, unless it exceeds the capacity.

    Cuts stand between tokens that are between characters, before a word where one begins within
    eight tokens of the last possible place; tokens is the size of the piece tokenized by itself. An empty text is one piece of no
    tokens, null has none."""
    if text is None:
        return []
    enc = _encoding(vocabulary)
    t = enc.encode_ordinary(text)
    if len(t) <= capacity:
        return [(0, len(text), len(t))]
    out, begin, at, begin_inside = [], 0, 0, False
    while at < len(t):
        n, size = min(capacity, len(t) - at), 0
        if at + n < len(t):  # cut before a word if one begins close by: its tokens stay what they are
            n, size = next(((m, m) for m in range(n, max(n - 8, 0), -1) if _begins_word(enc, t, at + m)), (n, 0))
        while True:
            try:
                piece = enc.decode_bytes(t[at : at + n]).decode()
                size = size if size and not begin_inside else n if at + n == len(t) and not begin_inside else len(enc.encode_ordinary(piece))
                if size <= capacity:
                    break
            except UnicodeDecodeError:  # within a character
                pass
            n, size = n - 1, 0
        out.append((begin, begin + len(piece), size))
        begin, at = begin + len(piece), at + n
        begin_inside = at < len(t) and not _begins_word(enc, t, at)
    return out


def _begins_word(enc, t: list[int], i: int) -> bool:
    """Whether token i is a space and a letter after something else than white space, so that the
    tokenizer parts the text there."""
    a = enc.decode_single_token_bytes(t[i])
    return len(a) > 1 and a[:1] == b" " and a[1:2].isalpha() and not enc.decode_single_token_bytes(t[i - 1])[-1:].isspace()


def sizes(df: DataFrame, ident: str, text: str, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(ident, piece, begin, end, tokens): one row per text, or per piece of one that exceeds the capacity."""

    ship(df.sparkSession)

    @F.pandas_udf("array<struct<begin int, end int, tokens int>>")
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([[{"begin": x, "end": y, "tokens": n} for x, y, n in cut_to_capacity(t, capacity, vocabulary)] for t in b], dtype=object)

    pieces = df.select(ident, f(F.col(text)).alias("_p"))
    return pieces.select(ident, F.posexplode("_p").alias("piece", "_s")).select(ident, "piece", "_s.begin", "_s.end", "_s.tokens")


# --- packing one group -------------------------------------------------------------------


def best_fit(size: list[int], capacity: int, largest_first: bool = False) -> list[list[int]]:
    """Bins of item numbers: in the order given, or largest first, each into the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # sorted rooms that some bin has
    bins: list[list[int]] = []
    for i in sorted(range(len(size)), key=lambda i: -size[i]) if largest_first else range(len(size)):
        k = bisect.bisect_left(rooms, size[i])
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(k)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - size[i]
        if not by_room[left]:
            bisect.insort(rooms, left)
        by_room[left].append(b)
    return bins


class _Bins:
    """The items of underfull bins in arrays that follow every exchange."""

    def __init__(self, bins: list[list[int]], size: np.ndarray, capacity: int):
        self.size, self.capacity = size, capacity
        self.where = np.zeros(len(size), np.int64)
        for b, items in enumerate(bins):
            self.where[items] = b
        self.fill = np.bincount(self.where, weights=size, minlength=len(bins)).astype(np.int64)
        #: Items that may come back or stand beside one: of bins that are neither full nor given up, sorted by bin and size.
        self.items = np.zeros(0, np.int64)

    def reach(self) -> np.ndarray:
        live = self.fill[self.where] < self.capacity
        items = np.flatnonzero(live & (self.size > 0))
        return items[np.lexsort((self.size[items], self.where[items]))]

    def step(self, giver: int) -> tuple[list[int], list[int], int] | None:
        """(items out, items back, taker) of the exchange that carries most tokens from the giver to a bin at least as full."""
        mine = np.flatnonzero((self.where == giver) & (self.size > 0))
        fill, room = self.fill, self.capacity - self.fill
        takers = np.flatnonzero((fill >= fill[giver]) & (room > 0) & (fill > 0))
        takers = takers[takers != giver]
        if not len(takers) or not len(mine):
            return None
        mine = mine[np.argsort(self.size[mine], kind="stable")]
        own = self.size[mine]
        best, most = None, 0
        k = int(np.searchsorted(own, room[takers].max(), "right")) - 1
        if k >= 0:  # a move, into the fullest bin with room for it
            fits = takers[room[takers] >= own[k]]
            best, most = ([int(mine[k])], [], int(fits[np.argmin(room[fits])])), int(own[k])
        ok = np.zeros(len(fill), bool)
        ok[takers] = True
        theirs = self.items[ok[self.where[self.items]]]
        if not len(theirs):
            return best
        back, free = self.size[theirs], room[self.where[theirs]]

        def exchange(sums: np.ndarray) -> tuple[int, int, int] | None:
            """(number of a sum, of an item that comes back, tokens carried) of the sums of what goes out, sorted."""
            at = np.searchsorted(sums, back + free, "right") - 1
            gain = np.where(at >= 0, sums[np.maximum(at, 0)] - back, 0)
            j = int(np.argmax(gain))
            return (int(at[j]), j, int(gain[j])) if gain[j] > 0 else None

        if (x := exchange(own)) and x[2] > most:
            best, most = ([int(mine[x[0]])], [int(theirs[x[1]])], int(self.where[theirs[x[1]]])), x[2]
        if len(mine) > 1:
            a, b = np.triu_indices(len(mine), 1)
            sums = own[a] + own[b]
            o = np.argsort(sums, kind="stable")
            if (x := exchange(sums[o])) and x[2] > most:
                best, most = ([int(mine[a[o[x[0]]]]), int(mine[b[o[x[0]]]])], [int(theirs[x[1]])], int(self.where[theirs[x[1]]])), x[2]
        if best:
            return best
        # one for two of the same bin: to each the smallest partner with which enough comes back
        line = self.where[theirs] * (self.capacity + 1)
        key = line + back
        for i, w in zip(mine.tolist(), own.tolist()):
            k = np.searchsorted(key, line + np.clip(w - free - back, 0, self.capacity))
            k += k == np.arange(len(theirs))
            k = np.minimum(k, len(theirs) - 1)
            gain = w - back - back[k]
            gain[(line[k] != line) | (k == np.arange(len(theirs))) | (gain > free)] = 0
            j = int(np.argmax(gain))
            if gain[j] > most:
                best, most = ([i], [int(theirs[j]), int(theirs[k[j]])], int(self.where[theirs[j]])), int(gain[j])
        return best

    def carry(self, giver: int, out: list[int], back: list[int], taker: int) -> None:
        d = int(self.size[out].sum() - self.size[back].sum())
        self.where[out], self.where[back] = taker, giver
        self.fill[giver] -= d
        self.fill[taker] += d
        rows = self.items[(self.where[self.items] != giver) & (self.where[self.items] != taker)]
        new = np.flatnonzero(((self.where == giver) | (self.where == taker)) & (self.fill[self.where] < self.capacity) & (self.size > 0))
        rows = np.concatenate([rows, new])
        self.items = rows[np.lexsort((self.size[rows], self.where[rows]))]


def improve(bins: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """Swap-based local search between underfull bins.

    The emptiest bin gives: an item moves to another bin with room for it, or is exchanged for one or two smaller items of a bin, or
    two of its items for one; all items of all underfull bins are in reach. Each step carries as many tokens as it can, d > 0, from a bin of
    fill f to one of fill g >= f and so adds 2d(g - f + d) to the sum of squared fills, for which reason the search ends.
    A bin that runs empty is gone; one that can give no more is left until others have changed. All items stay placed. It
    also ends when what is free in all bins together is less than one bin, since then none can be saved."""
    sizes = np.asarray(size, dtype=np.int64)
    if len(bins) < 2:
        return bins
    s = _Bins(bins, sizes, capacity)
    s.items = s.reach()
    for moved in iter(lambda: _round(s), 0):
        del moved
    out: dict[int, list[int]] = {}
    for i, b in enumerate(s.where.tolist()):
        if s.fill[b] or not sizes[i]:
            out.setdefault(b, []).append(i)
    left = [i for b, items in out.items() if not s.fill[b] for i in items]  # items of no size stay with others
    full = [items for b, items in out.items() if s.fill[b]]
    if left:
        full[:1] = [[*full[0], *left]] if full else [left]
    return full


def _round(s: _Bins) -> int:
    """Every underfull bin gives once, the emptiest first; the number of bins emptied."""
    emptied = 0
    for giver in np.argsort(s.fill, kind="stable").tolist():
        used = s.fill > 0
        if s.fill[giver] >= s.capacity or int((s.capacity - s.fill[used]).sum()) < s.capacity:
            break
        if not s.fill[giver]:
            continue
        while s.fill[giver] and (x := s.step(giver)):
            s.carry(giver, *x)
        emptied += not s.fill[giver]
    return emptied


def pack_group(size: list[int], capacity: int) -> list[list[int]]:
    """Best fit in the order given, then the search."""
    return improve(best_fit(size, capacity), size, capacity)


# --- the operator ------------------------------------------------------------------------


def _packed(items: DataFrame, group: str, label: str, capacity: int) -> DataFrame:
    """items with container and fill, packed within each group."""
    keep = [c for c in items.columns if c != group]

    def f(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("_n", kind="stable").reset_index(drop=True)
        size = t["tokens"].astype(int).tolist()
        where, fill = np.empty(len(t), dtype=object), np.zeros(len(t), dtype=int)
        for n, b in enumerate(pack_group(size, capacity)):
            where[b], fill[b] = f"{label}-{key[0]}-{n}", sum(size[i] for i in b)
        return t.assign(container=where, fill=fill)[[*keep, "container", "fill"]]

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in items.schema if x.name != group)
    return items.groupBy(group).applyInPandas(f, schema + ", container string, fill int")


def pack(df: DataFrame, ident: str, text: str, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, group_bins: int = 1024, group_rows: int = 32_768) -> DataFrame:
    """(ident, piece, begin, end, tokens, container, fill): every text, or every piece of one
    that exceeds the capacity by itself, in a container.

    fill is the container's sum of tokens, at most the capacity. begin and end are positions in
    the text. An empty text takes no room but has a container; a null text has one row without
    container. Rows that repeat an ident are items of their own. An empty table gives none.
    A group holds about ``group_bins`` containers' worth of tokens, at most about ``group_rows`` items, by hash of a number
    that is stored with the item; what its last bins waste is packed again with that of other groups."""
    base = df.select(F.col(ident).alias("_id"), F.col(text).alias("_text"))
    items = written(sizes(base, "_id", "_text", capacity, vocabulary).withColumn("_n", F.monotonically_increasing_id()), "pack-sizes")
    per = group_bins * capacity

    def groups(d: DataFrame) -> DataFrame:
        n = d.agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
        return d.withColumn("_group", F.pmod(F.xxhash64("_n"), F.lit(max(1, -(-(n.tokens or 0) // per), -(-n.rows // group_rows)))))

    first = written(_packed(groups(items), "_group", "a", capacity), "pack-first")
    # about one bin of each group stays underfull; whole bins go on, so none is taken apart in vain
    loose = F.col("fill") < F.lit(int(0.97 * capacity))
    again = _packed(groups(first.where(loose).drop("container", "fill")), "_group", "b", capacity)
    none = base.where("_text IS NULL").select("_id", *[F.lit(None).cast(t).alias(c) for c, t in (("piece", "int"), ("begin", "int"), ("end", "int"), ("tokens", "int"), ("container", "string"), ("fill", "int"))])
    out = first.where(~loose).unionByName(again).drop("_n").unionByName(none)
    return out.withColumnRenamed("_id", ident)


def utilisation(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, the least number of containers that could hold them, and the share filled."""
    c = packed.where("container IS NOT NULL").groupBy("container").agg(F.sum("tokens").alias("n"))
    return c.agg(
        F.count(F.lit(1)).alias("containers"), F.sum("n").cast("bigint").alias("tokens"),
        F.ceil(F.sum("n") / capacity).cast("bigint").alias("least"), (F.sum("n") / (F.count(F.lit(1)) * capacity)).alias("share"),
    )
