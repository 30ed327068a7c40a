"""Held-out passages that appear, wholly or in part, in a corpus.

Passages and documents become sequences of words (single characters for ideographs), without
case, width, marks of accent, punctuation and mark-up. Some of the words of a short window, in
order, make a seed; fixed masks say which words of the window count, so that a changed, dropped or
inserted word spoils only the seeds it stands in. The hashes of both sides are joined. Pairs of a
document and a passage with seeds close to each other are compared along the diagonals of their seeds,
and those with enough equal words are aligned, insertions and deletions allowed; stretches with a
minority of changed words are chained in running order."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain as joined

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemill.session import ship

#: Token positions that count in a window that begins with a word. All are hashed alike on both sides: what counts is the
#: sequence of the words, not the places of those left out. Five in a row, with one or two left out, and every second one;
MASKS = ((0, 1, 2, 3, 4), *((*range(k), *range(k + gap, 5 + gap)) for gap in (1, 2) for k in range(1, 5)), (0, 2, 4, 6, 8))
#: six, for words changed one by one.
MASKS += ((0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 8, 9), (0, 1, 4, 6, 7, 9), (0, 3, 4, 7, 9, 10), (0, 2, 5, 6, 9, 11))
#: The same for windows that begin with an ideograph: eight, about four words. Those with gaps leave out every n-th, n from 2 to 8.
MASKS_WIDE = (tuple(range(8)), *(tuple(j for j in range(16) if (j + 1) % n)[:8] for n in range(2, 9)), (0, 1, 2, 3, 6, 7, 8, 9), (0, 1, 2, 3, 7, 8, 9, 10))
#: A pair is looked at where seeds begin at this many places of the passage and at this share of its tokens, within BAND
#: neighbouring diagonals. If two words of five are changed, dropped or inserted, they begin at 0.13 to 0.2 of the tokens.
SEEDS, SEEDS_PER_TOKEN, BAND = 2, 0.03, 32
#: A pair is aligned if this share of its passage equals the text on the diagonals within NEAR of its seeds. Half of
#: a passage with half of its words changed is 0.25; the rest is for stretches without a seed.
EQUAL, NEAR = 0.2, 2
#: Where seeds begin at this share of the places of a passage, changes count half from the start.
SEEDED = 0.2
#: Score of an equal token.
MATCH = 4
#: Share of changes from which a stretch is measured again with changes at half their weight.
MUCH = 0.2
#: Diagonals that are aligned at once, those of many pairs; diagonals on either side of the hits, besides a twelfth of the passage.
CELLS, SLACK = 1 << 16, 10
#: Most passages, and characters of passages, of one index; a single longer passage has one of its own.
#: The indexes are used one after the other for every part of the corpus.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 5_000_000


@dataclass(frozen=True)
class Settings:
    """least: share of the passage that a document must hold. stretch: least matches less
    changes in one stretch, in words and in ideographs. penalty: weight of a changed or missing
    token of the passage; an inserted one has a quarter of it."""

    least: float = 0.5
    stretch: int = 7
    stretch_wide: int = 10
    penalty: float = 1.0


#: Text that is searched at once: bounds a worker's memory, whatever the batch.
SLICE_BYTES = 1 << 19
#: Bits of a seed's hash that tell at a first look whether any passage has it.
BITS = 22
#: Tokens of texts that wait to be aligned.
PENDING = 4 << 20

_TAG = re.compile(r"<[/!]?[a-zA-Z][^<>]*>")
_INLINE = re.compile(r"</?(?:[abisu]|em|strong|code|span|mark|sub|sup|small|big|tt|kbd|q)(?![a-zA-Z])", re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});")
_WIDE = ((0x2E80, 0x2FFF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Characters of mark-up that stand for nothing.
_DROPPED = frozenset("*_`~\u00ad")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
#: Separate parts of syllables, which are joined first.
_PARTS = re.compile("[\u1100-\u11ff\u3099\u309a\ua960-\ua97f\ud7b0-\ud7ff]")


def _unmarked(text: str) -> str:
    """Tags and entities taken out: a tag within a line joins what it parts, another one is white space."""
    if "<" in text:
        text = _TAG.sub(lambda m: "" if _INLINE.match(m.group()) else " ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m.group()), text)
    return unicodedata.normalize("NFC", text) if not text.isascii() and _PARTS.search(text) else text


class _Forms:
    """Per character what is left of it without case, width and accent, filled as characters are met:
    how many characters, the first of them, and its kind (0 parts words, 1 letter or digit, 2 ideograph)."""

    def __init__(self) -> None:
        self.count = np.full(0x110000, 255, np.uint8)
        self.form = np.zeros(0x110000, np.uint32)
        self.kind = np.zeros(0x110000, np.uint8)
        self.more: dict[int, list[int]] = {}

    def meet(self, code: np.ndarray) -> None:
        new = code[self.count[code] == 255]
        for c in np.unique(new).tolist() if len(new) else ():
            x = chr(c)
            if "\uac00" <= x <= "\ud7a3":
                parts = [x]
            else:
                parts = [y for y in unicodedata.normalize("NFKD", x).casefold() if unicodedata.category(y) not in ("Mn", "Cf", "Me") and y not in _DROPPED]
            kinds = [2 if any(a <= ord(y) <= b for a, b in _WIDE) else int(y.isalnum()) for y in parts]
            if not any(kinds):
                parts, kinds = parts[:1], kinds[:1]
            self.count[c], self.kind[c] = len(parts), max(kinds, default=0)
            if parts:
                self.form[c] = ord(parts[0])
            if len(parts) > 1:
                self.more[c] = [ord(y) if k else 0x20 for y, k in zip(parts, kinds)]
                self.meet(np.array(self.more[c], np.uint32))


_forms = _Forms()
_ODD, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint32((1 << BITS) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the words and ideographs of all texts, whether it is an ideograph, number of the first token of every text and of the end)."""
    texts = [_unmarked(t) if t else "" for t in texts]
    code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    f = _forms
    f.meet(code)
    n = f.count[code]
    if (n != 1).any():
        at = np.r_[0, np.cumsum(n, dtype=np.int64)]
        whole, first = np.repeat(code, n), at[np.minimum(first, len(code))]
        many = n > 1
        if many.any():
            where = np.repeat(many, n)
            whole[where] = list(joined.from_iterable(f.more[c] for c in code[many].tolist()))
        code = whole
    kind = f.kind[code]
    begin = (kind == 2) | ((kind == 1) & (np.r_[np.uint8(0), kind[:-1]] != 1)) if len(code) else np.zeros(0, bool)
    start = np.flatnonzero(begin)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(len(texts) + 1, np.int64)
    inside = np.flatnonzero(kind)
    number = np.cumsum(begin, dtype=np.int32)[inside] - 1
    place = inside - start[number]
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, 0x100000001B3 | 1, np.uint64))
    part = (f.form[code[inside]].astype(np.uint64) + np.uint64(1)) * _ODD * power[place]
    h = _mixed(np.add.reduceat(part, np.searchsorted(inside, start)))
    return h, kind[start] == 2, np.r_[np.searchsorted(start, first), len(start)]


def seed_hashes(code: np.ndarray, wide: np.ndarray, near: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and hashes of the windows whose counting positions are all known (> 0), over all masks; near: of
    those only that this table of first bits has."""
    mult = np.random.default_rng(20240611).integers(1, 2**31, size=8, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    n, known, number = len(code), code > 0, code.astype(np.uint32) * np.uint32(0x9E3779B1)
    number ^= number >> np.uint32(15)
    times = [number * m for m in mult]
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for masks, start in ((MASKS, known & ~wide), (MASKS_WIDE, known & wide)):
        if not start.any():
            continue
        part: dict[tuple, tuple] = {}  # sums over stretches without a gap, which masks share: (j, j2) by the place of j

        def run(j: int, j2: int, part=part) -> tuple[np.ndarray, np.ndarray]:
            if (j, j2) not in part:
                if j2 - j == 1:
                    part[j, j2] = times[j], known
                else:
                    (h, ok), m = run(j, j2 - 1), n - (j2 - j - 1)
                    part[j, j2] = h[:m] + times[j2 - 1][j2 - j - 1 :], ok[:m] & known[j2 - j - 1 :]
            return part[j, j2]

        for mask in masks:
            m = n - mask[-1]
            if m <= 0:
                continue
            cuts = [j for j in range(1, len(mask)) if mask[j] != mask[j - 1] + 1]
            hp, okp = run(0, (cuts or [len(mask)])[0])
            h, ok = hp[:m] + np.uint32(len(masks)), start[:m] & okp[:m]
            for j, j2 in zip(cuts, [*cuts[1:], len(mask)]):
                hp, okp = run(j, j2)
                h += hp[mask[j] : mask[j] + m]
                ok &= okp[mask[j] : mask[j] + m]
            at = np.flatnonzero(ok)
            h = h[at]
            if near is not None:
                first = np.flatnonzero(near.take((h >> np.uint32(32 - BITS)).astype(np.int32)))
                at, h = at[first], h[first]
            places.append(at), hashes.append(h)
    return np.concatenate(places), np.concatenate(hashes)


def opening(text: str) -> str:
    parts = _SENTENCE.split(text.strip(), maxsplit=1)
    return parts[0] if len(parts) > 1 else ""


def _digest(head: str) -> bytes | None:
    h, _, _ = tokens([head])
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None


class Index:
    """The seeds of a block of passages (id, text, whether the opening sentence is left out)."""

    def __init__(self, items: list[tuple[object, str, bool]]):
        h, wide, at = tokens([x[1] for x in items])
        _, _, head = tokens([opening(x[1]) if x[2] else "" for x in items])
        at[:-1] += np.diff(head)
        end = np.r_[at[1:-1] - np.diff(head)[1:], at[-1:]] if len(items) else at[1:]
        self.items = [x[0] for x in items]
        self.begin, self.length = at[:-1], end - at[:-1]
        self.vocab, code = np.unique(h, return_inverse=True)
        self.code = (code + 1).astype(np.int32)
        per = [seed_hashes(self.code[a:b], wide[a:b]) for a, b in zip(self.begin, end)]
        self.wide = np.array([wide[a:b].mean() > 0.5 if b > a else False for a, b in zip(self.begin, end)], bool)
        h = np.concatenate([x for _, x in per]) if per else np.zeros(0, np.uint32)
        i = np.concatenate([np.full(len(x), k, np.int32) for k, (x, _) in enumerate(per)]) if per else np.zeros(0, np.int32)
        at = np.concatenate([x for x, _ in per]).astype(np.int32) if per else np.zeros(0, np.int32)
        o = np.argsort(h, kind="stable")
        self.near, self.near2 = np.zeros((2, 1 << BITS), bool)
        self.near[h >> np.uint32(32 - BITS)] = self.near2[h & _LOW] = True
        known, first = np.unique(h[o], return_index=True)
        self.seeds = known, np.r_[first, len(h)], i[o], at[o]

    def passage(self, i: int) -> np.ndarray:
        return self.code[self.begin[i] : self.begin[i] + self.length[i]]

    def coded(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the words, 0 for those of no passage."""
        if not len(self.vocab):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[at] == h, at + 1, 0).astype(np.int32)

    def hits(self, code: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """(item number, place in passage, place in code) of every common seed."""
        at, h = seed_hashes(code, wide, self.near)
        near = self.near2[h & _LOW]
        at, h = at[near], h[near]
        known, first, item, place = self.seeds
        if not len(known):
            return np.zeros((0, 3), np.int64)
        k = np.minimum(np.searchsorted(known, h), len(known) - 1)
        same = known[k] == h
        at, a, n = at[same], first[k[same]], first[k[same] + 1] - first[k[same]]
        rows = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.stack([item[rows].astype(np.int64), place[rows].astype(np.int64), np.repeat(at, n)], axis=1)


class Bands:
    """Bands of neighbouring diagonals, many at once: (passage, text, first diagonal, number of diagonals)."""

    def __init__(self, bands: list[tuple[np.ndarray, np.ndarray, int, int]]):
        self.n, self.width = max(len(x[0]) for x in bands), max(x[3] for x in bands)
        top = max(max(int(x[0].max(initial=0)), int(x[1].max(initial=0))) for x in bands)
        kind, self.pad = np.int16 if top < 1 << 15 else np.int32, self.width // 2 + 1
        self.p = np.full((self.n + 2 * self.pad, len(bands)), -1, kind)
        self.d = np.full((self.n + self.width + 2, len(bands)), -2, kind)
        for k, (p, d, first, _) in enumerate(bands):
            self.p[self.pad : self.pad + len(p), k] = p
            part = d[max(0, first) : max(0, first + self.n + self.width)]
            self.d[max(0, -first) : max(0, -first) + len(part), k] = part

    def steps(self) -> Iterator[tuple[slice, slice, slice, slice, np.ndarray]]:
        """Cells that need earlier ones only: places in a line of diagonals with one more at either end (their own, the
        next and the former diagonal), rows of the padded passage, whether the tokens are equal."""
        for x in range(2 * self.n + self.width - 2):
            c = x % 2
            k, j = len(range(c, self.width, 2)), (x - c) // 2
            if not k:
                continue
            at = slice(self.pad + j - k + 1, self.pad + j + 1)
            same = self.p[at][::-1] == self.d[j + c : j + c + k]
            yield slice(c + 1, c + 2 * k, 2), slice(c + 2, c + 2 * k + 1, 2), slice(c, c + 2 * k - 1, 2), at, same


def peaks(b: Bands, change: int, enough: int) -> np.ndarray:
    """Per band the score of its best stretch, ``enough`` at most: MATCH a match, -change a changed or
    missing token, a quarter of that an inserted one."""
    line = np.zeros((b.width + 2, b.p.shape[1]), np.int8 if enough + 2 * change + MATCH < 128 else np.int32)
    best = np.zeros_like(line)
    for own, after, before, _, same in b.steps():
        h = same.view(np.int8) if line.dtype == np.int8 else same.astype(line.dtype)
        h *= MATCH + change
        h += line[own]
        np.maximum(h, line[after], out=h)
        h -= change
        np.maximum(h, line[before] - max(1, change // 4), out=h)
        np.maximum(h, 0, out=h)
        np.minimum(h, enough, out=h)
        line[own] = h
        np.maximum(best[own], h, out=best[own])
    return best.max(axis=0)


def stretches(b: Bands, least: list[int], change: int) -> list[list[tuple[int, int, int, int, int, float]]]:
    """Per band its stretches, scored as in ``peaks``: (begin, end, place of the begin and of the end in the text less the
    first diagonal, tokens of the passage held, share of changes). A gap of more than ``least`` tokens within a stretch is not held."""
    w = max(b.n, b.width).bit_length()  # a value: score, begin, diagonal of the begin; in ends also that of the end
    one, mask = 1 << 2 * w, (1 << w) - 1
    line, ends = np.zeros((b.width + 2, b.p.shape[1]), np.int64), np.zeros(b.p.shape, np.int64)
    rows, where = np.arange(len(b.p))[:, None] - b.pad, np.arange(-1, b.width + 1)[:, None]
    for own, after, before, at, same in b.steps():
        h = np.where(same, np.maximum(line[own], (rows[at][::-1] << w) + where[own]) + MATCH * one, line[own] - change * one)
        np.maximum(h, line[after] - change * one, out=h)
        np.maximum(h, line[before] - max(1, change // 4) * one, out=h)
        h[h < one] = 0
        line[own] = h
        part = ends[at][::-1]
        np.maximum(part, np.where(same, (h << w) + where[own], 0), out=part)
    out = []
    for k, low in enumerate(least):
        js = np.flatnonzero(ends[:, k])
        v = ends[js, k]
        by: dict[int, list[tuple[int, int, int]]] = {}
        for j, begin, score, c in zip((js - b.pad).tolist(), (v >> w & (one - 1)).tolist(), (v >> 3 * w).tolist(), (v & mask).tolist()):
            by.setdefault(begin, []).append((j, score, c))
        found = []
        for begin, path in by.items():
            best = max(range(len(path)), key=lambda q: path[q][1])
            if path[best][1] < MATCH * low:
                continue
            a, (j, score, c) = begin >> w, path[best]
            gaps = [y - x - 1 for x, y in zip([a, *(q[0] for q in path[:best])], [q[0] for q in path[: best + 1]]) if y - x - 1 > low]
            long = j + 1 - a
            found.append((a, j + 1, a + (begin & mask), j + c + 1, long - sum(gaps), (MATCH * long - score) / (MATCH + change) / long))
        out.append(found)
    return out


def _batches(n: list[int], width: list[int]) -> Iterator[list[int]]:
    """Numbers of bands of like size, with at most CELLS diagonals in all, or one band."""
    batch: list[int] = []
    for k in sorted(range(len(n)), key=lambda k: (n[k] // 24, width[k])):
        if batch and (width[k] * (len(batch) + 1) > CELLS or n[k] // 24 != n[batch[0]] // 24):
            yield batch
            batch = []
        batch.append(k)
    if batch:
        yield batch


def chain(found: list[tuple[int, int, int, int, float]]) -> float:
    """Most tokens of the passage in stretches that follow each other on both sides; what two share counts once."""
    found = sorted(set(found), key=lambda x: (x[1], x[3]))
    best: list[float] = []
    for k, (a, b, c, d, own) in enumerate(found):
        most = own
        for j in range(k):
            a2, b2, c2, d2, _ = found[j]
            over = max(0, b2 - a, d2 - c)
            if over < own and a2 <= a and c2 <= c and b2 <= b and d2 <= d:
                most = max(most, best[j] + own - over)
        best.append(most)
    return max(best, default=0.0)


def slack(length):
    """Diagonals on either side of the hits that are aligned too."""
    return SLACK + length // 12


def shares(pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], penalty: float) -> list[float]:
    """Share of each passage that its text holds in running order; pairs: (passage, text, hits (place in passage, place in text), least stretch)."""
    change = max(1, round(MATCH * penalty))
    bands, of, seeded = [], [], []
    for k, (p, d, hits, _) in enumerate(pairs):
        more = slack(len(p))
        all_diagonals = hits[:, 1] - hits[:, 0]
        diagonals = np.unique(all_diagonals)
        cut = np.flatnonzero(np.diff(diagonals) > more)
        for a, b in zip(diagonals[np.r_[0, cut + 1]].tolist(), diagonals[np.r_[cut, len(diagonals) - 1]].tolist()):
            bands.append((p, d, a - more, b - a + 2 * more + 1)), of.append(k)
            own = hits[:, 0] if not len(cut) else hits[(all_diagonals >= a) & (all_diagonals <= b), 0]
            seeded.append(len(own) >= SEEDED * len(p) and len(np.unique(own)) >= SEEDED * len(p))
    near, rest, most = [], [], MATCH * max((x[3] for x in pairs), default=0)
    for batch in _batches([len(x[0]) for x in bands], [x[3] for x in bands]):
        for i, top in zip(batch, peaks(Bands([bands[i] for i in batch]), change, most).tolist()):
            if top >= MATCH * pairs[of[i]][3]:
                near.append(i)
            elif seeded[i]:
                rest.append(i)
    found: dict[int, list[tuple[int, int, int, int, float]]] = {}
    for weight in (change, (change + 1) // 2):
        much, rest = rest, []
        for batch in _batches([len(bands[i][0]) for i in near], [bands[i][3] for i in near]):
            batch = [near[i] for i in batch]
            for i, own in zip(batch, stretches(Bands([bands[i] for i in batch]), [pairs[of[i]][3] for i in batch], weight)):
                own = [x for x in own if x[5] <= 0.5]
                first = bands[i][2]
                for a, b, c, d, held, rate in own:  # the run of changed tokens to be expected beyond either end is held too
                    run = max(0.0, rate) / (1 - min(rate, 0.5))
                    found.setdefault(of[i], []).append((a, b, c + first, d + first, held + min(a, run) + min(len(bands[i][0]) - b, run)))
                if any(rate >= MUCH for *_, rate in own):
                    much.append(i)
        near = much  # where much is changed, a change counts less: else the best stretch ends at the first cluster of changes
    return [min(1.0, chain(found.get(k, [])) / max(1, len(x[0]))) for k, x in enumerate(pairs)]


def crowd(pair: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per hit the number of places of the passage where hits of its pair begin within a band of its diagonal."""
    most = np.zeros(len(pair), np.int64)
    for off in (0, BAND // 2):
        band = (at - place + off) // BAND
        o = np.lexsort((place, band, pair))
        new = np.r_[True, (np.diff(pair[o]) != 0) | (np.diff(band[o]) != 0)] if len(o) else np.zeros(0, bool)
        first = new | np.r_[True, np.diff(place[o]) != 0] if len(o) else new
        group = np.cumsum(new) - 1
        most[o] = np.maximum(most[o], np.bincount(group, weights=first).astype(np.int64)[group])
    return most


def equal(index: Index, code: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray, band: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Per band how many tokens of its passage equal the text on a diagonal within NEAR of one of its hits. begin, end, item: per
    band the text's bounds in code and the passage; band, diagonal: of the hits in order, place in code less place in passage."""
    first = np.flatnonzero(np.r_[True, (np.diff(band) != 0) | (np.diff(diagonal) != 0)])
    around = (diagonal[first][:, None] + np.arange(-NEAR, NEAR + 1)).ravel()
    of = np.repeat(band[first], 2 * NEAR + 1)
    order = np.lexsort((around, of))
    of, around = of[order], around[order]
    new = np.r_[True, (np.diff(of) != 0) | (np.diff(around) != 0)]
    of, around = of[new], around[new]
    length = index.length[item]
    out, place = np.zeros(len(item), np.int64), np.cumsum(length) - length
    size, lo = np.cumsum(length[of]), 0
    while lo < len(of):  # whole bands, about a million tokens at a time
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + (1 << 20))))
        hi = int(np.searchsorted(of, of[hi - 1], "right"))
        o, shift = of[lo:hi], around[lo:hi]
        n = length[o]  # places of the passage at which the text has a token
        a, b = np.clip(begin[o] - shift, 0, n), np.clip(end[o] - shift, 0, n)
        n = b - a
        i = np.arange(n.sum()) + np.repeat(a - np.cumsum(n) + n, n)
        same = code[i + np.repeat(shift, n)] == index.code[i + np.repeat(index.begin[item[o]], n)]
        seen = np.zeros(int(length[o[0] : o[-1] + 1].sum()), bool)  # of every token of every band's passage
        seen[(i + np.repeat(place[o] - place[o[0]], n))[same]] = True
        out[o[0] : o[-1] + 1] = np.add.reduceat(np.r_[seen, False].astype(np.int64), place[o[0] : o[-1] + 1] - place[o[0]])
        lo = hi
    return out


def held(p: np.ndarray, d: np.ndarray, hits: np.ndarray, least: float, penalty: float) -> float:
    """Share of the passage p that d holds in running order, as stretches around the hits (place in p, place in d)."""
    return shares([(p, d, hits, int(least))], penalty)[0] if len(hits) else 0.0


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most SLICE_BYTES of text, or of one row."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.r_[0, np.searchsorted(size, np.arange(SLICE_BYTES, int(size[-1]) if len(size) else 0, SLICE_BYTES), "right"), len(size)])
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield b.slice(i, j - i)


def candidates(index: Index, h: np.ndarray, wide: np.ndarray, starts: np.ndarray, s: Settings) -> list[tuple[int, int, tuple]]:
    """(number of the text, number of the passage, what is aligned) of texts given as tokens."""
    code = index.coded(h)
    hits = index.hits(code, wide)
    doc = np.searchsorted(starts, hits[:, 2], "right") - 1
    order = np.lexsort((hits[:, 0], doc))
    hits, doc = hits[order], doc[order]
    number = lambda d, i: np.cumsum(np.r_[True, (np.diff(d) != 0) | (np.diff(i) != 0)]) - 1 if len(d) else d
    pair = number(doc, hits[:, 0])
    places = crowd(pair, hits[:, 1], hits[:, 2])
    good = places >= np.maximum(SEEDS, SEEDS_PER_TOKEN * index.length[hits[:, 0]])
    good = np.isin(pair, pair[good]) & (places >= SEEDS)
    hits, doc = hits[good], doc[good]
    if not len(doc):
        return []
    pair = number(doc, hits[:, 0])
    diagonal = hits[:, 2] - hits[:, 1]
    order = np.lexsort((diagonal, pair))
    hits, doc, pair, diagonal = hits[order], doc[order], pair[order], diagonal[order]
    band = np.cumsum(np.r_[True, (np.diff(pair) != 0) | (np.diff(diagonal) > slack(index.length[hits[1:, 0]]))]) - 1
    first = np.searchsorted(band, np.arange(band[-1] + 1))
    same = equal(index, code, starts[doc[first]], starts[doc[first] + 1], hits[first, 0], band, diagonal)
    least = np.where(index.wide, s.stretch_wide, s.stretch)[hits[first, 0]]
    same[same < least] = 0
    total = np.bincount(pair[first], weights=same)
    good = (same > 0)[band] & (total >= EQUAL * index.length[hits[np.searchsorted(pair, np.arange(len(total))), 0]])[pair]
    hits, doc, pair = hits[good], doc[good], pair[good]
    edge = np.flatnonzero(np.r_[True, np.diff(pair) != 0]) if len(doc) else np.zeros(0, int)
    out = []
    for a, b in zip(edge.tolist(), np.r_[edge[1:], len(doc)].tolist()):
        k, i = int(doc[a]), int(hits[a, 0])
        reach = 2 * int(index.length[i]) + SLACK + 1  # no band of the hits leads further
        begin, end = max(int(starts[k]), int(hits[a:b, 2].min()) - reach), min(int(starts[k + 1]), int(hits[a:b, 2].max()) + reach)
        part = np.stack([hits[a:b, 1], hits[a:b, 2] - begin], axis=1)
        out.append((k, i, (index.passage(i).copy(), code[begin:end].copy(), part, s.stretch_wide if index.wide[i] else s.stretch)))
    return out


class _Pending:
    """Pairs of many slices, aligned together once there are enough of them."""

    def __init__(self, s: Settings, id_type: pa.DataType, item_type: pa.DataType):
        self.s, self.types, self.ids, self.items, self.pairs, self.size = s, (id_type, item_type), [], [], [], 0

    def add(self, ids: pa.Array, index: Index, found: list[tuple[int, int, tuple]]) -> None:
        self.ids.append(ids.take(pa.array([k for k, _, _ in found], pa.int64())))
        self.items += [index.items[i] for _, i, _ in found]
        self.pairs += [x for _, _, x in found]
        self.size += sum(len(x[1]) for _, _, x in found)

    def done(self) -> pa.RecordBatch:
        share = shares(self.pairs, self.s.penalty)
        rows = [k for k, x in enumerate(share) if x >= self.s.least]
        ids = pa.concat_arrays([*self.ids, pa.array([], self.types[0])]).take(pa.array(rows, pa.int64()))
        out = pa.RecordBatch.from_arrays([ids, pa.array([self.items[k] for k in rows], self.types[1]), pa.array([share[k] for k in rows], pa.float64())], ["id", "item", "share"])
        self.__init__(self.s, *self.types)
        return out


def _scan(batches: Iterator[pa.RecordBatch], sent: list, s: Settings, item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Every slice of the corpus is made tokens once and held against one index after the other."""
    pending = None
    for batch in _slices(batches):
        pending = pending or _Pending(s, batch.column(0).type, item_type)
        h, wide, starts = tokens(batch.column(1).to_pylist())
        for one in sent:
            index = one.value
            pending.add(batch.column(0), index, candidates(index, h, wide, starts, s))
            if len(sent) > 1:  # one at a time in a worker's memory
                index = None
                one.__dict__.pop("_value", None)
            if pending.size > PENDING:
                yield pending.done()
    if pending:
        yield pending.done()


def _blocks(items: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Blocks of bounded size."""
    block: list[tuple] = []
    size = 0
    for item in items:
        if block and (len(block) >= BLOCK_ITEMS or size + len(item[1]) > BLOCK_CHARS):
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item[1])
    if block:
        yield block


def with_standing(items: DataFrame, passage: str) -> DataFrame:
    """items and _standing: whether the passage's opening sentence is also that of another passage."""

    @F.pandas_udf("binary")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([_digest(opening(t)) if t else None for t in b], dtype=object)

    marked = items.withColumn("_head", digest(F.col(passage)))
    shared = marked.groupBy("_head").agg(F.countDistinct(passage).alias("_n")).where("_head IS NOT NULL AND _n > 1").select("_head")
    return marked.join(shared.withColumn("_standing", F.lit(True)), "_head", "left").drop("_head").withColumn("_standing", F.coalesce("_standing", F.lit(False)))


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, settings: Settings | None = None) -> DataFrame:
    """(doc_id, item_id, share): documents that hold at least ``least`` of an item's passage.

    share is the part of the passage's tokens in stretches that the document has in the same
    order, changed words within a stretch included. An opening sentence that several passages
    share is left out of them. Null or empty texts and passages hold nothing. Repeated rows of documents are
    reported once each, repeated passages of an item once. Ids may be of any type. The corpus is read once: the passages, in indexes of
    bounded size, go to all executors, which hold one index at a time; every document is read whole."""
    if doc_id == item_id or "share" in (doc_id, item_id):
        raise ValueError("name the ids differently")
    s = settings or Settings()
    spark = ship(docs.sparkSession)
    d, i = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    item_type = to_arrow_type(i)
    known = items.select(F.col(item_id).alias("_i"), F.col(passage).cast("string").alias("_p")).where("_p IS NOT NULL").distinct()
    known = with_standing(known, "_p").orderBy("_i", "_p")
    sent = [spark.sparkContext.broadcast(Index(block)) for block in _blocks((r[0], r[1], r[2]) for r in known.select("_i", "_p", "_standing").toLocalIterator())]
    out = StructType([StructField("d", d), StructField("i", i), StructField("share", DoubleType())])
    sel = docs.select(F.col(doc_id).alias("d"), F.col(text).cast("string").alias("t"))
    return sel.mapInArrow(lambda it: _scan(it, sent, s, item_type), out).toDF(doc_id, item_id, "share")
