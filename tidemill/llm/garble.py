"""Text decoded with a wrong character encoding: finding it and restoring what was meant.

For every pair of encodings the sequences that the pair makes of ordinary characters are
computed beforehand and searched for by one multi-pattern automaton. Around its hits the
characters are turned back into the bytes they came from; where these are valid in the true
encoding and the evidence is enough, that span, and nothing else, is replaced."""

from __future__ import annotations

import bisect
import functools
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import ship

#: UTF-8 read as one of these. A byte without a character in it is taken as a C1 control.
SINGLE_BYTE = (
    "cp1252", "iso8859_15", "cp1251", "cp437", "cp850", "mac_roman", "koi8_r", "cp866", "cp1250", "iso8859_5", "mac_cyrillic",
    "iso8859_2", "cp852", "iso8859_7", "cp1253", "cp1257",
)
#: UTF-8 read as one of these; characters do not begin where bytes of the text's characters do.
MULTI_BYTE = ("gb18030", "big5hkscs", "cp932", "cp949")
#: A Russian text in the first read as the second, letter by letter.
LETTERWISE = tuple(itertools.permutations(("koi8_r", "cp1251", "cp866"), 2)) + (("iso8859_5", "cp1251"),)
#: Frequent Russian letter pairs.
PAIRS_RU = "ст но то на ен ов ни ра во ко ал по ро не ли ре ка пр та ел ор го ло ны ос ер от ва де те ла ан ит ол ла ес ри он об ом ск ты ки ат".split()
_PAIRS_RU = frozenset(PAIRS_RU)
#: Least evidence for a stretch; see ``_weight``.
ENOUGH, STRONG = 2.0, 1.6


def _plausible(c: str) -> bool:
    """Characters that ordinary text has: not every code point that happens to decode."""
    o = ord(c)
    return (
        0x80 <= o <= 0x17F or o in (0x192, 0x1A0, 0x1A1, 0x1AF, 0x1B0, 0x218, 0x219, 0x21A, 0x21B, 0x2C6, 0x2DC, 0x490, 0x491, 0xFEFF, 0xFFFD) or 0x386 <= o <= 0x3CE or 0x401 <= o <= 0x45F
        or 0x5B0 <= o <= 0x5F4 or 0x60C <= o <= 0x6D5 or 0x901 <= o <= 0x97F or 0xE01 <= o <= 0xE5B or 0x10D0 <= o <= 0x10F0 or 0x1EA0 <= o <= 0x1EF9
        or 0x2002 <= o <= 0x2044 or 0x20A0 <= o <= 0x20BF or 0x2100 <= o <= 0x27BF or 0x3000 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF
        or 0xAC00 <= o <= 0xD7A3 or 0xFE10 <= o <= 0xFE6F or 0xFF00 <= o <= 0xFFEF or 0x1F000 <= o <= 0x1FAFF
    )


def _chars(codec: str) -> dict[int, list[str]]:
    """Characters that a byte from 0x80 on may have become."""
    out = {}
    for b in range(0x80, 0x100):
        c = bytes([b]).decode(codec, "ignore") or chr(b)
        out[b] = [c] if codec != "cp1252" or c == chr(b) else [c, chr(b)]  # cp1252 stands for Latin-1 too
    return out


#: Leads whose 2-byte and 3-byte characters are plausible at all.
_LEADS2 = [b for b in range(0xC2, 0xE0) if any(_plausible(bytes([b, x]).decode()) for x in range(0x80, 0xC0))]
_HEADS3 = [(a, b) for a in range(0xE0, 0xF0) for b in range(0x80, 0xC0) if any(_plausible(t) for x in (0x80, 0x90, 0xA1, 0xBF) if (t := bytes([a, b, x]).decode("utf-8", "ignore")))]


def _usual(c: str) -> bool:
    """Frequent ideographs: the first level of the national set."""
    return b"\xb0" <= c.encode("gb2312", "ignore") < b"\xd8"


class _Tables:
    """What is computed once per Python worker."""

    def __init__(self) -> None:
        import ahocorasick

        self.byte = {w: {c: b for b, cs in _chars(w).items() for c in cs} for w in SINGLE_BYTE}
        seeds: dict[str, set] = {}
        for w in SINGLE_BYTE:
            ch = _chars(w)
            for a in _LEADS2:
                for b in range(0x80, 0xC0):
                    if _plausible(bytes([a, b]).decode()):
                        for s in itertools.product(ch[a], ch[b]):
                            seeds.setdefault("".join(s), set()).add(w)
            for a, b in [*_HEADS3, (0xF0, 0x9F)]:
                for s in itertools.product(ch[a], ch[b]):
                    seeds.setdefault("".join(s), set()).add(w)
        latin = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
        for w in MULTI_BYTE:  # the first two bytes of a 3-byte character, if they are one character
            for a, b in _HEADS3:
                c = bytes([a, b]).decode(w, "ignore")
                if len(c) == 1 and not _usual(c):
                    seeds.setdefault(c, set()).add(w)
            two = [bytes(x).decode(w, "ignore") for x in itertools.product(_LEADS2, range(0x80, 0xC0)) if _plausible(bytes(x).decode())]
            two = [c for c in two if len(c) == 1 and not c.isascii()]  # 2-byte characters become one: beside a Latin letter,
            for c in two:
                for x in latin:
                    seeds.setdefault(x + c, set()).add(w)
                    seeds.setdefault(c + x, set()).add(w)
            cyr = {c for c in two if "\u0400" <= c.encode(w).decode("utf-8", "ignore") <= "\u04ff"}
            for c, d in itertools.product(cyr, cyr):  # or two of Cyrillic ones
                if not (_usual(c) and _usual(d)):
                    seeds.setdefault(c + d, set()).add(w)
        for true, read in LETTERWISE:
            for p in PAIRS_RU:
                g = p.encode(true).decode(read, "ignore")
                if len(g) == 2:
                    seeds.setdefault(g, set()).add(f"{true}>{read}")
        seeds.setdefault("Ã ", set()).add("cp1252")
        # what natural words are made of is no seed; a span that begins at another one still runs over it
        russian = re.compile("[а-яё][а-яёА-ЯЁ]")
        seeds = {x: ws for x, ws in seeds.items() if not (len(x) > 1 and x.isalpha() and (all(c.islower() for c in x) and not any(">" in y for y in ws) or russian.fullmatch(x)))}
        self.one = {w: {c for c, ws in seeds.items() if w in ws and len(c) == 1} for w in MULTI_BYTE}
        # a quick look at all characters at once: can a seed of some class begin here?
        kind = lambda x, w: (w, x[0].isascii(), x[1].isascii())
        two = {x: ws for x, ws in seeds.items() if len(x) > 1}
        bit = {k: np.uint64(1 << n) for n, k in enumerate(sorted({kind(x, w) for x, ws in two.items() for w in ws}))}
        self.first, self.second = np.zeros(0x10000, np.uint64), np.zeros(0x10000, np.uint64)
        for x, ws in two.items():
            for w in ws:
                self.first[ord(x[0])] |= bit[kind(x, w)]
                self.second[ord(x[1])] |= bit[kind(x, w)]
        self.lone = np.zeros(0x10000, bool)
        self.lone[[ord(x) for x in seeds if len(x) == 1] + [0xFFFD]] = True
        self.auto = ahocorasick.Automaton()
        for s, ws in seeds.items():
            self.auto.add_word(s, (len(s), tuple(sorted(ws))))
        self.auto.make_automaton()


@functools.cache
def _tables() -> _Tables:
    return _Tables()


def _scripts(s: str) -> str:
    """One letter per character: Latin, Cyrillic, ideograph, other letter, control, symbol."""
    return "".join(
        "C" if "\x80" <= c <= "\x9f" else "s" if not c.isalpha() else "L" if c < "ɐ" else "R" if "Ѐ" <= c <= "ӿ" else "Z" if "⺀" <= c <= "鿿" else "o" for c in s
    )


def _weight(text: str, i: int, j: int, c: str) -> float:
    """Evidence that text[i:j] is one garbled character c. A sequence that natural words have
    too (letters of one script) counts little, a control character or a symbol inside a word much."""
    kinds = _scripts(text[i:j])
    before, after = text[i - 1 : i], text[j : j + 1]
    if c.isupper() and before.islower():  # a capital within a word: another encoding may read better
        return 0.7
    if c.islower() and before.isupper() and text[i - 2 : i - 1].isupper():  # nor a small letter within capitals
        return 0.3
    if "C" in kinds:
        return 2.0
    if len(set(kinds)) == 1 and kinds[0] in "LRo":
        if text[i] in "ÃÂĂĹ" and j - i == 2:  # never followed by these letters in a word
            return 1.6
        mixed = any(x.isascii() and x.isalpha() for x in (before, after)) and kinds[0] == "R"
        return 1.6 if mixed and j - i == 2 else 1.0 if mixed else 0.25
    if "가" <= c <= "힣":  # what bytes of other garblings make by chance: two together are evidence
        return 1.0 if len(set(kinds)) > 1 else 0.4
    if j - i > 2:
        return 2.0
    if kinds[0] == "L":
        return 1.0 if text[i + 1] in "«»  ´" and not after.isalpha() else 2.0
    inside = any(x.isalpha() and x.isascii() for x in (before, after)) or (before.isalpha() and after.isalpha())
    return 2.0 if inside and kinds != "ss" else 1.6 if inside else 0.7


def _single(text: str, at: list[int], w: str) -> list[tuple[int, int, str, float]]:
    """Spans (begin, end, meant, evidence) of UTF-8 read as the single-byte w; at: the seeds."""
    byte, hits, end = _tables().byte[w], [], 0
    for i in at:
        if i < end:
            continue
        while True:  # on from one garbled character to the next
            lead = byte.get(text[i]) if i < len(text) else None
            n = 0 if lead is None else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if lead < 0xF5 and lead >= 0xF0 else 0
            if not n or i + n > len(text):
                break
            # a plain space may stand for the byte A0, its weight is small if nothing else speaks for it
            space = 0xA0 if w == "cp1252" and (n == 3 or lead == 0xC3) else 0
            raw = [lead, *(space if x == " " else byte.get(x, 0) for x in text[i + 1 : i + n])]
            c = bytes(raw).decode("utf-8", "ignore")
            if len(c) != 1 or not _plausible(c):
                break
            weight = _weight(text, i, i + n, c)
            hits.append((i, i + n, c, min(weight, 0.3) if n == 3 and " " in text[i : i + n] else weight))
            i = end = i + n
    return _joined(hits)


def _whole_lines(text: str, spans: list, w: str) -> list[tuple[int, int, str, float]]:
    byte, lines = _tables().byte[w], {}
    for i, _, _, _ in spans:
        a = text.rfind("\n", 0, i) + 1
        if a not in lines:
            b = text.find("\n", i)
            lines[a] = len(text) if b < 0 else b
    at = [i for a, b in sorted(lines.items()) for i in range(a, b) if byte.get(text[i], 0) >= 0xC2]
    return _single(text, at, w)


def _joined(hits: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Hits that touch become one span; each touch is evidence too."""
    out: list[list] = []
    for i, j, c, w in hits:
        if out and out[-1][1] == i:
            out[-1] = [out[-1][0], j, out[-1][2] + c, out[-1][3] + w + 0.35]
        else:
            out.append([i, j, c, w])
    return [tuple(x) for x in out]


_RUN = re.compile(r"[^\x00-\x7f]+[\x40-\x7e]?")


def _reads(s: str, w: str) -> bool:
    try:
        return all(_plausible(c) or c.isascii() for c in s.encode(w).decode("utf-8"))
    except UnicodeError:
        return False


def _multi(text: str, at: list[int], w: str) -> list[tuple[int, int, str | None, float]]:
    """Spans of UTF-8 read as the multi-byte w; meant is None where bytes were lost."""
    t, out, end = _tables(), [], 0
    for i in at:
        if i < end:
            continue
        b = i
        if text[i].isascii():
            b = i = i + 1
        if text[i] in t.one[w]:  # from head to head, the last one's rest included
            e = i + 1
            while e < len(text) and not text[e].isascii() and e - i < 7:
                if text[e] in t.one[w] or text[e] == "\ufffd":
                    i = e
                e += 1
            last = i
            e = min(e, last + 3)
        else:
            while b and not text[b - 1].isascii():
                b -= 1
            e = last = _RUN.match(text, b).end()
            last -= text[e - 1].isascii()
        for stop in range(e, max(last, b), -1) if text[i] in t.one[w] else (last, e):  # the longest that reads well
            if _reads(text[b:stop], w):
                e = stop
                break
        core, end = text[b:e], e
        lost = core.count("�")
        heads = sum(c in t.one[w] for c in core)
        if lost:
            raw = b"".join(b"\xff" if c == "�" else c.encode(w, "ignore") for c in core)
        else:
            try:
                raw = core.encode(w)
            except UnicodeEncodeError:
                raw = core.encode(w, "ignore")
                lost = 1
        good = raw.decode("utf-8", "ignore")
        multi = [c for c in good if not c.isascii()]
        fair = sum(_plausible(c) for c in multi)
        used = sum(len(c.encode()) for c in good if c.isascii() or _plausible(c))
        wide = sum(len(c.encode()) == 3 and _plausible(c) for c in multi)
        before, after = text[b - 1 : b], text[end : end + 1]
        inside = (before.isascii() and before.isalpha()) + (after.isascii() and after.isalpha())
        if lost:
            pairs = sum(x in t.one[w] and y == "�" for x, y in zip(core, core[1:]))
            share = used / max(1, len(raw.replace(b"\xff", b"")))
            score = (2.0 if wide >= 2 and share > 0.6 else 0) + 0.7 * pairs * (lost >= 2 or wide > 0 or inside > 0) + 0.3 * heads
            if score >= 1:
                out.append((b, end, None, score))
            continue
        if used < len(raw) or not multi:
            if wide >= 3 and used / len(raw) > 0.85:
                out.append((b, end, None, 2.0))  # the last bytes were lost
            continue
        if wide and (wide >= 2 or fair >= 2):
            score = 1.0 + wide
        elif fair >= 3 and all("Ѐ" <= c <= "ӿ" for c in multi):
            score = 0.6 * fair - 0.9 * all(c in "小校笑效些孝肖" for c in core)
        elif fair == len(multi) and len(core) <= 3 and inside:
            score = 1.0 * inside if len(core) < 2 else 2.0
        elif wide:
            score = 1.6 if inside else 0.7
        else:
            score = 0.0
        if score:
            out.append((b, end, good, score))
    return out


_BEYOND, _GREEK = re.compile(r"[^\x00-\x7f]+"), re.compile(r"[Ͱ-Ͽ]{3,}")
_CONTROLS = re.compile("[\x80-\x84\x86-\x9f\ufffd]")
_SPOKEN_OF = re.compile(r"(?<![^\s(\[\"'«“„])\ufffd(?![^\s)\]\"'»”“,.;:!?])")
_CYR = re.compile(r"[Ѐ-ӿ]")

# --- texts in a national set, read as another --------------------------------------------

#: What a text that is no UTF-8 may have been read as, and what it may have been.
READ_AS = ("latin_1", "cp1252", "cp1251", "koi8_r", "cp866", "cp437", "cp850", "mac_roman", "cp1250", "iso8859_2", "iso8859_5", "iso8859_7", "cp1253", "mac_cyrillic", "gbk", "big5", "cp932", "cp949")
MEANT = ("cp1252", "cp1250", "iso8859_2", "cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic", "mac_roman", "cp437", "cp850", "cp1253", "iso8859_7", "gbk", "big5", "cp932", "euc_jp", "cp949")
#: Kinds of characters.
(OTHER, LOWER, UPPER, LAT, LAT_UP, CYR, CYR_UP, GREEK, GREEK_UP, WIDE, SIGN, CONTROL, BOX, LETTER, PUNCT, HANGUL) = range(16)
#: Letters of the alphabets that the single-byte sets were made for, and signs of running text.
_WESTERN = "àâäáãåæçèéêëìíîïñòóôöõøùúûüýÿßœšž"
_CENTRAL = "ąćęłńóśźżčďěňřšťůžáéíýúôľĺŕőűăâîșțşţđ"
_RUSSIAN = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
_MODERN_GREEK = "αβγδεζηθικλμνξοπρσςτυφχψωάέήίόύώϊϋΐΰ"
_MARKS, _SIGNS = "‘’“”„«»‹›–—…•·", "°€£§№™©®×¿¡½²³"
#: A reading is taken if its score is at least GOOD, MORE than that of the text and CLEAR of any other reading.
#: Where a reading as UTF-8 explains most of a stretch, another one must be SURE.
GOOD, MORE, CLEAR, SURE = 0.8, 0.3, 0.04, 0.95


class _Kinds:
    """Kind and naturalness of every character, and which kinds do not stand next to each other."""

    def __init__(self) -> None:
        import unicodedata

        self.kind, self.worth = np.zeros(0x10000, np.uint8), np.zeros(0x10000, np.float32)
        best = dict.fromkeys(_WESTERN + _RUSSIAN + _MODERN_GREEK, 1.0) | {c: 0.95 for c in _CENTRAL if c not in _WESTERN}
        for o in range(0x10000):
            c = chr(o)
            if o < 0x80:
                self.kind[o], self.worth[o] = (LOWER if c.islower() else UPPER if c.isupper() else OTHER), 1.0
                continue
            alpha, up, low = c.isalpha(), c.isupper(), c.lower()
            if o < 0xA0:
                k, w = CONTROL, -1.0
            elif 0xFF01 <= o <= 0xFF5E:  # full-width forms of ASCII
                k, w = (LOWER if c.islower() else UPPER if up else PUNCT), 0.9
            elif 0x2500 <= o <= 0x25FF:
                k, w = BOX, -0.2
            elif o < 0x250 and alpha and c not in "ªºµ":
                k, w = (LAT_UP if up else LAT), best.get(low[:1], 0.3)
            elif 0x400 <= o <= 0x4FF and alpha:
                k, w = (CYR_UP if up else CYR), best.get(low, 0.3)
            elif 0x370 <= o <= 0x3FF and alpha:
                k, w = (GREEK_UP if up else GREEK), best.get(low, 0.3)
            elif 0x4E00 <= o <= 0x9FFF:
                g, t = c.encode("gb2312", "ignore"), c.encode("big5", "ignore")
                k, w = WIDE, 1.0 if b"\xb0" <= g < b"\xd8" else 0.85 if b"\xa4" <= t < b"\xc9" else 0.2
            elif 0x3041 <= o <= 0x30FE:
                k, w = WIDE, 1.0
            elif 0xAC00 <= o <= 0xD7A3:
                k, w = HANGUL, 1.0 if b"\xb0" <= c.encode("euc_kr", "ignore")[:1] else 0.2
            elif 0x3001 <= o <= 0x3011 or o in (0xFF01, 0xFF08, 0xFF09, 0xFF0C, 0xFF1A, 0xFF1B, 0xFF1F):
                k, w = PUNCT, 1.0
            elif 0xFF61 <= o <= 0xFF9F:
                k, w = LETTER, 0.1
            elif c in _MARKS + _SIGNS:
                k, w = (PUNCT if c in _MARKS else SIGN), 0.7
            else:
                k, w = (LETTER if alpha else OTHER if unicodedata.category(c)[0] == "M" or unicodedata.category(c) == "Cf" else SIGN), 0.2
            self.kind[o], self.worth[o] = k, w
        latin, other = (LOWER, UPPER, LAT, LAT_UP), (CYR, CYR_UP, GREEK, GREEK_UP)
        odd = np.zeros((16, 16), bool)
        for a in (*latin, *other, LETTER):
            for b in (*latin, *other, LETTER):
                odd[a, b] = latin.index(a) // 4 != 0 if a in latin and b in latin else (a in latin) != (b in latin) or (a in (CYR, CYR_UP)) != (b in (CYR, CYR_UP))
        for a in (LOWER, LAT, CYR, GREEK):
            for b in (LAT_UP, CYR_UP, GREEK_UP):
                odd[a, b] = True
        letters = (*latin, *other)
        for x in (CONTROL, BOX):
            odd[x, list(letters)] = odd[list(letters), x] = True
        odd[SIGN, SIGN] = odd[CONTROL, :] = odd[:, CONTROL] = True
        odd[LAT, SIGN] = odd[SIGN, LAT] = odd[LAT_UP, SIGN] = odd[SIGN, LAT_UP] = odd[CYR, SIGN] = odd[SIGN, CYR] = True
        odd[WIDE, HANGUL] = odd[HANGUL, WIDE] = True
        self.odd = odd
        self.accented = np.isin(np.arange(16), (LAT, LAT_UP))
        self.upper = np.isin(np.arange(16), (LAT_UP, CYR_UP, GREEK_UP))
        self.letter = np.isin(np.arange(16), (*letters, LETTER))


@functools.cache
def _kinds() -> _Kinds:
    return _Kinds()


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)


def _oddities(kind: np.ndarray) -> np.ndarray:
    """Which characters stand where they do not in right text: beside what they never stand by, as the third accented letter in a
    row, or as a sign between letters."""
    k = _kinds()
    out = np.zeros(len(kind), bool)
    if len(kind) > 1:
        pair = k.odd[kind[:-1], kind[1:]]
        out[1:] = pair
    if len(kind) > 2:
        a = k.accented[kind]
        out[2:] |= a[2:] & a[1:-1] & a[:-2]
        out[1:-1] |= (kind[1:-1] == SIGN) & k.letter[kind[:-2]] & k.letter[kind[2:]]
    return out


def _score(text: str) -> float:
    """How natural the characters beyond ASCII are, 1 at most; capitals that begin no word count less, oddities against it."""
    k, code = _kinds(), _codes(text)
    kind = k.kind[code]
    far = code >= 0x80
    if not far.any():
        return 0.0
    worth = k.worth[code]
    inner = np.zeros(len(code), bool)
    inner[1:] = k.upper[kind[1:]] & k.letter[kind[:-1]]
    worth[inner] *= 0.8
    wide, latin = (kind == WIDE) | (kind == HANGUL), (kind == LOWER) | (kind == UPPER)
    # a Greek word has one accent
    bad = sum(len(x) for x in _GREEK.findall(text) if sum(c in "άέήίόύώΐΰΆΈΉΊΌΎΏ" for c in x) != 1 and not x.isupper()) if (kind == GREEK).any() else 0
    mixed = (wide[1:] & latin[:-1]).sum() + (wide[:-1] & latin[1:]).sum()  # words of another script stand within a text here and there
    return float((worth[far].sum() - _oddities(kind)[1:].sum() - 0.5 * mixed - 0.3 * bad) / far.sum())


def _readings(part: str) -> list[tuple[float, str, str]]:
    """(score, meant, set) of the ways to read a stretch, the best first; of like readings one."""
    out: dict[str, tuple[float, str]] = {}
    for read in READ_AS:
        try:
            raw = part.encode(read)
        except UnicodeEncodeError:
            if read != "cp1252":
                continue
            try:  # with controls, as it is read in practice
                raw = b"".join(bytes([ord(c)]) if "\x80" <= c < "\xa0" else c.encode("cp1252") for c in part)
            except UnicodeEncodeError:
                continue
        for meant in MEANT:
            if meant == read:
                continue
            try:
                t = raw.decode(meant)
            except UnicodeDecodeError:
                continue
            if t == part or t in out or t.isascii():
                continue
            try:
                back = t.encode(meant) == raw
            except UnicodeEncodeError:
                back = False
            if back:
                score = _score(t)
                if "가" <= max(t) <= "힣":  # words of Korean are short, between spaces
                    runs = re.findall("[가-힣]+", t)
                    score += 0.05 if len(runs) > 1 and sum(map(len, runs)) <= 5 * len(runs) else -0.1
                elif meant in ("gbk", "big5", "cp949") and any(len(x) < 2 for x in re.findall("[⺀-鿿]+", t)):
                    score -= 0.02
                out[t] = (score, meant)
    return sorted(((s, t, m) for t, (s, m) in out.items()), key=lambda x: (-x[0], x[2]))


def _apart(best: tuple, other: tuple) -> bool:
    """Whether the second of two readings of about the same score can be ruled out: it differs in a few characters, which are worse."""
    a, b = best[1], other[1]
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= 0.1 * len(a) and (best[0] - other[0]) * sum(not c.isascii() for c in a) >= 0.25


def _run_by_run(text: str, i: int, j: int, before: float) -> list[tuple[int, int, str | None, float]]:
    """A stretch in which some bytes were lost: its runs beyond ASCII by the set that reads most of them."""
    runs = [m.span() for m in _BEYOND.finditer(text, i, j)]
    by: dict[str, dict[tuple[int, int], tuple[float, str]]] = {}
    for a, b in runs:
        for s, t, m in _readings(text[a:b]):
            if s >= GOOD:
                by.setdefault(m, {})[a, b] = s, t
    size = {m: sum((b - a) * s for (a, b), (s, _) in x.items()) for m, x in by.items()}
    best = max(sorted(size), key=size.get, default=None)
    every = sum(b - a for a, b in runs)
    if best is None or every < 8 or every < 3 * len(runs) or size[best] < 0.7 * every or before > GOOD - MORE + 0.2:
        return []
    if any(m != best and size[m] > (1 - CLEAR) * size[best] and any(x.get(r, (0, ""))[1] != t for r, (_, t) in by[best].items()) for m, x in by.items()):
        return [(i, j, None, 3.0 * every)]
    return [(a, b, by[best][a, b][1] if (a, b) in by[best] else None, 3.0 * (b - a)) for a, b in runs]


def _national_lines(code: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(begin, end, places) of stretches, a line's at most, with characters that cannot stand where they do. Between the
    scripts of East Asia and others a stretch ends, if both have such characters."""
    k = _kinds()
    kind = k.kind[code]
    strange = _oddities(kind)
    strange |= (kind == WIDE) & (k.worth[code] < 0.5)  # rare ideographs
    odd = np.flatnonzero(strange)
    if not len(odd):
        return []
    ends = np.append(np.flatnonzero(code == 10), len(code))
    line = np.searchsorted(ends, odd)
    out = []
    for n in np.unique(line).tolist():
        a, b = int(ends[n - 1]) + 1 if n else 0, int(ends[n])
        own = odd[line == n]
        words = len(np.unique(np.cumsum(code[a:b] == 32)[np.minimum(own, b - 1) - a]))
        rare = kind[own] == WIDE
        if rare.sum() > 5 and rare.sum() > 0.4 * (kind[a:b] == WIDE).sum() or (~rare).sum() > 2 or (words > 1 and not rare.all()) or (kind[a:b] == CONTROL).any():
            far = code[a:b] >= 0x2E80
            for i, j in _parts(far, a, b) if far.any() and not far[np.minimum(own, b - 1) - a].any() else [(a, b)]:
                if len(mine := own[(own >= i) & (own <= j)]):
                    out.append((i, j, mine))
    return out


def _parts(far: np.ndarray, a: int, b: int) -> list[tuple[int, int]]:
    """Runs of a to b in which ``far`` is false."""
    edge = np.flatnonzero(np.diff(np.r_[True, far, True].astype(np.int8)))
    return [(a + int(i), a + int(j)) for i, j in zip(edge[::2], edge[1::2])]


def _national(text: str, code: np.ndarray, lines: list[tuple[int, int, np.ndarray]], known: np.ndarray) -> list[tuple[int, int, str | None, float]]:
    """Stretches, a line's at most, that another set explains better; meant is None where several sets do, or none though the
    characters cannot be right. known: how many characters before each are explained already; a stretch where most is, is left."""
    kind, out = _kinds().kind[code], []
    for a, b, odd in lines:
        controls = int((kind[a:b] == CONTROL).sum())
        far = np.flatnonzero(code[a:b] >= 0x80)
        at = np.minimum(odd, b - 1)
        explained = (known[at + 1] > known[at]) | (known[at] > known[np.maximum(at - 1, 0)])
        if not len(far):
            continue
        share = float(known[b] - known[a]) / len(far) if explained.mean() >= 0.7 else 0.0
        if share > 0.98:
            continue
        i, j = a + int(far[0]), a + int(far[-1]) + 1
        part = text[i:j]
        if "\ufffd" in part:
            continue
        before = _score(part)
        found = []
        for more in (0, 1):  # the second byte of the last character may be a letter
            if more and (j >= b or not "@" <= text[j] <= "~"):
                continue
            found += [(s, t, m, j + more) for s, t, m in _readings(text[i : j + more]) if not more or m in ("gbk", "big5", "cp932")]
        found.sort(key=lambda x: -x[0])
        if share >= 0.6 and not (found and found[0][0] >= SURE):
            continue
        if found and found[0][0] >= GOOD and found[0][0] >= before + MORE:
            best = found[0]
            clear = all(_apart(best, x) for x in found[1:] if x[0] >= best[0] - CLEAR)
            out.append((i, best[3], best[1] if clear else None, 3.0 * len(far)))
        elif not found and (spans := _run_by_run(text, i, j, before)):
            out += spans
        elif controls > 1 and before < 0.3:
            out.append((i, j, None, 0.5))
    return out


def _letterwise(text: str, counts: list[tuple[int, tuple]], breaks: list[int]) -> list[tuple[int, int, str | None, float]]:
    """Russian in one Cyrillic set read as another, clause by clause; short clauses follow the
    others of their line."""
    by: dict[int, dict[str, int]] = {}
    for i, ws in counts:
        part = by.setdefault(bisect.bisect(breaks, i), {})
        for w in ws:
            if ">" in w:
                part[w] = part.get(w, 0) + 1
    known: dict[int, str] = {}
    out: dict[int, tuple[int, int, str, float]] = {}

    def judged(n: int, pair: str) -> tuple[int, int, str, int, int, int]:
        a, b = breaks[n - 1] + 1 if n else 0, breaks[n] if n < len(breaks) else len(text)
        true, read = pair.split(">")
        raw = "".join(x if x.isascii() else x.encode(read, "ignore").decode(true, "ignore") or x for x in text[a:b])
        good, bad = (sum(x.lower()[i : i + 2] in _PAIRS_RU for i in range(len(x) - 1)) for x in (raw, text[a:b]))
        return a, b, raw, len(_CYR.findall(text[a:b])), good, bad

    for n, c in by.items():
        best = max(c, key=lambda w: (c[w], w))
        a, b, raw, letters, good, bad = judged(n, best)
        cyr = sum("\u0400" <= x <= "\u04ff" for x in raw)
        if letters >= 10 and c[best] >= 0.12 * letters and cyr >= 0.8 * letters and sum(x.islower() for x in raw) >= 0.5 * letters and good >= 0.15 * letters and good > 2 * bad:
            known.setdefault(text.rfind("\n", 0, a), best)
            out[n] = (a, b, raw, 3.0)
    for start, pair in known.items():  # a line of which most is misread is misread as a whole
        end = text.find("\n", start + 1)
        end = len(text) if end < 0 else end
        inside = range(bisect.bisect(breaks, start), bisect.bisect_left(breaks, end) + 1)
        if sum(len(_CYR.findall(out[n][2])) for n in inside if n in out) >= 0.5 * len(_CYR.findall(text[start + 1 : end])):
            for n in inside:
                if n not in out:
                    a, b, raw, letters, good, bad = judged(n, pair)
                    if letters and good >= bad:
                        out[n] = (a, b, raw, 3.0)
    return sorted(out.values())


def garbled_spans(text: str | None) -> list[tuple[int, int, str | None]]:
    """(begin, end, meant) of the garbled stretches of a text; meant is None where it is lost."""
    if not text or text.isascii():
        return []
    t = _tables()
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.minimum(code, 0xFFFF)  # no seed lies beyond
    here = t.lone[code]
    here[:-1] |= (t.first[code[:-1]] & t.second[code[1:]]) != 0
    spots = np.flatnonzero(here)
    strange = _national_lines(code)
    if not len(spots) and not len(strange):
        return []
    seeds: dict[str, list[int]] = {}
    letters: list[tuple[int, tuple]] = []
    breaks = np.flatnonzero(np.diff(spots) > 3)
    for a, b in zip(spots[np.r_[0, breaks + 1]].tolist(), spots[np.r_[breaks, len(spots) - 1]].tolist()) if len(spots) else ():
        for end, (n, ws) in t.auto.iter(text[a : b + 3]):
            i = a + end - n + 1
            if any(">" in w for w in ws):
                letters.append((i, ws))
            for w in ws:
                if ">" not in w:
                    seeds.setdefault(w, []).append(i)
    found: list[tuple[float, list]] = []
    names: dict[int, str] = defaultdict(str)
    for w, at in seeds.items():
        spans = _single(text, at, w) if w in SINGLE_BYTE else _multi(text, sorted(set(at)), w)
        if spans:
            names[id(spans)] = w
            found.append((sum(s[3] for s in spans), spans))
    if len(strange):  # what is UTF-8 is no national set
        known = np.zeros(len(code) + 1, np.int64)
        for i, j in {x[:2] for total, spans in found for x in spans if x[3] >= STRONG or total >= 2 * ENOUGH}:
            known[i + 1 : j + 1] = 1
        spans = _national(text, code, strange, np.cumsum(known))
        found += [(sum(s[3] for s in spans), spans)] if spans else []
    lost = [(m.start(), m.end(), None, 2.0) for m in re.finditer("\ufffd+", text)]
    if len(lost) == 1 and _SPOKEN_OF.search(text):  # a text about the character
        lost = []
    if lost:  # what no decoding leaves in a text
        found.append((0.0, lost))
    if letters:
        spans = _letterwise(text, letters, [m.start() for m in re.finditer(r"[\n.!?;:,|]", text)])
        found += [(sum(s[3] for s in spans), spans)] if spans else []
    out: list[tuple[int, int, str | None]] = []
    taken = bytearray(len(text))
    found.sort(key=lambda x: -x[0])
    single = [n for n, x in enumerate(found) if names[id(x[1])] in SINGLE_BYTE]
    if len(single) > 1:  # the set that was used explains most characters
        lines = {n: _whole_lines(text, [x for x in found[n][1] if x[3] >= 0.6], names[id(found[n][1])]) for n in single}
        order = sorted(single, key=lambda n: (-found[n][0] - sum(x[1] - x[0] for x in lines[n]) / 2, SINGLE_BYTE.index(names[id(found[n][1])])))
        for n, x in zip(single, [found[n] for n in order]):
            found[n] = x
    for total, spans in found:
        if spans is not lost and max(s[3] for s in spans) < STRONG and total < 2 * ENOUGH:
            continue
        name, least = names[id(spans)], 0.6
        if name in SINGLE_BYTE:  # the encoding is known: in these lines what natural words have too is read by it
            spans, least = _whole_lines(text, [x for x in spans if x[3] >= 0.6], name), 0.2
        for i, j, s, w in spans:
            if w >= least and taken.find(1, i, j) < 0:
                taken[i:j] = b"\1" * (j - i)
                out.append((i, j, s))
    return sorted(out)


def restore(text: str | None) -> tuple[str | None, int, bool]:
    """The text as meant, the number of garbled stretches, and whether all could be restored.

    Text garbled more than once is restored in as many rounds as it takes. Stretches whose bytes were lost, or that several sets explain,
    stay as they are. All could be restored if, besides, no character is left where stretches were that text does not have."""
    spans = garbled_spans(text)
    n, whole = len(spans), all(s is not None for _, _, s in spans)
    seen = set()
    while any(s is not None for _, _, s in spans) and text not in seen:  # a text that comes again would go round for ever
        seen.add(text)
        parts, at, size, new = [], 0, 0, []
        for i, j, s in spans:
            piece = text[i:j] if s is None else s
            parts += [text[at:i], piece]
            size += i - at
            new.append((size, size + len(piece)))
            size, at = size + len(piece), j
        text = "".join([*parts, text[at:]])
        # what was garbled twice is garbled still
        spans = [x for x in garbled_spans(text) if any(a < x[1] and x[0] < b for a, b in new[max(0, bisect.bisect(new, (x[0],)) - 1) :][:2])]
    whole = whole and not spans
    return text, n, n > 0 and whole and not _CONTROLS.search(text)


def find_garbled(df: DataFrame, text: str, with_text: bool = True) -> DataFrame:
    """df's columns and n_garbled, restorable and, if asked for, restored.

    n_garbled counts the stretches decoded with a wrong encoding; unusual but correct characters
    are none. restored is the text with only these stretches replaced, or the text itself. Null
    gives null, 0 and false; empty and ASCII texts are never garbled. Texts are read whole.
    Rows are judged one by one, so repeated rows come out alike."""
    clash = {"n_garbled", "restorable", "restored"} & set(df.columns)
    if clash:
        raise ValueError(f"rename {sorted(clash)} first")

    ship(df.sparkSession)
    kind = "n int, ok boolean" + (", restored string" if with_text else "")

    @F.pandas_udf(kind)
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if with_text:
                rows = [restore(x) for x in b]
                yield pd.DataFrame({"n": [r[1] for r in rows], "ok": [r[2] for r in rows], "restored": [r[0] for r in rows]})
            else:
                spans = [garbled_spans(x) for x in b]
                yield pd.DataFrame({"n": [len(s) for s in spans], "ok": [bool(s) and all(x[2] is not None for x in s) for s in spans]})

    # a text of as many bytes as characters is ASCII and needs no look
    g = df.withColumn("_g", f(F.when(F.octet_length(text) > F.length(text), F.col(text))))
    out = [F.col("_g.n").alias("n_garbled"), F.col("_g.ok").alias("restorable")]
    return g.select(*df.columns, *out, *([F.coalesce("_g.restored", text).alias("restored")] if with_text else []))
