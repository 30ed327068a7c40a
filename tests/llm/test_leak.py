import random
from types import SimpleNamespace

import pytest

from tidemill.llm import leak

WORDS = [a + b for a in "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split() for b in "ne ra so ti mu pa".split()]


def passage(seed, n=80):
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(n)]


def found(spark, docs, items, **s):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, passage string")
    return {(r.doc_id, r.item_id): r.share for r in leak.leaks(d, "doc_id", "text", i, "item_id", "passage", leak.Settings(**s) if s else None).collect()}


def test_forms_changes_and_parts(spark):
    p, rng = passage(1), random.Random(5)
    noise = lambda n: " ".join(passage(rng.random(), n))
    changed = [w if rng.random() > 0.25 else "other" for w in p]
    shuffled = p[:]
    rng.shuffle(shuffled)
    docs = [
        noise(200),
        noise(30) + " " + ", ".join(w.upper() for w in p) + " " + noise(30),
        noise(30) + " " + " ".join(changed) + " " + noise(30),
        " ".join(p[:46]) + " " + noise(60),
        " ".join(p[:24]) + " " + noise(9) + " " + " ".join(p[40:64]),
        " ".join(p[:20]) + " " + noise(60),
        " ".join(shuffled),
        " ".join(p[40:]) + " " + noise(5) + " " + " ".join(p[:15]),
        "<p>" + "<br>".join(f"**{w}**" for w in p) + "</p>",
        "", None, "x" * 100_000,
    ]
    got = found(spark, docs, [(7, " ".join(p)), (8, " ".join(passage(2))), (9, None), (10, "")])
    assert {d for d, i in got if i == 7} == {1, 2, 3, 4, 7, 8} and not [1 for d, i in got if i != 7]


def test_ideographs(spark):
    rng = random.Random(3)
    p = "".join(chr(rng.randint(0x4E00, 0x4E90)) for _ in range(150))
    wide = p.replace(p[40], p[40] + "​")
    assert set(found(spark, ["前言。" + "，".join(wide[i : i + 9] for i in range(0, len(wide), 9)), p[::-1], p[:50]], [(1, p)])) == {(0, 1)}


def test_standing_opening_is_no_case(spark):
    head = " ".join(passage(9, 30)) + ". "
    items = [(i, head + " ".join(passage(i + 50, 30))) for i in range(3)]
    got = found(spark, [head + " ".join(passage(99, 60)), head + " ".join(passage(51, 30))], items)
    assert set(got) == {(1, 1)}


def test_empty_sides_and_repeats(spark):
    p = " ".join(passage(1))
    assert found(spark, [], [(1, p)]) == {} and found(spark, [p], []) == {}
    d = spark.createDataFrame([(1, p, "a"), (1, p, "a")], "doc_id bigint, text string, share string")
    i = spark.createDataFrame([(1, p), (1, p)], "item_id bigint, passage string")
    assert leak.leaks(d, "doc_id", "text", i, "item_id", "passage").count() == 2


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(leak, "BLOCK_ITEMS", 2)
    items = [(i, " ".join(passage(i))) for i in range(5)]
    assert set(found(spark, [t for _, t in items], items)) == {(i, i) for i in range(5)}


@pytest.mark.parametrize("share", [0.0, 0.3, 0.4])
def test_share_against_full_alignment(share):
    """The chained stretches against a longest common subsequence over all positions."""
    import numpy as np

    rng = random.Random(share)
    p = np.array([rng.randint(1, 400) for _ in range(90)])
    d = np.array([x if rng.random() >= share else 0 for x in p])
    hits = np.stack([np.flatnonzero(p == d)] * 2, axis=1)
    lcs = [[0] * 91 for _ in range(91)]
    for i in range(90):
        for j in range(90):
            lcs[i + 1][j + 1] = lcs[i][j] + 1 if p[i] == d[j] else max(lcs[i][j + 1], lcs[i + 1][j])
    assert leak.held(p, d, hits, 7, 1.0) >= lcs[90][90] / 90 - 0.1


def test_slices_keep_all_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(leak, "SLICE_BYTES", 10)
    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["abc", None, "x" * 25, "", "yyyyyyyyyy", "z"])], ["a", "b"])
    out = list(leak._slices(iter([b, b.slice(0, 0)])))
    assert [i for x in out for i in x.column(0).to_pylist()] == list(range(6)) and len(out) > 2


@pytest.mark.parametrize("kind", ["every third changed", "every sixth dropped", "dropped", "two for one", "none to two for one", "ideographs inserted", "ideographs replaced"])
def test_whole_passage_with_shifts(spark, kind):
    """Dropped, inserted and differently long words, up to two in five, in a passage held whole."""
    rng = random.Random(kind)
    other = lambda k: [f"other{rng.randint(1, 10**6)}" for _ in range(k)]
    wide = kind.startswith("ideographs")
    items, docs = [], []
    for i in range(30):
        p = [chr(rng.randint(0x4E00, 0x51FF)) for _ in range(120)] if wide else [f"word{rng.randint(1, 600)}" for _ in range(120)]
        d = []
        for k, x in enumerate(p):
            hit = rng.random() < 0.4
            if kind == "every sixth dropped":
                d += [] if k % 6 == 5 else [x]
            elif kind == "every third changed":
                d += other(1) if k % 3 == 2 else [x]
            elif kind == "dropped":
                d += [] if hit else [x]
            elif kind == "two for one":
                d += other(2) if hit else [x]
            elif kind == "none to two for one":
                d += other(rng.randint(0, 2)) if hit else [x]
            elif kind == "ideographs inserted":
                d += [x, "龘"] if k % 9 == 8 else [x]
            elif k % 2 == 0:
                d += [chr(rng.randint(0x6000, 0x8000)) for _ in range(rng.randint(1, 3))] if hit else p[k : k + 2]
        items.append((i, ("" if wide else " ").join(p)))
        docs.append(("。" if wide else " ").join([("" if wide else " ").join(other(20)), ("" if wide else " ").join(d)]))
    got = found(spark, docs, items)
    assert len([1 for d, i in got if d == i]) >= 25 and not [1 for d, i in got if d != i]


def test_bound_of_seeds_keeps_the_tail(monkeypatch):
    """Two words of five changed in short passages: the same is found as without any bound."""
    import pyarrow as pa

    rng = random.Random(4)
    items = [(i, " ".join(f"word{rng.randint(1, 600)}" for _ in range(63))) for i in range(300)]
    docs = [" ".join(f"other{rng.randint(1, 10**6)}" if rng.random() < 0.43 else x for x in p.split()) for _, p in items]
    batch, index = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(docs)], ["id", "text"]), leak.Index([(*x, False) for x in items])
    scan = lambda: sum(x.num_rows for x in leak._scan(iter([batch]), [SimpleNamespace(value=index)], leak.Settings(), pa.int64()))
    got = scan()
    for name, value in (("SEEDS", 1), ("SEEDS_PER_TOKEN", 0), ("EQUAL", 0)):
        monkeypatch.setattr(leak, name, value, raising=False)
    assert got >= 0.99 * scan() > 0


def test_half_is_half(spark):
    """Unchanged text has no slack, changed words at the ends of stretches are held."""
    p, noise = [f"word{i}" for i in range(100)], " ".join(f"other{i}" for i in range(60))
    changed = ["new" if i % 4 == 3 else w for i, w in enumerate(p)]
    docs = [" ".join(p[:k]) + " " + noise for k in (48, 49, 50)] + [" ".join(changed[:52]) + " " + noise, " ".join(changed[:40]) + " " + noise]
    assert {d for d, _ in found(spark, docs, [(1, " ".join(p))])} == {2, 3}


def test_standing_opening_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(leak, "BLOCK_ITEMS", 1)
    head = " ".join(passage(9, 40)) + ". "
    items = [(i, head + " ".join(passage(i + 50, 30))) for i in range(3)]
    assert found(spark, [head + " ".join(passage(99, 60))], items) == {}


def changed(kind, p, rng):
    """A passage with every n-th, or a share of its words at random, changed."""
    hit = (lambda k: k % kind == kind - 1) if isinstance(kind, int) else (lambda k: rng.random() < kind)
    return [f"other{rng.randint(1, 10**6)}" if hit(k) else w for k, w in enumerate(p)]


@pytest.mark.parametrize("kind", [2, 3, 4, 5, 6, 7, 8, 0.3, 0.4, 0.45])
def test_no_regular_or_random_minority_blinds(kind):
    """Whole passages of 63 to 180 words, none of whose own words repeat much."""
    rng = random.Random(str(kind))
    items = [(i, " ".join(f"word{rng.randint(1, 2000)}" for _ in range(rng.randint(63, 180)))) for i in range(120)]
    docs = [" ".join(changed(kind, p.split(), rng)) for _, p in items]
    assert len(pairs(docs, items)) >= 114


@pytest.mark.parametrize("kind", [2, 3, 4, 5, 6, 7, 8, 0.3])
def test_ideographs_regularly_changed(kind):
    rng = random.Random(str(kind))
    items = [(i, "".join(chr(rng.randint(0x4E00, 0x52FF)) for _ in range(rng.randint(120, 200)))) for i in range(60)]
    hit = (lambda k: k % kind == kind - 1) if isinstance(kind, int) else (lambda k: rng.random() < kind)
    docs = ["".join(chr(rng.randint(0x6000, 0x8000)) if hit(k) else c for k, c in enumerate(p)) for _, p in items]
    assert len(pairs(docs, items)) >= 57


def pairs(docs, items):
    """(document, item) of documents and items numbered alike, without Spark; none of different numbers."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(docs)], ["id", "text"])
    out = [r for x in leak._scan(iter([batch]), [SimpleNamespace(value=leak.Index([(*x, False) for x in items]))], leak.Settings(), pa.int64()) for r in x.to_pylist()]
    assert all(r["id"] == r["item"] for r in out)
    return {r["id"] for r in out}


def test_less_than_half_verbatim_is_no_case():
    rng = random.Random(8)
    items = [(i, " ".join(f"word{rng.randint(1, 2000)}" for _ in range(100))) for i in range(60)]
    assert not pairs([" ".join(p.split()[:48]) + f" . {i} and so on" for i, p in items], items)
    assert len(pairs([f"as {i} before " + " ".join(p.split()[50:]) for i, p in items], items)) == 60


def test_same_rows_whatever_the_blocks(spark, monkeypatch):
    rng = random.Random(6)
    head = " ".join(passage(9, 20)) + ". "
    items = [(i, (head if i % 3 == 0 else "") + " ".join(passage(i, 70))) for i in range(9)]
    docs = [" ".join(changed(0.3, t.split(), rng)) for _, t in items] + [head + " ".join(passage(77, 70))]
    want = found(spark, docs, items)
    assert {i for _, i in want} == set(range(9)) and not [d for d, _ in want if d == 9]
    for n in (1, 2, 20_000):
        monkeypatch.setattr(leak, "BLOCK_ITEMS", n)
        assert found(spark, docs, items) == want


def test_ids_of_any_type_and_long_tags(spark):
    p = passage(4)
    d = spark.createDataFrame([("a/1", "<p title='" + "x " * 400 + "'>" + " ".join(p)), (None, "<a" + " ".join(p))], "doc string, text string")
    i = spark.createDataFrame([("q-1", " ".join(p))], "item string, passage string")
    assert {(r.doc, r.item) for r in leak.leaks(d, "doc", "text", i, "item", "passage").collect()} == {("a/1", "q-1"), (None, "q-1")}
    with pytest.raises(ValueError):
        leak.leaks(d, "doc", "text", i.withColumnRenamed("item", "doc"), "doc", "passage")


@pytest.mark.parametrize("a, b", [("STRASSE", "Straße"), ("ﬁne ½", "FINE 1 2"), ("e\u0301tude", "étude"), ("ＡＢＣ", "abc"), ("wo<b>rd</b>", "word"), ("Caf&eacute;", "cafe"), ("a\u200bb", "ab"), ("\u1112\u1161\u11ab", "한"), ("한글", "한글"), ("نَص", "نص")])
def test_forms_of_words(a, b):
    (x, _, at), (y, _, bt) = leak.tokens([a, None, ""]), leak.tokens([b, None, ""])
    assert x.tolist() == y.tolist() and len(x) and at.tolist() == [0, len(x), len(x), len(x)]

