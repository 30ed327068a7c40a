import numpy as np
import pytest

from tidemill.llm import neighbours as nb


def brute(vecs, k):
    """{id: set of k nearest ids} by exact cosine, ties to the smaller id."""
    out = {}
    for a, x in vecs.items():
        s = sorted((-round(float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), 12), b) for b, y in vecs.items() if b != a)
        out[a] = [b for _, b in s[:k]]
    return out


def data(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(max(2, n // 8), dim))
    x = c[rng.integers(len(c), size=n)] + 0.3 * rng.normal(size=(n, dim))
    return {f"{i:064x}" if i % 2 else f"id {i}": v.astype(np.float32) for i, v in enumerate(x)}


def found(spark, vecs, s, extra=()):
    rows = [("t", i, [float(z) for z in v]) for i, v in vecs.items()] + list(extra)
    df = spark.createDataFrame(rows, "tenant string, vid string, e array<float>").selectExpr("*", "1 AS cell", "2 AS grp", "3 AS found")
    near = nb.neighbour_rows(nb.nearest(df, "tenant", "vid", "e", s)).collect()
    out = {}
    for r in sorted(near, key=lambda r: r["rank"]):
        out.setdefault(r.id, []).append(r.neighbour)
    return out


def test_one_part_is_exact_with_dirt(spark):
    s, vecs = nb.Settings(dim=8, k=3), data(60, 8)
    vecs["zz"] = vecs["id 0"].copy()
    vecs["yy"] = vecs["id 0"] * 2
    nan = float("nan")
    bad = [("t", "n1", None), ("t", "n2", [1.0]), ("t", "n3", [nan] * 8), ("t", "n4", [0.0] * 8), ("t", None, [1.0] * 8), ("t", "n5", [None] + [1.0] * 7), ("t", "zz", [float(z) for z in vecs["zz"]]), ("alone", "x", [1.0] * 8)]
    assert found(spark, vecs, s, bad) == brute(vecs, 3)


def test_empty(spark):
    df = spark.createDataFrame([], "tenant string, vid string, e array<float>")
    assert nb.nearest(df, "tenant", "vid", "e", nb.Settings(dim=4)).count() == 0


def test_learned_parts_lose_little(spark):
    s, vecs = nb.Settings(dim=16, k=5, cell_rows=150, probes=3, sample_rows=800), data(1500, 16, 1)
    got, want = found(spark, vecs, s), brute(vecs, 5)
    assert set(got) == set(want)
    recall = np.mean([len(set(got[i]) & set(want[i])) / 5 for i in want])
    assert recall >= 0.9


def test_large_cells_are_split_into_blocks(spark):
    vecs = {f"v{i:04d}": np.ones(8, np.float32) for i in range(700)} | data(300, 8, 2)
    s = nb.Settings(dim=8, k=4, cell_rows=200, probes=9, sample_rows=500, block_rows=120)
    got = found(spark, vecs, s)
    want = brute({k: v for k, v in vecs.items() if k in {f"v{i:04d}" for i in range(12)}}, 4)
    assert len(got) == 1000
    for i in ("v0000", "v0003", "v0010"):
        assert got[i] == want[i]
    assert got["v0500"] == ["v0000", "v0001", "v0002", "v0003"]


def test_null_group_and_waves(spark, monkeypatch):
    monkeypatch.setattr(nb, "MODEL_BYTES", 3 * 17 * 4)
    a, b = data(400, 16, 7), data(300, 16, 8)
    rows = [(g, i, [float(z) for z in v]) for g, d in ((None, a), ("u", b)) for i, v in d.items()] + [("small", "s1", [1.0] * 16), ("small", "s2", [2.0] * 16)]
    df = spark.createDataFrame(rows, "tenant string, vid string, e array<float>")
    got = {}
    for r in nb.neighbour_rows(nb.nearest(df, "tenant", "vid", "e", nb.Settings(dim=16, k=3, cell_rows=140, probes=9, sample_rows=250))).orderBy("rank").collect():
        got.setdefault((r.grp, r.id), []).append(r.neighbour)
    assert {k[1]: v for k, v in got.items() if k[0] is None} == brute(a, 3)
    assert {k[1]: v for k, v in got.items() if k[0] == "u"} == brute(b, 3)
    assert got["small", "s1"] == ["s2"]


def test_balanced_parts():
    x = nb.unit(np.stack(list(data(1000, 16, 3).values())))
    g = nb.neighbour_graph(x, 10)
    label = nb.balanced_parts(g, 7)
    size = np.bincount(label, minlength=7)
    assert size.min() >= 1000 / 7 * 0.9 and size.max() <= 1000 / 7 * 1.1
    cut = np.mean(label[:, None] != label[g])
    assert cut < np.mean(np.random.default_rng(0).permutation(label)[:, None] != label[g]) * 0.7


@pytest.mark.parametrize("x", [np.array([[0.5, -0.25, 1 / 512]]), np.array([[0.1, 1e30, -3.3]]), np.array([[127 / 512, -1 / 512, 0]]), np.array([[2.0**-140, 2.0**-141, 0]]), np.array([[128.0, 1.0, -128.0]]), np.array([[3e38, 2.0**100, 1]])])
def test_packing_is_exact(x):
    x = x.astype(np.float32)
    assert (nb.unpack_vectors(nb.pack_vectors(x), 3) == x).all()


def test_packed_ids(spark):
    for i in ("ab12", "AB12", "abc", "", "é", "00"):
        df = spark.createDataFrame([(bytearray(nb.pack_id(i)),)], "b binary")
        assert df.select(nb.unpacked_id(df.b)).first()[0] == i


def test_pairs(spark):
    vecs = data(30, 8, 5)
    df = spark.createDataFrame([("t", i, [float(z) for z in v]) for i, v in vecs.items()], "tenant string, vid string, e array<float>")
    got = {tuple(r) for r in nb.neighbour_pairs(nb.nearest(df, "tenant", "vid", "e", nb.Settings(dim=8, k=2))).collect()}
    assert got == {(min(a, b), max(a, b)) for a, bs in brute(vecs, 2).items() for b in bs}


def recall_of(spark, vecs, s, queries):
    """Share of the true neighbours of some vectors that ``nearest`` gives."""
    got = found(spark, vecs, s)
    assert set(got) == set(vecs)
    names = sorted(vecs)
    x = nb.unit(np.stack([vecs[i] for i in names]))
    at = {i: n for n, i in enumerate(names)}
    rng = np.random.default_rng(5)
    hit = []
    for n in rng.choice(len(names), queries, replace=False):
        c = x @ x[n]
        c[n] = -2
        best = np.argpartition(-c, s.k)[: s.k]
        hit.append(np.mean([c[at[i]] >= c[best].min() - 1e-6 for i in got[names[n]]]))
    return float(np.mean(hit))


@pytest.mark.parametrize("parts", [20, 100, 400])
def test_recall_with_many_parts(spark, parts):
    vecs = data(8000, 16, parts)
    s = nb.Settings(dim=16, k=5, cell_rows=8000 // parts, part_sample=40)
    assert recall_of(spark, vecs, s, 1000) >= 0.95


def test_more_parts_are_searched_where_they_are_needed():
    rng = np.random.default_rng(2)
    loose = rng.normal(size=(3000, 32)).astype(np.float32)
    tight = (rng.normal(size=(60, 32))[rng.integers(60, size=3000)] + 0.1 * rng.normal(size=(3000, 32))).astype(np.float32)
    few, many = (nb.fit_group(x, 9000, nb.Settings(dim=32, cell_rows=200))[2] for x in (tight, loose))
    assert 2 <= few < many <= 12


def test_routes_by_join_like_by_broadcast(spark, monkeypatch):
    s, vecs = nb.Settings(dim=16, k=5, cell_rows=100, probes=2), data(900, 16, 4) | {f"same{i}": np.ones(16, np.float32) for i in range(300)}
    want = found(spark, vecs, s)
    monkeypatch.setattr(nb, "MODEL_BYTES", 0)
    monkeypatch.setattr(nb, "ROUTE_ROWS", 250)
    assert found(spark, vecs, s) == want


def test_equal_vectors_kept_by_id():
    x = np.array([[1.0, 2], [1, 2], [3, 4], [1, 2], [1, 2]], np.float32)
    ids, g = np.array(["d", "a", "x", "c", "b"]), np.zeros(5, int)
    assert nb._kept(g, ids, x, 1).tolist() == [False, True, True, False, True]
    assert nb._kept(np.arange(5), ids, x, 0).all()
