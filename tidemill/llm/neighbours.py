"""The k most similar vectors of every vector, within a group, by learned partitions.

A bounded sample of each group gives a neighbour graph; the graph is cut into balanced
parts; a softmax classifier learns the parts from the vectors. Every row is indexed in the part
the classifier finds most probable and, as a query, sent to the few most probable ones, where
the candidates are ranked again by exact cosine. How many are searched is chosen per group by the recall of
sampled vectors that the classifier has not seen. Groups of at most ``cell_rows`` vectors are one
part. Cells that will be large, by the sample, are split into blocks, which all their queries visit."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import ship, written

#: Most bytes of classifiers that are sent to every executor; more are stored and joined to the rows by group.
MODEL_BYTES = 256 << 20
#: Rows that meet their group's classifier in one task then, and bytes that a task of the search is to read.
ROUTE_ROWS, TASK_BYTES = 65_536, 64 << 20


@dataclass(frozen=True)
class Settings:
    """dim: length of a usable vector. cell_rows: aimed size of a part. probes, max_probes: fewest and most parts searched
    per query; between them those that together have a probability of MASS, the least with which sampled vectors that were held out
    find ``recall`` of their neighbours. part_sample, sample_rows: vectors per part, and most of a
    group, that the classifier is fitted on (a hash sample); every row is indexed. max_parts: most parts of a group, whose parts grow
    beyond cell_rows then. block_rows: aimed rows of a block."""

    k: int = 5
    dim: int = 512
    cell_rows: int = 128
    probes: int = 2
    max_probes: int = 12
    recall: float = 0.995
    part_sample: int = 64
    sample_rows: int = 16_384
    max_parts: int = 1024
    block_rows: int = 8192
    graph_k: int = 10

    def parts(self, rows: int) -> int:
        return max(1, min(-(-rows // self.cell_rows), self.max_parts))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


# --- fitting, on one group's sample ------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(n, k) indices of the most similar other rows of unit vectors x."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i : i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 0.05) -> np.ndarray:
    """Part of every vertex: parts grown over the graph to equal size, then vertices moved to
    the part of most of their neighbours as long as no part exceeds its share by ``slack``."""
    n = len(graph)
    near: list[list[int]] = [[] for _ in range(n)]
    for a, row in enumerate(graph.tolist()):
        for b in row:
            near[a].append(b)
            near[b].append(a)
    label = np.full(n, -1)
    rest = iter(np.argsort([len(x) for x in near], kind="stable").tolist())
    for p in range(parts):
        want = n * (p + 1) // parts - n * p // parts
        edge: list[tuple[int, int]] = []
        pull: dict[int, int] = {}
        while want:
            v = -1
            while edge and v < 0:
                w, u = heapq.heappop(edge)
                if label[u] < 0 and pull[u] == -w:
                    v = u
            if v < 0:
                v = next(u for u in rest if label[u] < 0)
            label[v], want = p, want - 1
            for u in near[v]:
                if label[u] < 0:
                    pull[u] = pull.get(u, 0) + 1
                    heapq.heappush(edge, (-pull[u], u))
    size, most, least = np.bincount(label, minlength=parts), int(n / parts * (1 + slack)) + 1, int(n / parts * (1 - slack))
    for _ in range(rounds):
        moved = 0
        for v in range(n):
            count: dict[int, int] = {}
            for u in near[v]:
                count[label[u]] = count.get(label[u], 0) + 1
            here = label[v]
            best = max(count, key=lambda p: (count[p], -p), default=here)
            if count.get(best, 0) > count.get(here, 0) and size[best] < most and size[here] > least:
                size[here], size[best], label[v] = size[here] - 1, size[best] + 1, best
                moved += 1
        if not moved:
            break
    return label


def fit_router(x: np.ndarray, label: np.ndarray, graph: np.ndarray, parts: int, steps: int = 120, batch: int = 2048) -> np.ndarray:
    """(dim + 1, parts) weights of a softmax classifier of the parts of a vector and its neighbours."""
    rng = np.random.default_rng(len(x))
    z = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((z.shape[1], parts), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    order, at = rng.permutation(len(x)), 0
    for t in range(1, steps + 1):  # Adam, over shares of the sample
        if at >= len(x):
            order, at = rng.permutation(len(x)), 0
        rows = order[at : at + batch]
        at += batch
        target = np.zeros((len(rows), parts), np.float32)
        np.add.at(target, (np.arange(len(rows)), label[rows]), float(graph.shape[1]))
        np.add.at(target, (np.arange(len(rows))[:, None], label[graph[rows]]), 1.0)
        target /= target.sum(1, keepdims=True)
        s = z[rows] @ w
        s = np.exp(s - s.max(1, keepdims=True))
        g = z[rows].T @ (s / s.sum(1, keepdims=True) - target) / len(rows) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def fit_group(x: np.ndarray, n_rows: int, s: Settings) -> tuple[np.ndarray, float, float, np.ndarray]:
    """(router, probability of the parts to search, their mean number, share of the rows in every part) of one group from a sample of its vectors, in random order."""
    parts = max(2, min(s.parts(n_rows), len(x) // 8))
    x = unit(x)
    held = min(len(x) // 8, 1024)
    new, own = x[:held], x[held:]
    graph = neighbour_graph(own, s.graph_k)
    w = fit_router(own, balanced_parts(graph, parts), graph, parts)
    k = min(s.k, len(own))
    near = np.argpartition(-(new @ own.T), k - 1, axis=1)[:, :k]
    cell = _probes(x, w)[0][:, 0]
    order, before = _probes(new, w)
    found = order[:, None, :] == cell[held:][near][:, :, None]
    searched = [_searched_parts(before, m, s) for m in MASS]
    recall = [(found & y[:, None, :]).any(2).mean() for y in searched]
    best = next((n for n, r in enumerate(recall) if r >= s.recall), len(MASS) - 1)
    return w, MASS[best], float(searched[best].sum(1).mean()), np.bincount(cell, minlength=parts) / len(cell)


def _searched_parts(before: np.ndarray, mass: float, s: Settings) -> np.ndarray:
    """Which of the parts, in the order of ``_probes``, are searched."""
    rank = np.arange(before.shape[1])
    return (rank < s.probes) | ((before < mass) & (rank < s.max_probes))


# --- rows as arrays ----------------------------------------------------------------------


def _vectors(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are usable vectors, and those vectors."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    rows = np.flatnonzero(np.asarray(col.is_valid()) & (np.asarray(col.value_lengths().fill_null(-1)) == dim))
    flat = col.take(pa.array(rows)).flatten().cast(pa.float32())
    x = flat.fill_null(np.float32("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[ok], x[ok]


def _hash(ids: list[str], salt: int) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(i, seed=salt) for i in ids], dtype=np.uint64)


def _kept(group: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be neighbours: of equal vectors of a group only the k + 1 with the smallest ids, since with
    equal similarity later ones are nobody's."""
    key = (x.view(np.uint32).astype(np.uint64) * np.random.default_rng(7).integers(1, 2**63, size=x.shape[1], dtype=np.uint64)).sum(1)
    _, first, code = np.unique(key ^ group.astype(np.uint64), return_index=True, return_inverse=True)
    same = (x == x[first[code]]).all(1) & (group == group[first[code]])  # different ones with one key are kept
    order = np.lexsort((ids, code))
    rank = np.empty(len(x), np.int64)
    rank[order] = np.arange(len(x)) - np.searchsorted(code[order], code[order])
    return ~same | (rank <= k)


def pack_vectors(x: np.ndarray) -> list[bytes]:
    """Rows of float32, without loss: as whole numbers of one byte where a power of two makes them such, as float16
    where that holds them exactly, or as they are; their bytes in planes (all first bytes, all second, ...), compressed."""
    import zstandard

    zip1 = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    with np.errstate(over="ignore", invalid="ignore"):
        half = x.astype(np.float16)
        exact = (half.astype(np.float32) == x).all(1)
        power = 6 - np.frexp(np.abs(x).max(1))[1]  # the greatest entry becomes 32 to 64, then up to 127
        power = power[:, None] + np.arange(2)
        whole = [np.ldexp(x, power[:, [j]]) for j in range(2)]
        byte = [(w == np.rint(w)).all(1) & (np.abs(w) < 128).all(1) & (np.abs(x).max(1) > 0) for w in whole]
    out = []
    for i in range(len(x)):
        j = next((j for j in range(2) if byte[j][i]), -1)
        if j >= 0:
            out.append(b"b" + int(power[i, j]).to_bytes(2, "little", signed=True) + zip1(whole[j][i].astype(np.int8).tobytes()))
        else:
            v = half[i] if exact[i] else x[i]
            out.append((b"h" if exact[i] else b"f") + zip1(v.view(np.uint8).reshape(len(v), -1).T.tobytes()))
    return out


def unpack_vectors(rows: list[bytes], dim: int) -> np.ndarray:
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    out = np.empty((len(rows), dim), dtype=np.float32)
    for i, r in enumerate(rows):
        if r[:1] == b"b":
            out[i] = np.ldexp(np.frombuffer(unzip(r[3:]), np.int8).astype(np.float32), -int.from_bytes(r[1:3], "little", signed=True))
            continue
        kind = np.float16 if r[:1] == b"h" else np.float32
        out[i] = np.frombuffer(unzip(r[1:]), np.uint8).reshape(-1, dim).T.copy().view(kind)[:, 0]
    return out


def pack_id(s: str) -> bytes:
    """An identifier in lower-case hexadecimal takes half its length."""
    try:
        raw = bytes.fromhex(s)
        if raw.hex() == s:
            return b"\1" + raw
    except ValueError:
        pass
    return b"\0" + s.encode()


def unpacked_id(c: Column) -> Column:
    rest = F.substring(c, 2, 1 << 30)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "utf-8"))


BASE, QUERY, BOTH = 1, 2, 3
#: Probabilities that the parts searched have together.
MASS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 1.0)


def _probes(x: np.ndarray, model: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Parts of every vector, most probable first, and what is probable of those before each."""
    if model is None:
        return np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1), np.float32)
    p = unit(x) @ model[:-1] + model[-1]
    p = np.exp(p - p.max(1, keepdims=True))
    order = np.argsort(-p, axis=1, kind="stable")
    p = np.take_along_axis(p, order, 1)
    before = np.cumsum(p, axis=1)
    return order, (before - p) / before[:, -1:]


@dataclass(frozen=True)
class Router:
    """weights; probability of the parts to search; (base blocks, query blocks) of the parts that will be large."""

    weights: np.ndarray
    mass: float
    blocks: dict[int, tuple[int, int]]

    @staticmethod
    def of(w: bytes, parts: int, mass: float, probes: float, share: list[float], rows: int, s: Settings) -> Router:
        blocks = {}
        for c, x in enumerate(share):  # a query is sent to ``probes`` parts on average
            if x * rows > s.block_rows:
                blocks[c] = (-(-int(x * rows) // s.block_rows), -(-int(x * rows * probes) // (4 * s.block_rows)))
        return Router(np.frombuffer(w, np.float32).reshape(-1, parts), mass, blocks)


ROUTED = "grp string, cell int, bblock int, qblock int, role int, id string, vec binary"


def _routed(b: pa.RecordBatch | pa.Table, routers: dict[str, Router], s: Settings) -> pa.RecordBatch:
    """Rows of ROUTED of rows (grp, id, vec)."""
    rows, x = _vectors(b.column(2), s.dim)
    took = pa.array(rows)
    names = np.array(b.column(0).take(took).to_pylist(), dtype=object)
    ids = np.array(b.column(1).take(took).to_pylist(), dtype=object).astype(str)
    found, group = np.unique(names.astype(str), return_inverse=True)
    base = _kept(group, ids, x, s.k) if len(x) else np.zeros(0, bool)
    pos, cell, bb, qb, role = ([np.zeros(0, np.int64)] for _ in range(5))
    for n, g in enumerate(found.tolist()):
        at = np.flatnonzero(group == n)
        r = routers.get(g)
        order, before = _probes(x[at], r.weights if r else None)
        visited = _searched_parts(before, r.mass if r else 0.0, s)
        split, every = r.blocks if r else {}, at
        for j in range(visited.any(0).sum()):
            at, to = every[visited[:, j]], order[visited[:, j]]
            cut = np.isin(to[:, j], list(split)) if split else np.zeros(len(at), bool)
            pos.append(at[~cut]), cell.append(to[~cut, j]), role.append(np.where(base[at[~cut]] & (j == 0), BOTH, QUERY))
            bb.append(np.zeros(int((~cut).sum()), int)), qb.append(np.zeros(int((~cut).sum()), int))
            if cut.any():
                hb, hq = _hash(ids[at[cut]].tolist(), 1), _hash(ids[at[cut]].tolist(), 2)
                for i, c, h1, h2 in zip(at[cut], to[cut, j], hb, hq):
                    nb, nq = split[int(c)]
                    own, mine = int(h1 % np.uint64(nb)), int(h2 % np.uint64(nq))
                    if j == 0 and base[i]:
                        pos.append([i] * nq), cell.append([c] * nq), bb.append([own] * nq), qb.append(range(nq)), role.append([BASE] * nq)
                    pos.append([i] * nb), cell.append([c] * nb), bb.append(range(nb)), qb.append([mine] * nb), role.append([QUERY] * nb)
    p = np.concatenate([np.asarray(a, dtype=np.int64) for a in pos])
    as_int = lambda a: pa.array(np.concatenate([np.asarray(y, dtype=np.int32) for y in a]))
    take = pa.array(rows[p])
    packed = np.array([*pack_vectors(x), None], dtype=object)[:-1][p]
    return pa.RecordBatch.from_arrays(
        [pa.array(names[p], pa.string()), as_int(cell), as_int(bb), as_int(qb), as_int(role), _plain(b.column(1)).take(take), pa.array(packed, pa.binary())],
        ["grp", "cell", "bblock", "qblock", "role", "id", "vec"],
    )


def _plain(c: pa.Array | pa.ChunkedArray) -> pa.Array:
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


# --- search within a block ---------------------------------------------------------------


def search_block(q: np.ndarray, b: np.ndarray, b_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, base row, cosine) of the k most similar base rows of every query. A float32
    product finds the candidates; all that could be among the k are ranked by the exact cosine,
    rounded to 12 digits, equal ones by id."""
    order = np.argsort(b_id, kind="stable")
    b = b[order]
    qn, bn = unit(q), unit(b)
    b64 = b.astype(np.float64)
    bl = np.sqrt((b64 * b64).sum(1))
    out: list[tuple] = []
    for i in range(0, len(q), 1024):
        s = qn[i : i + 1024] @ bn.T
        kk = min(k, s.shape[1])
        least = np.partition(s, s.shape[1] - kk, axis=1)[:, s.shape[1] - kk]
        r, c = np.nonzero(s >= (least - 1e-5)[:, None])
        q64 = q[i : i + 1024].astype(np.float64)
        ql = np.sqrt((q64 * q64).sum(1))
        cos = np.empty(len(r))
        for j in range(0, len(r), 16384):
            rr, cc = r[j : j + 16384], c[j : j + 16384]
            cos[j : j + 16384] = np.einsum("ij,ij->i", q64[rr], b64[cc]) / (ql[rr] * bl[cc])
        cos = np.round(cos, 12)
        o = np.lexsort((c, -cos, r))  # base rows stand in the order of their ids
        r, c, cos = r[o], c[o], cos[o]
        top = np.arange(len(r)) - np.searchsorted(r, r) < k
        out.append((r[top] + i, order[c[top]], cos[top]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _searched(t: pa.Table, s: Settings) -> pa.Table:
    """Neighbours, within one block, of its queries. Equal vectors are searched for once, and of
    equal base vectors only the k + 1 with the smallest ids can be anyone's neighbours."""
    role = t["role"].to_numpy()
    ids = np.array(t["id"].to_pylist(), dtype=object)
    packed = t["vec"].to_pylist()
    number: dict[bytes, int] = {}
    code = np.array([number.setdefault(v, len(number)) for v in packed])
    x = unpack_vectors(list(number), s.dim)

    def of(kind: int) -> np.ndarray:
        rows = np.flatnonzero(role & kind)
        return rows[np.unique(ids[rows].astype(str), return_index=True)[1]]  # in the order of ids

    qi, bi = of(QUERY), of(BASE)
    if not len(bi) or not len(qi):
        end, who, cos = np.zeros(len(qi) + 1, np.int32), np.zeros(0, int), np.zeros(0)
    else:
        bi = bi[np.argsort(code[bi], kind="stable")]
        bi = bi[np.arange(len(bi)) - np.searchsorted(code[bi], code[bi]) <= s.k]
        uq, back = np.unique(code[qi], return_inverse=True)
        r, c, cos = search_block(x[uq], x[code[bi]], ids[bi].astype(str), s.k + 1)
        first, last = np.searchsorted(r, back), np.searchsorted(r, back, "right")
        n = last - first
        who = np.repeat(np.arange(len(qi)), n)
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        other = ids[qi][who] != ids[bi][c[at]]  # itself left out
        who, at = who[other], at[other]
        near = np.arange(len(who)) - np.searchsorted(who, who) < s.k
        who, at = who[near], at[near]
        end = np.searchsorted(who, np.arange(len(qi) + 1)).astype(np.int32)
        who, cos = c[at], cos[at]
    found = pa.StructArray.from_arrays([pa.array(-cos), pa.array([pack_id(i) for i in ids[bi]], pa.binary()).take(pa.array(who, pa.int64()))], ["neg", "id"])
    return pa.table({
        "grp": pa.array([t["grp"][0].as_py()] * len(qi), pa.string()), "id": pa.array([pack_id(i) for i in ids[qi]], pa.binary()),
        "found": pa.ListArray.from_arrays(pa.array(end), found),
    })


# --- the operator ------------------------------------------------------------------------


MODELS = "grp string, n bigint, parts int, mass double, probes double, w binary, share array<double>"


def _fitted(rows: DataFrame, counts: DataFrame, s: Settings) -> DataFrame:
    """MODELS of the groups of more than one part, fitted group by group on the executors."""
    wanted = F.least(F.lit(s.sample_rows), F.lit(s.part_sample) * F.col("parts"))
    share = counts.where("parts > 1").select("grp", "n", (wanted / F.col("n") * 2**20).cast("int").alias("part"))
    sample = rows.where(F.size("vec") == s.dim).join(share, "grp").where(F.pmod(F.xxhash64("id"), F.lit(2**20)) < F.col("part"))

    def fit(t: pa.Table) -> pa.Table:
        n = t["n"][0].as_py()
        order = np.argsort(np.array(t["id"].to_pylist()), kind="stable")
        _, x = _vectors(t["vec"].take(pa.array(order)), s.dim)
        x = np.unique(x, axis=0) if len(x) else x
        x = x[np.random.default_rng(len(x)).permutation(len(x))]
        one = np.zeros((s.dim + 1, 1), np.float32), 1.0, 1.0, np.ones(1)  # a handful of different vectors is one part
        w, mass, probes, part = fit_group(x, n, s) if len(x) >= 32 else one
        return pa.table({
            "grp": [t["grp"][0].as_py()], "n": [n], "parts": pa.array([w.shape[1]], pa.int32()), "mass": [mass], "probes": [probes],
            "w": pa.array([w.tobytes()], pa.binary()), "share": pa.array([part.tolist()], pa.list_(pa.float64())),
        })

    return sample.select("grp", "id", "vec", "n").groupBy("grp").applyInArrow(fit, MODELS)


def _route_by_broadcast(rows: DataFrame, fitted: DataFrame, s: Settings) -> DataFrame:
    """For classifiers of MODEL_BYTES at most."""
    sent = rows.sparkSession.sparkContext.broadcast({r.grp: Router.of(r.w, r.parts, r.mass, r.probes, r.share, r.n, s) for r in fitted.collect()})  # at most MODEL_BYTES, fitted side by side
    return rows.mapInArrow(lambda it: (_routed(b, sent.value, s) for b in it), ROUTED)


def _route_by_join(rows: DataFrame, counts: DataFrame, fitted: DataFrame, s: Settings) -> DataFrame:
    """For any number of groups: rows and classifiers meet by group, large groups in several shares."""
    shares = counts.select("grp", F.ceil(F.col("n") / ROUTE_ROWS).cast("int").alias("_of"))
    own = rows.join(shares, "grp").select("grp", "id", "vec", F.pmod(F.xxhash64("id"), F.col("_of")).cast("int").alias("_share"))
    models = fitted.join(shares, "grp").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))).drop("_of")

    def route(t: pa.Table, m: pa.Table) -> pa.Table:
        known = {r["grp"]: Router.of(r["w"], r["parts"], r["mass"], r["probes"], r["share"], r["n"], s) for r in m.to_pylist()}
        return pa.Table.from_batches([_routed(t.select(["grp", "id", "vec"]), known, s)])

    return own.groupBy("grp", "_share").cogroup(models.groupBy("grp", "_share")).applyInArrow(route, ROUTED)


def nearest(df: DataFrame, group: str, ident: str, vector: str, settings: Settings | None = None) -> DataFrame:
    """(grp, id, rank, neighbour, cosine), identifiers packed (see ``neighbour_rows``): the k most similar others of every usable vector within its group.

    Vectors that are null, of another length, not finite, with a null entry or all zero take no
    part; neither do rows with a null id. An id stored more than once counts once (if
    with different vectors, each of them is a candidate). Equal
    similarities go to the smaller id. A group with fewer vectors gives what it has, a single
    vector or an empty table nothing. A null group is a group. Further columns are not read."""
    s = settings or Settings()
    ship(df.sparkSession)
    name = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("-"))  # a null group is "-"
    rows = df.select(name.alias("grp"), F.col(ident).cast("string").alias("id"), F.col(vector).alias("vec")).where("id IS NOT NULL")
    counted = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    parts = F.least(F.ceil(F.col("n") / s.cell_rows), F.lit(s.max_parts)).cast("int")
    counts = written(counted.withColumn("parts", parts), "vector-groups")
    total = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("parts") > 1, F.col("parts"))).alias("parts")).first()
    if (total.parts or 0) * (s.dim + 1) * 4 <= MODEL_BYTES:
        routed = _route_by_broadcast(rows, _fitted(rows, counts, s), s)
    else:
        routed = _route_by_join(rows, counts, written(_fitted(rows, counts, s), "vector-routers"), s)
    # a task of the search reads about TASK_BYTES, whatever the size of the whole
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total.n or 0) * s.probes * 2 * s.dim // TASK_BYTES))
    cell = ["grp", "cell", "bblock", "qblock"]
    found = routed.repartition(tasks, *cell).groupBy(*cell).applyInArrow(lambda t: _searched(t, s), "grp string, id binary, found array<struct<neg: double, id: binary>>")
    # as many lists as blocks visited; sorted by cosine, then by the id itself
    named = F.transform(F.flatten("found"), lambda f: F.struct(f["neg"].alias("neg"), unpacked_id(f["id"]).alias("name"), f["id"].alias("id")))
    top = found.groupBy("grp", "id").agg(F.collect_list("found").alias("found")).select("grp", "id", F.slice(F.array_sort(named), 1, s.k).alias("found"))
    shown = F.when(F.col("grp") != "-", F.substring("grp", 2, 1 << 30)).alias("grp")
    return top.select("grp", "id", F.posexplode("found").alias("rank", "_f")).select(
        shown, "id", (F.col("rank") + 1).alias("rank"), F.col("_f.id").alias("neighbour"), (-F.col("_f.neg")).alias("cosine")
    )


def neighbour_rows(near: DataFrame) -> DataFrame:
    """The rows of ``nearest`` with identifiers as given."""
    return near.withColumns({"id": unpacked_id(F.col("id")), "neighbour": unpacked_id(F.col("neighbour"))})


def neighbour_pairs(near: DataFrame) -> DataFrame:
    """(vector_id_a, vector_id_b), a < b, each pair once: one is among the other's most similar."""
    pair = near.select(F.least("id", "neighbour").alias("_a"), F.greatest("id", "neighbour").alias("_b")).distinct()
    a, b = unpacked_id(F.col("_a")), unpacked_id(F.col("_b"))
    return pair.select(F.least(a, b).alias("vector_id_a"), F.greatest(a, b).alias("vector_id_b"))
