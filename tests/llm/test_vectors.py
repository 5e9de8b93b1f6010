import numpy as np
import pytest

from folio.llm import topk, vector_graph as vg

SCHEMA = "vec_id long, embedding array<double>, label int, key string, rep long"


def table(seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(260):
        c = rng.normal(size=16) if i % 13 or not out else out[0][1] + 0.02 * rng.normal(size=16)
        out.append((i, np.asarray(c), i % 3 if i % 13 else 0))
    rows = [(i, v.tolist(), l, "k", 1) for i, v, l in out]
    rows += [(300, None, 1, "", 0), (301, [0.0] * 16, 1, "", 0), (302, [float("nan")] * 16, 1, "", 0), (303, [None] * 16, 1, "", 0), (304, rows[0][1], None, "", 0),
             (305, rows[0][1], 0, "", 0), (305, rows[0][1], 0, "", 0), (None, rows[0][1], 0, "", 0), (306, [float("inf")] + [0.0] * 15, 1, "", 0), (307, [], 1, "", 0)]
    return rows


def brute_components(rows):
    ok = [r[0] is not None and r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2]:
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                link[a, b] = x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93
    root = vg.local_roots(link)
    out = []
    for a in range(n):
        c = min((rows[b][0] for b in range(n) if root[b] == root[a]), default=None) if ok[a] else rows[a][0]
        out.append((rows[a][0], int(link[a].sum()), c, rows[a][0] == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(1500, 3000), (40, 3000), (40, 16)])
def test_components(spark, monkeypatch, shard, block):
    monkeypatch.setattr(vg, "SHARD", shard)
    monkeypatch.setattr(vg, "BLOCK", block)
    rows = table()
    got = sorted((tuple(r) for r in vg.components(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = brute_components(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and true > 0 and found >= 0.95 * true and all(g[1] <= w[1] for g, w in zip(got, want))
    if shard == 1500:
        assert got == want


def test_graph_finds_ranges():
    rng = np.random.default_rng(0)
    c = rng.normal(size=(60, 24))
    x = np.repeat(c, 12, 0) + 0.12 * rng.normal(size=(720, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = vg.range_search(x, vg.Graph(vg.robust_prune(x)), 0.93, 48)
    true = x @ x.T >= 0.93
    np.fill_diagonal(true, False)
    assert (link & true).sum() >= 0.97 * true.sum()


def test_graph_walks_all_edges(monkeypatch):
    monkeypatch.setattr(vg, "PAIRS", 3)
    rng = np.random.default_rng(6)
    lists = [np.unique(rng.integers(0, 30, k)) for k in rng.integers(0, 6, 30)]
    g = vg.Graph(lists)
    edges = {(a, int(b)) for a, xs in enumerate(lists) for b in xs}
    edges |= {(b, a) for a, b in edges}
    r, v = rng.integers(0, 4, 25), rng.integers(0, 30, 25)
    got = [(int(a), int(b)) for q, w in g.around(r, v) for a, b in zip(q, w, strict=True)]
    assert sorted(got) == sorted((int(a), w) for a, b in zip(r, v) for w in range(30) if (int(b), w) in edges)
    assert list(g.around(r[:0], v[:0]))[0][0].tolist() == []


def test_bundle_stays_small():
    """A block pair's worth of near copies, in far less memory than its pairs would take."""
    import tracemalloc

    rng = np.random.default_rng(1)
    x = rng.normal(size=64) + 0.02 * rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tracemalloc.start()
    link = vg.range_search(x, vg.Graph(vg.robust_prune(x)), 0.93, 48)
    vg.verified(x, link, 0.93)
    root = vg.local_roots(link)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert link.sum() >= 0.99 * 6000 * 5999 and (root == 0).mean() > 0.99 and most < 500e6


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vg.components(none).count() == 0
    assert topk.clean(none, "vec_id", "embedding").count() == 0
    one = spark.createDataFrame(table()[:1], SCHEMA)
    assert tuple(vg.components(one).first()) == (0, 0, 0, True)


def test_top_k(spark, monkeypatch):
    rows = [r for r in table() if r[0] is not None]
    whole = topk.clean(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding").selectExpr("id", "transform(v, x -> floor(x * 256)) AS x").cache()
    got = sorted(map(tuple, topk.top_k(whole, whole.filter("id % 50 = 0"), 5, shard=37, block=2).collect()))
    v = {r.id: np.array([*r.x, *[0] * (16 - len(r.x))], np.int64) for r in whole.collect()}
    want = []
    for q in v:
        if q % 50 == 0:
            best = sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:5]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert got == sorted(want) and 300 not in v and 302 not in v and 303 not in v
    few = whole.filter("id IN (0, 50, 7)")
    assert topk.top_k(few, few.filter("id % 50 = 0"), 5).count() == 4


def test_maxscore_ties():
    rng = np.random.default_rng(1)
    a = rng.integers(-3, 4, (20, 500))
    ids = rng.permutation(500)
    for k in (1, 5, 499, 600):
        q = rng.integers(-3, 4, 20)
        got_ids, got = topk.maxscore(a, ids, q, int(ids[3]), k)
        s = q @ a
        order = sorted((i for i in range(500) if i != 3), key=lambda i: (-s[i], ids[i]))[:k]
        assert got_ids.tolist() == ids[order].tolist() and got.tolist() == s[order].tolist()
