"""Near-duplicate vectors by robust-pruned flat graphs.

Vectors are compared within their label only. Equal vectors are one point with a count. Then

1. k-means over a bounded sample gives centroids for each label; every point joins the shards of its
   `overlap` nearest ones, so close points share a shard. A shard of more than BLOCK points is cut into
   blocks, and each pair of blocks is a shard of its own.
2. In a shard, each point's nearest points are pruned robustly: a candidate falls if a kept neighbour is ALPHA
   times closer to it than the point itself; DEGREE neighbours stay. The adjacency lists of a point from all
   its shards are united.
3. Each shard is searched for each of its points: greedily from the medoids of its parts with a beam, and when the
   beam has settled the search widens over all neighbours of what lies within the range, until nothing new does.
4. Each pair that was found is verified by its cosine in double precision. Pairs that share several shards are
   all compared in the first.
5. Recall is audited: for some points, drawn uniformly, the links are counted by brute force, and the mean share
   that was found is taken, by point and not by link, over all and within labels and small and large degrees. Below TARGET the search is
   repeated with more overlap and a longer beam; if the last attempt is below it too, all pairs of blocks within
   each label are compared by matrix product.

What leaves a shard is one count for each point and a spanning forest, never pairs; a pair that shares
several shards is counted in the first, wherever it was found. So a bundle of near copies costs no more rows than its points.

Bounds: at most SAMPLE vectors are collected to fit centroids, at most CENTROIDS centroids are broadcast, and
MOST vectors for the audit; every point is indexed and searched.

Cases: vectors that are null, zero, or hold null or non-finite components, and those without a label, link
with nothing; so do rows without an id, whose component is null and which are kept. Vectors of different
lengths are compared as if padded with zeros. Repeated rows link with each other; rows that share an id but
not a vector count as one point with the links of both. An empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.shared import block_pairs, bounds, connected_components, local_roots, row_sums, table, whole_groups

COSINE = 0.93
SAMPLE = 20_000
CENTROIDS = 4_096
SHARD = 600
BLOCK = 3_000
DEGREE = 16
NEAREST = 48
#: Random neighbours of each point beside those.
FAR = 8
ALPHA = 1.2
#: Points whose cosine falls short by this much are still followed while the range widens.
SLACK = 0.05
AUDIT = 400
#: Uniform draws of the audit grow up to about so many, while fewer than ENOUGH of them have links.
MOST = 25_600
ENOUGH = 30
#: Points with at most so many links are judged apart from those with more.
FEW = 3
TARGET = 0.95
#: Pairs of points, or edges, that are looked at together: a bundle of near copies has as many as its square.
PAIRS = 50_000
#: (overlap, beam) of the attempts.
ATTEMPTS = ((2, 48), (3, 96), (5, 192))
_log = logging.getLogger(__name__)


def points(vectors: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows (id, key) with a null key where a vector takes no part; points (key, rep, copies, label, v))."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(vector, lambda x: x != 0)
    part = F.coalesce(usable & F.col(vector).isNotNull() & F.col(label).isNotNull() & F.col(id_col).isNotNull(), F.lit(False))
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(part, F.md5(F.concat_ws("/", F.col(label).cast("string"), F.array_join(v, ",")))).alias("key"), F.col(label).cast("string").alias("label"), v.alias("v"))
    grouped = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.max(F.struct("label", "v")).alias("s"))
    return rows.select("id", "key"), grouped.select("key", "rep", "copies", "s.label", "s.v")


def _unit(vs: list, width: int | None = None) -> np.ndarray:
    width = width or max(map(len, vs))
    x = np.zeros((len(vs), width))
    for i, v in enumerate(vs):
        x[i, : len(v)] = v
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(pts: DataFrame) -> dict[str, np.ndarray]:
    """Centroids for each label that has several shards, from at most SAMPLE points."""
    total = pts.count()
    rows = pts.select("label", "v", "rep").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toPandas()
    if not len(rows):
        return {}
    out = {}
    rng = np.random.default_rng(3)
    for label, some in rows.groupby("label", sort=True):
        estimate = len(some) * total / len(rows)
        k = int(min(np.ceil(estimate / SHARD), len(some) // 8, np.ceil(CENTROIDS * len(some) / len(rows))))
        if k < 2:
            continue
        x = _unit(some["v"].tolist())
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(8):
            near = np.argmax(x @ c.T, 1)
            for j in range(k):
                if (near == j).any():
                    m = x[near == j].sum(0)
                    c[j] = m / max(np.sqrt((m * m).sum()), 1e-12)
        out[label] = c
    return out


def assign(pts: DataFrame, centroids: dict[str, np.ndarray], overlap: int) -> DataFrame:
    """(label, rep, copies, v, shards): the ascending numbers of a point's shards within its label."""
    shared = pts.sparkSession.sparkContext.broadcast(centroids)

    @F.pandas_udf("array<int>")
    def nearest(label: pd.Series, v: pd.Series) -> pd.Series:
        out = []
        for name, x in zip(label, v, strict=True):
            c = shared.value.get(name)
            if c is None:
                out.append([0])
                continue
            x = np.asarray(x, np.float64)
            m = min(len(x), c.shape[1])
            near = c[:, :m] @ (x[:m] / np.abs(x).max())
            out.append(sorted(np.argsort(-near, kind="stable")[:overlap].tolist()))
        return pd.Series(out)

    return pts.withColumn("shards", nearest("label", "v"))


def robust_prune(x: np.ndarray, degree: int = DEGREE, nearest: int = NEAREST, alpha: float = ALPHA, far: int = FAR) -> list[np.ndarray]:
    """Neighbours of each unit vector. Of its nearest ones, in order, each is kept unless one kept before is
    alpha times closer to it; then as many of some random ones, likewise, as `far` allows. Without those, a bundle of
    near copies would have no way in or out."""
    n = len(x)
    k = min(nearest, n - 1)
    if k < 1:
        return [np.zeros(0, np.int64)] * n
    some = np.random.default_rng(n).integers(0, n, (n, 2 * far))
    out = []
    for a in range(0, n, 512):
        sim = x[a : a + 512] @ x.T
        own = np.arange(len(sim))
        sim[own, own + a] = -np.inf
        cand = np.argpartition(-sim, k - 1, 1)[:, :k] if k < n - 1 else np.argsort(-sim, 1)[:, :k]
        near = np.take_along_axis(sim, cand, 1)
        order = np.argsort(-near, 1, kind="stable")
        cand = np.hstack([np.take_along_axis(cand, order, 1), some[a : a + 512]])
        near = np.hstack([np.take_along_axis(near, order, 1), np.take_along_axis(sim, some[a : a + 512], 1)])
        dist = np.sqrt(np.maximum(0, 2 - 2 * near))
        for b in range(0, len(cand), 64):
            c, d = cand[b : b + 64], dist[b : b + 64]
            v = x[c]
            between = np.sqrt(np.maximum(0, 2 - 2 * np.matmul(v, v.transpose(0, 2, 1))))
            alive = np.isfinite(d)
            kept = np.zeros(c.shape, bool)
            for j in range(c.shape[1]):
                now = alive[:, j] & (kept.sum(1) < (degree if j < k else degree + far))
                kept[:, j] = now
                alive &= ~(now[:, None] & (alpha * between[:, j] <= d))
            out += [np.unique(row[keep]) for row, keep in zip(c, kept, strict=True)]
    return out


def medoids_of(x: np.ndarray) -> np.ndarray:
    """Where searches start: the medoid of all, and those of about sqrt(n) parts around random points."""
    n = len(x)
    pivots = np.random.default_rng(n + 1).choice(n, min(n, int(np.sqrt(n)) + 1), replace=False)
    part = np.argmax(x @ x[pivots].T, 1)
    out = [int(np.argmax(x @ x.sum(0)))]
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        out.append(int(own[np.argmax(x[own] @ x[own].sum(0))]))
    return np.unique(out)


class Graph:
    """Adjacency lists with their reverse edges, one after the other."""

    def __init__(self, lists: list[np.ndarray]):
        n = len(lists)
        src = np.repeat(np.arange(n), [len(x) for x in lists])
        dst = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        pair = np.unique(np.concatenate([src * n + dst, dst * n + src]))
        self.to = pair % max(n, 1)
        self.start = np.searchsorted(pair // max(n, 1), np.arange(n + 1))

    def around(self, r: np.ndarray, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(r, w) for each neighbour w of v, some pairs at a time."""
        count = self.start[v + 1] - self.start[v]
        cut = np.append(np.flatnonzero(np.diff(np.cumsum(count) // PAIRS, prepend=0)), len(v))
        a = 0
        for b in cut:
            if b > a or b == len(v):
                c = count[a:b]
                place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                yield np.repeat(r[a:b], c), self.to[np.repeat(self.start[v[a:b]], c) + place]
            a = b


def cosines(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x[a] . y[b] for unit vectors, some pairs at a time."""
    out = np.empty(len(a))
    for k in range(0, len(a), PAIRS):
        out[k : k + PAIRS] = np.einsum("ij,ij->i", x[a[k : k + PAIRS]], y[b[k : k + PAIRS]])
    return out


def range_search(x: np.ndarray, graph: Graph, cosine: float, beam: int, slack: float = SLACK) -> np.ndarray:
    """Boolean (points, points): those found within the range of each point. All points of a block search
    side by side."""
    n = len(x)
    medoids = medoids_of(x)
    beam = min(beam, n)
    found = np.zeros((n, n), bool)

    def fresh(r: np.ndarray, v: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (query, point) pairs among the neighbours of these that were not seen; they are now."""
        new = np.zeros(seen.shape, bool)
        for q, w in graph.around(r, v):
            new[q, w] = True
        new &= ~seen
        seen |= new
        return np.nonzero(new)

    for a in range(0, n, 256):
        q = x[a : a + 256]
        seen = np.zeros((len(q), n), bool)
        seen[:, medoids] = True
        ids = np.broadcast_to(medoids, (len(q), len(medoids)))
        sims = q @ x[medoids].T
        done = np.zeros(ids.shape, bool)
        close = np.zeros(seen.shape, bool)  # all that come nearly within the range, in the beam or not
        close[:, medoids] = sims >= cosine - slack
        while True:
            if ids.shape[1] > beam:
                top = np.argpartition(-sims, beam - 1, 1)[:, :beam]
                ids, sims, done = (np.take_along_axis(z, top, 1) for z in (ids, sims, done))
            # a few at a time: the best open nodes of each beam
            width = min(4, ids.shape[1])
            open_sims = np.where(done, -np.inf, sims)
            best = np.argpartition(-open_sims, width - 1, 1)[:, :width]
            live = np.take_along_axis(open_sims, best, 1) > -np.inf
            if not live.any():
                break
            np.put_along_axis(done, best, True, 1)
            at = np.nonzero(live)
            r, v = fresh(at[0], np.take_along_axis(ids, best, 1)[at], seen)
            if not len(r):
                continue
            s = cosines(q, x, r, v)
            near = s >= cosine - slack
            close[r[near], v[near]] = True
            count = np.bincount(r, minlength=len(q))
            place = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
            more = np.full((len(q), count.max()), -np.inf)
            named = np.zeros(more.shape, ids.dtype)
            named[r, place], more[r, place] = v, s
            ids, sims, done = np.hstack([ids, named]), np.hstack([sims, more]), np.hstack([done, np.isneginf(more)])
        # widen: all neighbours of what lies within the range, or nearly
        r, v = np.nonzero(close)
        s = cosines(q, x, r, v)
        while len(r):
            inside = s >= cosine
            found[a + r[inside], v[inside]] = True
            r, v = fresh(r, v, seen)
            s = cosines(q, x, r, v)
            keep = s >= cosine - slack
            r, v, s = r[keep], v[keep], s[keep]
    np.fill_diagonal(found, False)
    found |= found.T.copy()
    return found


def verified(x: np.ndarray, link: np.ndarray, cosine: float) -> None:
    """Clears the links whose cosine in double precision falls short, some rows at a time."""
    step = max(1, PAIRS // max(1, len(x)))
    for s in range(0, len(x), step):
        a, b = np.nonzero(link[s : s + step])
        short = cosines(x, x, a + s, b) < cosine
        link[a[short] + s, b[short]] = False


def all_links(pts: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """What links() returns, by comparing all points of a label."""
    keys = ["label", "__i", "__j"]
    sizes = pts.groupBy("label").agg(F.count("*").alias("n"))
    placed = block_pairs(pts.join(sizes, "label").filter("n > 1"), "n", "rep", BLOCK)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys, 2_000):
            cut = bounds(*(pdf[k].to_numpy() for k in keys))
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                g = pdf.iloc[s:e]
                rep, own, x = g["rep"].to_numpy(np.int64), g["__own"].to_numpy(np.int64), _unit(g["v"].tolist())
                link = np.zeros((len(x), len(x)), bool)
                for a in range(0, len(x), 512):
                    link[a : a + 512] = x[a : a + 512] @ x.T >= cosine - 1e-9
                np.fill_diagonal(link, False)
                if g["__i"].iloc[0] != g["__j"].iloc[0]:
                    link &= own[:, None] != own[None, :]
                verified(x, link, cosine)
                roots = local_roots(link)
                n = row_sums(link, g["copies"].to_numpy(np.int64))
                yield pd.DataFrame({"rep": rep, "links": n, "root": rep[roots]})[(n > 0) | (roots != np.arange(len(rep)))]

    out = placed.select(*keys, "rep", "copies", "v", "__own").repartition(*keys).sortWithinPartitions(*keys, "rep").mapInPandas(compare, "rep long, links long, root long")
    out = table(out, "links")
    return out.groupBy("rep").agg(F.sum("links").alias("links")), out.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def settle_shared(x: np.ndarray, link: np.ndarray, shards: list, shard: int, cosine: float) -> np.ndarray:
    """Boolean (points, points): those that share an earlier shard, where they were counted. Pairs that share a
    later shard too are compared here whether the search found them or not, as a pair that is only found there
    would count nowhere. Links whose cosine falls short are cleared."""
    n = len(x)
    numbers = np.unique(np.concatenate([np.asarray(ts, np.int64) for ts in shards]))
    member = np.zeros((n, len(numbers)), np.float32)
    for r, ts in enumerate(shards):
        member[r, np.searchsorted(numbers, ts)] = 1
    before, after = member[:, numbers < shard], member[:, numbers > shard]
    earlier = np.zeros((n, n), bool)
    for a in range(0, n, 512):
        earlier[a : a + 512] = before[a : a + 512] @ before.T > 0
        later = (after[a : a + 512] @ after.T > 0) & ~earlier[a : a + 512]
        if later.any():
            link[a : a + 512] |= later & (x[a : a + 512] @ x.T >= cosine - 1e-9)
    np.fill_diagonal(link, False)
    verified(x, link, cosine)
    return earlier


_KEYS = ["label", "shard", "__i", "__j"]


def links(assigned: DataFrame, cosine: float, beam: int) -> tuple[DataFrame, DataFrame]:
    """(rep, links) and the forests (a, b) of one attempt."""
    spread = assigned.select("label", "rep", "copies", "v", "shards", F.explode("shards").alias("shard"))
    sizes = spread.groupBy("label", "shard").agg(F.count("*").alias("n"))
    placed = block_pairs(spread.join(sizes, ["label", "shard"]).filter("n > 1"), "n", "rep", BLOCK)
    placed = table(placed.select(*_KEYS, "rep", "copies", "v", "shards", "__own"), "shards")
    dealt = lambda df: df.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "rep")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, _KEYS, 2_000):
            cut = bounds(*(pdf[k].to_numpy() for k in _KEYS))
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                rep = pdf["rep"].to_numpy(np.int64)[s:e]
                lists = robust_prune(_unit(pdf["v"].iloc[s:e].tolist()))
                yield pd.DataFrame({"rep": rep, "near": [rep[x].tolist() for x in lists]})

    graph = dealt(placed.select(*_KEYS, "rep", "v")).mapInPandas(build, "rep long, near array<long>")
    united = graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, _KEYS, 2_000):
            cut = bounds(*(pdf[k].to_numpy() for k in _KEYS))
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                g = pdf.iloc[s:e]
                rep = g["rep"].to_numpy(np.int64)
                x = _unit(g["v"].tolist())
                order = np.argsort(rep, kind="stable")
                lists = []
                for near in g["near"]:
                    near = np.asarray(near, np.int64)
                    at = np.minimum(np.searchsorted(rep[order], near), len(rep) - 1)
                    lists.append(order[at[rep[order[at]] == near]])
                link = range_search(x, Graph(lists), cosine, beam)
                i, j, shard = int(g["__i"].iloc[0]), int(g["__j"].iloc[0]), int(g["shard"].iloc[0])
                own = g["__own"].to_numpy(np.int64)
                earlier = settle_shared(x, link, g["shards"].tolist(), shard, cosine)
                if i != j:
                    link &= own[:, None] != own[None, :]
                roots = local_roots(link)
                link &= ~earlier
                n = row_sums(link, g["copies"].to_numpy(np.int64))
                yield pd.DataFrame({"rep": rep, "links": n, "root": rep[roots]})[(n > 0) | (roots != np.arange(len(rep)))]

    out = dealt(placed.join(united, "rep")).select(*_KEYS, "rep", "copies", "v", "shards", "__own", "near").mapInPandas(search, "rep long, links long, root long")
    out = table(out, "links")
    return out.groupBy("rep").agg(F.sum("links").alias("links")), out.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def _probed(pts: DataFrame, ids: DataFrame, counts: DataFrame, cosine: float) -> pd.DataFrame:
    """(rep, label, n, got) of some points: their links by brute force, and as they were found."""
    probe = pts.join(F.broadcast(ids), "rep").select("key", "rep", "label", "v").toPandas()
    if not len(probe):
        return pd.DataFrame({"rep": [], "label": [], "n": [], "got": []})
    width = max(map(len, probe["v"]))
    shared = pts.sparkSession.sparkContext.broadcast({label: (g["key"].to_numpy(), g["rep"].to_numpy(np.int64), _unit(g["v"].tolist(), width)) for label, g in probe.groupby("label")})

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for label, g in pdf.groupby("label"):
                if label not in shared.value:
                    continue
                keys, _, x = shared.value[label]
                n = total.setdefault(label, np.zeros(len(keys), np.int64))
                y, copies, own = _unit(g["v"].tolist()), g["copies"].to_numpy(np.int64), g["key"].to_numpy()
                m = min(x.shape[1], y.shape[1])
                for a in range(0, len(x), 512):
                    near = x[a : a + 512, :m] @ y[:, :m].T >= cosine
                    near &= keys[a : a + 512, None] != own[None, :]
                    n[a : a + 512] += near @ copies
        for label, n in total.items():
            yield pd.DataFrame({"rep": shared.value[label][1], "label": label, "n": n})

    true = pts.select("key", "label", "copies", "v").mapInPandas(brute, "rep long, label string, n long").groupBy("rep").agg(F.min("label").alias("label"), F.sum("n").alias("n"))
    return true.join(counts, "rep", "left").select("rep", "label", "n", F.coalesce("links", F.lit(0)).alias("got")).toPandas()


def _least_recall(probes: pd.DataFrame) -> float:
    """The least mean of the share of a point's links that were found: over all points with links, and over those
    with at most FEW links, with more, and of each label, where ENOUGH were probed."""
    linked = probes[probes["n"] > 0]
    if not len(linked):
        return 1.0
    share = np.minimum(linked["got"], linked["n"]) / linked["n"]
    strata = [g for by in (linked["n"] <= FEW, linked["label"]) for _, g in share.groupby(by) if len(g) >= ENOUGH]
    return float(min(g.mean() for g in [share, *strata]))


def audit(pts: DataFrame, counts: DataFrame, cosine: float, sample: int = AUDIT) -> float:
    """The mean recall of a point, the least of its strata. Points are drawn uniformly, more of them while fewer
    than ENOUGH have links, up to MOST; up to `sample` points with found links are judged on their own."""
    some = lambda d, n: d.select("rep").distinct().orderBy(F.xxhash64("rep", F.lit(5)), "rep").limit(n)
    total = pts.count()
    while True:
        drawn = _probed(pts, some(pts, sample), counts, cosine)
        if (drawn["n"] > 0).sum() >= ENOUGH or sample >= min(total, MOST):
            break
        sample *= 8
    found = _probed(pts, some(counts.filter("links > 0"), AUDIT), counts, cosine)
    return min(_least_recall(drawn), _least_recall(found))


def components(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of vectors."""
    rows, pts = points(vectors, id_col, vector, label)
    pts = table(pts, "points")
    centroids = fit_centroids(pts)
    for overlap, beam in ATTEMPTS:
        counts, forest = links(assign(pts, centroids, overlap), cosine, beam)
        counts = table(counts, "counts")
        recall = audit(pts, counts, cosine)
        _log.info("overlap %d, beam %d: audited recall %.4f", overlap, beam, recall)
        if recall >= TARGET:
            break
    else:
        _log.warning("recall stayed below %.2f: all pairs of a label are compared", TARGET)
        counts, forest = all_links(pts, cosine)
    found = connected_components(forest, "a", "b")
    of_point = (
        pts.select("key", "rep", "copies")
        .join(counts, "rep", "left").join(found.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    done = rows.filter("key IS NOT NULL").join(of_point, "key").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    rest = rows.filter("key IS NULL").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CASE WHEN label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS v FROM embeddings),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.v IS NOT NULL AND b.v IS NOT NULL
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS r FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.r),
c AS (SELECT a, min(r) AS c FROM r GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept FROM embeddings e JOIN c ON c.a = e.vec_id
"""
