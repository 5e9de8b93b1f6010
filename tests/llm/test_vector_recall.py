"""That links which the search misses are found, counted, or seen by the audit."""

import numpy as np
import pytest

from folio.llm import vector_graph as vg
from tests.llm.test_vectors import brute_components

SCHEMA = "vec_id long, embedding array<double>, label int"


def groups(n=60, size=4, width=16, seed=5):
    """Groups of close vectors in three labels, with some rows that take no part or repeat."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n):
        c = rng.normal(size=width)
        rows += [(g * size + k, (c + 0.15 * rng.normal(size=width)).tolist(), g % 3) for k in range(size)]
    return [*rows, (900, rows[0][1], 0), (900, rows[0][1], 0), (901, None, 1), (None, rows[0][1], 0), (902, rows[0][1], None), (903, [0.0] * width, 1)]


@pytest.mark.parametrize("block", [3000, 16])
def test_exact_when_recall_stays_low(spark, monkeypatch, block):
    monkeypatch.setattr(vg, "SHARD", 4)
    monkeypatch.setattr(vg, "BLOCK", block)
    monkeypatch.setattr(vg, "ATTEMPTS", ((1, 1),))
    monkeypatch.setattr(vg, "audit", lambda *_: 0.5)
    rows = groups()
    got = sorted((tuple(r) for r in vg.components(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute_components(rows)


def test_hot_group_does_not_hide_losses(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=16)
    rows = [(i, (hot + 0.01 * rng.normal(size=16)).tolist(), 0) for i in range(400)]
    for g in range(100):
        c = rng.normal(size=16)
        rows += [(1000 + 2 * g + k, (c + 0.02 * rng.normal(size=16)).tolist(), 0) for k in range(2)]
    _, pts = vg.points(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    true = spark.createDataFrame([(r[0], r[1]) for r in brute_components(rows)], "rep long, links long")
    assert vg.audit(pts, true, vg.COSINE) == 1.0
    assert vg.audit(pts, true.filter("rep < 1000"), vg.COSINE) < vg.TARGET


def test_pair_found_in_a_later_shard_counts(spark, monkeypatch):
    rows = [r for r in groups() if r[0] is not None and r[0] < 240 and r[2] == 0]
    _, pts = vg.points(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    assigned = pts.selectExpr("key", "rep", "copies", "label", "v", "IF(rep < 120, array(0, 1), array(0)) AS shards")

    def late(x, graph, cosine, beam):  # the first shard has all points
        return np.triu(x @ x.T >= cosine, 1) | np.tril(x @ x.T >= cosine, -1) if len(x) < len(rows) else np.zeros((len(x), len(x)), bool)

    monkeypatch.setattr(vg, "range_search", late)
    counts, forest = vg.links(assigned, vg.COSINE, 48)
    want = {r[0]: r[1] for r in brute_components([r for r in rows if r[0] < 120]) if r[1]}
    assert want and {r.rep: r.links for r in counts.filter("links > 0").collect()} == want
    assert forest.filter("a <> b").count() > 0
