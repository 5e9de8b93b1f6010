import re

import numpy as np
import pytest

from folio.llm import near_copies as nc
from folio.llm.shared import connected_components
from tests.llm.helpers import DOCS, odd_docs


def brute(docs):
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w and i is not None else None)
    n = len(docs)
    link = [[a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for b in range(n)] for a in range(n)]
    root = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            a = todo.pop()
            for b in range(n):
                if b not in seen and (link[a][b] or (docs[a][0] is not None and docs[a][0] == docs[b][0])):
                    seen.add(b)
                    todo.append(b)
        root[i] = min((docs[j][0] for j in seen if docs[j][0] is not None), default=None) if docs[i][0] is not None else None
    return sorted(((docs[i][0], root[i], sum(map(bool, link[i]))) for i in range(n)), key=repr)


def near_group(n, size=150, seed=5):
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 5000, size)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, size, rng.integers(0, 4)):
            w[k] = f"n{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_classes_and_links(spark, monkeypatch, block):
    monkeypatch.setattr(nc, "BLOCK", block)
    monkeypatch.setattr(nc, "SUBTREE", block * 2)
    docs = [(100 + i, t) for i, t in enumerate(near_group(40))] + [(i, t) for i, t, *_ in odd_docs() if i not in (12, 15)]
    got = nc.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_odd_rows(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    got = nc.classes(docs)
    assert got.count() == docs.count()
    by = {r.doc_id: r for r in got.collect()}
    assert by[3].class_id == 1 and by[10].class_id == 9 and by[6].class_id == 6 and by[7].n_links == 0 and by[None].class_id is None
    kept = nc.one_of_each(docs, got)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 6, 7, 8, None, None, 9, 11, 12, 13, 14, 15, 15, 16, 17], key=repr)


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert nc.classes(docs).count() == 0 and nc.one_of_each(docs, nc.classes(docs)).count() == 0


def test_depth_follows_the_pairs():
    assert nc.next_depth({}, nc.LABEL) < nc.LABEL  # nothing seen proves little
    assert nc.next_depth({0.99: 10**6}, nc.LABEL) == nc.LABEL  # nearly equal texts have all met
    low = nc.next_depth({0.8: 10**6}, nc.LABEL)
    assert nc.met(0.8, low) >= nc.RECALL > nc.met(0.8, low + 1) and nc.next_depth({0.8: 10**6}, low) == low
    assert low < nc.next_depth({0.85: 10**6}, nc.LABEL) < nc.LABEL


def test_recall_of_random_pairs(spark):
    """Pairs of texts of all similarities around the threshold, with nothing else that would join them."""
    rng = np.random.default_rng(11)
    docs = []
    for g in range(400):
        w = [f"g{g}w{k}" for k in range(120)]
        docs.append((2 * g, " ".join(w)))
        at = int(rng.integers(100, 116))
        docs.append((2 * g + 1, " ".join([*w[:at], *(f"x{g}y{k}" for k in range(120 - at))])))
    want = {r[0]: r[1:] for r in brute_pairs(docs)}
    got = {r.doc_id: (r.class_id, r.n_links) for r in nc.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    linked = [i for i in want if want[i][1]]
    assert len(linked) > 300 and sum(got[i] == want[i] for i in linked) >= 0.995 * len(linked)
    assert all(got[i] == want[i] for i in want if not want[i][1])


def brute_pairs(docs):
    """brute() where only documents 2 g and 2 g + 1 can be near."""
    return [r for g in range(0, len(docs), 2) for r in brute(docs[g : g + 2])]


def test_recall_on_the_driver_tables(spark):
    """Classes and links of a whole table, by an inverted index of shingles instead of a forest."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets, owners = {}, {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if w:
            sets[i] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
            for x in sets[i]:
                owners.setdefault(x, []).append(i)
    shared = {}
    for own in owners.values():
        for a in own if len(own) > 1 else ():
            for b in own:
                if a < b:
                    shared[a, b] = shared.get((a, b), 0) + 1
    true = {(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)}
    links = {i: 0 for i, _ in docs}
    for pair in true:
        for i in pair:
            links[i] += 1
    got = {r.doc_id: r.n_links for r in nc.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert true and all(got[i] <= links[i] for i in links) and sum(got.values()) >= 0.999 * sum(links.values())


def test_rows_that_share_an_id(spark):
    base = " ".join(f"b{k}" for k in range(60))
    rows = [(1, base, 3), (1, base, 2), (1, "quite another text here", 5), (2, base, 4), (-(1 << 63), "one more text of its own", 6), (None, base, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels int")
    got = nc.classes(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, 2), (1, 1, 2), (1, 1, 0), (2, 1, 2), (-(1 << 63), -(1 << 63), 0), (None, None, 0)], key=repr)
    first = sorted(map(tuple, nc.one_of_each(docs, got).collect()), key=repr)
    again = sorted(map(tuple, nc.one_of_each(docs.repartition(3), got).collect()), key=repr)
    assert first == again and sorted((r[0], r[1]) for r in first if r[0] is not None) == sorted({(1, base), (1, rows[2][1]), (rows[4][0], rows[4][1])}) and len(first) == 4


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {n: n for e in edges for n in e}
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    assert got == {n: find(n) for e in edges for n in e if e[0] != e[1]}
