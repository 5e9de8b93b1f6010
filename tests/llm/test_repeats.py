import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import repeats
from tests.llm.helpers import DOCS, odd_docs, rows


def brute(docs, length=100):
    """docs: (doc_id, text); ids that repeat start at equal places."""
    where = {}
    for i, t in docs:
        raw = (t or "").encode()
        key = repeats.NULL_ID if i is None else i
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            where[w] = min(where.get(w, (key, p)), (key, p))
    out = []
    for i, t in docs:
        raw = (t or "").encode()
        key = repeats.NULL_ID if i is None else i
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if where[raw[p : p + length]] < (key, p):
                gone[p : p + length] = True
        g = gone[: len(raw)]
        kept = bytes(b for b, x in zip(raw, g) if not x)
        out.append((i, len(raw), int(g.sum()), int((g & ~np.append(False, g[:-1])[: len(g)]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.text("ab", min_size=1, max_size=400), st.text("abcxyz ", min_size=1, max_size=300), st.integers(1, 300).map(lambda n: "a" * n)))
def test_suffix_array(text):
    data = np.frombuffer(text.encode(), np.uint8)
    raw = text.encode()
    got = repeats.suffix_array(data, 1000)
    assert got.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=130, max_size=600))
def test_depth_is_enough(text):
    raw = text.encode()
    got = repeats.suffix_array(np.frombuffer(raw, np.uint8), 40)
    cut = [raw[i : i + 40] for i in got]
    assert cut == sorted(cut) and sorted(got.tolist()) == list(range(len(raw)))


@pytest.mark.parametrize("kinds", [500, 1])
def test_against_brute_force(spark, monkeypatch, kinds):
    monkeypatch.setattr(repeats, "KINDS", kinds)
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{k}" for k in rng.integers(0, 900, 60))
    docs = [(d[0], d[1]) for d in odd_docs()]
    for i in range(40):
        own = " ".join(f"q{k}" for k in rng.integers(0, 10**6, rng.integers(5, 60)))
        cut = int(rng.integers(0, len(passage) - 150))
        docs.append((200 + i, own[: int(rng.integers(0, len(own)))] + passage[cut : cut + int(rng.integers(90, 260))] + own))
    got = rows(repeats.strip(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)))
    assert got == brute(docs)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=1, max_size=400), st.integers(1, 60))
def test_common_prefixes(text, depth):
    raw = text.encode()
    order = repeats.suffix_array(np.frombuffer(raw, np.uint8), depth)
    want = []
    for a, b in zip(order, order[1:]):
        n = 0
        while n < depth and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        want.append(n)
    assert repeats.common_prefixes(np.frombuffer(raw, np.uint8), order, depth).tolist() == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abc ", max_size=300), min_size=1, max_size=4), st.sampled_from([1, 8]))
def test_segments_cover_windows(texts, seeds):
    """Each window lies in one segment, and equal windows have equal anchors."""
    raw = [t.encode() for t in texts]
    found = repeats.segments(raw, seeds=seeds)
    anchors = {}
    seen = []
    for d, s, n, a in zip(*(found[k].tolist() for k in ("doc", "start", "windows", "anchor"))) if found else ():
        for p in range(s, s + n):
            seen.append((d, p))
            assert anchors.setdefault(raw[d][p : p + 100], a) == a
    assert sorted(seen) == [(d, p) for d, r in enumerate(raw) for p in range(len(r) - 99)]


def test_common_line_in_many_contexts(spark, monkeypatch):
    """One line whose anchor has more kinds than are compared at once; some contexts repeat as well."""
    monkeypatch.setattr(repeats, "KINDS", 5)
    rng = np.random.default_rng(12)
    line = " all rights to this very common line are kept by no one "
    word = lambda: "".join(rng.choice(list("abcdefg"), rng.integers(2, 8)))
    docs = []
    for i in range(60):
        before, after = " ".join(word() for _ in range(30)), " ".join(word() for _ in range(30))
        if i % 7 == 3:
            before = docs[i - 1][1].split(line)[0]
        docs.append((i, before + line + after))
    assert rows(repeats.strip(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))) == brute(docs)


def test_shuffled_input_and_many_flushes(spark, monkeypatch):
    """Rows in any order, records sent on again and again, one very long text."""
    monkeypatch.setattr(repeats, "HELD", 500)
    monkeypatch.setattr(repeats, "CHUNK", 1)
    rng = np.random.default_rng(13)
    passage = " ".join(f"p{k}" for k in rng.integers(0, 900, 80))
    docs = [(int(i), " ".join(f"q{k}" for k in rng.integers(0, 10**6, 30)) + passage) for i in rng.permutation(60)]
    docs.append((99, " ".join(f"r{k}" for k in rng.integers(0, 10**6, 6_000)) + passage * 3))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6, "text")
    assert rows(repeats.strip(df)) == brute(docs)


def test_clean_texts(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    out = repeats.clean_texts(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r.doc_id: r for r in out.collect()}
    assert by[2].text == "" or by[1].text == ""
    assert by[17].text == "x" and by[7].text == "" and by[17].score == 0.1


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert repeats.strip(docs).count() == 0 and repeats.clean_texts(docs).count() == 0


def test_another_scan_may_be_cut_otherwise(spark, monkeypatch, tmp_path):
    """Once a table is written, the input's tasks hold other rows, as after the loss of an executor."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{k}" for k in rng.integers(0, 900, 60))
    docs = [(1, passage), (2, "x " * 80 + passage), (3, passage[40:])]
    moved, write = tmp_path / "moved", repeats.table

    def deal(batches):
        import os

        import pandas as pd

        for pdf in batches:
            for k in pdf["id"]:
                own = docs[k : k + 1] if os.path.exists(moved) else docs if k == 0 else []
                yield pd.DataFrame(own, columns=["doc_id", "text"])

    def table(df, tag):
        out = write(df, tag)
        moved.touch()
        return out

    monkeypatch.setattr(repeats, "table", table)
    assert rows(repeats.strip(spark.range(0, 3, 1, 3).mapInPandas(deal, "doc_id long, text string"))) == brute(docs)


def test_joined_runs():
    of = lambda rows: repeats._joined(*(np.array(x, np.int64) for x in zip(*rows)))
    got = of([(1, 5, 0, 100), (1, 5, 100, 150), (1, 5, 151, 260), (1, 6, 10, 120), (2, 5, 0, 300), (2, 5, 20, 130), (2, 5, 290, 400), (-9, 5, 3, 9), (-9, 5, 3, 9)])
    assert [tuple(r) for r in got.to_numpy().tolist()] == [(-9, 5, 3, 9), (1, 5, 0, 150), (1, 5, 151, 260), (1, 6, 10, 120), (2, 5, 0, 400)]
