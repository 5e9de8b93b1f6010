"""Which rows and texts two stages of the pipeline keep, by brute force."""

import hashlib

import numpy as np

import corpus_pipeline
from tests.llm.helpers import DOCS, odd_docs
from tests.llm.test_near_copies import brute as brute_classes, near_group
from tests.llm.test_repeats import brute as brute_runs


def test_rows_and_texts(spark, tmp_path):
    seen, docs = set(), []
    for d in odd_docs():
        if d[0] is not None and d[0] not in seen and (d[1] or "").isascii():
            seen.add(d[0])
            docs.append(d)
    docs += [(100 + k, t, "en", f"s{k % 3}", len(t), "k", "v", 0.1) for k, t in enumerate(near_group(12))]
    stages = dict(corpus_pipeline.STAGES)
    at = spark.createDataFrame(docs, DOCS)
    classes = brute_classes([d[:2] for d in docs])
    kept = {i for i, root, _ in classes if i == root}
    out = stages["near_copies"](spark, at, str(tmp_path)).collect()
    assert len(kept) < len(docs) and sorted(r.doc_id for r in out) == sorted(kept)
    texts = {d[0]: d[1] for d in docs}
    assert all(r.text == texts[r.doc_id] for r in out)
    out = {r.doc_id: r for r in stages["repeats"](spark, at, str(tmp_path)).collect()}
    want = {i: (n - gone, sha) for i, n, gone, _, sha in brute_runs([d[:2] for d in docs])}
    got = {i: (r.n_chars, hashlib.sha256((r.text or "").encode()).hexdigest()) for i, r in out.items()}
    assert got == want and np.sum([d[4] - want[d[0]][0] for d in docs]) > 0
