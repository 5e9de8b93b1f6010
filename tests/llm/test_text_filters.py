import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from folio.llm import licenses, mixing, pu_quality, url_filter
from tests.llm.helpers import DOCS, odd_docs


def test_urls(spark):
    urls = [
        (1, "https://A.Example.org/es/x?y"), (2, "http://example.org/en/12"), (3, "http://notexample.org/es/"), (4, "http://x.com/fr/1"), (5, "http://x.com/de/1"), (6, "http://x.net/porn/1"),
        (7, "http://x.net/pornography"), (8, "http://x.net/free-casino"), (9, "http://x.net/free/free"), (10, None), (11, "no scheme porn"), (12, ""), (13, "http://org/"), (14, "http://x.net#a://b.org/"), (15, "HTTP://ADULT.net/BET"), (1, "https://A.Example.org/es/x?y"),
    ]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    verdict = {i: (r.rule, r.verdict) for i, r in got.items()}
    assert verdict == {
        1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: ("com/fr/", "allow"), 5: ("com/de/", "block"), 6: (None, "block"), 7: (None, "allow"), 8: (None, "block"),
        9: (None, "allow"), 10: (None, "allow"), 11: (None, "block"), 12: (None, "allow"), 13: ("org/", "allow"), 14: (None, "allow"), 15: (None, "block"),
    }
    assert (got[1].host, got[1].path, got[14].host, got[10].host, got[11].path) == ("a.example.org", "/es/x", "x.net", "", "")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_long_urls_of_mixed_width(spark):
    wide = "aé\U0001d54f\u4e2d" * 50_000
    urls = [(1, wide), (2, "http://" + wide + "/p"), (3, "http://h/" + wide + "?porn"), (4, "x" * 200_000 + "://h.org/")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert (got[1].host, got[1].path, got[1].verdict) == ("", "", "allow")
    assert got[2].host == wide and got[2].path == "/p" and got[3].path == "/" + wide and got[3].verdict == "block"
    assert got[4].rule == "org/"


def test_vocabulary_and_rules_from_tables(spark):
    terms = spark.createDataFrame([("Alpha", 1.0), ("beta", 0.4), ("gamma", 0.6), ("beta", 0.1), (None, 1.0), ("delta", None)], "term string, weight double")
    rules = spark.createDataFrame([("allow", "Good.net", None), ("block", "good.net", "/x")], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a/alpha"), (2, "http://a/beta"), (3, "http://a/beta-gamma"), (4, "http://good.net/alpha"), (5, "http://w.good.net/x"), (6, "http://a/alphabet")], "page_id long, url string").withColumn("verdict", F.lit("mine"))
    vocabulary = url_filter.load_vocabulary(terms)
    got = {r.page_id: (r.verdict, r.soft_weight) for r in url_filter.judge(pages, rules=url_filter.load_rules(rules), vocabulary=vocabulary).collect()}
    assert got == {1: ("block", 0.0), 2: ("allow", 0.4), 3: ("block", 1.0), 4: ("allow", 0.0), 5: ("block", 0.0), 6: ("allow", 0.0)}
    assert url_filter.judge(pages, rules=(), vocabulary=()).filter("verdict = 'allow' AND rule IS NULL").count() == 6


def test_mix_of_an_id_that_repeats(spark, monkeypatch):
    """Null ids and one that repeats: as if each row stood for itself."""
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(None if k % 3 else 5, "w " * (1 + k % 2), "en", "s" if k % 4 else None, 0) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    planned = mixing.plan(mixing.sizes_of(docs), bucket_rows=2).collect()
    assert len(planned) == 90
    for source in ("s", None):
        own = sorted((r for r in planned if r.source == source), key=lambda r: (hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest(), -1 if r.doc_id is None else r.doc_id, r.size, -r.passes))
        goal, total, at = own[0].target, own[0].source_size, 0
        assert total == sum(r.size for r in own)
        for r in own:
            whole = int(goal // total)
            assert r.passes == whole + (whole < 2 and 2 * at + r.size < 2 * (goal - whole * total))
            at += r.size
    assert mixing.mix(docs).count() == sum(r.passes for r in planned)


def test_mix(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    planned = mixing.plan(mixing.sizes_of(docs), bucket_rows=2).collect()
    total = sum(size(d[1]) for d in odd_docs())
    assert sum(r.size for r in planned) == total and all(r.taken <= 2 * r.size for r in planned)
    goals = {r.source: (r.target, r.source_size) for r in planned}
    assert abs(sum(g for g, _ in goals.values()) - 1.5 * total) < 1e-6 and all(g <= 2 * s + 1e-9 for g, s in goals.values())
    for s, (goal, _) in goals.items():
        assert abs(sum(r.taken for r in planned if r.source == s) - goal) <= max(r.size for r in planned if r.source == s) / 2 + 1
    # the water level: sources below their limit share by weight
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted((x for x in goals if x), key=str))} | {None: (3, 1, 2)[len([x for x in goals if x]) % 3]}
    free = [g / weight[s] for s, (g, n) in goals.items() if g < 2 * n - 1e-9]
    assert max(free, default=0) - min(free, default=0) < 1e-6
    out = mixing.mix(docs)
    got = out.collect()
    want = {}
    for r in planned:
        want[r.doc_id, r.source, r.size] = want.get((r.doc_id, r.source, r.size), 0) + r.passes
    seen = {}
    for r in got:
        k = (r.doc_id, r.source, size(r.text))
        seen[k] = seen.get(k, 0) + 1
    assert seen == {k: n for k, n in want.items() if n}
    at = [r["__position"] for r in got]
    assert at == sorted(at)
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_schedule_inverts_demand(spark):
    for slope in (0.5, 1.0, 2.0):
        t = spark.range(11).select(mixing._demand_inverse(F.col("id") / 10.0, F.lit(slope)).alias("t")).collect()
        a, b = 2 / (1 + slope), 2 * slope / (1 + slope)
        for k, r in enumerate(t):
            assert abs(a * r.t + (b - a) * r.t**2 / 2 - k / 10) < 1e-9


def test_quality_learns(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = pu_quality.score(docs, pu_quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)


def plain_risk(w, p, u, prior):
    """The two terms of the risk, one document at a time."""
    loss = lambda f: math.log1p(math.exp(-f))
    f = lambda z: sum(a * b for a, b in zip(z, w, strict=True))
    pos = sum(loss(f(z)) for z in p) / len(p)
    neg = sum(loss(-f(z)) for z in u) / len(u) - prior * sum(loss(-f(z)) for z in p) / len(p)
    return prior * pos, neg


def test_risk_and_gradient():
    rng = np.random.default_rng(3)
    p, u, w = rng.normal(0.5, 1, (30, 4)), rng.normal(0, 1, (50, 4)), rng.normal(0, 1, 4)
    r_pos, r_neg, g_pos, g_neg = pu_quality.risk(w, p, u, 0.4)
    assert np.allclose((r_pos, r_neg), plain_risk(w, p, u, 0.4))
    for k in range(4):
        e = np.eye(4)[k] * 1e-6
        up, down = plain_risk(w + e, p, u, 0.4), plain_risk(w - e, p, u, 0.4)
        assert np.allclose((g_pos[k], g_neg[k]), ((up[0] - down[0]) / 2e-6, (up[1] - down[1]) / 2e-6), atol=1e-6)


def test_fit_lowers_the_risk():
    rng = np.random.default_rng(4)
    p, u = rng.normal(1, 1, (200, 3)).astype(np.float32), rng.normal(0, 1, (300, 3)).astype(np.float32)
    m = pu_quality.fit(p, u, 0.3)
    value = lambda w: sum(max(0.0, x) if k else x for k, x in enumerate(plain_risk(w, m.expand(p), m.expand(u), 0.3)))
    assert value(m.weights) < 0.8 * value(np.zeros(len(m.weights)))


def test_scores_one_by_one(spark, sf):
    """The whole query, against a model that is fitted and applied without Spark."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    part = lambda i: zlib.crc32(str(i).encode()) % 3
    pos = {r.doc_id for r in labels if r.quality == 1 and part(r.doc_id) != 1}
    fitted = sorted(i for i in docs if part(i) != 1)  # fewer than the bounds
    x = np.stack([pu_quality.features(docs[i]) for i in fitted])
    is_p = np.array([i in pos for i in fitted])
    rng = np.random.default_rng(7)
    p, u = rng.permutation(x[is_p]), rng.permutation(x)
    m = pu_quality.fit(p, u, pu_quality.estimate_prior(p, u))
    for r in pu_quality.op2_pu_quality(spark, sf).collect():
        z = [min(6.0, max(-6.0, (v - a) / s)) for v, a, s in zip(pu_quality.features(docs[r.doc_id]).astype(float), m.mean, m.scale, strict=True)]
        f = sum(w * v for w, v in zip(m.weights, [*z, *(v * v / 6 for v in z), 1.0], strict=True))
        assert abs(r.score - 1 / (1 + math.exp(-max(-40, min(40, f))))) < 1e-9
        assert r.held_out == (part(r.doc_id) == 1) and r.predicted == (r.score >= 0.5)


def test_prior_estimate():
    rng = np.random.default_rng(0)
    p = rng.normal(1.5, 1, (1500, 4)).astype(np.float32)
    u = np.vstack([rng.normal(1.5, 1, (2100, 4)), rng.normal(-1.5, 1, (900, 4))]).astype(np.float32)
    u = rng.permutation(u)
    prior = pu_quality.estimate_prior(p, u)
    assert abs(prior - 0.7) < 0.06
    m = pu_quality.fit(p, u, prior)
    assert (m.scores(rng.normal(-1.5, 1, (500, 4))) < 0.5).mean() > 0.95 and (m.scores(rng.normal(1.5, 1, (500, 4))) >= 0.5).mean() > 0.95


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pu_quality.score(docs, pu_quality.train(docs, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(i, 1) for i in range(1, 18)] + [(1, None), (None, 1), (999, 1)], "doc_id long, quality int")
    assert pu_quality.score(docs, pu_quality.train(docs, labels)).count() == docs.count()
    named = pu_quality.score(docs, pu_quality.train(docs, labels), ("h", "s", "p"))
    assert named.columns == [*docs.columns, "s", "h", "p"] and {r.score for r in named.collect()} == {0.1}
    empty = docs.limit(0)
    assert pu_quality.score(empty, pu_quality.train(empty, labels)).count() == 0


def test_licences(spark):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under the Foo Bar License": "unknown", "nothing of the kind": None,
        "GNU Lesser General Public License": None, "": None, "under this or that": None,
    }
    lines.pop("GNU Lesser General Public License")
    docs = [(k, "some words\n" + line + "\nmore words", "e") for k, line in enumerate(lines)] + [(90, None, "e"), (91, "word " * 30_000 + "license", "e")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string, licence_text string")).collect()}
    for k, want in enumerate(lines.values()):
        assert got[k].licence == want, (docs[k], got[k])
    assert got[90].licence is None and got[90].n_paragraphs == 0 and got[91].n_paragraphs == 1
    both = licenses.scan(spark.createDataFrame([(1, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.")], "doc_id long, text string")).first()
    assert both.licences == "cc-by-nc,mit" and both.n_confirmed == 2


WRAPPED = {
    "cc-by-sa": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "cc-by-nc": "This work is licensed under the Creative Commons\r\nAttribution-NonCommercial 4.0 International License.",
    "gpl-3.0": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.",
    "gpl-2.0": "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in the Software\nwithout restriction",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
}


def test_wrapped_and_distant_licences(spark):
    """A wrapped statement is one paragraph, a blank line ends it, and a statement inside very long prose is found whole."""
    prose = "the river and the hills were seen from afar by the people of the town "
    rows = [(name, kind, text) for name, t in WRAPPED.items() for kind, text in (("wrapped", t), ("prose", prose * 9 + t + " " + prose * 300))]
    rows.append(("bsd,mit", "two", prose + WRAPPED["mit"] + " " + prose * 9 + WRAPPED["bsd"]))
    got = licenses.scan(spark.createDataFrame(rows, "want string, kind string, text string")).collect()
    for r in got:
        assert (r.licences, r.n_paragraphs, r.n_unknown) == (r.want, 1, 0), r[:2]
    torn = licenses.scan(spark.createDataFrame([("Released under\n \t\nthe MIT License",)], "text string")).first()
    assert torn.n_paragraphs == 2


def test_licences_of_odd_rows(spark):
    text = WRAPPED["mit"]
    rows = [(None, text, 7), (1, text, 7), (1, text, 7), (2, None, 7), (3, "", 7), (4, " \n\n \t\n", 7), (5, "a" * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_paragraphs int").withColumn("licences", F.lit("mine")).withColumn("paragraph", F.lit(1))
    got = licenses.scan(docs).collect()
    assert sorted((r.doc_id or 0, r.licences, r.n_paragraphs, r.paragraph) for r in got) == [
        (0, "mit", 1, 1), (1, "mit", 1, 1), (1, "mit", 1, 1), (2, "", 0, 1), (3, "", 0, 1), (4, "", 0, 1), (5, "", 1, 1),
    ]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licence_scan_is_native(spark, sf):
    plan = licenses.op10_license_classifier(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
