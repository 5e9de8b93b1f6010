"""Licence scan with DataFrame functions alone: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of lines that ends at a blank line or after a line with a stop, so a statement that is wrapped is
read whole. It is scored in windows of WINDOW words, a new one every STEP words. A window's features are the different
words and word pairs in it; a multinomial logistic regression over these gives the odds of each licence family, of a licence that belongs to none of them
(`unknown`) and of no licence (`none`). The model is fitted on the driver when it is first needed, from the
statements below and variations of them, by plain gradient descent: the same weights every time. A
temperature, fitted on folds that were left out, calibrates the odds. Weights are whole numbers of 1/SCALE,
so sums don't depend on their order.

A predicted family is confirmed if the window holds enough of the word triples of one of the family's
templates; a prediction that isn't confirmed, or whose probability is under SURE, counts as unknown. Windows overlap, so one
counts as a statement only if neither neighbour says something better: confirmed before unknown, then the likelier, then the
smaller name, then the earlier.

A window without any sign, that is a word which by its own weight speaks for a licence and isn't in COMMON, is
`none` by rule; one regular expression, made from the model, finds the paragraphs that hold one. All of it is a projection over the
documents: nothing is shuffled or grouped, so skew doesn't matter.

Cases: null, empty and blank texts have no paragraphs and no licence. All windows of very long paragraphs are scored. A text's
licence is that of its best statement, in the order above. Columns named like results are replaced. Each row of
the input gives one row; null ids, repeated rows and further columns don't matter. An empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
SURE = 0.5
CONFIRM = 0.6
STEPS = 400
WINDOW, STEP = 64, 32
_BLANK = "[^ \\t\\r\\n]"
_STOP = r"([.!?:;])[ \t\r]*\n"
_GAP = r"\n[ \t\r\n]*\n"
UNKNOWN, NONE = "unknown", "none"

#: Statements of each family.
TEMPLATES = {
    "agpl-3.0": ("licensed under the gnu affero general public license version 3", "gnu affero general public license", "licensed under the agpl 3.0"),
    "apache-2.0": ("licensed under the apache license version 2.0", "released under the apache license 2.0", "you may not use this file except in compliance with the license", "distributed under the apache 2.0 license"),
    "bsd": ("licensed under the bsd license", "released under the bsd 3 clause license", "redistribution and use in source and binary forms with or without modification are permitted", "distributed under the terms of the bsd 2 clause license"),
    "cc-by": ("licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license", "this work is licensed under creative commons attribution 3.0"),
    "cc-by-nc": ("licensed under cc by nc 4.0", "licensed under a creative commons attribution noncommercial 4.0 license", "licensed under a creative commons attribution noncommercial 4.0 international license", "creative commons attribution non commercial license"),
    "cc-by-nd": ("licensed under cc by nd 4.0", "licensed under a creative commons attribution noderivatives 4.0 license", "licensed under a creative commons attribution noderivatives 4.0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4.0", "licensed under a creative commons attribution sharealike 4.0 license", "licensed under a creative commons attribution sharealike 4.0 international license", "text is available under the creative commons attribution share alike license"),
    "cc0": ("released under cc0 1.0", "dedicated to the public domain under cc0", "creative commons zero public domain dedication", "this work is in the public domain"),
    "gpl-2.0": ("licensed under the gnu general public license version 2", "released under the gpl 2.0", "under the terms of the gnu general public license version 2"),
    "gpl-3.0": ("licensed under the gnu general public license version 3", "released under the gpl 3.0", "licensed under the gplv3", "under the terms of the gnu general public license version 3"),
    "isc": ("licensed under the isc license", "released under the isc license"),
    "lgpl": ("licensed under the gnu lesser general public license", "released under the lgpl 2.1", "under the terms of the gnu lesser general public license version 3"),
    "mit": ("released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software", "distributed under the terms of the mit license"),
    "mpl-2.0": ("subject to the terms of the mozilla public license version 2.0", "licensed under the mozilla public license 2.0", "released under the mpl 2.0"),
}
OTHER = (
    "licensed under the example community license", "released under a custom license", "all rights reserved", "copyright 2019 by the authors all rights reserved",
    "this document is proprietary and confidential", "licensed under the vendor source license version 1", "see the license file for details", "subject to the license agreement",
    "use is governed by the license terms", "licensed for evaluation only", "released under the terms of a commercial license", "the license of this work is not known", "licensed under the terms below",
)
PLAIN = (
    "the driver showed a license at the border", "he renewed the driving license last year", "the plate number and the license were checked", "the committee agreed on version 2 of the plan",
    "this work is about the history of the region", "the public library opened a general section", "released in the spring of that year", "the software was tested under load",
    "permission to enter was granted at the gate", "the terms of the contract were read aloud", "the creative writing class met on monday", "commons and fields lie to the north",
    "the apache people lived in the plains", "the gnu is an animal of the savanna", "students of mit built a small car", "under the bridge the water was cold", "the meeting was held in the general hall",
    "a copy of the letter was sent to any person who asked", "the new version of the song is longer", "source and binary numbers are used in class", "the attribution of the painting is in doubt", "a domain is a part of a kingdom",
    "the house stands by the sea", "the price is 4 and the size is 2", "free of charge on sundays", "this is a plain line of text and nothing more", "they may not use the side door", "the file was kept in the office",
)
#: Words that say too little alone to make a line worth scoring.
COMMON = frozenset("all and any are available below document dedication except example for forms known may not note only or share subject the this to under use with without you zero".split())
_EDGES = (("", ""), ("this work is", ""), ("", "see the file for details"), ("copyright 2020 the authors", ""), ("this project is", "unless stated otherwise"), ("the code in this folder is", ""), ("note", ""))


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def grams_of(words: list[str]) -> list[str]:
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]))


def _training() -> list[tuple[list[str], str, int]]:
    """(grams, class, fold)."""
    rows = []
    for family, texts in TEMPLATES.items():
        for i, t in enumerate(texts):
            rows += [(grams_of(words_of(f"{a} {t} {b}")), family, i) for a, b in _EDGES]
    for i, t in enumerate(OTHER):
        rows += [(grams_of(words_of(f"{a} {t} {b}")), UNKNOWN, i) for a, b in _EDGES[:4]]
    for i, t in enumerate(PLAIN):
        rows += [(grams_of(words_of(f"{a} {t} {b}")), NONE, i) for a, b in _EDGES[:4]]
        rows.append((grams_of(words_of(t)[::-1]), NONE, i))
    rows += [([w], NONE, i) for i, w in enumerate(["license", "version", "under", "the", "public", "general", "work", "this", "is", "apache", "mit", "gnu", "cc", "by", "4", "0"])]
    return rows


def _fit(rows: list[tuple[list[str], str, int]], vocab: dict[str, int], names: list[str]) -> np.ndarray:
    """Weights (grams and, last, the offset) x classes."""
    x = np.zeros((len(rows), len(vocab) + 1))
    y = np.zeros((len(rows), len(names)))
    for i, (grams, name, _) in enumerate(rows):
        x[i, [vocab[g] for g in grams if g in vocab]] = 1
        x[i, -1] = y[i, names.index(name)] = 1
    weight = 1 / y.sum(0)[y.argmax(1)]
    weight[y[:, names.index(NONE)] == 1] *= 4
    weight /= weight.sum()
    w = np.zeros((x.shape[1], len(names)))
    speed = np.zeros_like(w)
    for _ in range(STEPS):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 2.0 * (x.T @ ((p - y) * weight[:, None]) + 2e-4 * w)
        w += speed
    return w


def _odds(w: np.ndarray, vocab: dict[str, int], rows: list) -> np.ndarray:
    return np.stack([w[[*(vocab[g] for g in grams if g in vocab), len(vocab)]].sum(0) for grams, _, _ in rows])


@functools.cache
def model() -> dict:
    """names, weights {gram: [whole numbers]}, offset, temperature, signs (words that any licence has one of)."""
    rows = _training()
    names = [*sorted(TEMPLATES), UNKNOWN, NONE]
    vocab = {g: i for i, g in enumerate(sorted({g for grams, _, _ in rows for g in grams}))}
    w = _fit(rows, vocab, names)
    # the temperature that makes left-out folds likeliest
    z, y = [], []
    for fold in range(3):
        test = [r for r in rows if r[2] % 3 == fold]
        z.append(_odds(_fit([r for r in rows if r[2] % 3 != fold], vocab, names), vocab, test))
        y += [names.index(r[1]) for r in test]
    z, y = np.concatenate(z), np.array(y)

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(y)), y]).mean())

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    whole = np.rint(w / temperature * SCALE).astype(int)
    # a sign: a word that lifts some licence class over none; without signs, a paragraph is none
    lift = whole[:-1].max(1) - whole[:-1, names.index(NONE)]
    signs = sorted({x for g, i in vocab.items() if lift[i] > 0.35 * SCALE for x in [max(g.split(), key=lambda s: lift[vocab[s]])] if len(x) > 1 and not x.isdigit() and x not in COMMON and lift[vocab[x]] > 0.35 * SCALE})
    return {"names": names, "weights": {g: whole[i].tolist() for g, i in vocab.items()}, "offset": whole[-1].tolist(), "temperature": temperature, "signs": signs}


def _triples(words: list[str]) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))))


@functools.cache
def template_triples() -> list[tuple[str, list[str]]]:
    return [(family, _triples(words_of(t))) for family in sorted(TEMPLATES) for t in TEMPLATES[family]]


def sign_pattern() -> str:
    return "(?i)(?:^|[^a-z0-9])(?:" + "|".join(model()["signs"]) + ")(?:[^a-z0-9]|$)"


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def paragraphs(text: str) -> Column:
    """Runs of lines up to a blank line or a line that ends with a stop."""
    parted = F.regexp_replace(F.coalesce(text, F.lit("")), _STOP, "$1\n\n")
    return F.filter(F.split(parted, _GAP), lambda x: x.rlike(_BLANK))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_paragraphs, licence (of the likeliest statement, null without any), probability, n_confirmed, n_unknown (of
    statements), and licences, all families that were confirmed, joined by commas."""
    m = model()
    names, n = m["names"], len(m["names"])
    none = n - 1
    vocab = _constant(list(m["weights"]), "array<string>")
    weights = _constant(m["weights"], "map<string,array<int>>")
    signs = _constant(m["signs"], "array<string>")
    word_list = lambda x: F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda w: w != "")
    pairs = lambda w, k: F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.concat_ws(" ", F.slice(w, i, k)))).otherwise(F.array().cast("array<string>"))
    total = lambda ws, c: F.aggregate(ws, F.lit(m["offset"][c]), lambda a, w: a + w[c])
    logits = lambda ws: F.array(*[total(ws, c) for c in range(n)])

    # the steps of one window, each bound to a name by a one-element array
    def step(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    def judge(w: Column) -> Column:
        triples = F.when(F.size(w) >= 3, pairs(w, 3)).otherwise(F.array(F.concat_ws(" ", w)))
        hits = F.transform(F.array_intersect(vocab, F.concat(w, pairs(w, 2))), lambda g: weights[g])
        return step(hits, lambda h: step(logits(h), lambda z: step(F.array_max(z), lambda top: step(F.array_position(z, top).cast("int") - 1, lambda best: step(triples, lambda t: F.struct(
            best.alias("best"),
            F.round(F.lit(1.0) / F.aggregate(z, F.lit(0.0), lambda a, v: a + F.exp((v - top) / F.lit(float(SCALE)))), 6).alias("p"),
            F.element_at(F.array(*[F.greatest(*[F.size(F.array_intersect(_constant(x, "array<string>"), t)) / F.lit(float(len(x))) for g, x in template_triples() if g == f], F.lit(0.0)) for f in sorted(TEMPLATES)], F.lit(0.0), F.lit(0.0)), best + 1).alias("held"),
        ))))))

    sure = lambda r: (r["best"] < n - 2) & (r["p"] >= SURE) & (r["held"] >= CONFIRM)
    named = lambda r: F.when(r["best"] != none, F.struct(F.when(sure(r), 0).otherwise(1).alias("rank"), (-r["p"]).alias("p"), F.when(sure(r), _constant(names, "array<string>")[r["best"]]).otherwise(F.lit(UNKNOWN)).alias("name")))
    windows = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((F.size(w) - WINDOW) / F.lit(STEP)).cast("int"), F.lit(0))), lambda k: F.slice(w, k * STEP + 1, WINDOW))
    said = lambda w: F.transform(windows(w), lambda x: F.when(F.arrays_overlap(x, signs), step(judge(x), named)))

    def best_of_neighbours(found: Column) -> Column:
        before = lambda r, i: F.coalesce(r < F.get(found, i - 1), F.lit(True))
        after = lambda r, i: F.coalesce(r <= F.get(found, i + 1), F.lit(True))
        return F.filter(found, lambda r, i: r.isNotNull() & before(r, i) & after(r, i))

    signed = F.filter(F.col("__paragraphs"), lambda x: x.rlike(sign_pattern()))
    found = F.flatten(F.transform(signed, lambda x: step(step(word_list(x), said), best_of_neighbours)))
    top = F.array_min(F.col("__named"))
    return (
        docs.withColumn("__paragraphs", paragraphs(text))
        .withColumn("n_paragraphs", F.size("__paragraphs"))
        .withColumn("__named", found)
        .withColumn("licence", top["name"])
        .withColumn("probability", -top["p"])
        .withColumn("n_confirmed", F.size(F.filter("__named", lambda r: r["rank"] == 0)))
        .withColumn("n_unknown", F.size(F.filter("__named", lambda r: r["rank"] == 1)))
        .withColumn("licences", F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("__named", lambda r: r["rank"] == 0), lambda r: r["name"]))), ","))
        .drop("__paragraphs", "__named")
    )


def op10_license_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "n_paragraphs", "licence", "probability", "n_confirmed", "n_unknown", "licences")


def oracle() -> str:
    m = model()
    names, n = m["names"], len(m["names"])
    q = lambda s: "'" + s.replace("'", "''") + "'"
    weights = ", ".join(f"({q(g)}, {list(w)})" for g, w in m["weights"].items())
    triples = ", ".join(f"({i}, {q(f)}, {q(t)}, {len(ts)})" for i, (f, ts) in enumerate(template_triples()) for t in ts)
    z = ", ".join(f"CAST({m['offset'][c]} + coalesce(sum(w[{c + 1}]), 0) AS BIGINT)" for c in range(n))
    pattern = sign_pattern().replace("(?i)", "")
    return f"""
WITH wt(g, w) AS (VALUES {weights}), tp(i, family, t, n) AS (VALUES {triples}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), {q(_STOP)}, '\\1' || chr(10) || chr(10), 'g'), {q(_GAP)}), lambda x: regexp_matches(x, {q(_BLANK)})) AS blocks FROM documents),
l AS (SELECT rid, unnest(range(1, len(blocks) + 1)) AS pos, unnest(blocks) AS block FROM d),
e AS (SELECT rid, pos, list_filter(string_split_regex(lower(block), '[^a-z0-9]+'), lambda x: x <> '') AS ws FROM l WHERE regexp_matches(block, {q(pattern)}, 'i')),
v AS (SELECT rid, pos, k, ws[k * {STEP} + 1 : k * {STEP} + {WINDOW}] AS ws FROM (SELECT rid, pos, ws, unnest(range(0, 1 + greatest(0, (len(ws) - {WINDOW} + {STEP - 1}) // {STEP}))) AS k FROM e)),
c AS (SELECT * FROM v WHERE list_has_any(ws, {m["signs"]})),
g AS (SELECT DISTINCT rid, pos, k, g FROM (
   SELECT rid, pos, k, unnest(ws) AS g FROM c UNION ALL
   SELECT rid, pos, k, array_to_string(ws[i : i + 1], ' ') FROM (SELECT rid, pos, k, ws, unnest(range(1, len(ws))) AS i FROM c))),
z AS (SELECT c.rid, c.pos, c.k, [{z}] AS z FROM c LEFT JOIN g ON g.rid = c.rid AND g.pos = c.pos AND g.k = c.k LEFT JOIN wt ON wt.g = g.g GROUP BY c.rid, c.pos, c.k),
b AS (SELECT rid, pos, k, list_position(z, list_max(z)) - 1 AS best, round(1.0 / list_sum(list_transform(z, lambda v: exp((v - list_max(z)) / {float(SCALE)}::DOUBLE))), 6) AS p FROM z),
t AS (SELECT DISTINCT rid, pos, k, CASE WHEN len(ws) >= 3 THEN array_to_string(ws[i : i + 2], ' ') ELSE array_to_string(ws, ' ') END AS t
      FROM (SELECT rid, pos, k, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM c)),
h AS (SELECT rid, pos, k, family, max(held) AS held FROM (SELECT rid, pos, k, i, family, count(*) / CAST(any_value(n) AS DOUBLE) AS held FROM t JOIN tp ON tp.t = t.t GROUP BY ALL) GROUP BY ALL),
f AS (SELECT b.rid, b.pos, b.k, b.p, CASE WHEN best < {n - 2} AND b.p >= {SURE} AND coalesce(h.held, 0) >= {CONFIRM} THEN 0 ELSE 1 END AS rk, [{", ".join(map(q, names))}][best + 1] AS nm
      FROM b LEFT JOIN h ON h.rid = b.rid AND h.pos = b.pos AND h.k = b.k AND h.family = [{", ".join(map(q, names))}][best + 1] WHERE best <> {n - 1}),
r AS (SELECT rid, pos, k, {{'rk': rk, 'p': -p, 'nm': CASE WHEN rk = 0 THEN nm ELSE 'unknown' END}} AS r FROM f),
s AS (SELECT x.rid, x.r FROM r x LEFT JOIN r y ON y.rid = x.rid AND y.pos = x.pos AND y.k = x.k - 1 LEFT JOIN r w ON w.rid = x.rid AND w.pos = x.pos AND w.k = x.k + 1
      WHERE (y.rid IS NULL OR x.r < y.r) AND (w.rid IS NULL OR x.r <= w.r)),
a AS (SELECT rid, min(r) AS top, count(*) FILTER (WHERE r.rk = 0) AS ok, count(*) FILTER (WHERE r.rk = 1) AS un,
      array_to_string(list_sort(list_distinct(list(r.nm) FILTER (WHERE r.rk = 0))), ',') AS fams FROM s GROUP BY rid)
SELECT doc_id, CAST(len(blocks) AS INTEGER) AS n_paragraphs, top.nm AS licence, -top.p AS probability, CAST(coalesce(ok, 0) AS INTEGER) AS n_confirmed,
  CAST(coalesce(un, 0) AS INTEGER) AS n_unknown, coalesce(fams, '') AS licences
FROM d LEFT JOIN a ON a.rid = d.rid
"""
