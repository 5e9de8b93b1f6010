"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled 1; unlabelled are rows of the corpus itself, of which some part is
good. That part, the class prior, is estimated by the best-bin rule: a first classifier of positives
against unlabelled ranks rows it was not trained on, and the prior is the least ratio, over score
thresholds, of the unlabelled share above the threshold to the positives' share (each with its
confidence term). The model then minimises the non-negative unbiased risk
    prior * R(positives, +) + max(0, R(unlabelled, -) - prior * R(positives, -))
with the logistic loss; where the second term falls below 0, the step climbs it instead. Negative labels
are never read.

A score comes from the text alone: shares of kinds of characters, of repeated, shouted, symbol-ridden
and joined words and lines, lengths and entropies. The model is linear in these and their squares.

Bounds: at most POSITIVES and UNLABELLED rows are fitted, chosen by the smallest hash of doc_id; scoring
covers all rows and is a map. The samples' ids are the only broadcast.

Cases: null and empty texts get the features of an empty text, and so a score like any other. Null
doc_ids are scored but never fitted; for held_out they count as the text "". Labels of unknown
documents, null or doubled labels don't matter (a document is positive if any of its labels is 1).
Without a positive in the fitting part every score is 0.5. Repeated rows score alike; an empty table
gives an empty result. Further columns are kept by score(); those that have the name of a result are replaced, so
whoever needs them passes other names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import small_batches

POSITIVES = 8_000
UNLABELLED = 16_000
FOLDS = 3
HELD_OUT = 1
STEPS = 600
RATE = 0.05
DECAY = 1e-3
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = (text or "").split()
    m = max(1, len(words))
    lines = [x for x in (text or "").split("\n") if x]
    k = max(1, len(lines))
    share = c / n
    used = share[share > 0]
    different = set(words)
    follow = sum(map(str.__eq__, words, words[1:]))
    upper = sum(map(str.isupper, words))
    plain = sum(map(str.isalpha, words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    tail = sum(1 for w in words if not w[-1].isalnum())
    bad = [share[b] for b in _PUNCT]
    common = c[97:123].max() / n
    return np.array(
        [
            c[97:123].sum() / n, c[65:91].sum() / n, c[48:58].sum() / n, c[128:].sum() / n, share[32], share[10],
            sum(bad), *bad,
            np.log1p(len(raw)) / 10, np.log1p(len(words)) / 10,
            len(different) / m, np.log1p(len(different)) / np.log1p(m + 1), follow / m, upper / m, plain / m, tail / m,
            lengths.mean() / 10, lengths.std() / 10, np.log1p(lengths.max()) / 10,
            len(set(lines)) / k, np.log1p(m / k) / 10,
            -(used * np.log2(used)).sum() / 8 if len(used) else 0.0, common,
        ],
        np.float32,
    )


def bucket(doc_id: str) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


class Model:
    """Standardised features and their squares, a weight for each, and an offset."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z / 6, np.ones((len(z), 1))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x.astype(np.float64)) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk(w: np.ndarray, zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """prior * R(positives, +); R(unlabelled, -) - prior * R(positives, -); and the gradients of both."""
    fp, fu = zp @ w, zu @ w
    r_pos = prior * np.logaddexp(0, -fp).mean()
    r_neg = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    # d/df of log(1 + e^-f) is -s(-f); of log(1 + e^f) it is s(f)
    g_pos = -(prior * zp.T @ _sigmoid(-fp)) / len(zp)
    g_neg = zu.T @ _sigmoid(fu) / len(zu) - prior * (zp.T @ _sigmoid(fp)) / len(zp)
    return r_pos, r_neg, g_pos, g_neg


def fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """Minimises the non-negative risk by Adam over all rows at once. prior 0 < prior < 1."""
    both = np.vstack([p, u]).astype(np.float64)
    scale = both.std(0)
    model = Model(both.mean(0), np.where(scale > 1e-9, scale, 1.0), np.zeros(2 * both.shape[1] + 1))
    zp, zu = model.expand(p.astype(np.float64)), model.expand(u.astype(np.float64))
    w, a, b = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    keep = np.ones_like(w)
    keep[-1] = 0
    for t in range(1, steps + 1):
        _, r_neg, g_pos, g_neg = risk(w, zp, zu, prior)
        g = (g_pos + g_neg if r_neg >= 0 else -g_neg) + DECAY * keep * w
        a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
        w = w - RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    model.weights = w
    return model


def estimate_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Best-bin estimate on rows that the ranking classifier has not seen."""
    a, b = fit(p[::2], u[::2], 0.5, STEPS // 2), (p[1::2], u[1::2])
    sp, su = np.sort(a.logits(b[0])), np.sort(a.logits(b[1]))
    if not len(sp) or not len(su):
        return 0.5
    at = np.unique(sp)
    above = lambda s: 1 - np.searchsorted(s, at, side="left") / len(s)
    wide = lambda s: np.sqrt(np.log(4 / delta) / 2 / len(s))
    qp, qu = above(sp), above(su)
    ratio = np.where(qp > 0.05, (qu + wide(su) + wide(sp)) / np.maximum(qp, 1e-9), np.inf)
    best = int(np.argmin(ratio))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.02, 0.98))


def _matrix(docs: DataFrame, ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and features of the sampled rows, at most POSITIVES + UNLABELLED, in order of ids."""
    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "x": [features(t).tobytes() for t in pdf["text"]]})

    # one row for each id before anything is collected; of ids that repeat, the least features
    got = rows.mapInPandas(run, "doc_id long, x binary").groupBy("doc_id").agg(F.min("x").alias("x")).toPandas().sort_values("doc_id")
    return got["doc_id"].to_numpy(np.int64), np.stack([np.frombuffer(x, np.float32) for x in got["x"]]) if len(got) else np.zeros((0, len(features(""))), np.float32)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Fits on rows that are not held out. docs needs doc_id and text; labels doc_id and quality."""
    first = lambda d, n: d.filter("doc_id IS NOT NULL").filter(bucket("doc_id") != HELD_OUT).select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(n)
    pos = {r[0] for r in first(labels.filter("quality = 1"), positives).collect()}
    web = {r[0] for r in first(docs, unlabelled).collect()}
    if not pos or not web:
        return None
    ids, x = _matrix(docs, docs.sparkSession.createDataFrame([(i,) for i in sorted(pos | web)], "doc_id long"))
    is_p, is_u = np.isin(ids, list(pos)), np.isin(ids, list(web))
    if is_p.sum() < 4 or is_u.sum() < 4:
        return None
    rng = np.random.default_rng(7)
    p, u = rng.permutation(x[is_p]), rng.permutation(x[is_u])
    return fit(p, u, estimate_prior(p, u))


def score(docs: DataFrame, model: Model | None, names: tuple[str, str, str] = ("held_out", "score", "predicted")) -> DataFrame:
    """Adds held_out, score and predicted, or what `names` calls them."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = shared.value
        if m is None or not len(texts):
            return pd.Series([0.5] * len(texts), dtype="float64")
        return pd.Series(m.scores(np.stack([features(t) for t in texts])))

    held, made, predicted = names
    out = docs.withColumns({made: run("text"), held: bucket("doc_id") == HELD_OUT})
    return out.withColumn(predicted, F.when(F.col(made) >= 0.5, 1).otherwise(0))


def op2_pu_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score(docs, train(docs, labels)).select("doc_id", "held_out", "score", "predicted")
