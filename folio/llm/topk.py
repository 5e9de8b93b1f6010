"""Exact top-k inner products by MaxScore.

A vector is a document, a dimension with a weight a term, and shards of vectors are posting lists: a
shard keeps each dimension as one contiguous row. What a dimension adds to a score lies between two
bounds of the shard (the query's weight times the dimension's smallest and largest value), so every
term adds its lower bound for certain and at most the range above it. A query's terms are split by
these ranges: the terms whose ranges together can't lift a vector to the k-th best score so far are
non-essential. The essential postings are traversed in full; the rest are probed term by term, largest
range first, only for vectors that can still compete. Ties stay in the running, so the answer is exact.
Shards give k candidates for each query, and those are merged.

Queries are a stated set; they meet the shards in blocks of QUERY_BLOCK, so no task needs all of
either side. All arithmetic is in 64-bit integers.

Cases: rows whose id or vector is null, or whose vector holds a null or non-finite component, take no
part; vectors shorter than the longest one count as padded with zeros. Rows that share an id are the
same vector: the smallest by component order is used, and a query never meets its own id. Fewer
candidates than k give fewer rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import table

SHARD = 8192
QUERY_BLOCK = 1024
_BLOCK = "part long, ids binary, data binary, rows int, width int"


def clean(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part, one row for each id."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).filter(usable)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to `size` rows each: ids and a row-major integer matrix."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        data: list[np.ndarray] = []

        def out() -> pd.DataFrame:
            width = max(map(len, data))
            m = np.zeros((len(data), width), np.int64)
            for i, x in enumerate(data):
                m[i, : len(x)] = x
            key = hash((ids[0], ids[-1], len(ids)))
            return pd.DataFrame([(key, np.array(ids, np.int64).tobytes(), m.tobytes(), len(ids), width)], columns=["part", "ids", "data", "rows", "width"])

        for pdf in batches:
            for i, x in zip(pdf["id"], pdf["x"], strict=True):
                ids.append(i)
                data.append(np.asarray(x, np.int64))
                if len(ids) == size:
                    yield out()
                    ids, data = [], []
        if ids:
            yield out()

    return rows.mapInPandas(pack, _BLOCK)


def maxscore(shard: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the query's k best in the shard, best first. shard: (dimensions, vectors)."""
    low, high = np.minimum(query * shard.min(1), query * shard.max(1)), np.maximum(query * shard.min(1), query * shard.max(1))
    span = high - low
    order = np.argsort(-span, kind="stable")
    left = np.append(np.cumsum(span[order][::-1])[::-1], 0)  # left[m]: what terms m.. can still add above their lower bounds
    base = int(low.sum())
    # a first threshold: the k-th best exact score among those with the best partial score over the first terms
    m = max(1, min(4, len(order)))
    part = query[order[:m]] @ shard[order[:m]] - low[order[:m]].sum()
    alive = np.flatnonzero(ids != own)
    if len(alive) > k:
        probe = alive[np.argpartition(-part[alive], k - 1)[: 8 * k] if len(alive) > 8 * k else slice(None)]
        exact = np.sort(query @ shard[:, probe])
        bar = int(exact[-k]) - base
        # essential: the least number of leading terms such that the rest alone can't reach the bar
        essential = int(np.argmax(left <= bar)) if (left <= bar).any() else len(order)
        essential = max(m, min(essential, len(order)))
        if essential > m:
            part = part + query[order[m:essential]] @ shard[order[m:essential]] - low[order[m:essential]].sum()
        part, alive, at = part[alive], alive, essential
        while True:
            stay = part + left[at] >= bar
            part, alive = part[stay], alive[stay]
            if at >= len(order):
                break
            step = order[at : at + 4]
            part = part + (query[step] @ shard[np.ix_(step, alive)] - low[step].sum())
            at += len(step)
            if len(alive) > k:
                bar = max(bar, int(np.partition(part, len(part) - k)[-k]))  # lower bounds of scores
        scores = part + base
    else:
        scores = query @ shard[:, alive]
    best = np.lexsort((ids[alive], -scores))[:k]
    return ids[alive][best], scores[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """vectors and queries have (id, x array<long>), one row for each id; (query_id, rank, id, score)."""
    left = table(_packed(vectors, shard), "shards").withColumn("__one", F.lit(1))
    right = table(_packed(queries, block), "queries").select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("rows").alias("q_rows"), F.col("width").alias("q_width"), F.xxhash64("ids", "rows").alias("q_part"), F.lit(1).alias("__one"))
    # each shard meets each block of queries once; rows here are blocks, never vectors
    numbers = right.select("q_part")
    met = left.join(numbers.withColumn("__one", F.lit(1)), "__one").drop("__one").join(right.drop("__one"), "q_part")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ids, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                width = max(r.width, r.q_width)
                a = np.zeros((width, r.rows), np.int64)
                a[: r.width] = np.frombuffer(r.data, np.int64).reshape(r.rows, r.width).T
                q = np.zeros((r.q_rows, width), np.int64)
                q[:, : r.q_width] = np.frombuffer(r.q_data, np.int64).reshape(r.q_rows, r.q_width)
                found = [maxscore(a, ids, x, own, k) for x, own in zip(q, q_ids, strict=True)]
                yield pd.DataFrame({"query_id": np.repeat(q_ids, [len(i) for i, _ in found]), "id": np.concatenate([i for i, _ in found]), "score": np.concatenate([s for _, s in found])})

    few = met.mapInPandas(search, "query_id long, id long, score long")
    # merge: the k best of all shards; each shard gave k rows for a query at most
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k)
    merged = few.groupBy("query_id").agg(best.alias("b")).select("query_id", F.posexplode("b").alias("p", "b"))
    return merged.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.id").alias("id"), (-F.col("b.s")).alias("score"))


def op8_maxscore(spark, sf_dir: str) -> DataFrame:
    vectors = clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    whole = table(vectors.select("id", F.transform("v", lambda x: F.floor(x * 256)).alias("x")), "vectors")
    found = top_k(whole, whole.filter("id % 50 = 0"), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
