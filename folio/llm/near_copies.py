"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Documents are sets of five-word shingles; a word is a run of bytes other than ASCII white space, and a
text of fewer words is one shingle of all of them. Two documents are linked if the Jaccard similarity of
their sets is 0.8 or more.

1. Every document gets 128 minima, read as 16 trees with labels of 8. Documents of one set are one text
   from here on, with a count.
2. Within each tree, labels that share a prefix are a subtree. Matching starts from whole labels. The
   similarities of the pairs that meet tell, with the chance that a pair of such similarity meets at this length,
   which share of all pairs of at least the threshold has met so far and would meet at shorter prefixes (one more
   pair, just at the threshold, is supposed to be there unseen). The prefix is shortened to the greatest
   length at which that share reaches RECALL, and the estimate made again there, until it does.
   Subtrees of that length are dealt out. In a subtree, sorted labels are walked from the
   longest shared prefix to the shortest. At each length, members of a run are compared by their
   whole signatures (of 8-bit minima): one that is closer than ABSORB to a pivot is spoken for by it, the
   others become pivots and are compared with all pivots. Signature distance is a metric, so links that
   lie within LOOSE of each other are never lost this way, and a run of near copies costs its members times
   its pivots. LOOSE leaves a pair at the threshold with an absorbed end more than three standard deviations.
3. Links join texts into loose clusters. Shingles of clustered texts only are then compared exactly, all
   against all within a cluster: by products of incidence matrices over the shingles that occur twice. A
   cluster of more than BLOCK texts is cut into blocks, and pairs of blocks are spread over tasks. What leaves a
   task is one count for each text and a spanning forest, never pairs.

The result has one row for each document: class_id, the smallest doc_id that links reach, and n_links, how
many other documents are linked to it directly, copies included.

Skew: a set that thousands of documents share is counted before the shuffle; subtrees of more than SUBTREE
texts are cut into block pairs like clusters. The membership filter that spares unclustered texts a second
shuffle has a fixed number of slots.

Cases: null texts and texts without words link with nothing. Rows with equal doc_ids count as one document
and share a class. Rows with a null doc_id link with nothing, have a null class_id and count towards no one's
links. Repeated rows are repeated in the result. Texts may be of any length; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import Sets, block_pairs, bounds, connected_components, local_roots, small_batches, split_by_slots, table, trim, whole_groups

WORDS = 5
SIMILARITY = 0.8
TREES = 16
LABEL = 8
RECALL = 0.999
#: Shares of the signature: texts closer than LOOSE may be linked, texts closer than ABSORB have one pivot.
LOOSE = 0.42
ABSORB = 0.08
SUBTREE = 4096
BLOCK = 512
#: Bytes of text that are shingled at once.
CHUNK = 500_000
#: Pairs that seem less similar than the threshold by up to so much count as pairs at it.
NOISE = 0.04


def met(similarity: float, depth: int, trees: int = TREES) -> float:
    """The chance that a pair meets in some tree at this length of the prefix."""
    return 1 - (1 - similarity**depth) ** trees


def recall_at(pairs: dict[float, int], seen: int, depth: int, similarity: float = SIMILARITY) -> float:
    """The share of pairs at the threshold or above that meet at `depth`, from the number of pairs of each similarity
    that met at `seen`."""
    pairs = {similarity: 1.0} | {s: float(n) for s, n in pairs.items() if s > similarity} | {similarity: 1.0 + sum(n for s, n in pairs.items() if similarity - NOISE <= s <= similarity)}
    there = {s: n / met(s, seen) for s, n in pairs.items()}
    return sum(n * met(s, depth) for s, n in there.items()) / sum(there.values())


def next_depth(pairs: dict[float, int], seen: int, recall: float = RECALL, similarity: float = SIMILARITY) -> int:
    """`seen`, if the target is reached there, else the greatest shorter length at which it is."""
    return next((d for d in range(seen, 0, -1) if recall_at(pairs, seen, d, similarity) >= recall), 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each document). data: the bytes of all documents, each followed by a
    blank; docs: where each begins, and the end."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    # a word's hash: the sum of its bytes' hashes by place, so one pass over all bytes will do
    begin = ~space
    begin[1:] &= space[:-1]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(docs), np.int64)
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    place = np.arange(len(data), dtype=np.int64)
    word = np.cumsum(begin) - 1
    place -= starts[np.maximum(word, 0)]
    value = _mix(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)))
    value[space] = 0
    out = _mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))
    return out, np.searchsorted(starts, docs)


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different shingle hashes of all texts put together, where each text's begin, and the end)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    docs = np.append(0, np.cumsum([len(r) + 1 for r in raw])).astype(np.int64)
    h, at = word_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8), docs)
    counts = np.diff(at)
    n = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), n)
    first = np.repeat(at[:-1], n) + np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(n))[:-1], n)
    size = np.minimum(words, counts)[owner]
    value = np.zeros(len(owner), np.uint64)
    for k in range(words):
        use = k < size
        value[use] = _mix(value[use] * np.uint64(3) + h[first[use] + k] + np.uint64(k + 1))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[keep], value[keep]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signatures(value: np.ndarray, at: np.ndarray, n: int = TREES * LABEL) -> np.ndarray:
    """n minima for each text that has shingles."""
    short = (value >> np.uint64(32)).astype(np.uint32)
    a, b = _coefficients(n)
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), n), np.uint32)
    for i in range(n if len(starts) else 0):
        x = short * a[i] + b[i]
        x ^= x >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(x, starts)
    return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j] or "") <= CHUNK):
            n += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _set_key(value: np.ndarray) -> bytes:
    return hashlib.md5(value.tobytes(), usedforsecurity=False).digest()


def sketch(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, set_key, labels): a key of the shingle set, and the labels of all trees, 4 bytes for each minimum."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            ids = pd.array(pdf["doc_id"].to_numpy(np.int64), "Int64")
            ids[pdf["none"].to_numpy(bool)] = pd.NA
            for i, j in _chunks(texts):
                value, at = shingles([t or "" for t in texts[i:j]], words)
                sig = signatures(value, at)
                rows, r = [], 0
                for k in range(j - i):
                    if at[k + 1] > at[k]:
                        rows.append((_set_key(value[at[k] : at[k + 1]]), sig[r].tobytes()))
                        r += 1
                    else:
                        rows.append((None, None))
                out = pd.DataFrame(rows, columns=["set_key", "labels"], dtype=object)
                out.insert(0, "doc_id", ids[i:j])
                yield out
        trim()

    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    return docs.select(known.alias("doc_id"), F.col("doc_id").isNull().alias("none"), "text").mapInPandas(run, "doc_id long, set_key binary, labels binary")


def prefix_keys(texts: DataFrame, depth: int) -> DataFrame:
    """(rep, tree, key): the prefixes of each text's labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            tree = np.frombuffer(b"".join(pdf["labels"]), np.uint32).reshape(-1, TREES, LABEL).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), tree.shape[:2]).copy()
            for k in range(depth):
                key = _mix(key * np.uint64(31) + tree[:, :, k])
            yield pd.DataFrame({"rep": np.repeat(pdf["rep"].to_numpy(np.int64), TREES), "tree": np.tile(np.arange(TREES, dtype=np.int32), len(pdf)), "key": key.view(np.int64).ravel()})

    return texts.select("rep", "labels").mapInPandas(run, "rep long, tree int, key long")


def _subtree_links(label: np.ndarray, sig: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Links within a subtree: label (members, LABEL) of its tree, sig (members, 128). From the longest
    shared prefix to the subtree's own."""
    order = np.lexsort(label.T[::-1])
    links: list[tuple[int, int]] = []
    alive = order  # pivots still to be compared, in the order of the trie
    for length in range(label.shape[1], depth - 1, -1):
        runs = bounds(*(label[alive, k] for k in range(length)))
        if len(runs) - 1 == len(alive):
            continue
        left = []
        for a, b in zip(runs[:-1], runs[1:], strict=True):
            rest = alive[a:b]
            if len(rest) == 1:
                left.append(rest)
                continue
            pivots = []
            while len(rest):
                p, rest = rest[0], rest[1:]
                pivots.append(p)
                if not len(rest):
                    break
                far = (sig[rest] != sig[p]).mean(1)
                links += [(p, q) for q in rest[far <= LOOSE]]
                rest = rest[far > ABSORB]
            left.append(np.array(pivots))
        alive = np.concatenate(left)
    return links


def loose_links(texts: DataFrame, depth: int) -> DataFrame:
    """(a, b, near) for texts that may be near and how near they seem: texts has (rep, labels)."""
    rows = prefix_keys(texts, depth)
    several = rows.groupBy("tree", "key").agg(F.count("*").alias("n")).filter("n > 1")
    meeting = table(rows.join(several, ["tree", "key"]), "subtrees")
    dealt = block_pairs(meeting.join(texts.select("rep", "labels"), "rep"), "n", "rep", SUBTREE)
    dealt = dealt.repartition("key", "__i", "__j").sortWithinPartitions("tree", "key", "__i", "__j", "rep")
    keys = ["tree", "key", "__i", "__j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys, 5_000):
            rep = pdf["rep"].to_numpy(np.int64)
            whole = np.frombuffer(b"".join(pdf["labels"]), np.uint32).reshape(len(pdf), -1)
            sig = whole.astype(np.uint8)  # the low bytes
            tree = pdf["tree"].to_numpy(np.int64)
            cut = bounds(*(pdf[k].to_numpy() for k in keys))
            size = np.diff(cut)
            # pairs, by far the most groups, all at once
            two = cut[:-1][size == 2]
            a, b = [two], [two + 1]
            found = Sets(len(pdf))
            for s, e in zip(cut[:-1][size > 2], cut[1:][size > 2], strict=True):
                t = tree[s] * LABEL
                for i, j in _subtree_links(whole[s:e, t : t + LABEL], sig[s:e], depth):
                    found.join(s + int(i), s + int(j))
                up = found.roots()
                i = np.arange(s, e)
                i = i[up[i] != i]
                a.append(up[i])
                b.append(i)
            a, b = np.concatenate(a), np.concatenate(b)
            near = (sig[a] == sig[b]).mean(1)
            keep = (near >= 1 - LOOSE) | ~np.isin(a, two)  # what a chain of links ties together stays
            if keep.any():
                yield pd.DataFrame({"a": rep[a[keep]], "b": rep[b[keep]], "near": near[keep]}).drop_duplicates()

    return dealt.select(*keys, "rep", "labels").mapInPandas(run, "a long, b long, near double")


def forest_links(texts: DataFrame, recall: float = RECALL, similarity: float = SIMILARITY) -> DataFrame:
    """loose_links() at the prefix length that reaches the recall."""
    depth = LABEL
    while True:
        links = table(loose_links(texts, depth), "links")
        # at most one row for each number of equal minima
        pairs = {r[0]: r[1] for r in links.select("a", "b", "near").distinct().groupBy("near").count().collect()}
        shorter = next_depth(pairs, depth, recall, similarity)
        if shorter == depth:
            return links
        depth = shorter


def exact_counts(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Boolean matrix of linked pairs: products of incidence matrices over shingles that occur twice."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    all_values = np.concatenate(sets)
    uniq, inverse, count = np.unique(all_values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    # shingles with the same owners are one weighted column; most shared shingles fall together
    shared = count[inverse] > 1
    owner, inverse = owner[shared], inverse[shared]
    both = np.zeros((n, n))
    if len(owner):
        tag = _mix(owner.astype(np.uint64) + np.uint64(1))
        pattern = np.zeros(len(uniq), np.uint64)
        np.add.at(pattern, inverse, tag)
        cols, first, weight = np.unique(pattern[np.unique(inverse)], return_index=True, return_counts=True)
        rep = np.unique(inverse)[first]
        where = np.full(len(uniq), -1)
        where[rep] = np.arange(len(rep))
        use = where[inverse] >= 0
        owner, col = owner[use], where[inverse[use]]
        for k in range(0, len(cols), 4096):
            at = (col >= k) & (col < k + 4096)
            m = np.zeros((n, min(4096, len(cols) - k)))
            m[owner[at], col[at] - k] = 1
            both += (m * weight[k : k + 4096]) @ m.T
    union = size[:, None] + size[None, :] - both
    link = both >= similarity * union - 1e-9 * np.maximum(union, 1)
    np.fill_diagonal(link, False)
    return link


def verified(docs: DataFrame, clusters: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """clusters has (rep, set_key, copies, cluster, n). Returns (rep, links), links counting copies, and the
    spanning forests (a, b) of verified links."""
    maybe, _ = split_by_slots(docs.select("doc_id", "text"), "doc_id", clusters, "rep")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].tolist()
            for i, j in _chunks(texts):
                value, at = shingles([t or "" for t in texts[i:j]], words)
                sets = [value[at[k] : at[k + 1]] for k in range(j - i)]
                yield pd.DataFrame({"rep": ids[i:j], "found": [_set_key(s) for s in sets], "set": [s.tobytes() for s in sets]})
        trim()

    sets = maybe.mapInPandas(cut, "rep long, found binary, set binary")
    met = sets.join(clusters, "rep").filter("found = set_key").drop("found", "set_key")
    keys = ["cluster", "__i", "__j"]
    dealt = block_pairs(met, "n", "rep", BLOCK).select(*keys, "__own", "rep", "copies", "set").repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys, 2_000):
            cut = bounds(*(pdf[k].to_numpy() for k in keys))
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                g = pdf.iloc[s:e]
                rep, first = np.unique(g["rep"].to_numpy(np.int64), return_index=True)  # repeated rows
                if len(rep) < 2:
                    continue
                copies, own = g["copies"].to_numpy(np.int64)[first], g["__own"].to_numpy(np.int64)[first]
                link = exact_counts([np.frombuffer(g["set"].iloc[k], np.uint64) for k in first], similarity)
                i, j = int(g["__i"].iloc[0]), int(g["__j"].iloc[0])
                if i != j:  # pairs within one block meet in (i, i) and (j, j)
                    link &= own[:, None] != own[None, :]
                n = link @ copies
                yield pd.DataFrame({"rep": rep, "links": n, "root": rep[local_roots(link)]})[n > 0]
        trim()

    out = table(dealt.mapInPandas(run, "rep long, links long, root long"), "verified")
    return out.groupBy("rep").agg(F.sum("links").alias("links")), out.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def classes(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, n_links), one row for each row of docs."""
    small_batches(docs.sparkSession)
    each = table(sketch(docs, words), "sketches")
    some = each.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    texts = table(some.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("labels").alias("labels")), "texts")
    loose = connected_components(forest_links(texts, similarity=similarity), "a", "b")
    sizes = loose.groupBy("root").agg(F.count("*").alias("n"))
    clusters = table(loose.join(sizes, "root").select(F.col("node").alias("rep"), F.col("root").alias("cluster"), "n").join(texts.select("rep", "set_key", "copies"), "rep"), "clusters")
    links, forest = verified(docs, clusters, words, similarity)
    # ids that stand for several texts tie those together, too
    found = connected_components(forest, "a", "b")
    of_text = (
        texts.select("set_key", "rep", "copies")
        .join(found.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .join(links, "rep", "left")
        .select("set_key", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    done = some.select("doc_id", "set_key").join(of_text, "set_key").select("doc_id", "class_id", "n_links")
    rest = each.filter("set_key IS NULL OR doc_id IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return done.unionByName(rest)


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents of docs that stay: of each class the one with the smallest doc_id. Only rows that may be
    dropped are joined. Where rows share the smallest id, each different text stays once, with the columns whose hash is
    the least, so that reruns agree. Rows without a doc_id stay."""
    found = table(found.filter("doc_id IS NOT NULL").select("doc_id", "class_id"), "classes")
    per = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n"))
    odd = table(per.filter("class_id <> doc_id OR n > 1"), "odd")
    maybe, sure = split_by_slots(docs, "doc_id", odd, "doc_id")
    gone = odd.select("doc_id").alias("o")
    kept = maybe.join(gone, "doc_id", "left_anti").unionByName(sure)
    again = odd.filter("class_id = doc_id").select("doc_id")  # ids of several rows
    if again.limit(1).count():
        rows = maybe.join(again, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"))
        least = rows.groupBy(F.col("row.doc_id").alias("id"), F.md5(F.coalesce("row.text", F.lit(""))).alias("text")).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        kept = kept.unionByName(least.select("row.*"))
    return kept.select(*docs.columns)


def op3_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.r),
c AS (SELECT a, min(r) AS class_id FROM r GROUP BY a)
SELECT d.doc_id, c.class_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links FROM documents d JOIN c ON c.a = d.doc_id
"""
