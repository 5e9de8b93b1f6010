"""Removal of repeated byte strings by suffix arrays.

Every byte goes that lies in a LENGTH-byte string which also starts earlier: in a document with a smaller
doc_id, or earlier in the same one. Strings are judged on the input as it is.

Suffix arrays need text side by side, a corpus is spread over machines, so equal strings must first come
together, and the rest of the text should stay where it is:

1. Each LENGTH-byte window has an anchor: the GRAM bytes within it with the smallest hash (the first of
   equals). Equal windows have equal anchors in equal places. Windows that follow each other mostly share
   their anchor; together they are a segment. What is dealt out by the anchor's hash is one small record for
   each segment, with a hash of its bytes. Equal segments of one task are sent once, so a passage that is in
   every document does not pile up; what goes for that is written in the same table as the records.
2. Where records meet, equal segments are settled: all but the first go. Anchors with one kind of segment
   are done. Only the first segment of each kind, at anchors of several kinds, is asked for by text.
3. The texts that are asked for are dealt out by anchor, and a suffix array is built over them in two stages:
   suffixes smaller than their successors are sorted directly, all others are induced by one scan over
   the buckets of first bytes. The common prefixes of neighbours in the array are computed; those of LENGTH or more
   are equal windows, and all but the first of each run go. An anchor with more than KINDS kinds, as a common
   short line in many contexts makes it, is dealt out by SEEDS anchors at once, each of its own order of
   grams: equal windows still agree in all of them, others hardly ever.
4. The removed runs of a document come together at its text.

Documents are keyed by (doc_id, hash of the text). Cases: a null doc_id ranks with the smallest of all; rows that
repeat a doc_id start at the same places, so an equal string at an equal place in them is not earlier; their
results are kept apart by their texts. A null text is empty. Documents shorter than LENGTH lose nothing but
are in the result. A very long document is handled in one piece by one task. Empty tables give empty
results; further columns are ignored by strip() and kept by clean_texts().
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.near_copies import _mix
from folio.llm.shared import bounds, partitions, small_batches, split_by_slots, table, trim, whole_groups, zstd

LENGTH = 100
GRAM = 32
#: Bytes of text whose windows are hashed at once; a longer document is a chunk of its own.
CHUNK = 400_000
#: Records that a task holds before it sends them on.
HELD = 300_000
#: Kinds of segments at one anchor that are compared without anchors of other orders, and the number of those.
KINDS = 500
SEEDS = 8
#: Bytes of text whose records make one bucket, roughly.
BUCKET = 32 << 20
#: Bytes of one suffix array, unless one anchor has more.
ARRAY = 600_000
NULL_ID = -(1 << 63)
_BASE, _BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def _inverse(base: np.uint64) -> np.uint64:
    x = np.uint64(1)
    with np.errstate(over="ignore"):
        for _ in range(7):
            x = x * (np.uint64(2) - base * x)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Polynomial hashes of any substrings of a byte array."""

    def __init__(self, data: np.ndarray, base: np.uint64 = _BASE):
        value = _mix(np.arange(1, 257, dtype=np.uint64) * base)[data]
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * _powers(base, len(data)), out=self.sum[1:])
        self.back = _powers(_inverse(base), len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sum[end] - self.sum[start]) * self.back[start])

    def all(self, size: int) -> np.ndarray:
        return _mix((self.sum[size:] - self.sum[:-size]) * self.back[: len(self.sum) - size])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i that has as many."""
    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.append(x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(raw: list[bytes], length: int = LENGTH, gram: int = GRAM, seeds: int = 1) -> dict[str, np.ndarray] | None:
    """The segments of some documents: doc (index), start, windows, place (of the anchor), anchor, kind. With several
    seeds the windows of a segment share the anchors of all orders, and anchor is a hash of these and their distances."""
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if len(data) < length:
        return None
    first = np.append(0, np.cumsum(sizes))
    h = Hashes(data)
    grams = h.all(gram)
    ok = np.ones(len(grams) - length + gram, bool)
    for e in first[1:-1]:  # windows that reach into the next document
        ok[max(0, e - length + 1) : e] = False
    at = np.flatnonzero(ok)
    if not len(at):
        return None
    # the first of the smallest: hash above, position below
    low = np.uint64(max(24, len(grams).bit_length()))
    begin = np.ones(len(at), bool)
    begin[1:] = at[1:] != at[:-1] + 1
    found = []
    for seed in range(seeds):
        order = _mix(grams + np.uint64(seed) * _BASE2) if seed else grams
        ranked = ((order >> low) << low) | np.arange(len(grams), dtype=np.uint64)
        best = (_sliding_min(ranked, length - gram + 1) & np.uint64((1 << int(low)) - 1)).astype(np.int64)[at]
        begin[1:] |= best[1:] != best[:-1]
        found.append(best)
    s = np.flatnonzero(begin)
    n = np.diff(np.append(s, len(at)))
    start, anchor = at[s], found[0][s]
    name = grams[anchor]
    for other in found[1:]:
        name = _mix(name ^ grams[other[s]] ^ _mix((other[s] - anchor).astype(np.uint64)))
    doc = np.searchsorted(first, start, side="right") - 1
    kind = Hashes(data, _BASE2)(start, start + n + length - 1)
    kind = _mix(kind ^ ((anchor - start).astype(np.uint64) << np.uint64(32)) ^ n.astype(np.uint64))
    return {"doc": doc, "start": start - first[doc], "windows": n, "place": anchor - start, "anchor": name, "kind": kind}


_FIELDS = (("anchor", "<u8"), ("kind", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("start", "<u4"), ("windows", "u1"), ("place", "u1"))


def _pack(rows: dict[str, np.ndarray]) -> bytes:
    return zstd()[0].compress(b"".join(np.ascontiguousarray(rows[k].astype(t)).view(np.uint8).reshape(len(rows[k]), -1).T.tobytes() for k, t in _FIELDS))


def _unpack(data: bytes, n: int) -> dict[str, np.ndarray]:
    raw, at, out = np.frombuffer(zstd()[1].decompress(data), np.uint8), 0, {}
    for k, t in _FIELDS:
        w = np.dtype(t).itemsize
        out[k] = np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(t).ravel()
        at += n * w
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"), F.col("doc_id").cast("long").alias("id"))


def _settle(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by anchor, kind and place; which of these are the first of their kind; which go)."""
    order = np.lexsort((rows["text"], rows["start"], rows["doc"], rows["kind"], rows["anchor"]))
    cut = bounds(rows["anchor"][order], rows["kind"][order])
    head = np.repeat(order[cut[:-1]], np.diff(cut))
    first = np.zeros(len(order), bool)
    first[cut[:-1]] = True
    gone = (rows["doc"][order] != rows["doc"][head]) | (rows["start"][order] != rows["start"][head])
    return order, first, gone


_RECORDS = "bucket long, n int, rows binary, doc long, hash long, start long, end long"


def _joined(doc: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """(doc, hash, start, end): these runs of bytes, those that overlap or touch as one."""
    order = np.lexsort((start, text, doc))
    doc, text, start, end = doc[order], text[order], start[order], end[order]
    cut = bounds(doc, text)
    owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    step = np.int64(end.max()) + 2  # keeps the running maximum within its document
    reach = np.maximum.accumulate(end + owner * step)
    begin = np.ones(len(start), bool)
    begin[1:] = start[1:] + owner[1:] * step > reach[:-1]
    s = np.flatnonzero(begin)
    last = np.append(s[1:], len(start)) - 1
    return pd.DataFrame({"doc": doc[s], "hash": text[s], "start": start[s], "end": reach[last] - owner[s] * step})


def _records(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed records with their bucket and, where bucket is null, the runs (doc, hash, start, end) that go because
    the same task has an equal segment that is earlier. Both are of one scan: how tasks cut the input may differ
    in another one, and what one leaves out the other would not report."""

    names = [x.split()[0] for x in _RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict[str, np.ndarray]] = []

        def flush() -> Iterator[pd.DataFrame]:
            if not held:
                return
            rows = {k: np.concatenate([h[k] for h in held]) for k, _ in _FIELDS}
            held.clear()
            order, _, gone = _settle(rows)
            go = order[gone]
            if len(go):
                start = rows["start"][go].astype(np.int64)
                runs = _joined(rows["doc"][go], rows["text"][go], start, start + rows["windows"][go] + LENGTH - 1)
                runs["bucket"], runs["n"] = (pd.array([None] * len(runs), t) for t in ("Int64", "Int32"))
                runs["rows"] = None
                yield runs[names]
            stay = order[~gone]
            bucket = (rows["anchor"][stay] % np.uint64(buckets)).astype(np.int64)
            stay = stay[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cut = bounds(bucket)
            for i in range(0, len(cut) - 1, 256):
                some = list(zip(cut[i : i + 256], cut[i + 1 : i + 257], strict=False))
                out = pd.DataFrame([(bucket[a], b - a, _pack({k: rows[k][stay[a:b]] for k, _ in _FIELDS})) for a, b in some], columns=names[:3])
                for name in names[3:]:
                    out[name] = pd.array([None] * len(out), "Int64")
                yield out

        for pdf in batches:
            texts, i = pdf["text"].tolist(), 0
            ids, hashes = pdf["doc"].to_numpy(np.int64), pdf["hash"].to_numpy(np.int64)
            while i < len(texts):
                raw, j, n = [], i, 0
                while j < len(texts) and n < CHUNK:
                    raw.append(texts[j].encode("utf-8", "surrogatepass"))
                    n += len(raw[-1])
                    j += 1
                found = segments(raw)
                if found:
                    found["text"] = hashes[i:j][found["doc"]]
                    found["doc"] = ids[i:j][found["doc"]]
                    held.append({k: found[k].astype(t) for k, t in _FIELDS})
                    if sum(len(h["doc"]) for h in held) >= HELD:
                        yield from flush()
                i = j
        yield from flush()
        trim()

    return docs.mapInPandas(run, _RECORDS)


def _meet(records: DataFrame, buckets: int) -> DataFrame:
    """(doc, hash, start, end, anchor, place, hot): anchor null: bytes start to end go; else the text of these
    bytes is asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["bucket"], 1):
            parts = [_unpack(r, n) for r, n in zip(pdf["rows"], pdf["n"], strict=True)]
            rows = {k: np.concatenate([p[k] for p in parts]) for k, _ in _FIELDS}
            order, first, gone = _settle(rows)
            anchor = rows["anchor"][order]
            cut = bounds(anchor)
            kinds = np.add.reduceat(first.astype(np.int64), cut[:-1])
            kinds = np.repeat(kinds, np.diff(cut))
            ask = first & (kinds > 1)
            pick = np.append(order[gone], order[ask])
            start = rows["start"][pick].astype(np.int64)
            out = pd.DataFrame({"doc": rows["doc"][pick], "hash": rows["text"][pick], "start": start, "end": start + rows["windows"][pick] + LENGTH - 1})
            none = int(gone.sum())
            out["anchor"] = pd.array([None] * none + rows["anchor"][order[ask]].view(np.int64).tolist(), "Int64")
            out["hot"] = np.append(np.zeros(none, bool), kinds[ask] > KINDS)
            yield out
        trim()

    return records.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket").mapInPandas(run, "doc long, hash long, start long, end long, anchor long, hot boolean")


def _cut_texts(asked: DataFrame) -> DataFrame:
    """(anchor, doc, hash, start, bytes): the segments that were asked for; those of hot anchors cut by all seeds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, hot, where = [], [], []

            def cut_hot(hot=hot, where=where, rows=rows) -> None:
                found = segments(hot, seeds=SEEDS) if hot else None
                if found:
                    for k, a, s, n in zip(*(found[x].tolist() for x in ("doc", "anchor", "start", "windows")), strict=True):
                        doc, text, start = where[k]
                        rows.append((a - (1 << 64) if a >> 63 else a, doc, text, start + s, hot[k][s : s + n + LENGTH - 1]))
                hot.clear()
                where.clear()

            held = 0
            for r in pdf.itertuples():
                raw = r.text.encode("utf-8", "surrogatepass")
                for a in r.asks:
                    some = raw[a["start"] : a["end"]]
                    if a["hot"]:
                        hot.append(some)
                        where.append((r.doc, r.hash, a["start"]))
                        held += len(some)
                    else:
                        rows.append((a["anchor"], r.doc, r.hash, a["start"], some))
                if held >= CHUNK:
                    cut_hot()
                    held = 0
            cut_hot()
            if rows:
                yield pd.DataFrame(rows, columns=["anchor", "doc", "hash", "start", "bytes"])

    return asked.mapInPandas(run, "anchor long, doc long, hash long, start long, bytes binary")


# --- the suffix array -----------------------------------------------------------------------------


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of data in the order of their first `depth` bytes (a suffix that ends earlier is smaller)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    # smaller than the successor: the next byte that differs is larger
    last = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)  # ends of runs of one byte
    run_end = last[np.searchsorted(last, np.arange(n))]
    follow = np.append(data, np.uint8(0))[np.minimum(run_end + 1, n)]
    small = (run_end < n - 1) & (follow > data)
    direct = _sort_directly(data, np.flatnonzero(small), depth)
    first_of_direct = data[direct]
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    pending[data[n - 1]].append(np.array([n - 1]))  # the successor of the last suffix is empty, the least of all
    out = []
    edges = np.searchsorted(first_of_direct, np.arange(257))
    for c in range(256):
        front = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        bucket = []
        while len(front):
            bucket.append(front)
            front = front[front > 0] - 1
            front = front[data[front] == c]
        bucket.append(direct[edges[c] : edges[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[data[before] > c]  # larger than their successors
        by = data[before]
        order = np.argsort(by, kind="stable")
        before, by = before[order], by[order]
        cut = bounds(by) if len(by) else [0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            pending[by[a]].append(before[a:b])
        pending[c] = []
    return np.concatenate(out)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros follow the end."""
    x = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    out = x[: len(data)].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | x[k : k + len(data)]
    return out


def _sort_directly(data: np.ndarray, which: np.ndarray, depth: int) -> np.ndarray:
    """`which` in the order of the `depth` bytes from there on: eight bytes at a time, and only where the
    bytes before were equal."""
    eight = np.append(_eights(data), np.uint64(0))
    order = which[np.argsort(eight[which], kind="stable")]
    key = eight[order]
    same = np.append(False, key[1:] == key[:-1]) if len(key) else np.zeros(0, bool)
    done = 8
    while done < depth and same.any():
        # runs of equals, in place
        tied = same | np.append(same[1:], False)
        at = np.flatnonzero(tied)
        group = np.cumsum(~same[at])
        key = eight[np.minimum(order[at] + done, len(data))]
        again = np.lexsort((key, group))
        order[at] = order[at[again]]
        key, group = key[again], group[again]
        still = np.append(False, (key[1:] == key[:-1]) & (group[1:] == group[:-1]))
        same = np.zeros(len(order), bool)
        same[at] = still
        done += 8
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For each suffix but the first in this order, how many bytes it shares with the one before, up to `depth`."""
    eight = np.append(_eights(data), np.zeros(depth, np.uint64))
    left = len(data) - np.maximum(order[1:], order[:-1])
    out = np.minimum(left, depth).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    same = np.arange(len(out))
    for k in range(0, depth, 8):
        x = eight[order[same] + k] ^ eight[order[same + 1] + k]
        differ = np.flatnonzero(x)
        # the first byte that differs is the highest one set
        bits = np.zeros(len(differ), np.int64)
        y = x[differ].copy()
        for step in (32, 16, 8):
            high = y >> np.uint64(step) != 0
            bits[high] += step
            y[high] >>= np.uint64(step)
        out[same[differ]] = np.minimum(out[same[differ]], k + 7 - bits // 8)
        same = same[x == 0]
    return out


def equal_windows(data: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(windows in suffix order, starts of the runs whose common prefix is `length` or more, and the end).
    windows: boolean, where one begins."""
    order = suffix_array(data, length)
    order = order[windows[order]]
    apart = np.flatnonzero(common_prefixes(data, order, length) < length) + 1
    starts = np.append(0, apart) if len(order) else np.zeros(0, np.int64)
    return order, np.append(starts, len(order)).astype(np.int64)


def _compare(cut: DataFrame) -> DataFrame:
    """(doc, hash, start, end): the bytes of the segments that go."""

    def settle(pdf: pd.DataFrame) -> pd.DataFrame | None:
        raw = pdf["bytes"].tolist()
        sizes = np.array([len(r) for r in raw], np.int64)
        first = np.append(0, np.cumsum(sizes))
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), sizes)
        place = np.arange(len(data)) - first[owner]
        windows = place + LENGTH <= sizes[owner]
        order, runs = equal_windows(data, windows)
        keep = np.diff(runs) > 1
        if not keep.any():
            return None
        group = np.repeat(np.arange(len(runs) - 1), np.diff(runs))
        take = keep[group]
        order, group = order[take], group[take]
        own = owner[order]
        doc, start = pdf["doc"].to_numpy(np.int64)[own], pdf["start"].to_numpy(np.int64)[own] + place[order]
        rank = np.lexsort((start, doc, group))
        order, group, doc, start = order[rank], group[rank], doc[rank], start[rank]
        c = bounds(group)
        head = np.repeat(c[:-1], np.diff(c))
        go = np.sort(order[(doc != doc[head]) | (start != start[head])])
        if not len(go):
            return None
        begin = np.ones(len(go), bool)
        begin[1:] = (go[1:] != go[:-1] + 1) | (owner[go[1:]] != owner[go[:-1]])
        s = np.flatnonzero(begin)
        n = np.diff(np.append(s, len(go)))
        own = owner[go[s]]
        at = pdf["start"].to_numpy(np.int64)[own] + place[go[s]]
        return pd.DataFrame({"doc": pdf["doc"].to_numpy(np.int64)[own], "hash": pdf["hash"].to_numpy(np.int64)[own], "start": at, "end": at + n + LENGTH - 1})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["anchor"], ARRAY // 130):
            out = settle(pdf)
            if out is not None:
                yield out
        trim()

    return cut.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(run, "doc long, hash long, start long, end long")


def runs(docs: DataFrame) -> DataFrame:
    """(doc, hash, start, end): byte runs that go, overlapping and in no order."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs)
    long = keyed.filter(F.octet_length("text") >= LENGTH)
    size = long.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(4 * partitions(docs.sparkSession), math.ceil(size / BUCKET))
    sent = table(_records(long, buckets), "sent")
    found = table(_meet(sent.filter("bucket IS NOT NULL").select("bucket", "n", "rows"), buckets), "records")
    asks = found.filter("anchor IS NOT NULL").groupBy("doc", "hash").agg(F.collect_list(F.struct("anchor", "start", "end", "hot")).alias("asks"))
    maybe, _ = split_by_slots(long, "doc", found.filter("anchor IS NOT NULL"), "doc")
    compared = table(_compare(_cut_texts(maybe.join(asks, ["doc", "hash"]))), "compared")
    return found.filter("anchor IS NULL").select("doc", "hash", "start", "end").unionByName(compared).unionByName(sent.filter("bucket IS NULL").select("doc", "hash", "start", "end"))


def _applied(docs: DataFrame, gone: DataFrame, texts: bool) -> DataFrame:
    """docs has (doc, hash, text, ...): adds n_bytes, n_removed, n_spans, kept_sha256, and with texts kept_text.
    Only documents that may lose bytes are joined."""
    spans = table(gone.groupBy("doc", "hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")), "spans")
    maybe, sure = split_by_slots(docs, "doc", spans, "doc")

    out_type = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * texts

    @F.pandas_udf(out_type)
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, ss in zip(text, spans, strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            kept, at, n = [], 0, 0
            end = -1
            for s in ss if ss is not None else ():
                a, b = s["start"], s["end"]
                if a > end:
                    n += 1
                if a > at:
                    kept.append(raw[at:a])
                at = end = max(at, b)
            kept.append(raw[at:])
            left = b"".join(kept)
            row = (len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest())
            rows.append((*row, left.decode("utf-8", "ignore")) if texts else row)
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * texts])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * texts]
    joined = maybe.join(spans, ["doc", "hash"], "left").withColumn("__c", cut("text", "spans"))
    joined = joined.select(*docs.columns, *[F.col(f"__c.{n}").alias(n) for n in names])
    zero = F.lit(0).cast("long")
    whole = sure.select(*docs.columns, F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), *[F.col("text").alias("kept_text")] * texts)
    return joined.unionByName(whole)


def strip(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each document."""
    out = _applied(_keyed(docs), runs(docs), False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def clean_texts(docs: DataFrame) -> DataFrame:
    """docs with what is left of their texts. Bytes of a character that was cut through are dropped."""
    text = F.coalesce("text", F.lit(""))
    packed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"), F.struct(*[c for c in docs.columns if c != "text"]).alias("rest"))
    out = _applied(packed, runs(docs), True)
    return out.select(*[F.col("kept_text").alias("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])


def op9_suffix_array(spark, sf_dir: str) -> DataFrame:
    return strip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
