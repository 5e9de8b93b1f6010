"""Token files coded by a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, is shared by all blocks. A block holds the ids of
consecutive documents and is coded by LANES interleaved states: lane j has the ids j, j + LANES, ... of
each segment. Every SEGMENT ids the states and the place in the stream are noted in the header, so the
segments of a block are decoded side by side, and any block without any other. Header and payload have
their own CRC-32, and each document its CRC-32 of ids.

A file set is a folder with
  blocks/  Parquet rows (part, seq, first, n_tokens, n_docs, block), block being the bytes below;
  table/   the frequencies (id, freq), which sum to 2^PRECISION;
  parts/   (part, base, n_tokens): how many ids stand before each part.
Parquet is the container: Spark's own committer makes the writes atomic, so a lost executor or a repeated
task leaves no half file, and any store that Spark reads will do.

Bytes of a block, little-endian: magic "FRNS", u32 header bytes, u32 payload bytes, u32 CRC of the
header, u32 CRC of the payload; header: u32 ids, u32 documents, u32 segments, u32 bytes of document ids,
documents' ids (i64, then u8 flags: 1 null id, 2 first piece, 4 last piece), ids for each (u32), for
each segment LANES states (u64) and a stream place (u32); payload: u32 words.

Documents stand in ascending doc_id order (nulls first): ranges of ids become parts, sorted within. The
range borders come from the ids alone, so texts are tokenized once and never sampled. Only a document
longer than a block goes on in the next; the CRCs of its pieces are combined.

Cases: null and empty texts are documents of the end id alone. Documents with equal ids stand in the
order of their ids' bytes. Very long texts are cut into blocks after tokenization only. Other columns are
left out. An empty table gives an empty file set.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.shared import forget, new_path, partitions, small_batches, table, zstd

MAGIC = b"FRNS"
PRECISION = 20
LANES = 64
SEGMENT = 16_384
BLOCK = 4 * SEGMENT
#: Blocks that a task codes side by side.
TOGETHER = 16
LOW = np.uint64(1 << 31)
#: Where null ids stand: before the smallest one, in its part.
LEAST = -(1 << 63)
#: Characters that one call of the tokenizer gets at most, but for single longer texts.
CALL = 200_000
_BLOCKS = "part int, seq int, first long, n_tokens long, n_docs int, block binary"


# --- tokens ---------------------------------------------------------------------------------------


class Encoder:
    """The tokenizers library over whole texts; ids as bytes of `kind`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32

    def __call__(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]


_loaded: dict[str, Encoder] = {}
forget.append(_loaded.clear)


def encoder_for(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _pack(ids: np.ndarray) -> bytes:
    """Ids for the way to their block: their width, then byte planes, compressed."""
    planes = ids.view(np.uint8).reshape(-1, ids.itemsize).T
    return bytes((ids.itemsize,)) + zstd()[0].compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstd()[1].decompress(data[1:]), np.uint8)
    return raw.reshape(data[0], -1).T.ravel().view(f"<u{data[0]}")


def tokenize(docs: DataFrame, path: str, end_id: int, borders: list[int]) -> DataFrame:
    """(doc_id, none, part, ids) for each document, none being true for a null doc_id, and, with a null part, the counts of the ids of each task."""
    edge = np.array(borders, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(path)
        counts = np.zeros(0, np.int64)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            keys, none = pdf["doc_id"].to_numpy(np.int64), pdf["none"].to_numpy(bool)
            part = np.searchsorted(edge, keys, side="right").astype(np.int32)
            i = 0
            while i < len(texts):
                j, n = i, 0
                while j < len(texts) and (j == i or n + len(texts[j]) <= CALL):
                    n += len(texts[j])
                    j += 1
                end = np.array([end_id], encoder.kind).tobytes()
                ids = [x + end for x in encoder(texts[i:j])]
                seen = np.bincount(np.frombuffer(b"".join(ids), encoder.kind))
                if len(seen) > len(counts):
                    counts = np.pad(counts, (0, len(seen) - len(counts)))
                counts[: len(seen)] += seen
                yield pd.DataFrame({"doc_id": keys[i:j], "none": none[i:j], "part": part[i:j], "ids": [_pack(np.frombuffer(x, encoder.kind)) for x in ids]})
                i = j
        if counts.any():
            used = np.flatnonzero(counts)
            yield pd.DataFrame({"doc_id": [0], "none": [True], "part": pd.array([None], "Int32"), "ids": [zlib.compress(np.stack([used, counts[used]]).tobytes(), 1)]})

    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    return docs.select(known.alias("doc_id"), F.col("doc_id").isNull().alias("none"), "text").mapInPandas(run, "doc_id long, none boolean, part int, ids binary")


def count_ids(counted: DataFrame) -> np.ndarray:
    """The counts of all ids. Adding up happens on the executors; what comes back has one row for each id
    of the vocabulary at most."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for x in pdf["ids"]:
                used, n = np.frombuffer(zlib.decompress(x), np.int64).reshape(2, -1)
                yield pd.DataFrame({"id": used, "n": n})

    rows = counted.filter("part IS NULL").select("ids").mapInPandas(spread, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def frequencies(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Counts scaled to sum to 2^precision; every id that occurs has at least 1."""
    total, whole = int(counts.sum()), 1 << precision
    if not total:
        return np.zeros(len(counts), np.int64)
    exact = counts.astype(np.float64) * whole / total
    freq = np.where(counts > 0, np.maximum(1, np.floor(exact)), 0).astype(np.int64)
    over = int(freq.sum()) - whole
    if over > whole - np.count_nonzero(freq) and over > 0:
        raise ValueError("more ids than the table has places")
    order = np.argsort(-freq, kind="stable")
    i = 0
    while over > 0:  # take from the most frequent
        j = order[i % len(order)]
        take = min(over, max(0, int(freq[j]) // 16))
        freq[j] -= take
        over -= take
        i += 1
        if not take:
            order = np.argsort(-freq, kind="stable")
            freq[order[:over]] -= freq[order[:over]] > 1
            over, i = int(freq.sum()) - whole, 0
    freq[order[0]] -= over
    return freq


# --- blocks ---------------------------------------------------------------------------------------


class Coder:
    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.precision = np.uint64(precision)
        self.freq = freq.astype(np.uint64)
        self.start = np.append(0, np.cumsum(freq)[:-1]).astype(np.uint64) if len(freq) else freq.astype(np.uint64)
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each block (states at each segment's start, stream places of the segments, stream). All segments of
        all blocks are coded side by side; a short one's missing places are skipped."""
        per = [-(-len(ids) // SEGMENT) for ids in blocks]
        steps = SEGMENT // LANES
        sym = np.zeros((sum(per), SEGMENT), np.int64)
        size = np.zeros(sum(per), np.int64)
        k = 0
        for ids, n in zip(blocks, per, strict=True):
            sym.reshape(-1)[k * SEGMENT : k * SEGMENT + len(ids)] = ids
            size[k : k + n] = np.minimum(SEGMENT, len(ids) - SEGMENT * np.arange(n))
            k += n
        sym = sym.reshape(-1, steps, LANES)
        x = np.full((len(sym), LANES), LOW, np.uint64)
        words = np.zeros((steps, *x.shape), np.uint32)
        sent = np.zeros(words.shape, bool)
        bits, word = self.precision, np.uint64(32)
        top = np.uint64((1 << 63) >> int(bits))
        lane = np.arange(LANES)
        for t in range(steps - 1, -1, -1):
            ok = t * LANES + lane[None, :] < size[:, None]
            s = sym[:, t]
            f = self.freq[s]
            if not ok.all():
                f = np.where(ok, f, np.uint64(1))
            full = x >= top * f
            full &= ok
            sent[t], words[t] = full, x
            x = np.where(full, x >> word, x)
            q = x // f
            x = np.where(ok, (q << bits) + (x - q * f) + self.start[s], x)
        streams = [words[:, k][sent[:, k]] for k in range(len(sym))]
        out, k = [], 0
        for n in per:
            some = streams[k : k + n]
            place = np.append(0, np.cumsum([len(s) for s in some]))[:-1].astype(np.uint32)
            out.append((x[k : k + n], place, np.concatenate(some) if some else np.zeros(0, np.uint32)))
            k += n
        return out

    def decode(self, states: np.ndarray, place: np.ndarray, stream: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of segments, decoded side by side: states (segments, LANES), places in the joint stream and
        ids of each."""
        n_seg, steps = len(states), SEGMENT // LANES
        x, at = states.astype(np.uint64).copy(), place.astype(np.int64).copy()
        data = np.append(stream, np.uint32(0)).astype(np.uint64)
        got = np.zeros((n_seg, steps, LANES), np.uint32)
        mask, word = np.uint64((1 << int(self.precision)) - 1), np.uint64(32)
        lane = np.arange(LANES)
        for t in range(int(-(-counts.max() // LANES)) if len(counts) else 0):
            ok = t * LANES + lane[None, :] < counts[:, None]
            low = x & mask
            s = self.slots[low]
            got[:, t] = s
            nxt = self.freq[s] * (x >> self.precision) + low - self.start[s]
            x = np.where(ok, nxt, x)
            need = ok & (x < LOW)
            rank = np.cumsum(need, 1)
            i = np.minimum(at[:, None] + rank - 1, len(data) - 1)
            x = np.where(need, (x << word) | data[i], x)
            at += rank[:, -1]
        flat = got.reshape(n_seg, -1)
        return np.concatenate([flat[k, : counts[k]] for k in range(n_seg)]) if n_seg else np.zeros(0, np.uint32)


def write_blocks(coder: Coder, blocks: list[tuple[np.ndarray, list[tuple[int | None, int, int]]]]) -> list[bytes]:
    """blocks: (ids, documents), a document being (doc_id, ids here, flags 2 first piece and 4 last piece)."""
    out = []
    for (ids, docs), (states, place, stream) in zip(blocks, coder.encode([ids for ids, _ in blocks]), strict=True):
        names = np.array([0 if d is None else d for d, _, _ in docs], "<i8").tobytes() + bytes((d is None) | f for d, _, f in docs)
        lens = np.array([n for _, n, _ in docs], "<u4").tobytes()
        marks = b"".join(states[k].astype("<u8").tobytes() + struct.pack("<I", place[k]) for k in range(len(states)))
        header = struct.pack("<4I", len(ids), len(docs), len(states), len(names)) + names + lens + marks
        payload = stream.astype("<u4").tobytes()
        out.append(MAGIC + struct.pack("<4I", len(header), len(payload), zlib.crc32(header), zlib.crc32(payload)) + header + payload)
    return out


def read_blocks(coder: Coder, blocks: list[bytes]) -> list[tuple[list[tuple[int | None, int, int]], np.ndarray]]:
    """(documents as for write_blocks, ids) of each block; all segments of all blocks are decoded at once."""
    heads, states, places, counts, streams, base = [], [], [], [], [], 0
    for b in blocks:
        if b[:4] != MAGIC:
            raise ValueError("not a block")
        h, p, ch, cp = struct.unpack_from("<4I", b, 4)
        header, payload = b[20 : 20 + h], b[20 + h : 20 + h + p]
        if len(payload) != p or zlib.crc32(header) != ch or zlib.crc32(payload) != cp:
            raise ValueError("a block is damaged")
        n, docs, segs, size = struct.unpack_from("<4I", header)
        names = np.frombuffer(header, "<i8", docs, 16)
        flags = header[16 + 8 * docs : 16 + size]
        lens = np.frombuffer(header, "<u4", docs, 16 + size)
        at = 16 + size + 4 * docs
        for k in range(segs):
            states.append(np.frombuffer(header, "<u8", LANES, at))
            places.append(base + struct.unpack_from("<I", header, at + 8 * LANES)[0])
            counts.append(min(SEGMENT, n - k * SEGMENT))
            at += 8 * LANES + 4
        streams.append(np.frombuffer(payload, "<u4"))
        base += len(streams[-1])
        heads.append((n, [(None if f & 1 else int(d), int(c), f & 6) for d, c, f in zip(names, lens, flags, strict=True)]))
    ids = coder.decode(np.array(states, np.uint64).reshape(-1, LANES), np.array(places, np.int64), np.concatenate(streams) if streams else np.zeros(0, np.uint32), np.array(counts, np.int64))
    cuts = np.cumsum([n for n, _ in heads])[:-1]
    return [(docs, x) for (_, docs), x in zip(heads, np.split(ids, cuts), strict=True)]


# --- file sets ------------------------------------------------------------------------------------


def write(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, parts: int | None = None) -> None:
    """Writes the documents' ids to the folder `out`."""
    spark = docs.sparkSession
    small_batches(spark)
    n = parts or partitions(spark)
    quantiles = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    borders = sorted(set(quantiles))
    tokens = table(tokenize(docs, tokenizer_path, end_id, borders), "tokens")
    freq = frequencies(count_ids(tokens))
    shared = spark.sparkContext.broadcast(freq)  # one number for each id of the vocabulary

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        part, seq, first, size = -1, 0, 0, 0
        ids: list[np.ndarray] = []
        held: list[tuple[int | None, int, int]] = []
        ready: list[tuple] = []

        def close() -> None:
            nonlocal ids, held, size, seq, first
            if held:
                ready.append((part, seq, first, size, np.concatenate(ids), held))
                seq, first = seq + 1, first + size
            ids, held, size = [], [], 0

        def coded() -> pd.DataFrame:
            blocks = write_blocks(coder, [(r[4], r[5]) for r in ready])
            rows = [(*r[:4], len(r[5]), b) for r, b in zip(ready, blocks, strict=True)]
            ready.clear()
            return pd.DataFrame(rows, columns=["part", "seq", "first", "n_tokens", "n_docs", "block"])

        for pdf in batches:
            for key, none, p, data in zip(pdf["doc_id"].tolist(), pdf["none"].tolist(), pdf["part"].tolist(), pdf["ids"], strict=True):
                if p != part:
                    close()
                    part, seq, first = p, 0, 0
                x = _unpack(data)
                if size + len(x) > BLOCK:
                    close()
                at = 0
                while at < len(x):
                    take = min(len(x) - at, BLOCK - size)
                    ids.append(x[at : at + take])
                    held.append((None if none else key, take, 2 * (at == 0) + 4 * (at + take == len(x))))
                    at += take
                    size += take
                    if size == BLOCK:
                        close()
                if len(ready) >= TOGETHER:
                    yield coded()
        close()
        if ready:
            yield coded()

    # ids are sorted in the JVM; equal ids by their bytes, so that runs agree
    dealt = tokens.filter("part IS NOT NULL").repartitionById(len(borders) + 1, "part").sortWithinPartitions("part", F.col("none").desc(), "doc_id", "ids")
    dealt.mapInPandas(encode, _BLOCKS).write.option("compression", "none").parquet(f"{out}/blocks")
    used = np.flatnonzero(freq)
    spark.createDataFrame(pd.DataFrame({"id": used, "freq": freq[used]}), "id long, freq long").coalesce(1).write.parquet(f"{out}/table")
    totals = spark.read.parquet(f"{out}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)  # one row for each part
    totals.withColumn("base", F.sum("n_tokens").over(before) - F.col("n_tokens")).coalesce(1).write.parquet(f"{out}/parts")


def load_table(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id long, freq long").parquet(f"{path}/table").toPandas()
    freq = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    freq[rows["id"]] = rows["freq"]
    return freq


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The pieces of documents: (doc_id, part, seq, start, n_tokens, flags, crc), start counting ids of all
    pieces before; with_ids adds the ids as an array."""
    shared = spark.sparkContext.broadcast(load_table(spark, path))
    schema = "doc_id long, part int, seq int, start long, n_tokens long, flags int, crc long" + ", ids array<long>" * with_ids

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value)
        for pdf in batches:
            for i in range(0, len(pdf), TOGETHER):
                some = pdf.iloc[i : i + TOGETHER]
                rows = []
                for r, (docs, ids) in zip(some.itertuples(), read_blocks(coder, list(some["block"])), strict=True):
                    at = 0
                    for key, n, flags in docs:
                        x = ids[at : at + n]
                        row = (key, r.part, r.seq, r.base + r.first + at, n, flags, zlib.crc32(x.astype("<u4").tobytes()))
                        rows.append((*row, x.astype(np.int64)) if with_ids else row)
                        at += n
                out = pd.DataFrame([r[1:] for r in rows], columns=["part", "seq", "start", "n_tokens", "flags", "crc", *["ids"] * with_ids])
                out.insert(0, "doc_id", pd.array([r[0] for r in rows], "Int64"))
                yield out

    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    bases = spark.read.schema("part int, n_tokens long, base long").parquet(f"{path}/parts").select("part", "base")
    return blocks.join(bases, "part").select("part", "seq", "first", "base", "block").mapInPandas(decode, schema)


def crc_combine(a: int, b: int, length: int) -> int:
    """CRC-32 of two texts put together, from their CRCs and the second one's bytes."""

    def times(matrix: list[int], v: int) -> int:
        out = 0
        for m in matrix:
            if not v:
                break
            if v & 1:
                out ^= m
            v >>= 1
        return out

    shift = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    bits = 8 * length
    while bits:
        if bits & 1:
            a = times(shift, a)
        shift = [times(shift, m) for m in shift]
        bits >>= 1
    return a ^ b


def summary(pieces: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document. Only documents of several blocks are grouped."""
    whole = pieces.filter("flags = 6").select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, none, rows = 0, True, []
        part, start, n, crc = -1, 0, 0, 0
        for pdf in batches:
            for r in pdf.itertuples():
                if r.flags & 2:
                    key, none, part, start, n, crc = r.doc_id, r.none, r.part, r.start, r.n_tokens, r.crc
                else:
                    crc, n = crc_combine(crc, r.crc, 4 * r.n_tokens), n + r.n_tokens
                if r.flags & 4:
                    rows.append((key, none, start, n, crc))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "none", "start", "n_tokens", "ids_crc32"])
                rows = []

    # ids without nulls, else pandas turns them to floats
    pieced = pieces.filter("flags <> 6").withColumn("none", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    several = pieced.repartition("part").sortWithinPartitions("part", "start").mapInPandas(together, "doc_id long, none boolean, start long, n_tokens long, ids_crc32 long")
    return whole.unionByName(several.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none"))


def op1_rans(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = new_path(spark, "tokens")
    write(docs, out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    pieces = table(read(spark, out), "pieces")
    return summary(pieces)
