"""What several operators of this subpackage need: tables in the shared folder,
whole groups out of Arrow batches, bounded membership filters, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Slots of the membership filter, a bit each: at most 2 MB are broadcast.
SLOTS = 1 << 24

#: Rows of a square matrix that are looked at together.
TILE = 256


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte: itself where it is printable Latin-1, else the next of U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master gets
    one of its own when the setting is missing; any other master without it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file:///tmp/checkpoints/folio"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/folio-{tag}-{uuid.uuid4().hex}"


def table(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and lost
    executors only repeat what reads the table."""
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind table()'s result, once nothing reads them any more."""
    spark = df.sparkSession
    roots = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for root in roots:
        if "/folio-" in root:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_codecs: list = []


def zstd() -> list:
    """A compressor and a decompressor for each worker process; making one costs more than its use on a document."""
    if not _codecs:
        import zstandard

        _codecs.extend((zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()))
    return _codecs


#: What empties the caches that other operators left in this worker.
forget: list[Callable[[], None]] = []


def trim() -> None:
    """Empties caches and gives memory that a worker's allocator holds in vain back to the system; workers live on
    after a task, and the next one may be another operator's."""
    for clear in forget:
        clear()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts go to Python: keeps Arrow batches to so many rows, as the default of 10,000 long texts would
    take most of a worker's memory on both sides. A smaller setting of the session's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slot(key: str | Column) -> Column:
    """From 1 to SLOTS."""
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1


def split_by_slots(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of df that may have a key in wanted, rows that surely have none), without a shuffle of
    df. What is broadcast is a bitmap of SLOTS bits, however large wanted is; when it is huge, every row
    falls in the first part and the join that follows does all the work. Null keys are never wanted."""
    at = wanted.filter(F.col(wanted_key).isNotNull()).select(slot(wanted_key).alias("s"))
    bits = at.groupBy(F.bitmap_bucket_number("s").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__bits"))
    place = F.bitmap_bit_position(F.col("__slot")).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2 == 1, F.lit(False))
    marked = df.withColumn("__slot", F.when(F.col(key).isNotNull(), slot(key))).withColumn("__bucket", F.bitmap_bucket_number(F.col("__slot")))
    marked = marked.join(F.broadcast(bits), "__bucket", "left").withColumn("__hit", hit).drop("__bucket", "__bits", "__slot")
    return marked.filter("__hit").drop("__hit"), marked.filter("NOT __hit").drop("__hit")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], least: int = 20_000) -> Iterator[pd.DataFrame]:
    """Joins the batches of a partition that is sorted by keys, so that each frame has whole groups
    and, but for the last, at least `least` rows."""
    kept: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        if not len(pdf):
            continue
        kept.append(pdf)
        rows += len(pdf)
        if rows < least:
            continue
        whole = pd.concat(kept, ignore_index=True) if len(kept) > 1 else kept[0].reset_index(drop=True)
        last = np.ones(len(whole), bool)
        for k in keys:
            last &= (whole[k] == whole[k].iloc[-1]).to_numpy()
        cut = int(np.argmax(last))
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        kept = [whole.iloc[cut:]]
        rows = len(whole) - cut
    if rows:
        yield pd.concat(kept, ignore_index=True)


def bounds(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows, and the end."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


class Sets:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        up = self.up
        while True:
            nxt = up[up]
            if np.array_equal(nxt, up):
                return up
            up = nxt


def local_roots(link: np.ndarray) -> np.ndarray:
    """The smallest index that links (a symmetric boolean matrix) reach. Each row is looked at once, TILE at a time, so a
    bundle in which all are linked costs no more than its matrix."""
    root = np.arange(len(link))
    left = link.any(1)
    for i in range(len(link)):
        if not left[i]:
            continue
        reached = np.zeros(len(link), bool)
        reached[i] = True
        todo = np.array([i])
        while len(todo):
            new = np.zeros(len(link), bool)
            for k in range(0, len(todo), TILE):
                new |= link[todo[k : k + TILE]].any(0)
            new &= ~reached
            reached |= new
            todo = np.flatnonzero(new)
        root[reached] = i
        left &= ~reached
    return root


def row_sums(link: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """link @ weight for a boolean matrix, without a copy of it in whole numbers."""
    parts = [link[k : k + TILE] @ weight for k in range(0, len(link), TILE)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def block_pairs(df: DataFrame, size: str, by: str, most: int) -> DataFrame:
    """Adds __i and __j: a group (its row count is in column `size`) with more than `most` rows is
    cut into blocks by the hash of `by`, and each row goes to every pair of blocks that has its own.
    Any two rows of a group meet in exactly one (__i, __j), or in (b, b) if they share block b."""
    n = F.ceil(F.col(size) / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64(by, F.lit(7)), n).cast("int")
    both = F.explode(F.sequence(F.lit(0), n - 1)).alias("__k")
    return (
        df.withColumn("__own", own)
        .select("*", both)
        .withColumn("__i", F.least("__own", "__k"))
        .withColumn("__j", F.greatest("__own", "__k"))
        .drop("__k")
    )


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): root is the smallest node that the links reach. Alternates large-star and
    small-star; each round is a table in the shared folder. Nodes without links are left out.

    A hub may have a third of all links. Minima are aggregated before the shuffle; where they are joined back, both sides
    come by a shuffle that the join itself asks for (the minima, one row for each node, are dealt out by a hash of their own
    before), which lets adaptive execution split the hub's rows over many tasks."""
    e = table(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(e)
    while seen[0]:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("m")).union(e.select(F.col("v").alias("n"), F.col("u").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("low")).withColumn("low", F.least("n", "low"))
        large = both.join(low.repartition(F.xxhash64("n")), "n").filter("m > n").select(F.col("m").alias("u"), F.col("low").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least.repartition(F.xxhash64("u")), "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        nxt = table(small.union(least.select("u", F.col("low").alias("v"))).distinct(), "edges")
        now = mark(nxt)
        drop_table(e)
        e = nxt
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
