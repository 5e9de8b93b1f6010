"""Order and file names of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.parsing import DOC

FILES = 4096


def source_order(items: DataFrame, start: int = 0) -> DataFrame:
    """Numbers all items from start + 1 in the order of files, blocks, pieces and items. Counts are summed by file, then by
    FILES consecutive files, and rows are numbered within their file, so no task needs all items or all files."""
    order = [c for c in ("block_index", "piece_index", "item_index") if c in items.columns]
    counts = items.groupBy(*DOC).agg(F.count("*").alias("__n")).withColumn("__b", F.floor(F.col("file_index") / FILES))
    # the sum of a bucket is its last running sum: both readers take the same window, so the items are counted once
    running = counts.withColumn("__sum", F.sum("__n").over(Window.partitionBy("__b").orderBy("file_index", "source_doc")))
    buckets = running.groupBy("__b").agg(F.max("__sum").alias("__all")).withColumn("__before", F.sum("__all").over(Window.orderBy("__b")) - F.col("__all")).drop("__all")
    base = running.join(buckets, "__b").select(*DOC, (F.col("__sum") - F.col("__n") + F.col("__before")).alias("__base"))
    own = F.row_number().over(Window.partitionBy(*DOC).orderBy(*order))
    return items.withColumn("__own", own).join(base, DOC).withColumn("source_order", (F.col("__base") + F.col("__own") + start).cast("long")).drop("__own", "__base")


def file_name(title: Column, timestamp: Column, trace_id: Column, review_status: Column, order: Column, kb_id: Column) -> Column:
    safe = lambda x: F.when(F.coalesce(x, F.lit("")) != "", T.safe_name(x))
    return F.concat(F.concat_ws("-", safe(title), safe(timestamp), safe(trace_id), F.when(review_status == "failed", "failed"), T.order_prefix(order), safe(kb_id)), F.lit(".md"))
