"""Drafting that goes on where it stopped.

Progress is by content, not by place: a chunk is done if its document, section, piece and text are in the table of
items. resume() drafts only what is not; stream() does the same for files as they arrive, with Spark's checkpoint for
which files were seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folio.functions import text as T
from folio.operators.model_calls import KEY, keyed, stored
from folio.plans.draft import by_rules, chunks_of
from folio.sources.settings import DraftSettings

def remaining(chunks: DataFrame, done: DataFrame | None) -> DataFrame:
    """Chunks that the table of items doesn't have."""
    return chunks if done is None else chunks.join(done.select(*KEY).distinct(), KEY, "left_anti")


def resume(docs: DataFrame, done: DataFrame | None, catalogue: list[dict], status: str = "active", settings: DraftSettings | None = None, normalize=by_rules) -> DataFrame:
    return normalize(remaining(keyed(chunks_of(docs, settings)), done), catalogue, status)


def _documents(texts: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    return texts.select(F.abs(F.xxhash64("path")).alias("file_index"), name.alias("source_doc"), T.file_stem(name).alias("stem"), F.regexp_replace("value", "\r\n?", "\n").alias("markdown"))


def stream(spark: SparkSession, folder: str, table: str, checkpoint: str, catalogue: list[dict], status: str = "active") -> StreamingQuery:
    """Drafts all text files that are in the folder and were not seen before, then ends. Each batch is one append of the
    table, tagged by its number; a batch that is repeated after a failure first sees what it already wrote."""
    texts = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(folder).select(F.col("_metadata.file_path").alias("path"), "value")

    def put(batch: DataFrame, number: int) -> None:
        done = stored(spark, table)
        resume(_documents(batch.filter(F.lower("path").rlike(r"\.(md|markdown|txt)$"))), done, catalogue, status).withColumn("batch", F.lit(number)).write.mode("append").parquet(table)

    return texts.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry(failed_blocks: DataFrame, catalogue: list[dict], status: str = "active", normalize=by_rules) -> DataFrame:
    """Items for the chunks of failed files; source_order goes on from the failed item's own."""
    rows = failed_blocks.withColumn("file_index", F.lit(0)).withColumn("block_index", F.col("order")).withColumn("piece_index", F.lit(0)).withColumn("category_description", F.lit("")).withColumn("subcategory_description", F.lit(""))
    return normalize(rows, catalogue, status).withColumn("source_order", F.greatest(F.col("order") - 1, F.lit(0)) + F.col("item_index"))
