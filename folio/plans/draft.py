"""The draft plan: documents to named, ordered items, as one lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import chunking, coverage, items, model_calls, model_items, naming, parsing
from folio.sources.settings import DraftSettings


def chunks_of(docs: DataFrame, settings: DraftSettings | None = None, context: bool = True) -> DataFrame:
    s = settings or DraftSettings()
    rows = chunking.chunks(parsing.parse(docs), s.max_chars)
    return chunking.with_context(rows, s.context_chars, s.outline_max_sections) if context else rows


def by_rules(chunks: DataFrame, catalogue: list[dict], status: str) -> DataFrame:
    return items.normalize(chunks, catalogue, status).withColumn("item_index", F.lit(1))


def by_model(chunks: DataFrame, catalogue: list[dict], status: str, complete: Callable, store: str, spec: str = "", **options) -> DataFrame:
    """Items from the model's objects; chunks without any get the rules' item, marked failed. Answers go to the table
    `store` and are read from there, so each is paid for once."""
    asked = model_calls.answered(chunks, complete, store, status, spec, **options)
    good = model_items.from_objects(asked.filter("raw IS NOT NULL"), status)
    lacking = F.size("missing") > 0
    warned = coverage.with_warning(good.filter(lacking), F.col("missing")).unionByName(good.filter(~lacking))
    made = items.postprocess(warned.drop("missing"), catalogue)
    bad = items.failed(by_rules(asked.filter("raw IS NULL").drop("raw", "missing", "item_index"), catalogue, status))
    return made.unionByName(bad.select(*made.columns))


def draft(docs: DataFrame, catalogue: list[dict], timestamp: str, trace_id: str, status: str = "active", settings: DraftSettings | None = None, start: int = 0, normalize: Callable[[DataFrame, list[dict], str], DataFrame] = by_rules) -> DataFrame:
    """All items of the documents with source_order and file_name. Items by rules don't use the context, so its windows
    are only in the plan for a model."""
    rows = chunks_of(docs, settings, context=normalize is not by_rules)
    made = naming.source_order(normalize(rows, catalogue, status), start)
    name = naming.file_name(T.file_stem(F.col("source_doc")), F.lit(timestamp), F.lit(trace_id), F.col("review_status"), F.col("source_order"), F.col("kb_id"))
    return made.withColumn("file_name", name)
