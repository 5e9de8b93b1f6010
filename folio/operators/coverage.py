"""Which sentences of a source are missing in the items made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators.items import SECTION_4, SECTION_5, before
from folio.operators.tools import strip_summary


def core_sections(body: Column) -> Column:
    """The body without its summary, up to section 4, else up to section 5."""
    return T.bind(strip_summary(body), lambda b: F.coalesce(before(b, SECTION_4), before(b, SECTION_5), b))


def missing_facts(content: Column, bodies: Column) -> Column:
    """Facts of the content that none of the bodies (an array) has, in order."""
    covered = T.coverage_text(F.array_join(F.transform(bodies, core_sections), "\n"))
    return T.bind(covered, lambda c: F.transform(F.filter(T.fact_pairs(content), lambda f: ~F.contains(c, f["k"])), lambda f: f["s"]))


def of_blocks(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, missing): what all items of a block together leave out."""
    per = items.groupBy(*keys).agg(F.min("content").alias("content"), F.collect_list("body").alias("bodies"))
    return per.select(*keys, missing_facts(F.col("content"), F.col("bodies")).alias("missing"))


def noted(body: Column, source_doc: Column, section: Column, missing: Column) -> Column:
    """The body with a note that lists up to 20 missing facts under section 1, or at its end."""
    listed = F.array_join(F.transform(F.slice(missing, 1, 20), lambda f: F.concat(F.lit("> - "), f)), "\n")
    note = F.concat(F.lit(f"\n\n{K.COVERAGE_NOTE}\n> 来源文档："), source_doc, F.lit("\n> 来源章节："), T.or_else(section, K.WHOLE_TEXT), F.lit(f"\n{K.COVERAGE_LIST}\n"), listed)
    match = rf"(?smd)\A(.*?^##{T.S}+1\.{T.S}+核心内容{T.S}*$)(.*)\z"
    put = F.concat(F.regexp_extract(body, match, 1), note, F.regexp_extract(body, match, 2))
    return F.when(body.rlike(match), put).otherwise(F.concat(T.strip_right(body), F.lit("\n\n## 人工复核提示"), note))


def with_warning(items: DataFrame, missing: Column) -> DataFrame:
    """Items that leave facts out become drafts that someone has to look at."""
    return (
        items.withColumn("status", F.lit("draft")).withColumn("review_status", F.lit("coverage_warning"))
        .withColumn("tags", F.when(F.array_contains("tags", K.REVIEW_TAG), F.col("tags")).otherwise(F.array_append("tags", K.REVIEW_TAG)))
        .withColumn("body", noted(F.col("body"), F.col("source_doc"), F.col("source_section"), missing))
    )
