"""Files that an earlier run wrote, read back."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T

FRONT = r"(?s)\A---\n(.*?)\n---\n(.*)\z"


def _yaml_json(text: str, strict: bool) -> tuple[str | None, str | None]:
    import yaml

    try:
        data = yaml.safe_load(text) or {}
        if not isinstance(data, dict):
            return ("{}", None) if not strict else (None, "front matter is no mapping")
        return json.dumps(data, ensure_ascii=False, default=str), None
    except yaml.YAMLError as e:
        return None, str(e)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of all .md files under a folder."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parsed(texts: DataFrame) -> DataFrame:
    """(path, error, meta map of field to JSON text, body, text)."""

    @F.pandas_udf("meta string, error string")
    def parse_yaml(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_yaml_json(t or "", True) for t in text], columns=["meta", "error"])

    front, has = F.regexp_extract("text", FRONT, 1), F.col("text").rlike(FRONT)
    return (
        texts.withColumn("__y", F.when(has, parse_yaml(front)))
        .select(
            "path",
            F.when(~has, F.lit("缺少 YAML Front Matter")).otherwise(F.col("__y.error")).alias("error"),
            F.from_json("__y.meta", "map<string,string>").alias("meta"),
            F.when(has, T.strip(F.regexp_extract("text", FRONT, 2))).alias("body"),
            "text",
        )
    )


def failed_source(text: Column) -> Column:
    """What stands after the first failed_chunk_source heading, out of its fence; "" without one."""
    x = T.strip(F.regexp_extract(text, r"(?s)\A.*?## failed_chunk_source(.*)\z", 1))
    fenced = F.regexp_replace(F.regexp_replace(x, r"\A```[^\n]*\n", ""), r"```\z", "")
    return T.strip(F.when(x.rlike(r"\A```[^\n]*\n"), fenced).when(x.startswith("```"), F.regexp_replace(x, r"```\z", "")).otherwise(x))


def failed_blocks(files: DataFrame) -> DataFrame:
    """The chunks of failed files, as far as a file tells them: rows of parsed() whose name has `failed` in it."""
    text = lambda f: F.coalesce(F.nullif(F.col("meta")[f], F.lit("null")), F.lit(""))
    listed = lambda f: F.coalesce(F.from_json(F.col("meta")[f], "array<string>"), F.array().cast("array<string>"))
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    pages = F.transform(F.filter(listed("source_pages"), lambda p: T.matches(p, "[0-9]+")), lambda p: p.cast("int"))
    items = F.coalesce(F.from_json(F.col("meta")["related_items"], "array<struct<" + ",".join(f"`{k}`:string" for k in K.RELATED_KEYS) + ">>"), F.array().cast("array<struct<" + ",".join(f"`{k}`:string" for k in K.RELATED_KEYS) + ">>"))
    return (
        files.withColumn("content", failed_source(F.col("text"))).filter(F.lower(T.file_stem(name)).contains("failed") & (F.col("content") != ""))
        .select(
            "path", T.or_else(text("source_doc"), T.file_stem(name)).alias("source_doc"), text("source_section").alias("source_section"), "content", pages.alias("pages"),
            F.coalesce(text("source_order").try_cast("int"), F.lit(0)).alias("order"), text("category").alias("category"), listed("category_keywords").alias("category_keywords"), text("source_doc_description").alias("source_doc_description"),
            text("subcategory").alias("subcategory"), listed("category_path").alias("category_path"), listed("related_categories").alias("related_categories"), listed("relation_notes").alias("relation_notes"), items.alias("related_items"), F.lit("").alias("context"),
        )
    )
