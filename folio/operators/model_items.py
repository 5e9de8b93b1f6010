"""Items out of what a model returned: JSON objects joined with the chunk they were made from.

raw is a column of JSON text, one object for each row; the other columns are the chunk's, and item_index counts the
objects of a chunk from 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators import items as I
from folio.operators.coverage import core_sections


def _raw(name: str) -> Column:
    """A field as text, "" where it is missing, null or false."""
    return F.coalesce(F.get_json_object("raw", f"$['{name}']"), F.lit(""))


def _list(name: str) -> Column:
    text = F.get_json_object("raw", f"$['{name}']")
    parsed = F.from_json(text, "array<string>")
    clean = F.filter(F.transform(parsed, lambda v: T.strip(F.coalesce(v, F.lit("None")))), lambda v: v != "")
    return F.when(text.startswith("[") & parsed.isNotNull(), clean).otherwise(T.as_list(text))


def keywords(raw: Column, own: Column, subcategory: Column, category: Column, body: Column, content: Column) -> Column:
    """The best tokens of the model's list, the chunk's, the subclass (three times), the core sections and the text."""
    bag = lambda title: F.concat(raw, own, title, title, title, T.item_tokens(core_sections(body)), T.item_tokens(F.substring(content, 1, 1200)))
    # what the lists hold need not be tokens
    values = F.filter(F.transform(T.bind(T.item_tokens(subcategory), bag), T.clean_item_keyword), lambda t: t != "")
    return T.rank_tokens(values, F.transform(T.item_tokens(category), T.clean_item_keyword))


def related_of(raw: Column, category: Column) -> Column:
    """A model's related items under any of their names, in the four fixed keys."""
    k = K.RELATED_KEYS
    names = {k[0]: (k[0], "大类", "category"), k[1]: (k[1], "小类", "subcategory", "title"), k[2]: (k[2], "关联信息", "说明", "reason"), k[3]: (k[3], "relevance")}
    entries = F.filter(F.coalesce(F.from_json(F.get_json_object(raw, "$.related_items"), "array<string>"), F.array().cast("array<string>")), lambda x: x.startswith("{"))

    def one(x: Column) -> Column:
        m = F.from_json(x, "map<string,string>")
        pick = lambda key: F.coalesce(*[F.nullif(m[n], F.lit("")) for n in names[key]], F.lit(""))
        return F.struct(
            T.or_else(T.clean_taxonomy(T.or_else(pick(k[0]), category)), category).alias(k[0]), T.clean_taxonomy(pick(k[1])).alias(k[1]),
            T.or_else(T.clean_relation(pick(k[2])), K.LEGACY_RELATION).alias(k[2]), T.clean_relevance(pick(k[3])).alias(k[3]),
        )

    return F.filter(F.transform(entries, one), lambda r: r[k[1]] != "")


def from_objects(rows: DataFrame, status: str = "active") -> DataFrame:
    """Items with all fields, where the object has them, else the chunk's or the rules'."""
    distinct = lambda values: T.distinct_clean(values, T.clean_taxonomy)
    kind = T.strip(T.or_else(_raw("doc_type"), "biz"))
    own_path = F.when(F.size("category_path") > 0, F.col("category_path"))
    related = F.concat(related_of(F.col("raw"), F.col("__cat")), F.col("related_items"))
    return (
        rows.withColumn("title", T.strip(T.or_else(_raw("title"), I.guess_title(F.col("source_section"), F.col("content")))))
        .withColumn("doc_type", F.when(kind.isin(*K.DOC_TYPES), kind).otherwise("biz"))
        .withColumn("__cat", T.strip(T.or_else(_raw("category"), I.guess_category(F.col("category"), F.col("source_doc")))))
        .withColumn("__sub", T.clean_taxonomy(T.or_else(_raw("subcategory"), T.or_else(F.col("subcategory"), F.col("__cat")))))
        .withColumn("body", T.strip(T.or_else(_raw("body"), I.build_body(F.col("title"), F.col("content")))))
        .withColumn("body", F.when(F.col("body").startswith("# "), F.col("body")).otherwise(F.concat(F.lit("# "), "title", F.lit("\n\n"), "body")))
        .withColumn("kb_id", I.kb_id(F.col("doc_type"), F.col("title"), I.source_seed(), F.col("item_index")))
        .withColumn("category_keywords", keywords(_list("category_keywords"), F.col("category_keywords"), F.col("subcategory"), F.col("category"), F.col("body"), F.col("content")))
        .withColumn("category_path", distinct(F.concat(F.array("__cat"), F.coalesce(F.nullif(_list("category_path"), F.array().cast("array<string>")), own_path, F.array("__cat", "__sub")), F.array("__sub"))))
        .withColumn("related_categories", F.slice(distinct(F.concat(_list("related_categories"), F.col("related_categories"))), 1, 8))
        .withColumn("relation_notes", T.clean_notes(F.concat(_list("relation_notes"), F.col("relation_notes"))))
        .withColumn("__related", related)
        .withColumn("related_items", I.merged_related(F.when(F.size("__related") > 0, F.col("__related")).otherwise(I.related_or_legacy(F.col("__cat"), F.col("__related"), F.col("related_categories"), F.col("relation_notes")))))
        .withColumn("source_version", T.or_else(_raw("source_version"), T.guess_version(F.concat("source_doc", F.lit(" "), "content"))))
        .withColumn("source_doc_description", T.clean_description(T.or_else(_raw("source_doc_description"), F.col("source_doc_description"))))
        .withColumn("risk_level", T.risk_level(_raw("risk_level")))
        .withColumns({c: _list(c) for c in ("business_modules", "applicable_roles", "tags")})
        .withColumns({"domain": F.lit(K.DOMAIN), "owner": F.lit(K.OWNER), "confidentiality": F.lit(K.CONFIDENTIALITY), "effective_date": F.lit(""), "status": F.lit(status), "review_status": F.lit("pending")})
        .withColumn("source_pages", I.unique_pages(F.col("pages"))).withColumn("source_trace", I.source_trace(F.col("source_section"), F.col("pages")))
        .withColumn("category", F.col("__cat")).withColumn("subcategory", F.col("__sub")).drop("__cat", "__sub", "__related", "raw")
    )
