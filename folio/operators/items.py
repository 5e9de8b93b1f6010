"""Chunks to knowledge items by rules, and the parts of a body that are always rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators import tools as tool_match

#: A heading of a numbered section; the text of a section runs to the next one that matters.
SECTION_4 = rf"(?md)^##{T.S}+4\.{T.S}+关联能力{T.S}*$"
SECTION_5 = rf"(?md)^##{T.S}+5\.{T.S}+来源依据{T.S}*$"
SUMMARY_MARK = "知识分类："


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def guess_title(section: Column, content: Column) -> Column:
    return T.or_else(F.substring(T.first_heading(content), 1, 80), T.or_else(F.substring(section, 1, 80), K.UNTITLED_ITEM))


def guess_category(category: Column, source_doc: Column) -> Column:
    stem = T.strip(F.regexp_replace(source_doc, r"\.[^.]*\z", ""))
    return T.or_else(category, T.or_else(F.substring(stem, 1, 80), K.UNSORTED))


def build_body(title: Column, content: Column) -> Column:
    text = T.strip(F.regexp_replace(T.strip(content), rf"\A#{{1,4}}{T.S}+[^\n]+\n?", ""))
    answers = (text, F.lit(K.NOT_STATED), F.lit(K.USE_RULE), F.lit(K.NO_TOOLS), F.lit(K.SOURCE_BODY))
    sections = [p for i, (name, a) in enumerate(zip(K.SECTION_TITLES, answers, strict=True), 1) for p in (f"\n\n## {i}. {name}\n\n", a)]
    return T.strip(_cat("# ", title, *sections))


def kb_id(doc_type: Column, title: Column, seed: Column, number: Column) -> Column:
    return _cat(doc_type, "-offline-", F.substring(F.md5(F.concat_ws(":", seed, title, number.cast("string"))), 1, 10), "-v1")


def source_seed() -> Column:
    return F.concat_ws(":", "source_doc", "source_section", F.col("order").cast("string"))


def unique_pages(pages: Column) -> Column:
    return F.array_sort(F.array_distinct(pages))


def source_trace(section: Column, pages: Column) -> Column:
    return _cat("section=", section, F.when(F.size(pages) > 0, _cat("; pages=", F.array_join(unique_pages(pages).cast("array<string>"), ","))).otherwise(""))


def heuristic(chunks: DataFrame, status: str = "active") -> DataFrame:
    """One item for each chunk; the chunk's own columns stay for what follows."""
    empty = F.array().cast("array<string>")
    category = guess_category(F.col("category"), F.col("source_doc"))
    title = guess_title(F.col("source_section"), F.col("content"))
    return (
        chunks.withColumn("title", title)
        .withColumn("doc_type", F.lit("biz"))
        .withColumn("kb_id", kb_id(F.col("doc_type"), F.col("title"), source_seed(), F.lit(1)))
        .withColumn("body", build_body(F.col("title"), F.col("content")))
        .withColumn("source_version", T.guess_version(_cat(F.col("source_doc"), " ", F.col("content"))))
        .withColumn("category", category)
        .withColumn("category_keywords", F.when(F.size("category_keywords") > 0, F.col("category_keywords")).otherwise(F.array("category")))
        .withColumn("subcategory", T.or_else(F.col("subcategory"), F.col("category")))
        .withColumns({"domain": F.lit(K.DOMAIN), "owner": F.lit(K.OWNER), "confidentiality": F.lit(K.CONFIDENTIALITY), "risk_level": F.lit("low"), "effective_date": F.lit(""), "status": F.lit(status), "review_status": F.lit("pending")})
        .withColumns({"business_modules": empty, "applicable_roles": empty, "tags": empty})
        .withColumn("source_pages", unique_pages(F.col("pages"))).withColumn("source_trace", source_trace(F.col("source_section"), F.col("pages")))
    )


# --- sections of a body ---------------------------------------------------------------------------


def related_json(related: Column) -> Column:
    """The related items as JSON, indented by two."""
    quote = lambda x: F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)
    entry = lambda r: _cat("  {\n", F.concat_ws(",\n", *[_cat(f'    "{k}": ', quote(r[k])) for k in K.RELATED_KEYS]), "\n  }")
    return _cat("[\n", F.array_join(F.transform(related, entry), ",\n"), "\n]")


def related_or_legacy(category: Column, related: Column, categories: Column, notes: Column) -> Column:
    """related, or the same made from the older parallel lists."""
    clean = lambda n: T.bind(T.clean_relation(n), lambda c: F.when((c != "") & ~F.substring(c, 1, 20).contains("同属"), c).otherwise(K.LEGACY_RELATION))
    note = lambda i: F.coalesce(F.get(notes, i), F.lit(""))
    k = K.RELATED_KEYS
    legacy = F.transform(F.slice(categories, 1, 6), lambda n, i: F.struct(category.alias(k[0]), n.alias(k[1]), clean(note(i)).alias(k[2]), F.when(i < 3, "高").otherwise("一般").alias(k[3])))
    return F.when(F.size(related) > 0, related).otherwise(legacy)


def merged_related(*lists: Column) -> Column:
    """Up to eight items of all lists in order, the first of each class and subclass."""
    k = K.RELATED_KEYS
    clean = F.filter(F.transform(F.concat(*lists), lambda r: F.struct(T.clean_taxonomy(r[k[0]]).alias(k[0]), T.clean_taxonomy(r[k[1]]).alias(k[1]), T.clean_relation(r[k[2]]).alias(k[2]), T.clean_relevance(r[k[3]]).alias(k[3]))), lambda r: r[k[1]] != "")

    def first(rows: Column) -> Column:
        name = lambda r: F.concat(r[k[0]], F.lit("\n"), r[k[1]])
        return T.bind(F.transform(rows, name), lambda keys: F.filter(rows, lambda r, i: F.array_position(keys, name(r)) == i + 1))

    return F.slice(T.bind(clean, first), 1, 8)


def category_summary(category: Column, subcategory: Column, keywords: Column, related: Column) -> Column:
    head = _cat(f"{SUMMARY_MARK}\n大类标题：", T.or_else(category, K.UNSORTED), "\n小类标题：", T.or_else(subcategory, "无"), "\n关键词：", T.or_else(F.array_join(keywords, "、"), "无"))
    return F.when(F.size(related) > 0, _cat(head, "\n关联信息：\n", related_json(related))).otherwise(head)


def with_summary(body: Column, summary: Column) -> Column:
    """The summary goes under the title, or in front; a body that has one stays."""
    titled = lambda p: T.strip(_cat(F.get(p, F.lit(0)), "\n\n", summary, "\n\n", F.array_join(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), "\n")))
    put = lambda x: F.when(x == "", summary).when(x.startswith("# "), T.bind(T.lines(x), titled)).otherwise(_cat(summary, "\n\n", x))
    return F.when(body.contains(SUMMARY_MARK), body).otherwise(T.bind(T.strip(body), put))


def _rewritten(body: Column, head: str, until: str, replacement: Column, end: str, new: str) -> Column:
    """Sets the text of the first section whose heading matches `head`, up to the first match of `until` after it. The
    parts are put together as data, so nothing in them is read as a pattern. Each pattern is searched once, and what it found
    is looked for as it is: it stands at the start of a line, and where it first does is the first match."""
    place = lambda x, line: F.when(F.startswith(x, line), F.lit(1)).otherwise(F.instr(x, F.concat(F.lit("\n"), line)) + 1)
    rest = lambda x, at: F.substring(x, at, F.length(x))
    tail = lambda r: T.bind(F.regexp_extract(r, rf"(?md)^##{T.S}+{until}", 0), lambda line: F.when(line == "", "").otherwise(rest(r, place(r, line))))

    def changed(b: Column, line: Column) -> Column:
        put = lambda at: _cat(F.substring(b, F.lit(1), at - 1), T.strip_right(line), "\n\n", replacement, end, T.bind(rest(b, at + F.length(line)), tail))
        return T.strip(T.bind(place(b, line), put))

    added = lambda b: T.strip(_cat(T.strip_right(b), f"\n\n{new}\n\n", replacement))
    heading = lambda b: F.regexp_extract(b, rf"(?md)^##{T.S}+{head}{T.S}*\n", 0)
    return T.bind(body, lambda b: T.bind(heading(b), lambda line: F.when(line == "", added(b)).otherwise(changed(b, line))))


def rewrite_functions(body: Column, replacement: Column) -> Column:
    return _rewritten(body, r"4\." + T.S + "+关联能力", r"5\." + T.S + "+来源依据", replacement, "\n\n", "## 4. 关联能力")


def source_section(source_doc: Column, section: Column, pages: Column) -> Column:
    listed = F.when(F.size(pages) > 0, _cat("- 来源页码：", F.array_join(unique_pages(pages).cast("array<string>"), "、"), "\n")).otherwise("")
    return _cat("- 来源文档：", source_doc, "\n- 来源章节：", T.or_else(section, K.WHOLE_TEXT), "\n", listed, K.SOURCE_NOTE)


def rewrite_source(body: Column, replacement: Column) -> Column:
    return _rewritten(body, r"5\." + T.S + "+来源依据", r"\p{Nd}+\.", replacement, "\n", "## 5. 来源依据")


def strip_page_lines(x: Column) -> Column:
    start, n = rf"(?md)^{T.S}*(?:[-*]{T.S}*)?", r"\p{Nd}"
    x = T.replaced(x, "来源页码", rf"{start}来源页码[：:][^\n]*\n?", "")
    x = T.replaced(x, "页码", rf"{start}页码[：:]{T.S}*{n}+(?:{T.S}*[,，、]{T.S}*{n}+)*{T.S}*\n?", "")
    x = T.replaced(x, "页", rf"{start}第{T.S}*{n}{{1,4}}{T.S}*页(?:{T.S}*/{T.S}*共{T.S}*{n}{{1,4}}{T.S}*页)?{T.S}*\n?", "")
    return T.strip(T.replaced(x, "\n\n\n", "\n{3,}", "\n\n"))


def before(body: Column, pattern: str) -> Column:
    """The text before the first match, null without one."""
    return F.when(body.rlike(pattern), F.split(body, pattern, 2)[0])


def strip_page_markers(body: Column) -> Column:
    head = before(body, SECTION_5)
    tail = F.substring(body, F.length(head) + 1, F.length(body))
    return F.when(head.isNull(), strip_page_lines(body)).otherwise(T.strip(_cat(strip_page_lines(head), "\n\n", T.strip_left(tail))))


def describes_function(source_doc: Column, section: Column, content: Column) -> Column:
    return F.lower(F.concat_ws("\n", source_doc, section, content)).rlike("function_name|input_schema|output_schema|函数名称|入参|出参")


def postprocess(items: DataFrame, catalogue: list[dict]) -> DataFrame:
    """Summary, matched tools, sources and page markers, in this order, and the check of the type."""
    related = related_or_legacy(F.col("category"), F.col("related_items"), F.col("related_categories"), F.col("relation_notes"))
    own = F.col("doc_type").eqNullSafe("function") & ~describes_function(F.col("source_doc"), F.col("source_section"), F.col("content"))
    out = (
        items.withColumn("body", with_summary(F.col("body"), category_summary(F.col("category"), F.col("subcategory"), F.col("category_keywords"), related)))
        .withColumn("matched_tools", tool_match.matched(F.concat_ws("\n", "source_section", "content", "title", "body"), catalogue))
        .withColumn("body", rewrite_functions(F.col("body"), tool_match.section(F.col("matched_tools"), catalogue)))
        .withColumn("body", rewrite_source(F.col("body"), source_section(F.col("source_doc"), F.col("source_section"), F.col("pages"))))
        .withColumn("body", strip_page_markers(F.col("body")))
    )
    return out.withColumn("kb_id", F.when(own, F.regexp_replace("kb_id", r"\Afunction-", "biz-")).otherwise(F.col("kb_id"))).withColumn("doc_type", F.when(own, "biz").otherwise(F.col("doc_type")))


def failed(items: DataFrame) -> DataFrame:
    """Marks items that stand in for a failed model call, with the chunk at their end."""
    note = _cat(T.strip(F.col("body")), "\n\n", K.FAILED_NOTE, T.strip(F.col("content")), "\n```")
    return items.withColumn("review_status", F.lit("failed")).withColumn("body", T.strip(note))


def normalize(chunks: DataFrame, catalogue: list[dict], status: str = "active") -> DataFrame:
    return postprocess(heuristic(chunks, status), catalogue)


def metadata(items: DataFrame) -> DataFrame:
    """The fields of the front matter, in their order."""
    return items.select(*K.ITEM_FIELDS)
