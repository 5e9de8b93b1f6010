"""Documents to blocks, with the profile of each document and block.

A document is a row: file_index, source_doc, stem, markdown. Documents are dealt out once; all that concerns one document
alone is a projection over its row or a window over its blocks, so nothing else is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators.keywords import keyword_lists

#: What identifies a document, and orders documents.
DOC = ["file_index", "source_doc"]
BLOCK = [*DOC, "block_index"]


def strip_page_markers(markdown: Column) -> Column:
    return F.array_join(F.filter(T.lines(markdown), lambda x: ~T.is_noise(T.strip(x))), "\n")


def recover_headings(markdown: Column) -> Column:
    return F.array_join(F.transform(T.lines(markdown), T.recovered), "\n")


def pieces(markdown: Column) -> Column:
    """The texts between headings of up to four marks: array<struct<content, section>>."""
    kept = F.transform(F.filter(T.lines(markdown), lambda x: ~T.is_noise(T.strip(x))), T.recovered)
    cut = F.filter(F.transform(F.split(F.array_join(kept, "\n"), rf"\n(?=#{{1,4}}{T.S}+)"), T.strip), lambda x: x != "")
    return F.transform(cut, lambda x, i: F.struct(x.alias("content"), T.or_else(T.first_heading(x), F.concat(F.lit(f"{K.PIECE} "), (i + 1).cast("string"))).alias("section")))


def pages_of(section: Column) -> Column:
    digits = F.regexp_extract_all(section, F.lit(rf"第{T.S}*(\p{{Nd}}+){T.S}*页"), F.lit(1))
    return F.transform(digits, lambda d: F.translate(d, "０１２３４５６７８９", "0123456789").cast("int"))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows by their document in so many partitions that all cores have several. A number that is given is kept: the work on a
    byte of text is much, and partitions joined by their size would leave cores idle. Rows that lie so already stay."""
    return rows.repartition(max(4 * rows.sparkSession.sparkContext.defaultParallelism, 16), *DOC)


def document_profile(docs: DataFrame) -> DataFrame:
    """Adds pieces, category, category_description, doc_keywords and source_doc_description."""
    heading = rf"\A#{{1,4}}{T.S}+([^\n]+)\z"
    top = rf"\A#{T.S}+([^\n]+)\z"
    lines = F.transform(T.lines(F.col("markdown")), T.strip)
    first_title = T.first_group(F.get(F.filter(F.slice(F.col("__lines"), 1, 80), lambda x: x.rlike(top)), F.lit(0)), top)
    first_section = F.get(F.col("pieces"), F.lit(0))["section"]
    category = F.coalesce(first_title, F.when(first_section.isNotNull() & ~first_section.startswith(K.PIECE), first_section), F.col("stem"))
    raw = F.filter(F.transform(F.filter(F.col("__lines"), lambda x: x.rlike(heading)), lambda x: T.first_group(x, heading)), T.useful_heading)
    sections = F.filter(F.transform(F.slice(F.col("pieces"), 1, 12), lambda p: p["section"]), T.useful_heading)
    headings = F.slice(T.distinct_clean(F.when(F.size(raw) > 0, raw).otherwise(sections)), 1, 12)
    others = F.filter(F.col("headings"), lambda h: h != F.col("category"))
    book = lambda a, b, c: F.concat(F.lit(a), F.col("category"), F.lit(b), F.when(F.size(others) > 0, c))
    description = F.coalesce(
        book("本分类对应来源文档《", "》，用于归集与", F.concat(F.array_join(F.slice(others, 1, 4), "、"), F.lit("相关的知识条目。"))),
        F.concat(F.lit("本分类对应来源文档《"), F.col("category"), F.lit("》，用于归集该文档中的知识条目。")),
    )
    overall = F.coalesce(
        book("本文件围绕《", "》展开，主要覆盖", F.concat(F.array_join(F.slice(others, 1, 6), "、"), F.lit("等主题。"))),
        F.concat(F.lit("本文件围绕《"), F.col("category"), F.lit("》展开，用于沉淀来源文档中的主要知识条目。")),
    )
    parts = lambda seed: F.filter(F.transform(F.split(seed, rf"[{T.SPACE},，、;；/／|｜（）()《》【】\\-]+"), T.clean_category), lambda p: F.length(p) >= 2)
    keywords = F.slice(T.distinct_clean(F.flatten(F.transform(F.concat(F.array("category"), F.col("headings")), lambda s: F.concat(parts(s), F.array(s))))), 1, 16)
    return (
        docs.withColumn("pieces", pieces(F.col("markdown"))).withColumn("__lines", lines)
        .withColumn("category", T.clean_category(category)).withColumn("headings", headings)
        .withColumn("category_description", description).withColumn("source_doc_description", overall).withColumn("doc_keywords", keywords)
        .drop("__lines")
    )


def blocks(profiled: DataFrame) -> DataFrame:
    """One row for each block of document_profile()'s documents, without related sections."""
    piece = lambda p: F.struct(p["section"].alias("section"), p["content"].alias("content"), T.subcategory_of(p["section"], p["content"]).alias("subcategory"))
    # an inner explode of a column would have the pieces made once more, to leave out documents without any
    cut = profiled.select(*DOC, "category", "category_description", "source_doc_description", "doc_keywords", F.posexplode_outer(F.transform("pieces", piece)).alias("block_index", "piece"))
    rows = cut.filter("block_index IS NOT NULL").select(
        *DOC, "block_index", F.col("piece.section").alias("source_section"), F.col("piece.content").alias("content"), F.col("piece.subcategory").alias("subcategory"), "category", "category_description", "source_doc_description", "doc_keywords"
    )
    cat, sub, said = F.col("category"), F.col("subcategory"), F.col("category_description")
    q = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    made = (
        rows.withColumn("order", F.col("block_index"))
        .withColumn("pages", pages_of(F.col("source_section")))
        .withColumn("__lists", keyword_lists(cat, sub, F.col("content"), F.array_join(F.slice("doc_keywords", 1, 3), " ")))
        .withColumn("category_keywords", F.col("__lists.all")).withColumn("plain_keywords", F.col("__lists.own")).drop("__lists")
        .withColumn("category_description", F.when(F.instr(said, cat) == 0, q("本大类来源于文档结构中的“", cat, "”，用于承载该主题下的相关知识条目。")).otherwise(said))
        .withColumn("subcategory_description", F.when(sub == cat, q("用于说明“", cat, "”主题下的具体内容、边界和使用提示。")).otherwise(q("用于说明“", sub, "”在“", cat, "”大类下的具体内容、边界和关联提示。")))
        .withColumn("category_path", F.when(sub != cat, F.array(cat, sub)).otherwise(F.array(cat)))
    )
    return dealt(made)  # Spark forgets where rows are after a Python function


def siblings(rows: DataFrame) -> DataFrame:
    """The different (section, subcategory, keywords without the document's) of each document, numbered as they come."""
    plain = rows.select(*DOC, "block_index", "source_section", "subcategory", F.col("plain_keywords").alias("keywords"))
    first = plain.groupBy(*DOC, "source_section", "subcategory", "keywords").agg(F.min("block_index").alias("first"))
    w = Window.partitionBy(*DOC)
    return (
        first.withColumn("idx", F.row_number().over(w.orderBy("first")) - 1)
        .withColumn("own_idx", F.min("idx").over(Window.partitionBy(*DOC, "source_section", "subcategory")))
    )


def _best_related(told: Column, current: Column, words: Column, family: Column, titles: Column, own: Column) -> Column:
    """Up to five of the sections `told`, whose place is their number, best first: array<struct<n, title, info, relevance, score>>."""
    shared = lambda e: F.array_intersect(words, e["words"])
    named = lambda e: F.array_intersect(titles, e["titles"])
    same = lambda e: ((family != "") & (family == e["family"])).cast("int")
    distance = lambda i: F.abs(i - current)

    def scored(e: Column, i: Column) -> Column:
        score = F.size(shared(e)) * 3.0 + F.size(named(e)) * 2.0 + same(e) * 2.0 - F.least(distance(i), F.lit(8)) * 0.25
        return F.when(e["useful"] & (e["name"] != own), F.struct(score.alias("score"), distance(i).alias("distance"), e["name"].alias("name"), i.alias("i")))

    by_length = lambda xs: F.transform(F.array_sort(F.transform(xs, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))), lambda r: r["x"])
    reasons = lambda e: F.slice(T.distinct_clean(F.concat(by_length(shared(e)), by_length(named(e)))), 1, 3)

    def said(r: Column) -> Column:
        return T.bind(F.get(told, r["i"]), lambda e: F.struct(r["score"].alias("score"), r["distance"].alias("distance"), reasons(e).alias("reasons"), same(e).alias("same")))

    def item(r: Column, name: Column, k: Column) -> Column:
        info = F.concat(
            T.or_else(F.concat_ws("；",
                F.when(F.size(r["reasons"]) > 0, F.concat(F.lit("与当前小类共享核心语义："), F.array_join(r["reasons"], "、"))),
                F.when(r["same"] == 1, F.lit("来源结构处于同一章节组")),
                F.when(r["distance"] <= 2, F.lit("章节位置接近"))), "与当前小类存在可参考的相近主题"),
            F.lit("。"),
        )
        relevance = F.when(r["score"] >= 5, "高").when((r["score"] >= 2) | (r["distance"] <= 2), "一般").otherwise("低")
        return F.struct((k + 1).alias("n"), name.alias("title"), info.alias("info"), relevance.alias("relevance"), r["score"].alias("score"))

    def top(ranked: Column) -> Column:
        # of one name the best, the farther of equals. At one distance there are two sections at most, one before and one
        # after; between those the reasons decide, which are only made for the few that are left
        def of_name(name: Column, k: Column) -> Column:
            equal = lambda rs: F.filter(rs, lambda r: (r["score"] == rs[0]["score"]) & (r["distance"] == rs[0]["distance"]))
            tied = T.bind(F.filter(ranked, lambda r: r["name"] == name), equal)
            return T.bind(F.array_max(F.transform(tied, said)), lambda r: item(r, name, k))

        return F.transform(F.slice(F.array_distinct(F.transform(ranked, lambda r: r["name"])), 1, 5), of_name)

    return T.bind(F.sort_array(F.filter(F.transform(told, scored), lambda r: r.isNotNull()), asc=False), top)


def related(rows: DataFrame) -> DataFrame:
    """Adds related: the up to five best sections of the same document, best first. Each row sees the different sections of
    its document in an array, so sections don't meet in a join, and rows are worked on where they are."""
    section, sub = F.col("source_section"), F.col("subcategory")
    of_kind = Window.partitionBy(*DOC, "source_section", "subcategory")
    first = F.row_number().over(Window.partitionBy(*DOC, "source_section", "subcategory", "plain_keywords").orderBy("block_index")) == 1
    told = F.struct(
        F.col("block_index").alias("at"), sub.alias("name"), F.col("plain_keywords").alias("words"), F.col("__family").alias("family"), F.col("__titles").alias("titles"), F.col("__useful").alias("useful")
    )
    whole = Window.partitionBy(*DOC).orderBy("block_index").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    current = lambda ts: F.array_position(F.transform(ts, lambda e: e["at"]), F.col("__own")).cast("int") - 1
    best = T.bind(F.col("__told"), lambda ts: T.bind(current(ts), lambda c: _best_related(ts, c, F.col("category_keywords"), F.col("__family"), F.col("__titles"), sub)))
    return (
        rows.withColumns({"__family": T.family_key(section), "__titles": T.tokens(sub), "__useful": T.useful_heading(sub)})
        .withColumns({"__first": first, "__own": F.min("block_index").over(of_kind)})
        .withColumn("__told", F.collect_list(F.when(F.col("__first"), told)).over(whole)).withColumn("related", best)
        .drop("__family", "__titles", "__useful", "__first", "__own", "__told")
    )


def with_related(rows: DataFrame) -> DataFrame:
    """Adds related_items (the four fixed keys), related_categories and relation_notes."""
    cat, sub = F.col("category"), F.col("subcategory")
    keys = K.RELATED_KEYS
    return (
        related(rows)
        .withColumn("related_items", F.transform("related", lambda x: F.struct(cat.alias(keys[0]), x["title"].alias(keys[1]), x["info"].alias(keys[2]), x["relevance"].alias(keys[3]))))
        .withColumn("related_categories", F.transform("related", lambda x: x["title"]))
        .withColumn("relation_notes", F.transform(F.slice("related_categories", 1, 3), lambda n: F.concat(F.lit("“"), sub, F.lit("”与“"), n, F.lit("”同属“"), cat, F.lit("”大类，回答时应结合来源章节区分适用场景、交互对象和处理要求。"))))
        .drop("related")
    )


def parse(docs: DataFrame) -> DataFrame:
    """Blocks of documents with their whole profile."""
    return with_related(blocks(document_profile(docs)))
