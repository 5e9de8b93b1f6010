"""Blocks to chunks of bounded size, with the context of their neighbours.

Short parent sections take in the child sections that follow: the fold over a document's blocks is a running count of
parents and a running minimum, so it is windows, not a loop. Packing by size is a native fold over a chunk's parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators.parsing import BLOCK, DOC


def merge_children(rows: DataFrame) -> DataFrame:
    """Each parent (numbered N.N, under 120 characters) takes in the directly following N.N.* blocks."""
    w = Window.partitionBy(*DOC).orderBy("block_index")
    prefix = T.section_prefix(F.col("source_section"))
    marked = (
        rows.withColumn("__parent", (prefix != "") & (F.length(T.strip(F.col("content"))) < K.PARENT_CHARS))
        .withColumn("__segment", F.sum(F.col("__parent").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    s = Window.partitionBy(*DOC, "__segment").orderBy("block_index").rowsBetween(Window.unboundedPreceding, 0)
    child = (F.col("__segment") > 0) & (F.col("__parent") | T.strip(F.col("source_section")).startswith(F.concat(F.first(prefix).over(s), F.lit("."))))
    marked = marked.withColumn("__run", F.min(child.cast("int")).over(s)).withColumn("__head", F.when(F.col("__run") == 1, F.first("block_index").over(s)).otherwise(F.col("block_index")))
    rest = [c for c in rows.columns if c not in (*DOC, "block_index", "content", "pages")]
    own = F.struct("block_index", "content", "pages")
    # one aggregate for each column, so that those that nothing reads are not made
    merged = marked.groupBy(*DOC, "__head").agg(F.array_sort(F.collect_list(own)).alias("__parts"), *[F.min_by(c, "block_index").alias(c) for c in rest])
    return merged.select(
        *DOC, F.col("__head").alias("block_index"), *rest,
        F.array_join(F.transform("__parts", lambda p: p["content"]), "\n\n").alias("content"),
        F.when(F.size("__parts") > 1, F.array_sort(F.array_distinct(F.flatten(F.transform("__parts", lambda p: p["pages"]))))).otherwise(F.get("__parts", F.lit(0))["pages"]).alias("pages"),
    ).select(*rows.columns)


def pack(parts: Column, limit: int) -> Column:
    """Consecutive parts joined by blank lines while their lengths sum to the limit at most."""
    none = F.array().cast("array<string>")

    def step(a: Column, x: Column) -> Column:
        full = (a["n"] > 0) & (a["n"] + F.length(x) > limit)
        return F.struct(
            F.when(full, F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]).alias("done"),
            F.when(full | (a["n"] == 0), x).otherwise(F.concat(a["open"], F.lit("\n\n"), x)).alias("open"),
            (F.when(full, 0).otherwise(a["n"]) + F.length(x)).alias("n"),
        )

    start = F.struct(none.alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))
    return F.aggregate(parts, start, step, lambda a: F.when(a["n"] > 0, F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]))


def by_paragraphs(x: Column, limit: int) -> Column:
    parts = F.filter(F.transform(F.split(x, rf"\n{T.S}*\n"), T.strip), lambda p: p != "")
    return T.bind(pack(parts, limit), lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(x)))


def by_headings(x: Column, limit: int) -> Column:
    """Sections packed to the limit; one that is longer is cut into paragraphs, and ends what was open before it."""
    none = F.array().cast("array<string>")
    sections = F.filter(F.transform(F.split(x, rf"\n(?=#{{2,4}}{T.S}+)"), T.strip), lambda p: p != "")
    start = F.struct(none.alias("done"), none.alias("open"), F.lit(0).alias("n"))
    close = lambda a: F.concat(a["done"], F.when(F.size(a["open"]) > 0, F.array(F.array_join(a["open"], "\n\n"))).otherwise(none))

    def step(a: Column, s: Column) -> Column:
        n = F.length(s)
        full = (F.size(a["open"]) > 0) & (a["n"] + n > limit)
        return (
            F.when(n > limit, F.struct(F.concat(close(a), by_paragraphs(s, limit)).alias("done"), none.alias("open"), F.lit(0).alias("n")))
            .when(full, F.struct(close(a).alias("done"), F.array(s).alias("open"), n.alias("n")))
            .otherwise(F.struct(a["done"].alias("done"), F.concat(a["open"], F.array(s)).alias("open"), (a["n"] + n).alias("n")))
        )

    return T.bind(sections, lambda p: F.when(F.size(p) > 1, F.aggregate(p, start, step, close)).otherwise(by_paragraphs(x, limit)))


def split_long(rows: DataFrame, limit: int) -> DataFrame:
    """Chunks of up to the limit where paragraphs allow it; adds piece_index, 0 for blocks that stay whole."""
    whole = T.strip(F.col("content"))
    cut = F.when(F.length(whole) > limit, F.transform(by_headings(whole, limit), lambda x, i: F.struct((i + 1).alias("i"), T.strip(x).alias("t")))).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.col("content").alias("t"))))
    i = F.col("__p.i")
    return (
        rows.withColumn("__p", F.explode(cut)).withColumn("piece_index", i).withColumn("content", F.col("__p.t"))
        .withColumn("source_section", F.when(i > 0, F.concat(F.col("source_section"), F.lit(" / 片段 "), i.cast("string"))).otherwise(F.col("source_section")))
        .withColumn("order", F.when(i > 0, F.col("order") * 100 + i).otherwise(F.col("order"))).drop("__p")
        .filter((i == 0) | (F.col("content") != ""))
    )


def chunks(rows: DataFrame, limit: int = K.MAX_CHARS) -> DataFrame:
    return split_long(merge_children(rows), limit).filter(F.length(T.strip(F.col("content"))) >= K.MIN_CHUNK)


def _listed(sections: Column, n_chunks: Column, most: int) -> Column:
    left = n_chunks - F.size(sections)
    more = F.when((F.size(sections) >= most) & (left > 0), F.concat(F.lit("\n- ... 其余 "), left.cast("string"), F.lit(" 个片段"))).otherwise("")
    return F.concat(F.array_join(F.transform(sections, lambda s: F.concat(F.lit("- "), s)), "\n"), more)


def outline(rows: DataFrame, most: int = K.OUTLINE_SECTIONS) -> DataFrame:
    """(document keys, outline): the first `most` different sections of a document."""
    named = rows.withColumn("__s", T.strip(F.col("source_section"))).groupBy(*DOC, "__s").agg(F.min(F.struct("block_index", "piece_index")).alias("at"), F.count("*").alias("n"))
    every = Window.partitionBy(*DOC)
    top = named.withColumn("n_chunks", F.sum("n").over(every)).filter("__s <> ''").withColumn("k", F.row_number().over(every.orderBy("at"))).filter(F.col("k") <= max(most, 1))
    listed = top.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("at", "__s"))).alias("l"), F.max("n_chunks").alias("n_chunks"))
    return listed.select(*DOC, _listed(F.transform("l", lambda x: x["__s"]), F.col("n_chunks"), most).alias("outline"))


def with_outline(rows: DataFrame, most: int = K.OUTLINE_SECTIONS) -> DataFrame:
    """Adds the outline of each row's document, "" without a named section: as outline(), but in windows over the rows, which
    need not be made twice for it."""
    w = Window.partitionBy(*DOC).orderBy("block_index", "piece_index")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = (F.row_number().over(Window.partitionBy(*DOC, "__s").orderBy("block_index", "piece_index")) == 1) & (F.col("__s") != "")
    marked = rows.withColumn("__s", T.strip(F.col("source_section"))).withColumn("__first", first)
    placed = marked.withColumn("__k", F.sum(F.col("__first").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    told = placed.withColumn("__l", F.collect_list(F.when(F.col("__first") & (F.col("__k") <= max(most, 1)), F.col("__s"))).over(whole)).withColumn("__n", F.count("*").over(whole))
    return told.withColumn("outline", F.when(F.size("__l") > 0, _listed(F.col("__l"), F.col("__n"), most)).otherwise("")).drop("__s", "__first", "__k", "__l", "__n")


def with_context(rows: DataFrame, context_chars: int = K.CONTEXT_CHARS, most: int = K.OUTLINE_SECTIONS) -> DataFrame:
    """Adds context: the outline, the classes, and what the neighbours say in short."""
    if context_chars <= 0:
        return rows.withColumn("context", F.lit(""))
    w = Window.partitionBy(*DOC).orderBy("block_index", "piece_index")
    short = T.compact(F.col("content"), context_chars // 2)
    near = lambda f, title: F.when(f("source_section").over(w).isNotNull(), F.concat(F.lit(f"{title}\n章节："), f("source_section").over(w), F.lit("\n"), f("__short").over(w)))
    classes = F.concat(F.lit("知识分类：\n大类标题："), F.col("category"), F.lit("\n小类标题："), F.col("subcategory"), F.lit("\n关键词："), F.array_join("category_keywords", ", "))
    head = F.when(F.col("outline") != "", F.concat(F.lit("文档章节目录：\n"), F.col("outline")))
    classed = F.when((F.col("category") != "") | (F.col("subcategory") != "") | (F.size("category_keywords") > 0), classes)
    told = rows.withColumn("__short", short).withColumn("__before", near(F.lag, "上一片段摘要：")).withColumn("__after", near(F.lead, "下一片段摘要："))
    return with_outline(told, most).withColumn("context", F.concat_ws("\n\n", head, classed, "__before", "__after")).drop("__short", "__before", "__after", "outline")
