"""Quality rules over generated files, each rule an expression.

files has path, error (null where the front matter could be read), meta (map of field to JSON text) and body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import fixed as K
from folio.functions import text as T
from folio.operators.items import before

ISSUE = "array<struct<level:string,message:string>>"
SECTION_4_LINE = rf"(?md)^##{T.S}+4\.{T.S}+关联能力{T.S}*$"


def issue(when: Column, level: str, message) -> Column:
    return F.when(when, F.struct(F.lit(level).alias("level"), (message if isinstance(message, Column) else F.lit(message)).alias("message")))


def field(name: str) -> Column:
    """A field as text: strings without their quotes, "" for what is missing, null or empty."""
    raw = F.col("meta")[name]
    return F.coalesce(F.when(raw.isin("null", "[]", "{}", "false", "0"), "").otherwise(raw), F.lit(""))


def list_field(name: str) -> Column:
    return F.coalesce(F.from_json(F.col("meta")[name], "array<string>"), F.array().cast("array<string>"))


def numbered_sections(body: Column) -> Column:
    """array<struct<number, text>> of the numbered sections; of equal numbers the last one."""
    marked = F.split(F.regexp_replace(body, rf"(?md)^##{T.S}+(\p{{Nd}}+)\.{T.S}+[^\n]*$", "\u0001$1\u0001"), "\u0001")

    def sections(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), ((F.size(parts) - 1) / 2).cast("int")), lambda i: F.struct(F.element_at(parts, (i * 2).cast("int")).cast("int").alias("number"), T.strip(F.element_at(parts, (i * 2 + 1).cast("int"))).alias("text")))

    def last(s: Column) -> Column:
        return F.filter(s, lambda x, i: ~F.exists(F.slice(s, i + 2, F.size(s)), lambda y: y["number"] == x["number"]))

    none = F.array().cast("array<struct<number:int,text:string>>")
    return T.bind(marked, lambda p: F.when(F.size(p) > 2, T.bind(sections(p), last)).otherwise(none))


def related_issues() -> Column:
    """What is wrong with related_items, which may be anything."""
    raw = F.col("meta")["related_items"]
    entries = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))
    filled = field("related_items") != ""

    def of_entry(x: Column, i: Column) -> Column:
        at = F.concat(F.lit("related_items["), (i + 1).cast("string"), F.lit("]"))
        value = lambda k: F.coalesce(F.from_json(x, "map<string,string>")[k], F.lit(""))
        blank = [issue(T.strip(value(k)) == "", "warning", F.concat(at, F.lit(f" 缺少字段: {k}"))) for k in K.RELATED_KEYS]
        rank = issue(~value(K.RELATED_KEYS[3]).isin(*K.RELEVANCE), "warning", F.concat(at, F.lit(" 关联度不规范")))
        other = issue(F.lit(True), "warning", F.concat(at, F.lit(" 应为对象")))
        return F.when(x.startswith("{"), F.array(*blank, rank)).otherwise(F.array(other))

    not_list = F.array(issue(filled & ~raw.startswith("["), "warning", "related_items 应为列表"))
    return F.concat(not_list, F.when(filled & raw.startswith("["), F.flatten(F.transform(entries, of_entry))).otherwise(F.array().cast(ISSUE)))


def file_issues() -> Column:
    """All issues of one file, in the order of the rules."""
    has = lambda f: F.map_contains_key(F.col("meta"), f)
    body, n = F.col("body"), F.length("body")
    kind = F.when(has("doc_type"), F.regexp_replace(F.coalesce(F.col("meta")["doc_type"], F.lit("null")), r"\Anull\z", "None")).otherwise("None")
    core = F.coalesce(before(body, SECTION_4_LINE), body)
    tags = F.filter(F.transform(list_field("tags"), T.strip), lambda t: T.matches(t, "[A-Z][A-Z0-9]{1,12}"))
    absent = F.filter(tags, lambda t: ~F.regexp_like(core, F.concat(F.lit("(?<![A-Za-z0-9])"), t, F.lit("(?![A-Za-z0-9])"))))
    warn = lambda text: lambda x: F.struct(F.lit("warning").alias("level"), F.concat(F.lit(text), x).alias("message"))
    empty = F.filter(numbered_sections(body), lambda s: ~s["number"].isin(4, 5) & (s["text"] == ""))
    category, sub = T.strip(field("category")), T.strip(field("subcategory"))
    plain = F.array(
        *[issue(~has(f), "error", f"缺少必填字段: {f}") for f in K.REQUIRED_FIELDS],
        *[issue(~has(f), "warning", f"缺少来源追踪字段: {f}") for f in K.TRACE_FIELDS],
        *[issue(~has(f), "warning", f"缺少分类关系字段: {f}") for f in K.RELATION_FIELDS],
        issue(~kind.isin(*K.DOC_TYPES), "error", F.concat(F.lit("doc_type 不合法: "), kind)),
        issue(n > 3000, "warning", F.concat(F.lit("正文较长，建议继续拆分: "), n.cast("string"), F.lit(" 字符"))),
        issue(n < 200, "warning", F.concat(F.lit("正文较短，可能信息不足: "), n.cast("string"), F.lit(" 字符"))),
        issue(F.regexp_count(body, F.lit(rf"(?md)^##{T.S}+")) < 5, "warning", "二级标题少于 5 个，可能未遵照标准知识库结构"),
        *[issue(~body.rlike(rf"(?md)^##{T.S}+{i}\.{T.S}+[^\n]*{t}"), "warning", f"缺少或未对齐章节: ## {i}. {t}") for i, t in enumerate(K.SECTION_TITLES, 1)],
    )
    rules = F.concat(
        plain,
        F.transform(empty, lambda s: warn("章节内容为空: ## ")(s["number"].cast("string"))),
        F.transform(absent, warn("关键缩写未进入正文核心章节: ")),
        F.array(issue((sub != "") & (sub == category), "warning", "小类与大类相同，分类层级可能未细化")),
        related_issues(),
    )
    unread = F.array(F.struct(F.lit("error").alias("level"), F.concat(F.lit("无法读取 Markdown Front Matter: "), F.col("error")).alias("message")))
    return F.when(F.col("error").isNotNull(), unread).otherwise(F.filter(rules, lambda x: x.isNotNull()))


def spread_issues(files: DataFrame) -> DataFrame:
    """Signs that a whole set of files was put into one class: counted once over all files."""
    keywords = F.transform(list_field("category_keywords"), T.strip)
    read = F.col("error").isNull()
    seen = files.agg(
        F.min("path").alias("path"), F.count("*").alias("paths"), F.count(F.when(read, 1)).alias("n"),
        F.count_distinct(F.when(read, F.nullif(T.strip(field("category")), F.lit("")))).alias("categories"),
        F.count_distinct(F.when(read, F.nullif(T.strip(field("subcategory")), F.lit("")))).alias("subcategories"),
        F.count_distinct(F.when(read & (F.size(keywords) > 0), keywords)).alias("keywords"),
    )
    enough = (F.col("paths") >= 3) & (F.col("n") >= 5)
    both = F.array(issue(enough & (F.col("categories") == 1) & (F.col("subcategories") <= 1), "warning", K.SPREAD_CATEGORY), issue(enough & (F.col("keywords") == 1), "warning", K.SPREAD_KEYWORDS))
    return seen.select("path", F.posexplode(F.filter(both, lambda x: x.isNotNull())).alias("pos", "i")).select("path", "pos", "i.level", "i.message")


def validate(files: DataFrame) -> DataFrame:
    """(path, pos, level, message); the issues of a set of files come after those of each."""
    own = files.select("path", F.posexplode(file_issues()).alias("pos", "i")).select("path", "pos", "i.level", "i.message")
    return own.unionByName(spread_issues(files).withColumn("pos", F.col("pos") + 1_000_000))


def from_items(items: DataFrame, path: Column) -> DataFrame:
    """The files that items would make, without writing them."""
    as_text = lambda c, kind: F.col(c) if kind == "string" else F.to_json(F.col(c)) if kind.startswith("array") else F.col(c).cast("string")
    kinds = {f.name: f.dataType.simpleString() for f in items.schema.fields}
    pairs = [x for c in K.ITEM_FIELDS for x in (F.lit(c), as_text(c, kinds[c]))]
    return items.select(path.alias("path"), F.lit(None).cast("string").alias("error"), F.create_map(*pairs).alias("meta"), T.strip(F.col("body")).alias("body"))
