"""Documents for the named queries, made of the driver's tables, with the SQL that makes the same.

plain: each row of documents is a text file. sectioned: forty rows with consecutive ids are one file, a numbered section
with the whole text for each, and before every fourth one a short parent of its own; rows without an id are dealt to files
of theirs by their text. A few hand-written files with what Latin prose doesn't have go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.parsing import dealt

PER_FILE = 40

SAMPLES = (
    ("温室养护手册.md", "# 温室养护手册\n\n编写说明\n\n## 第一章 总则\n\n第 2 页 / 共 7 页\n\n本手册所说的自动灌溉控制器，是指安装在苗床旁的供水设备，以下简称“灌控器”，英文简称为 AIC。灌控器每天 06:30 之前要完成一次自检！\n\n第二章 浇水安排\n\n2.1 水量设定\n先看土壤湿度。\n\n2.1.1 水量设定表\n\n| 项目 | 取值 |\n|---|---|\n| bedId | 苗床号 |\n\n- 单次浇水不得超过 40 升；湿度高于 85% 时应停止浇水。\n1. 水压不足时关闭阀门并且告诉园丁。\n\n7\n\n2.1.2 病害处理 第 4 页\n**病害处理**按照先隔离、再喷药的顺序进行。病害处理包括记录叶片、隔离植株、复查三步。\n\n附录A 植物编号\n苗床号由园艺组编排，长度不超过 6 位。"),
    ("花讯.txt", "兰花换盆记录应在开花之后两周内登记，登记内容为换盆日期、基质配比以及根系状况。\n当用户询问兰花换盆记录、换盆日期、基质配比或根系状况时调用。\n来源页码：5\n本页不包括查询接口。\n版本为 V 1.4，只用于南侧温室。"),
    ("目录.md", "目录....4\n---\n第 1 页\nPage 3 of 8\n----- · -----\n\n"),
    ("空.md", ""),
    ("文档片段样例.md", "文档片段 3\n全文检索说明\n\n#### 1.2.34\n\n1.2.3 标题\n\n2024 小结\n\nnuclear IPv4 abc_1 病害处理 病害处理 来源文档\n##### 五级标题\n\n# 接口\n\n接口说明接口说明，接口口径。"),
)


#: Bytes of a table for each task: the work on a byte of text is much, and a file may be one row group.
TASK = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's table, its rows dealt out evenly: the splits of the scan follow the row groups of the files, and a table
    of any size may have few of them."""
    path = f"{sf_dir}/documents.parquet"
    size = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0] or 0
    return spark.read.parquet(path).repartition(max(4 * spark.sparkContext.defaultParallelism, size // TASK))


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    return docs.select(F.col("doc_id").alias("file_index"), F.concat(name, F.lit(".md")).alias("source_doc"), name.alias("stem"), F.coalesce("text", F.lit("")).alias("markdown"))


PLAIN_SQL = "SELECT doc_id AS file_index, concat('doc-', doc_id, '.md') AS source_doc, concat('doc-', doc_id) AS stem, coalesce(text, '') AS markdown FROM documents"


def samples(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(i - len(SAMPLES), n, t) for i, (n, t) in enumerate(SAMPLES)], "file_index long, source_doc string, markdown string")
    return rows.select("file_index", "source_doc", T.file_stem(F.col("source_doc")).alias("stem"), "markdown")


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


SAMPLES_SQL = "SELECT CAST(column0 AS BIGINT) AS file_index, column1 AS source_doc, regexp_replace(column1, '\\.[^.]+$', '') AS stem, column2 AS markdown FROM (VALUES " + ", ".join(f"({i - len(SAMPLES)}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(SAMPLES)) + ") v(column0, column1, column2)"


def sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    at = F.pmod(F.coalesce("doc_id", F.lit(1)), F.lit(PER_FILE))
    group = (F.floor(at / 4) + 1).cast("string")
    head = F.concat(F.lit("## "), group, F.lit(".1."), (at % 4 + 1).cast("string"), F.lit(" "), F.regexp_replace(F.substring(text, 1, 40), "[^A-Za-z]+", " "), F.lit("\n\n"))
    parent = F.when(at % 4 == 0, F.concat(F.lit("## "), group, F.lit(".1 part "), group, F.lit("\n\nfour notes follow\n\n"))).otherwise(F.lit(""))
    section = F.concat(parent, head, F.replace(text, F.lit("\n"), F.lit("\n\n")))
    other = F.lit(-1_000) - F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("long")
    file = F.coalesce(F.floor(F.col("doc_id") / PER_FILE), other)
    name = F.concat(F.lit("file-"), F.col("file_index").cast("string"))
    parts = docs.select(file.alias("file_index"), "doc_id", section.alias("s")).withColumn("source_doc", F.concat(name, F.lit(".md"))).withColumn("stem", name)
    whole = samples(spark).select("file_index", F.lit(None).cast("long").alias("doc_id"), F.col("markdown").alias("s"), "source_doc", "stem")
    # samples are files of one part; so all is dealt out once, and stays where it is for what follows
    made = dealt(parts.unionByName(whole)).groupBy("file_index", "source_doc", "stem")
    return made.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "s"))), lambda x: x["s"]), "\n\n").alias("markdown"))


SECTIONED_SQL = f"""
SELECT file_index, concat('file-', file_index, '.md') AS source_doc, concat('file-', file_index) AS stem, markdown FROM (
  SELECT coalesce(doc_id // {PER_FILE}, -1000 - CAST(concat('0x', substr(md5(text), 1, 4)) AS BIGINT)) AS file_index, string_agg(s, concat(chr(10), chr(10)) ORDER BY doc_id, s) AS markdown
  FROM (SELECT doc_id, text, concat(CASE WHEN k % 4 = 0 THEN concat('## ', k // 4 + 1, '.1 part ', k // 4 + 1, chr(10), chr(10), 'four notes follow', chr(10), chr(10)) ELSE '' END,
      '## ', k // 4 + 1, '.1.', k % 4 + 1, ' ', regexp_replace(substr(text, 1, 40), '[^A-Za-z]+', ' ', 'g'), chr(10), chr(10), replace(text, chr(10), concat(chr(10), chr(10)))) AS s
    FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id, 1) % {PER_FILE} AS k FROM documents)) GROUP BY 1)
UNION ALL {SAMPLES_SQL}"""

#: A catalogue for matching: one tool as in the samples, one that the prose meets by words alone, one that never matches.
TOOLS = (
    {"name": "orchid_repotting_log", "display_name": "兰花换盆台账", "description": "给出兰花的换盆日期、基质配比、根系状况以及下一次换盆的建议。", "trigger": "当用户询问兰花换盆记录、换盆日期、基质配比或根系状况时调用。",
     "input_schema": {"properties": {"potId": {"description": "花盆编号"}}}, "output_schema": {"type": "array"}},
    {"name": "tionthe_lookup", "display_name": "thand other", "description": "that this with from only", "trigger": "tionou ering anded", "required_permissions": ["read"], "requires_confirmation": True},
    {"name": "never_called_zz", "display_name": "", "description": "查询状态", "trigger": "", "risk_level": "high"},
)
