"""Items from a chat model.

The model is a function from messages to a response, given by the caller; it runs inside mapInPandas, so a partition
has one client and its size bounds the load. Everything around the call is fixed: what is asked, how an answer is read,
and what is said back when an answer can't be used. Calls are not repeatable and cost money, so answers are written to a
table before anything reads them, keyed by what was asked; a chunk that has an answer there is not asked again."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from folio.functions import fixed as K

ROOT = '{"items": [...]}'
SYSTEM = f"你负责把原文整理成知识条目，只能使用原文中的事实。只返回一个 JSON object，根节点严格为 {ROOT}，不要任何其他文字。"


@dataclass(frozen=True)
class Parsed:
    value: object = None
    error: str = ""


# --- reading answers ------------------------------------------------------------------------------


def _get(x, name: str):
    return x.get(name) if isinstance(x, dict) else getattr(x, name, None)


def text_of(content) -> str:
    """The text of a message's content: a string, parts, or a mapping or object that holds one."""
    if content is None or isinstance(content, str):
        return content or ""
    if isinstance(content, list):
        return "\n".join(t for t in map(text_of, content) if t)
    names = ("text", "content", "output_text") + (("json", "arguments") if isinstance(content, dict) else ())
    found = next((t for n in names if (t := text_of(_get(content, n)))), "")
    if found:
        return found
    if isinstance(content, dict):
        try:
            return json.dumps(content, ensure_ascii=False)
        except TypeError:
            pass
    return str(content)


def _choice(response):
    choices = _get(response, "choices") or []
    return choices[0] if choices else None


def _arguments(calls) -> str:
    for call in calls if isinstance(calls, list) else [calls] if calls else []:
        function = _get(call, "function")
        if t := text_of(_get(call if function is None else function, "arguments")):
            return t
    return ""


def answer_of(response) -> str:
    """Content, else a function call's arguments, else the tool calls', else the reasoning."""
    message = _get(_choice(response), "message")
    if message is None:
        return ""
    return text_of(_get(message, "content")) or _arguments(_get(message, "function_call")) or _arguments(_get(message, "tool_calls")) or text_of(_get(message, "reasoning_content"))


def finish_reason(response) -> str:
    return str(_get(_choice(response), "finish_reason") or "")


def truncated(answer: str, reason: str) -> bool:
    return reason == "length" or any(answer.count(a) > answer.count(b) for a, b in ("{}", "[]"))


def _where(e: json.JSONDecodeError, text: str) -> str:
    rows = text.splitlines()
    row = rows[e.lineno - 1] if e.lineno <= len(rows) else ""
    start = max(e.colno - 41, 0)
    return f"{e.msg} at line {e.lineno}, column {e.colno}, char {e.pos}. near: {row[start : e.colno + 40]}\n{' ' * max(e.colno - start - 1, 0)}^"


def read_json(text: str) -> Parsed:
    """The text as JSON without a fence around it, else the first span of braces, then of brackets, that is JSON; spans
    begin as early as they can, and among those end as late as they can."""
    text = text.strip()
    if fence := re.match(r"^```(?:json|JSON)?\s*(.*?)\s*```$", text, re.S):
        text = fence[1].strip()

    try:
        return Parsed(json.loads(text))
    except json.JSONDecodeError as e:
        error = _where(e, text)
    decoder = json.JSONDecoder()
    for a, b in ("{}", "[]"):
        end = text.rfind(b) + 1
        start = text.find(a)
        while 0 <= start < end - 1:
            span = text[start:end]
            try:  # what begins here ends where it must, so no other end has to be tried
                return Parsed(decoder.raw_decode(span)[0])
            except json.JSONDecodeError as e:
                error = _where(e, span)
            start = text.find(a, start + 1)
    return Parsed(error=error)


def shape_of(value) -> str:
    if isinstance(value, dict):
        return f"object keys={list(value)[:10]}"
    return f"array len={len(value)}" if isinstance(value, list) else type(value).__name__


# --- what is asked --------------------------------------------------------------------------------

RULES = (
    "正文依次为 # 标题、" + "、".join(f"## {i}. {t}" for i, t in enumerate(K.SECTION_TITLES, 1)) + "；没有内容的一节写“暂无”或“原文未明确说明”，不删除标题。",
    "只写原文有的事实，不编造来源、阈值、角色、日期和版本；缺少的字段留空。",
    "原文的每个事实句都要进入 ## 1 到 ## 3，保留主体、限定、阈值、比较符、单位、时间、数量、例外和禁止要求。",
    "定义、简称、英文简称、缩写类的句子（“以下简称”“英文简称”“称为”“是指”“定义为”）在 ## 1. 核心内容 中保留完整原句。",
    "多个独立主题才拆成多个 items；每个条目要能独立检索和回答，长度以 800 到 1500 字为宜。",
    "## 4. 关联能力 只写“暂无”，由程序补写；页码只由程序写入 ## 5. 来源依据。",
    "辅助上下文只用来理解位置和术语，其中独有的事实不写入正文。",
    "category 为大类，subcategory 为小类；category_keywords 按重要性排序，不超过 10 个，大类词不超过 3 个。",
    "related_items 的每个对象只含" + "、".join(K.RELATED_KEYS) + "；关联度取" + "、".join(K.RELEVANCE) + "之一。",
    "doc_type 取 " + "、".join(K.DOC_TYPES) + "；risk_level 取 " + "、".join(K.RISK_LEVELS) + "。",
)
FIELDS = ("title", "doc_type", "category", "subcategory", "related_items", "category_keywords", "business_modules", "source_version", "risk_level", "applicable_roles", "tags", "body", "split_reason")


def prompt_of(chunk: dict, status: str, spec: str = "") -> str:
    listed = lambda xs: ", ".join(xs) if xs is not None and len(xs) else "无"
    related = [dict(r) for r in chunk.get("related_items") or []]
    facts = {
        "来源文档": chunk["source_doc"], "知识大类": chunk.get("category") or K.UNSORTED, "文件总体说明": chunk.get("source_doc_description") or "无", "知识小类": chunk.get("subcategory") or "无",
        "同级相关小类": listed(chunk.get("related_categories")), "关联信息提示": json.dumps(related, ensure_ascii=False) if related else "无", "大类关键词": listed(chunk.get("category_keywords")), "来源章节": chunk["source_section"],
    }
    rules = "\n".join(f"{i}. {r}" for i, r in enumerate((*RULES, f'status 为 "{status}"。', f"只返回 {ROOT}，每个元素的字段为 {', '.join(FIELDS)}。"), 1))
    return "\n\n".join(["请把下面的原文片段整理为知识条目。", rules, f"规范：\n{spec or '无'}", "\n".join(f"{k}：{v}" for k, v in facts.items()), f"辅助上下文：\n{chunk.get('context') or '无'}", f"原文：\n{chunk['content']}"])


def messages_of(prompt: str) -> list[dict[str, str]]:
    return [{"role": "system", "content": SYSTEM}, {"role": "user", "content": prompt}]


def said_back(messages: list[dict[str, str]], answer: str, feedback: str) -> None:
    messages += [{"role": "assistant", "content": answer or ""}, {"role": "user", "content": feedback}]


EMPTY = f"重试：上一轮没有内容。请只返回 {ROOT}。"
NO_OBJECTS = f"重试：items 中没有可用的对象。请返回 {ROOT}，每个元素是一个条目对象。"
SHORTER = f"\n上一轮似乎被截断，请压缩表述，保持 {ROOT}。"


def repair_feedback(error: str, answer: str) -> str:
    return f'重试：上一轮不是合法 JSON。只修复语法、转义和根结构，不改内容；字符串中的英文双引号写成 \\"，换行写成 \\n；根节点严格为 {ROOT}。\n解析错误：{error or "unknown"}\n上一轮输出：\n{answer.strip()[:3000]}'


def shape_feedback(value) -> str:
    return f"重试：上一轮是 JSON，但根节点不是 {ROOT}，不接受纯数组、单个条目或其他根字段。上一轮结构：{shape_of(value)}"


def coverage_feedback(chunk: dict, missing: list[str], core: str) -> str:
    facts = "\n".join(f"- {f}" for f in missing[:8])
    return (
        f"重试：上一轮遗漏了以下事实，请写入 ## 1. 核心内容、## 2. 适用边界 或 ## 3. 使用要求，短句保留原句：\n{facts}\n\n来源文档：{chunk['source_doc']}\n来源章节：{chunk['source_section'] or K.WHOLE_TEXT}\n\n"
        f"原文：\n{chunk['content'].strip()[:4000] or '无'}\n\n辅助上下文（其独有事实不写入正文）：\n{(chunk.get('context') or '').strip()[:2000] or '无'}\n\n上一轮的核心正文：\n{core.strip()[:3000] or '无'}"
    )


# --- the exchange ---------------------------------------------------------------------------------


def core_of(body: str) -> str:
    """coverage.core_sections() for one body, inside a worker."""
    for label in ("知识分类", "知识大类说明"):
        body = re.sub(rf"{label}：\s*\n.*?(?=\n{{2,}}|^##\s+|\Z)", "", body, flags=re.S | re.M)
    cut = re.search(r"^##\s+4\.\s+关联能力\s*$", body, re.M) or re.search(r"^##\s+5\.\s+来源依据\s*$", body, re.M)
    return body[: cut.start()] if cut else body


def squashed(text: str) -> str:
    """text.coverage_text(), inside a worker."""
    text = re.sub(r"^#{1,6}\s+.*$", "", text, flags=re.M)
    return re.sub(r"[\s`*_#|>：:，,。；;！？!?、（）()【】\[\]《》“”\"'‘’.\-—–]+", "", text).lower()


def converse(chunk: dict, complete: Callable, status: str, spec: str = "", attempts: int = K.MODEL_ATTEMPTS, coverage_attempts: int = K.COVERAGE_ATTEMPTS, wait: Callable[[float], None] = time.sleep, most_wait: float = 30) -> tuple[list[dict], list[str]]:
    """(objects, missing facts) for one chunk; no objects if no answer could be used. chunk["facts"] lists the facts that
    the bodies must have. An answer that leaves some out is sent back a few times, then taken with the list."""
    messages = messages_of(prompt_of(chunk, status, spec))
    sent_back = 0
    for attempt in range(1, attempts + 1):
        feedback, answer = None, ""
        try:
            response = complete(messages)
        except Exception:  # noqa: BLE001 whatever the client raises, the next attempt may go through
            response = None
        if response is not None:
            answer = answer_of(response)
            cut = SHORTER if truncated(answer.strip(), finish_reason(response)) else ""
            parsed = read_json(answer) if answer.strip() else Parsed()
            objects = parsed.value.get("items") if isinstance(parsed.value, dict) else None
            if not answer.strip():
                feedback = EMPTY
            elif not parsed.value:
                feedback = repair_feedback(parsed.error, answer) + cut
            elif not isinstance(objects, list):
                feedback = shape_feedback(parsed.value) + cut
            elif not (objects := [o for o in objects if isinstance(o, dict)]):
                feedback = NO_OBJECTS
            else:
                core = "\n\n".join(core_of(str(o.get("body") or "")) for o in objects)
                had = squashed("\n".join(core_of(str(o.get("body") or chunk["content"])) for o in objects))
                missing = [f for f in chunk.get("facts") or [] if squashed(f) not in had]
                if not missing or sent_back >= coverage_attempts or attempt >= attempts:
                    return objects, missing
                sent_back += 1
                feedback = coverage_feedback(chunk, missing, core)
        if attempt < attempts:
            if feedback is not None:
                said_back(messages, answer, feedback)
            wait(min(2 ** (attempt - 1), most_wait))
    return [], []


def objects_of(chunks: DataFrame, complete: Callable, status: str = "active", spec: str = "", keep: list[str] | None = None, **options) -> DataFrame:
    """The columns `keep` of chunks (all without it) with item_index, raw (a JSON object) and missing for each object; raw is
    null, item_index 0, for a chunk without a usable answer. `complete` must be picklable; chunks needs what with_context()
    gives. Each read of the result asks anew: see answered()."""
    from folio.functions import text as T

    keys = keep or [c for c in chunks.columns if c != "facts"]
    asked = chunks.withColumn("facts", T.fact_sentences(F.col("content")))
    schema = chunks.select(*keys).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                said = {k: (list(v) if hasattr(v, "tolist") else v) for k, v in row.items()}
                objects, missing = converse(said, complete, status, spec, **options)
                base = {k: row[k] for k in keys}
                rows = [(i, json.dumps(o, ensure_ascii=False)) for i, o in enumerate(objects, 1)] or [(0, None)]
                out += [{**base, "item_index": i, "raw": raw, "missing": missing} for i, raw in rows]
            yield pd.DataFrame(out, columns=[*keys, "item_index", "raw", "missing"])

    made = StructType(schema.fields).add("item_index", IntegerType()).add("raw", StringType()).add("missing", ArrayType(StringType()))
    return asked.mapInPandas(run, made)


#: What names a chunk, whatever run it is in.
KEY = ["source_doc", "source_section", "block_index", "piece_index", "content_md5"]


def keyed(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("content_md5", F.md5("content"))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that may not be there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def answered(chunks: DataFrame, complete: Callable, store: str, status: str = "active", spec: str = "", **options) -> DataFrame:
    """chunks with item_index, raw and missing as objects_of() gives them, by way of the table `store`. Only chunks without a
    usable answer there are asked, and what comes is appended; of several answers the last counts."""
    spark = chunks.sparkSession
    rows = keyed(chunks).withColumn("ask_md5", F.md5(F.concat_ws("\n", "content", "context", F.lit(spec), F.lit(status))))
    # written once beside the answers: all that follows reads this, and doesn't parse the documents again
    path = f"{store}.chunks/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    on = [*KEY, "ask_md5"]
    done = stored(spark, store)
    todo = rows if done is None else rows.join(done.filter("raw IS NOT NULL").select(*on).distinct(), on, "left_anti")
    objects_of(todo, complete, status, spec, keep=on, **options).withColumn("at", F.current_timestamp()).write.mode("append").parquet(store)
    found = spark.read.parquet(store)
    last = found.groupBy(*on).agg(F.max("at").alias("at"))
    return rows.join(found.join(last, [*on, "at"]).drop("at"), on).drop("content_md5", "ask_md5")
