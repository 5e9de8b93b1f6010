"""Rules on single texts: golden rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import chunking, items, parsing, tools


def of(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_noise(spark):
    lines = ["---", "12", "第 3 页 / 共 9 页", "Page 2 of 5", "page 3", "目录....3", "目 录", "|---|---|", "", "a" + "." * 20, "a\x02b", "１２", "12345", "目录"]
    assert of(spark, T.is_noise, lines) == [True, True, True, True, True, True, True, False, False, True, True, True, False, False]


def test_headings(spark):
    lines = ["1.2.3 标题", "1.2.34", "1 概述", "第一章 浇水", "附录A 名录", "# x y", "第十章", "1.2.3.4.5 深层标题", "plain"]
    assert of(spark, T.recovered, lines) == ["#### 1.2.3 标题", "1.2.34", "1 概述", "## 第一章 浇水", "## 附录A 名录", "# x y", "第十章", "#### 1.2.3.4.5 深层标题", "plain"]
    assert of(spark, T.heading_of_line, lines) == ["#### 1.2.3 标题", "", "", "## 第一章 浇水", "## 附录A 名录", "# x y", "", "#### 1.2.3.4.5 深层标题", ""]


def test_embedded_headings(spark):
    texts = ["封面前 言本指引适用", "见本文件3.1范围", "参见3.1范围", "说明附录A名录", "a\n\n\n\nb", "V3.1x"]
    assert of(spark, T.separate_headings, texts) == ["前 言本指引适用", "见本文件\n\n3.1范围", "参见3.1范围", "说明\n\n附录A名录", "a\n\nb", "V3.1x"]


def test_compact_lines(spark):
    rows = [["1.1 概述", "本文说明了接口。", "第二句", "继续 ABC", "DEF 结尾", "- 12 -", "12", "一、 列表项", "尾"], []]
    out = of(spark, T.compact_lines, rows, "array<string>")
    assert out == ["### 1.1 概述\n\n本文说明了接口。\n第二句继续 ABC DEF 结尾- 12 -\n\n一、 列表项\n\n尾", ""]


def test_categories(spark):
    assert of(spark, T.clean_category, ["", "全文检索说明", "文档片段 3", " # a  b # ", "x" * 90]) == ["未分类", "检索说明", "未分类", "a b", "x" * 80]
    assert of(spark, T.clean_heading_title, ["3.1 概述", "第二章、浇水", "2024 总结", "文档片段 1"]) == ["概述", "浇水", "总结", "未分类"]
    assert of(spark, T.useful_heading, ["3.1", "A.2", "目录", "Q/ABC", "ICS 1", "x\\y", "接口", ""]) == [False] * 6 + [True, False]
    assert of(spark, T.family_key, ["a.1.2", "Ａ.1", "3.1.2", "3", "x", "10.1.2 y"]) == ["A", "Ａ", "3.1", "3", "", "10.1"]
    assert of(spark, T.section_prefix, ["3.1 a", "3.1.2 b", "3.12.1 c", "10.12.3", "3.12 d", " 1.2"]) == ["3.1", "", "3.1", "10.1", "3.12", "1.2"]


def test_tokens(spark):
    assert of(spark, T.tokens, ["9abc def_1 中文ab12 甲 ab", "nuclear IPv4 来源文档 V2", "文档片段 接口"]) == [["abc", "def_1", "中文ab12"], [], ["未分类", "接口"]]
    assert of(spark, T.clean_keyword, ["nuclear", "IPv4", "来源文档", "A.1.2 名称", "-x_", "3.1", "名"]) == ["", "", "", "名称", "", "", ""]
    assert of(spark, T.core_text, ["# 标题\n|a|b|c|\n正文"]) == ["\n b \n正文"] or of(spark, T.core_text, ["|a|b|c|"]) == [" b "]


def rank(values, category):
    count = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    out, own = [], 0
    for t in sorted(count, key=lambda t: (-count[t], values.index(t))):
        own += t in category
        if t not in category or own <= 3:
            out.append(t)
    return out[:10]


def test_rank_tokens(spark):
    import random

    rng = random.Random(3)
    rows = [([rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 40))], rng.sample("abcdefgh", 5)) for _ in range(60)]
    got = [r.x for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v array<string>, c array<string>").select("i", T.rank_tokens(F.col("v"), F.col("c")).alias("x")).orderBy("i").collect()]
    assert got == [rank(*r) for r in rows]


def test_item_cleaning(spark):
    assert of(spark, T.clean_relevance, ["最高", "极高", "中等", "", None, " 低 "]) == ["高", "极高", "一般", "一般", "一般", "低"]
    assert of(spark, T.risk_level, ["HIGH", None, "severe", " critical "]) == ["high", "low", "low", "critical"]
    assert of(spark, T.guess_version, ["IPv4 header", "v 2.1.3", "none"]) == ["V4", "V2.1.3", ""]
    assert of(spark, lambda x: T.clean_relation(x), ["“甲”与“乙”同属“丙”大类，回答时应结合来源章节区分适用场景、交互对象和处理要求。", "位置接近；"]) == ["", "位置接近"]
    assert of(spark, T.as_list, ["a,b，c、 d,,", "", None]) == [["a", "b", "c", "d"], [], []]
    assert of(spark, T.safe_name, ["A b/手册 2025", "--", "x__Y.z"]) == ["a-b-手册-2025", "kb-item", "x__y.z"]
    assert of(spark, T.order_prefix, [12, 1234567, -1, None], "long") == ["000012", "1234567", "000000", "000000"]
    assert of(spark, lambda x: T.compact(x, 0), ["a  b\nc"]) == ["a b c"] and of(spark, lambda x: T.compact(x, 3), ["ab cd"]) == ["ab..."]


def test_facts(spark):
    text = "# 标题\n- 单次浇水的水量不得超过 40 升这一上限；湿度过高时应停水并且告诉值班园丁。\n|---|---|\n1. **短**句。\n单次浇水的水量不得超过40升这一上限；"
    assert of(spark, T.fact_sentences, [text]) == [["单次浇水的水量不得超过 40 升这一上限；", "湿度过高时应停水并且告诉值班园丁。"]]


def pack(parts, limit):
    done, cur, n = [], [], 0
    for p in parts:
        if cur and n + len(p) > limit:
            done.append("\n\n".join(cur))
            cur, n = [], 0
        cur.append(p)
        n += len(p)
    return done + (["\n\n".join(cur)] if cur else [])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), max_size=8), min_size=1, max_size=12))
def test_pack(spark, sizes):
    rows = [[str(i) * n for i, n in enumerate(r)] for r in sizes]
    assert of(spark, lambda x: chunking.pack(x, 10), rows, "array<string>") == [pack(r, 10) for r in rows]


def test_pack_keeps_long_paragraphs(spark):
    assert of(spark, lambda x: chunking.by_paragraphs(x, 5), ["aa\n\nbbbb\n\nc", "a" * 20, ""]) == [["aa", "bbbb\n\nc"], ["a" * 20], [""]]
    text = "## a\n\nxx\n## b\n\n" + "y" * 30 + "\n\n" + "z" * 30 + "\n## c\n\nw"
    assert of(spark, lambda x: chunking.by_headings(x, 40), [text]) == [["## a\n\nxx", "## b\n\n" + "y" * 30, "z" * 30, "## c\n\nw"]]


def test_body_sections(spark):
    body = "# t\n\n## 1. 核心内容\n\n$1 \\ 来源页码：3\n来源页码：3\n第 3 页\n\n## 4. 关联能力\n\nold\n\n## 5. 来源依据\n\nold 来源页码：3\n"
    out = of(spark, lambda b: items.rewrite_functions(b, F.lit("new $1 \\")), [body, "# x"])
    assert out[0].endswith("## 4. 关联能力\n\nnew $1 \\\n\n## 5. 来源依据\n\nold 来源页码：3") and out[1] == "# x\n\n## 4. 关联能力\n\nnew $1 \\"
    out = of(spark, lambda b: items.rewrite_source(b, F.lit("src")), [body, "# x"])
    assert out[0].endswith("## 5. 来源依据\n\nsrc") and out[1] == "# x\n\n## 5. 来源依据\n\nsrc"
    out = of(spark, items.strip_page_markers, [body])
    assert out[0] == "# t\n\n## 1. 核心内容\n\n$1 \\ 来源页码：3\n## 4. 关联能力\n\nold\n\n## 5. 来源依据\n\nold 来源页码：3"


def test_summary(spark):
    put = lambda b: items.with_summary(b, F.lit("知识分类：\nx"))
    assert of(spark, put, ["# t\n\nbody", "body", "", "has 知识分类： already"]) == ["# t\n\n知识分类：\nx\n\n\nbody", "知识分类：\nx\n\nbody", "知识分类：\nx", "has 知识分类： already"]


def test_related_json(spark):
    import json

    rows = [(1, [("甲", '引"号', "a\\b", "高"), ("甲", "乙", "", "低")]), (2, [])]
    df = spark.createDataFrame(rows, "i int, r array<struct<`大类标题`:string,`小类标题`:string,`关联说明`:string,`关联度`:string>>")
    got = [r.x for r in df.orderBy("i").select(items.related_json(F.col("r")).alias("x")).collect()]
    want = [dict(zip(("大类标题", "小类标题", "关联说明", "关联度"), x)) for x in rows[0][1]]
    assert got[0] == json.dumps(want, ensure_ascii=False, indent=2)


def test_tools(spark):
    from folio.plans.corpus import TOOLS

    catalogue = [dict(t) for t in TOOLS]
    texts = ["兰花换盆记录应在两周内登记，根系状况另附照片。当用户询问兰花换盆记录时调用。", "本页不涉及查询兰花换盆台账工具。", "查询 接口 工具 当前", "call ORCHID_REPOTTING_LOG now"]
    assert of(spark, lambda x: tools.matched(x, catalogue), texts) == [[0], [], [], [0]]
    assert of(spark, lambda x: tools.matched(x, []), texts[:1]) == [[]]
    text = tools.tool_yaml(catalogue[0])
    assert 'required_permissions: []' in text and '  potId: "花盆编号"' in text and text.endswith("output_schema: {}")
    assert "requires_confirmation: true" in tools.tool_yaml(catalogue[1]) and 'required_permissions: ["read"]' in tools.tool_yaml(catalogue[1])
    shared = ["查询", "接口", "温室主题", "task_009"]
    assert tools._significant(shared) == ["温室主题", "task_009"]


def test_pieces(spark):
    got = of(spark, parsing.pieces, ["x\n# a\n##### b", "", "目录....3\n\n12\n", "a\n第 3 页\n## 第 4 页 标题"])
    assert [[(p.content, p.section) for p in ps] for ps in got] == [[("x", "文档片段 1"), ("# a\n##### b", "a")], [], [], [("a", "文档片段 1"), ("## 第 4 页 标题", "第 4 页 标题")]]
    assert of(spark, parsing.pages_of, ["第 4 页 标题 第５页", "x"]) == [[4, 5], []]


def test_list_parts_keep_line_ends_where_spaces_only_are_cut(spark):
    assert of(spark, lambda x: T.as_list(x, F.trim), ["a ,\nb, , c", ""], "string") == [["a", "\nb", "c"], []]
    assert of(spark, T.as_list, ["a ,\nb, , c"]) == [["a", "b", "c"]]
