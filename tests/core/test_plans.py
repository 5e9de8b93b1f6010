"""Whole plans on small documents, and what surrounds them."""

import json
import random
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from folio import jobs
from folio.functions import text as T
from folio.operators import chunking, coverage, items, model_calls, model_items, naming, parsing, validation
from folio.plans import corpus
from folio.plans.draft import by_model, chunks_of, draft
from folio.sources import files, generated, settings, sinks
from folio.streaming import incremental

CATALOGUE = [dict(t) for t in corpus.TOOLS]


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.samples(spark)


def prefix_of(title):
    import re

    m = re.match(r"^(\d+\.\d+)(?!\.)", title)
    return m[1] if m else ""


def merged(rows):
    """Plain statement of how short parents take in their children."""
    out, cur, pre = [], None, ""
    for i, title, text in rows:
        p = prefix_of(title)
        if p and len(text) < 120:
            if cur:
                out.append(cur)
            cur, pre = (i, [text]), p
        elif cur and title.startswith(pre + "."):
            cur[1].append(text)
        else:
            if cur:
                out.append(cur)
            cur = None
            out.append((i, [text]))
    return out + ([cur] if cur else [])


def test_merge_children(spark):
    rng = random.Random(5)
    rows = [(d, f"d{d}", b, rng.choice(["3.1 a", "3.1.1 b", "3.1.2 c", "3.2 d", "3.2.1 e", "x", "3.12.1 f"]), "t" * rng.choice([10, 130])) for d in range(40) for b in range(rng.randint(1, 12))]
    df = spark.createDataFrame([(*r, [r[2]], "k") for r in rows], "file_index long, source_doc string, block_index int, source_section string, content string, pages array<int>, other string")
    got = sorted((r.file_index, r.block_index, r.content) for r in chunking.merge_children(df).collect())
    want = sorted((d, i, "\n\n".join(parts)) for d in range(40) for i, parts in merged([(r[2], r[3], r[4]) for r in rows if r[0] == d]))
    assert got == want


def test_parse(docs):
    rows = {(r.source_doc, r.block_index): r for r in parsing.parse(docs).collect()}
    first = rows["温室养护手册.md", 0]
    assert first.category == "温室养护手册" and all(r.related_items is not None for r in rows.values())
    assert not [k for k in rows if k[0] in ("目录.md", "空.md")]
    for r in rows.values():
        assert len(r.related_items) <= 5 and all(x["关联度"] in ("高", "一般", "低") for x in r.related_items) and r.subcategory not in [x["小类标题"] for x in r.related_items]
        assert r.category_path == ([r.category, r.subcategory] if r.category != r.subcategory else [r.category])


def test_related_ties_prefer_the_farther(spark):
    text = "\n".join(f"## {n}\n\n正" for n in ("甲节甲", "乙节乙", "丙节丙", "丁节丁"))
    df = spark.createDataFrame([(0, "a.md", "a", "# 根\n" + text)], "file_index long, source_doc string, stem string, markdown string")
    rows = {r.subcategory: [x["小类标题"] for x in r.related_items] for r in parsing.parse(df).collect()}
    assert set(rows["甲节甲"]) <= {"根", "乙节乙", "丙节丙", "丁节丁"} and rows["甲节甲"]


def test_context(docs):
    rows = chunks_of(docs).orderBy("file_index", "block_index", "piece_index").collect()
    own = [r for r in rows if r.source_doc == "温室养护手册.md"]
    assert own and own[0].context.startswith("文档章节目录：\n- ") and "知识分类：\n大类标题：温室养护手册" in own[0].context
    assert ("下一片段摘要：" in own[0].context) == (len(own) > 1) and "上一片段摘要：" not in own[0].context
    assert all(len(T_strip(r.content)) >= 40 for r in rows)
    assert chunks_of(docs, settings.DraftSettings(context_chars=0)).first().context == ""


def T_strip(x):
    return x.strip()


def test_outline_limit(spark):
    rows = [(0, "a", i, 0, f"s{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "file_index long, source_doc string, block_index int, piece_index int, source_section string")
    assert chunking.outline(df, 4).first().outline == "- s0\n- s1\n- s2\n- s3\n- ... 其余 2 个片段" and chunking.outline(df, 6).first().outline.endswith("- s5")


def test_draft(docs):
    made = draft(docs, CATALOGUE, "20250102030405", "0f1e2d3c")
    rows = made.orderBy("source_order").collect()
    assert [r.source_order for r in rows] == list(range(1, len(rows) + 1)) and len({r.file_name for r in rows}) == len(rows)
    one = next(r for r in rows if r.source_doc == "花讯.txt")
    assert one.file_name == f"花讯-20250102030405-0f1e2d3c-{one.source_order:06d}-{one.kb_id}.md" and one.source_version == "V1.4"
    assert "```yaml\nfunction_name: \"orchid_repotting_log\"" in one.body and "来源页码：" not in one.body.split("## 5.")[0]
    assert one.body.count("## ") >= 5 and "## 5. 来源依据\n\n- 来源文档：花讯.txt\n- 来源章节：文档片段 1\n- 来源说明" in one.body
    assert {(r.source_doc, r.block_index, r.piece_index, r.body) for r in rows} == {(r.source_doc, r.block_index, r.piece_index, r.body) for r in draft(docs.repartition(5), CATALOGUE, "20250102030405", "0f1e2d3c").collect()}


def test_file_name(spark):
    row = spark.createDataFrame([("手册", "20250102030405", "0f1e2d3c", "pending", 31, "biz-offline-0a9-v1"), ("手册", "20250102030405", "0f1e2d3c", "failed", 31, "biz-offline-0a9-v1")], "a string, b string, c string, d string, e int, f string")
    got = [r.n for r in row.select(naming.file_name(*[F.col(c) for c in "abcdef"]).alias("n")).collect()]
    assert sorted(got) == ["手册-20250102030405-0f1e2d3c-000031-biz-offline-0a9-v1.md", "手册-20250102030405-0f1e2d3c-failed-000031-biz-offline-0a9-v1.md"]


DEFINITION = "# 名词\n自动灌溉控制器以下简称“灌控器”，英文简称为 AIC，是供水设备。"


def chunk_table(spark):
    base = corpus.samples(spark).limit(0)
    one = spark.createDataFrame([(0, "定义.md", "定义", DEFINITION + "\n补充一。\n补充二。\n补充三。"), (1, "坏.md", "坏", "# 坏\n" + "这一页写的是过冬花木的包裹办法，字数够用，可是问不出能用的答案，只好按规则整理。" * 2)], base.schema)
    return chunks_of(one)


def answer(core, **more):
    body = f"# 名词\n\n## 1. 核心内容\n\n{core}\n\n## 2. 适用边界\n\n无\n\n## 3. 使用要求\n\n无\n\n## 4. 关联能力\n\n暂无\n\n## 5. 来源依据\n\nx"
    return {"choices": [{"message": {"content": json.dumps({"items": [{"title": "名词", "doc_type": "function", "body": body, "tags": "AIC、浇水", **more}]}, ensure_ascii=False)}, "finish_reason": "stop"}]}


def test_model_exchange():
    chunk = {"source_doc": "a.md", "source_section": "名词", "content": DEFINITION, "context": "上下文", "facts": ["自动灌溉控制器以下简称“灌控器”，英文简称为 AIC，是供水设备。"]}
    seen, said = [], iter([{"choices": []}, {"choices": [{"message": {"content": '{"answer":"bad"}'}}]}, {"choices": [{"message": {"content": '{"items": [1,}'}, "finish_reason": "length"}]}, answer("灌控器即 AIC。"), answer(DEFINITION.split("\n")[1])])

    def complete(messages):
        seen.append([dict(m) for m in messages])
        return next(said)

    objects, missing = model_calls.converse(chunk, complete, "active", wait=lambda s: None)
    assert len(objects) == 1 and not missing and len(seen) == 5
    assert seen[2][4]["content"] == '{"answer":"bad"}' and "object keys=['answer']" in seen[2][5]["content"] and "截断" in seen[3][7]["content"] and "line 1, column" in seen[3][7]["content"]
    last = seen[4][-1]["content"]
    assert all(x in last for x in ("a.md", "名词", "AIC，是供水设备", "上下文", "灌控器即 AIC"))
    assert all(x in seen[0][1]["content"] for x in ("以下简称", "英文简称", DEFINITION, "status 为"))
    waits = []
    assert model_calls.converse(chunk, lambda m: 1 / 0, "active", wait=waits.append) == ([], []) and waits == [1, 2, 4, 8, 16, 30, 30, 30, 30]
    objects, missing = model_calls.converse(chunk, lambda m: answer("少"), "active", wait=lambda s: None)
    assert len(objects) == 1 and missing == chunk["facts"]


class Part:
    def __init__(self, **x):
        self.__dict__ |= x


def test_answers():
    wrap = lambda m: {"choices": [{"message": m}]}
    assert model_calls.answer_of(wrap({"content": [{"text": "a"}, {"text": "b"}]})) == "a\nb"
    assert model_calls.answer_of(Part(choices=[Part(message=Part(content=[Part(text="x")]))])) == "x"
    assert model_calls.answer_of(wrap({"content": "", "tool_calls": [{"function": {"arguments": "{}"}}]})) == "{}"
    assert model_calls.answer_of(wrap({"content": None, "reasoning_content": "r"})) == "r" and model_calls.answer_of({}) == ""
    assert model_calls.read_json("x ```json {\"a\": 1} ``` y").value == {"a": 1} and model_calls.read_json("```json\n[1]\n```").value == [1]
    bad = model_calls.read_json('{"a": 1,}')
    assert bad.value is None and "line 1, column" in bad.error
    assert model_calls.shape_of([1]) == "array len=1" and model_calls.truncated("{", "") and not model_calls.truncated("{}", "stop")


def test_by_model(spark, tmp_path):
    def complete(messages):
        if "坏" in messages[1]["content"]:
            return {"choices": [{"message": {"content": "no json"}}]}
        return answer("只有简称 AIC。", related_items=[{"大类": "甲", "title": "乙", "reason": "同组", "relevance": "强"}, {"小类标题": "乙", "大类标题": "甲"}, "x", {"category": "甲"}], risk_level="HIGH", category="灌溉")

    made = by_model(chunk_table(spark), CATALOGUE, "active", complete, store=f"{tmp_path}/answers", attempts=5, wait=lambda s: None)
    rows = {r.source_doc: r for r in made.collect()}
    good, bad = rows["定义.md"], rows["坏.md"]
    assert good.review_status == "coverage_warning" and good.status == "draft" and good.tags == ["AIC", "浇水", "需人工复核"] and "> - 自动灌溉控制器以下简称" in good.body
    assert good.doc_type == "biz" and good.kb_id.startswith("biz-offline-") and good.risk_level == "high" and good.category == "灌溉"
    assert [tuple(x) for x in good.related_items][0] == ("甲", "乙", "同组", "高") and len([x for x in good.related_items if x["小类标题"] == "乙"]) == 1
    assert bad.review_status == "failed" and "## failed_chunk_source\n\n```text\n# 坏" in bad.body and bad.body.endswith("```")

    def other(messages):  # only what had no answer is asked again
        assert "坏" in messages[1]["content"]
        return answer("花木", category="过冬")

    again = {r.source_doc: r for r in by_model(chunk_table(spark), CATALOGUE, "active", other, store=f"{tmp_path}/answers", attempts=1, wait=lambda s: None).collect()}
    assert again["定义.md"].body == good.body and again["坏.md"].category == "过冬"


class Server:
    """A chat model behind HTTP that answers what `say` returns."""

    def __init__(self, say):
        import threading
        from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

        asked = self.asked = []

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                asked.append((self.path, self.headers.get("Authorization"), body))
                said = json.dumps(say(body["messages"])).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(said)

            def log_message(self, *_):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.http.server_port}/v1"


def test_client():
    from folio.operators import model_client

    assert model_client.client_of(settings.ModelSettings()) is None
    with pytest.raises(ValueError):
        model_client.client_of(settings.ModelSettings(enabled=True))
    server = Server(lambda m: answer("x"))
    model = model_client.client_of(settings.ModelSettings(enabled=True, base_url=server.url + "/", api_key="k", model="m", temperature=0.5))
    assert "k" not in repr(model).replace("http", "").split("model")[0] and model([{"role": "user", "content": "花"}])["choices"]
    path, key, body = server.asked[0]
    assert (path, key, body["model"], body["temperature"], body["messages"][0]["content"]) == ("/v1/chat/completions", "Bearer k", "m", 0.5, "花")


def test_draft_and_retry_by_a_model(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda: spark)
    monkeypatch.setattr(jobs, "WAVE", 1)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n, text in (("a.md", "# 甲\n" + "苗床的水量每天看一次并且写进本子里。" * 4), ("b.md", "# 乙\n" + "坏的一页，没有人能整理出来，只好留到以后。" * 3)):
        (source / n).write_text(text, encoding="utf-8")
    works = [False]

    def say(messages):
        if "坏的一页" in messages[1]["content"] and not works[0]:
            return {"choices": [{"message": {"content": "no"}}]}
        return answer(messages[1]["content"].split("原文：\n")[1])

    server = Server(say)
    (tmp_path / "spec.md").write_text("写法须知", encoding="utf-8")
    (tmp_path / "c.yaml").write_text(f"llm: {{enabled: true, base_url: '{server.url}', model: m, max_attempts: 2, max_wait_seconds: 0}}\ndraft: {{context_chars: 0}}")
    args = ["draft", "--input", str(source), "--output", str(out), "--config", str(tmp_path / "c.yaml"), "--spec", str(tmp_path / "spec.md")]
    assert jobs.main(args) == 0
    names = sorted(p.name for p in out.iterdir())
    assert len(names) == 2 and sum("failed" in n for n in names) == 1 and "写法须知" in server.asked[0][2]["messages"][1]["content"]
    before = len(server.asked)
    assert jobs.main([*args, "--on-existing", "retry"]) == 0 and sorted(p.name for p in out.iterdir()) == names
    assert len(server.asked) > before
    works[0] = True
    (out / "x-failed-y.md").write_text("---\ntitle: x\n---\n\nno source", encoding="utf-8")
    assert jobs.main([*args, "--on-existing", "retry"]) == 0
    left = sorted(p.name for p in out.iterdir())
    assert len(left) == 3 and [n for n in left if "failed" in n] == ["x-failed-y.md"]
    asked = len(server.asked)
    assert jobs.main([*args, "--on-existing", "rebuild"]) == 0 and len(server.asked) == asked + 1  # the one that failed
    assert not [p for p in out.iterdir() if p.name != "x-failed-y.md" and "failed" in p.name]


def test_resume_goes_on_at_the_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda: spark)
    monkeypatch.setattr(jobs, "WAVE", 1)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n in "abc":
        (source / f"{n}.md").write_text(f"# {n}\n" + "苗床的水量每天看一次并且写进本子里。" * 4, encoding="utf-8")
    write, calls = sinks.write_files, []

    def stops(items, folder):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(items, folder)

    monkeypatch.setattr(sinks, "write_files", stops)
    with pytest.raises(RuntimeError):
        jobs.main(["draft", "--input", str(source), "--output", str(out)])
    state = jobs.progress_of(str(out))
    assert (state["status"], state["file_index"], state["source_order"], state["current_file_name"]) == ("failed", 1, 1, "b.md")
    assert jobs.main(["draft", "--input", str(source), "--output", str(out), "--on-existing", "resume"]) == 0
    names = sorted(p.name for p in out.iterdir())
    assert [n.split("-")[3] for n in names] == ["000001", "000002", "000003"] and len({n.split("-")[1] for n in names}) == 1 and len(calls) == 4


def test_missing_facts(spark):
    fact = "自动灌溉控制器以下简称“灌控器”，英文简称为 AIC，是供水设备。"
    rows = spark.createDataFrame([(DEFINITION, ["# t\n\n## 1. 核心内容\n\n短"]), (DEFINITION, [f"# t\n\n{fact}"]), (DEFINITION, [f"x\n## 4. 关联能力\n{fact}"])], "c string, b array<string>")
    assert [r.m for r in rows.select(coverage.missing_facts(F.col("c"), F.col("b")).alias("m")).collect()] == [[fact], [], [fact]]


def files_of(spark, rows):
    return spark.createDataFrame(rows, "path string, text string")


def page(meta, body):
    return "---\n" + meta + "\n---\n\n" + body


FULL = "\n".join(f"{f}: x" for f in ("kb_id", "title", "domain", "category_keywords", "business_modules", "source_doc", "source_version", "source_section", "owner", "confidentiality", "risk_level", "applicable_roles", "status", "source_order", "source_pages", "source_trace"))
GOOD = "# t\n\n" + "\n\n".join(f"## {i}. {t}\n\n内容" + "字" * 60 for i, t in enumerate(("核心内容", "适用边界", "使用要求", "关联能力", "来源依据"), 1))


def test_validation(spark):
    rows = [
        ("a.md", page(f"{FULL}\ndoc_type: biz\ncategory: 甲\nsubcategory: 乙\nrelated_items: []\ntags: []", GOOD)),
        ("b.md", page(f"{FULL}\ndoc_type: biz\ncategory: 甲\nsubcategory: 乙\nrelated_items: []\ntags: [AIC, abc]", GOOD.replace("## 5. 来源依据\n\n内容", "## 5. 来源依据\n\nAIC"))),
        ("c.md", page(f"{FULL}\ndoc_type: biz\ncategory: 甲\nsubcategory: 甲\nrelated_items: [x, {{大类标题: a, 小类标题: b, 关联说明: c, 关联度: 中}}, {{大类标题: a}}]\ntags: []", GOOD.replace("适用边界\n\n内容" + "字" * 60, "适用边界"))),
        ("d.md", "no front matter"), ("e.md", page("title: x", "short")),
    ]
    got = {}
    for r in validation.validate(generated.parsed(files_of(spark, rows))).orderBy("path", "pos").collect():
        got.setdefault(r.path, []).append(r.message)
    assert "a.md" not in got and got["b.md"] == ["关键缩写未进入正文核心章节: AIC"] and got["d.md"] == ["无法读取 Markdown Front Matter: 缺少 YAML Front Matter"]
    assert got["c.md"] == ["章节内容为空: ## 2", "小类与大类相同，分类层级可能未细化", "related_items[1] 应为对象", "related_items[2] 关联度不规范", "related_items[3] 缺少字段: 小类标题", "related_items[3] 缺少字段: 关联说明", "related_items[3] 缺少字段: 关联度", "related_items[3] 关联度不规范"]
    assert "doc_type 不合法: None" in got["e.md"] and "缺少必填字段: kb_id" in got["e.md"] and "正文较短，可能信息不足: 5 字符" in got["e.md"] and "二级标题少于 5 个，可能未遵照标准知识库结构" in got["e.md"]


def test_spread(spark):
    rows = [(f"{i}.md", page("category: 甲\nsubcategory: 乙\ncategory_keywords: [a, b]", "x")) for i in range(5)]
    spread = validation.spread_issues(generated.parsed(files_of(spark, rows)))
    assert [(r.path, r.message[:6]) for r in spread.orderBy("pos").collect()] == [("0.md", "所有文件的大"), ("0.md", "所有文件的 ")]
    assert validation.spread_issues(generated.parsed(files_of(spark, rows[:4]))).count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "b.md").write_bytes("# 甲\r\n乙\r丙".encode())
    (tmp_path / "in" / "sub" / "A.TXT").write_text("text", encoding="utf-8")
    (tmp_path / "in" / "bad.md").write_bytes(b"\xff\xfe")
    (tmp_path / "in" / "skip.csv").write_text("x")
    (tmp_path / "in" / "old.doc").write_bytes(b"x")
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(tmp_path / "in" / "c.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>标题</w:t></w:r></w:p><w:p><w:r><w:t>正文</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    (tmp_path / "in" / "p.pdf").write_bytes(b"pdf")
    docs = files.read_documents(spark, str(tmp_path / "in"), {"pdf": lambda b: ["1.1 概述", "第一行", "第二行", "12"]})
    rows = docs.orderBy("file_index").collect()
    assert [r.source_doc for r in rows] == ["A.TXT", "b.md", "bad.md", "c.docx", "old.doc", "p.pdf"] and [r.file_index for r in rows] == list(range(6))
    by = {r.source_doc: r for r in rows}
    assert by["b.md"].markdown == "# 甲\n乙\n丙" and by["bad.md"].error == "not UTF-8" and by["c.docx"].markdown == "## 标题\n\n正文\n\n| a | b |\n| --- | --- |"
    assert by["p.pdf"].markdown == "### 1.1 概述\n\n第一行第二行" and by["old.doc"].error
    assert files.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_docx():
    """Lists with their levels, links, a table in a cell, a cell over two columns, content controls, deleted text."""
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    said = lambda t: f"<w:r><w:t>{t}</w:t></w:r>"
    para = lambda t, more="": f"<w:p><w:pPr>{more}</w:pPr>{t}</w:p>"
    item = lambda t, number, level=0: para(said(t), f'<w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{number}"/></w:numPr>')
    cell = lambda t, more="": f"<w:tc><w:tcPr>{more}</w:tcPr>{t}</w:tc>"
    inner = f"<w:tbl><w:tr>{cell(para(said('x')))}{cell(para(said('y')))}</w:tr></w:tbl>"
    body = [
        para(said("Rules"), '<w:pStyle w:val="Heading1"/>'), item("one", 1), item("deep", 2, 1), item("two", 1), para(said("See ") + f'<w:hyperlink r:id="r1">{said("the page")}</w:hyperlink>' + "<w:del><w:r><w:delText>gone</w:delText></w:r></w:del>"),
        f"<w:sdt><w:sdtContent>{para(said('kept'))}</w:sdtContent></w:sdt>", item("plain", 0), para(said("dot"), '<w:pStyle w:val="ListBullet"/>'),
        f"<w:tbl><w:tr>{cell(para(said('wide')), '<w:gridSpan w:val=&quot;2&quot;/>'.replace('&quot;', chr(34)))}</w:tr><w:tr>{cell(para(said('a')) + para(said('b')))}{cell(inner + para(''))}</w:tr></w:tbl>",
    ]
    levels = lambda kind: "".join(f'<w:lvl w:ilvl="{i}"><w:numFmt w:val="{kind}"/></w:lvl>' for i in range(2))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("word/document.xml", f"<w:document {space}><w:body>{''.join(body)}</w:body></w:document>")
        z.writestr("word/numbering.xml", f'<w:numbering {space}><w:abstractNum w:abstractNumId="5">{levels("decimal")}</w:abstractNum><w:abstractNum w:abstractNumId="6">{levels("bullet")}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="5"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="6"/></w:num></w:numbering>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="http://h/p"/></Relationships>')
    assert files.docx_text(held.getvalue()).split("\n\n") == [
        "# Rules", "1. one\n    - deep\n2. two", "See [the page](http://h/p)", "kept", "plain", "- dot", "| wide | wide |\n| --- | --- |\n| a b | x y |",
    ]


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("llm: {enabled: 'yes', max_tokens: x, temperature: '0.5'}\ndraft: {max_chars: '100'}")
    m = settings.model_settings(str(tmp_path / "c.yaml"))
    assert m.enabled and m.max_tokens == 4096 and m.temperature == 0.5 and settings.draft_settings(str(tmp_path / "c.yaml")).max_chars == 100
    assert settings.draft_settings(None).context_chars == 800 and settings.as_bool(1, False) is False and settings.as_bool("off", True) is False
    (tmp_path / "t.yaml").write_text("tools:\n  - name: a\n  - x\n")
    assert settings.read_tools(str(tmp_path / "t.yaml")) == [{"name": "a"}] and settings.read_tools(str(tmp_path / "no.yaml")) == []
    (tmp_path / "bad.yaml").write_text("a: [")
    assert settings.read_tools(str(tmp_path / "bad.yaml")) == [] and settings.read_spec(None) == ""


def test_actions():
    assert [jobs.action_for(x) for x in ("１", "1：重来", "2", "3", "4", "R", "continue", "f", "")] == ["rebuild", "rebuild", "resume", "retry", "exit", "rebuild", "resume", "retry", "exit"]


def test_progress(tmp_path):
    assert jobs.progress_of(str(tmp_path)) is None
    jobs.save_progress(str(tmp_path), files=["a/one.md", "a/two.pdf"], file_index=1, block_index=3)
    got = jobs.progress_of(str(tmp_path))
    assert got["current_file_name"] == "two.pdf" and got["block_index"] == 3
    (tmp_path / jobs.PROGRESS).write_text("{")
    assert jobs.progress_of(str(tmp_path)) is None


def test_commands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda: spark)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for name, text in corpus.SAMPLES[:2]:
        (source / name).write_text(text, encoding="utf-8")
    assert jobs.main(["draft", "--input", str(source), "--output", str(out)]) == 0
    made = sorted(p.name for p in out.iterdir())
    assert made and all(n.endswith(".md") for n in made)
    text = (out / made[0]).read_text(encoding="utf-8")
    assert text.startswith("---\nkb_id: biz-offline-") and list(__import__("yaml").safe_load(text.split("---")[1]))[:3] == ["kb_id", "title", "doc_type"]
    assert jobs.main(["validate", "--input", str(out)]) == 0
    monkeypatch.setattr("builtins.input", lambda _: "４")
    assert jobs.main(["draft", "--input", str(source), "--output", str(out)]) == 0 and sorted(p.name for p in out.iterdir()) == made
    assert jobs.main(["draft", "--input", str(source), "--output", str(out), "--on-existing", "resume"]) == 1
    assert jobs.main(["draft", "--input", str(source), "--output", str(out), "--on-existing", "rebuild"]) == 0
    assert len(list(out.iterdir())) == len(made)
    assert jobs.main(["parse", "--input", str(source), "--output", str(tmp_path / "parsed")]) == 0
    assert (tmp_path / "parsed" / "花讯.parsed.md").read_text(encoding="utf-8") == corpus.SAMPLES[1][1]


def test_retry(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda: spark)
    source = "苗床的温度记录没有整理好，园丁要在周五之前重新抄写一遍，并且注明每一行的日期。"
    text = page("source_doc: 甲.md\nsource_section: 乙\nsource_pages: [3, x]\nsource_order: 7\ncategory: 丙\nreview_status: failed", f"# t\n\n## failed_chunk_source\n\n```text\n{source}\n```\n")
    (tmp_path / "x-failed-000007-y.md").write_text(text, encoding="utf-8")
    assert jobs.main(["draft", "--output", str(tmp_path), "--on-existing", "retry"]) == 0
    left = list(tmp_path.glob("*.md"))
    assert len(left) == 1 and "-000007-" in left[0].name and "failed" not in left[0].name and source in left[0].read_text(encoding="utf-8")


def test_resume_and_stream(spark, tmp_path):
    docs = corpus.samples(spark)
    whole = incremental.keyed(incremental.resume(docs, None, CATALOGUE))
    whole.write.parquet(f"{tmp_path}/done")
    done = spark.read.parquet(f"{tmp_path}/done")
    assert done.count() > 2 and incremental.resume(docs, done, CATALOGUE).count() == 0
    assert incremental.resume(docs, done.limit(1), CATALOGUE).count() == done.count() - 1
    (tmp_path / "in").mkdir()
    run = lambda: incremental.stream(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/check", CATALOGUE).awaitTermination()
    (tmp_path / "in" / "花讯.txt").write_text(corpus.SAMPLES[1][1], encoding="utf-8")
    run()
    assert spark.read.parquet(f"{tmp_path}/table").count() == 1
    (tmp_path / "in" / "养护.md").write_text(corpus.SAMPLES[0][1], encoding="utf-8")
    run()
    run()
    rows = spark.read.parquet(f"{tmp_path}/table").groupBy("source_doc").count().collect()
    assert {r.source_doc for r in rows} == {"花讯.txt", "养护.md"} and {r["count"] for r in rows if r.source_doc == "花讯.txt"} == {1}


def test_entry(spark):
    import __spark_entry__ as e

    names, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(names) and len(names) > 25
    assert e.entry(spark).limit(1).count() == 1


def test_texts_are_worked_on_once(docs):
    plan = parsing.parse(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
    assert chunking.chunks(parsing.parse(docs))._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_few_bytes_are_dealt_to_all_cores(docs):
    rows = parsing.related(parsing.blocks(parsing.document_profile(docs)))
    assert rows.rdd.getNumPartitions() >= 16  # a size by bytes gives one, whatever the work is


def test_unread_columns_are_not_made(docs):
    assert "keyword_lists" not in chunks_of(docs, context=False).select("content")._jdf.queryExecution().optimizedPlan().toString()


def test_keyword_lists_follow_the_text_rules(spark):
    from folio.operators import keywords

    rng = random.Random(11)
    words = ["abc", "def_1", "nuclear", "IPv4", "a_b__", "x" * 90, "中文ab12", "文档片段", "文档片段3", "全文检索", "来源文档", "接口", "接口说明", "|甲乙|", "## 节 题\n", "V2x", "全文v1", "abc", "接口"]
    rows = [(i, " ".join(rng.choices(words, k=3)), " ".join(rng.choices(words, k=4)), rng.choice(["\n", " "]).join(rng.choices(words, k=60)), " ".join(rng.choices(words, k=5))) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, c string, s string, x string, m string")
    bag = lambda *xs: F.filter(F.transform(F.concat(*xs), lambda t: T.again(t)), lambda t: t != "")
    s, x, m, c = T.tokens(F.col("s")), T.tokens(T.core_text(F.col("x"))), T.tokens(F.col("m")), T.tokens(F.col("c"))
    want = df.select("i", T.rank_tokens(bag(s, s, s, x, m), c).alias("all"), T.rank_tokens(bag(s, s, s, x), c).alias("own"), T.tokens(F.col("x")).alias("t"))
    got = df.select("i", keywords.keyword_lists(F.col("c"), F.col("s"), F.col("x"), F.col("m")).alias("l"), keywords.tokens(F.col("x")).alias("t")).select("i", "l.all", "l.own", "t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_outline_of_each_row_needs_no_second_pass(docs):
    rows = chunks_of(docs, context=False)
    told = chunking.with_outline(rows, 3).select("source_doc", "outline").distinct().collect()
    assert sorted(map(tuple, told)) == sorted(map(tuple, chunking.outline(rows, 3).select("source_doc", "outline").collect()))
    assert "Join" not in chunks_of(docs)._jdf.queryExecution().optimizedPlan().toString()
