"""Texts, word lists and limits that are part of the results and must stay as they are."""

from __future__ import annotations

# --- fixed values: enumerations and constant fields
DOC_TYPES = ("biz", "function")
DOMAIN = "通用业务"
OWNER = "通用知识库"
CONFIDENTIALITY = "内部"
RISK_LEVELS = ("low", "medium", "high", "critical")
RELEVANCE = ("极高", "高", "一般", "低")
RELEVANCE_HIGH = ("最高", "强", "较高")
RELEVANCE_NORMAL = ("中", "中等", "普通")
UNSORTED = "未分类"
PIECE = "文档片段"
WHOLE_TEXT = "全文"
UNTITLED_ITEM = "待整理知识条目"
REVIEW_TAG = "需人工复核"

# --- fixed values: limits
MAX_CHARS = 3600
CONTEXT_CHARS = 800
OUTLINE_SECTIONS = 40
MIN_CHUNK = 40
PARENT_CHARS = 120
MODEL_ATTEMPTS = 10
COVERAGE_ATTEMPTS = 3

# --- fixed values: word lists
KEYWORD_STOPWORDS = ("知识条目", "来源文档", "核心内容", "适用边界", "使用要求", "关联能力", "来源依据", "暂无", "原文未明确说明", "本分类", "当前小类", "小类标题")
USELESS_HEADINGS = ("目录", "前言", "范围", "术语和定义", "规范性引用文件", "未分类")
USELESS_PREFIXES = ("Q/", "ICS", "CCS")
USELESS_PARTS = ("\\", "fonttbl", "ansi")
MATCH_STOPWORDS = ("查询", "情况", "当前", "根据", "用于", "辅助", "例如", "包括", "用户", "所属", "对象", "主体", "时间", "场景", "知识", "条目", "来源", "文档", "规则", "要求")
MATCH_NOISE = ("api", "接口", "服务", "工具", "函数", "查询", "获取", "列表", "详情", "具体", "类型", "状态", "编码", "名称", "标识")
SECTION_TITLES = ("核心内容", "适用边界", "使用要求", "关联能力", "来源依据")
REQUIRED_FIELDS = ("kb_id", "title", "doc_type", "domain", "category", "category_keywords", "business_modules", "source_doc", "source_version", "source_section", "owner", "confidentiality", "risk_level", "applicable_roles", "tags", "status")
TRACE_FIELDS = ("source_order", "source_pages", "source_trace")
RELATION_FIELDS = ("subcategory", "related_items")
RELATED_KEYS = ("大类标题", "小类标题", "关联说明", "关联度")
ITEM_FIELDS = (
    "kb_id", "title", "doc_type", "domain", "category", "category_keywords", "subcategory", "related_items", "business_modules", "source_doc", "source_version", "source_section",
    "source_order", "source_pages", "source_trace", "effective_date", "owner", "confidentiality", "risk_level", "applicable_roles", "tags", "status", "review_status",
)

# --- fixed values: sentences of items
NO_TOOLS = "暂无。"
NOT_STATED = "原文未明确说明。"
USE_RULE = "当用户咨询本条目相关问题时，模型应基于来源依据回答；缺少关键数据时，应说明需要补充的信息，不得主观推断。"
SOURCE_BODY = "基于来源章节归纳，需人工复核原文一致性。"
SOURCE_NOTE = "- 来源说明：基于来源章节归纳，需人工复核原文一致性。"
LEGACY_RELATION = "与当前小类存在结构、标题或核心语义上的关联，可作为补充参考。"
LEGACY_PHRASE = r"回答时应结合来源章节区分适用场景、交互对象和处理要求。?"
LEGACY_SAME = r"^[“”\"']?[^“”\"']{1,80}[“”\"']?与[“”\"']?[^“”\"']{1,80}[“”\"']?同属[“”\"']?[^“”\"']{1,120}[“”\"']?大类[，,]?"
FAILED_NOTE = "## LLM 生成失败警告\n\nWARNING: LLM 多次重试后仍未返回合格 JSON，本文件由离线规则兜底生成，需人工核对。\n\n## failed_chunk_source\n\n```text\n"
COVERAGE_NOTE = "> WARNING: LLM 多次重试后仍未通过来源事实覆盖校验，本条目已降为草稿，需人工复核。"
COVERAGE_LIST = "> 待人工补齐或确认的来源事实："
SPREAD_CATEGORY = "所有文件的大类/小类几乎一致，分类可能退化"
SPREAD_KEYWORDS = "所有文件的 category_keywords 完全一致，关键词区分度不足"
