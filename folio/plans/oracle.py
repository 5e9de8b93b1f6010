"""SQL for DuckDB that states the same rules as folio.functions.text and folio.operators, for comparison.

Each function returns the text of an expression; each name in CTE is a common table expression that may use those
before it. RE2 has no look-around, so texts are cut at marks that are put in first."""

from __future__ import annotations

from folio.functions import fixed as K
from folio.operators import tools
from folio.plans import corpus
from folio.plans.corpus import quoted as q

_SP = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S = f"[{_SP}]"
HAN = r"\x{4e00}-\x{9fff}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, {q(flags)})"


def like(x: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({x}, {q(pattern)}{', ' + q(flags) if flags else ''})"


def take(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def strip(x: str) -> str:
    return sub(sub(x, f"{S}+\\z"), f"\\A{S}+")


def strip_chars(x: str, chars: str) -> str:
    return sub(x, f"\\A[{chars}]+|[{chars}]+\\z")


def squeeze(x: str) -> str:
    return sub(x, f"{S}+", " ")


def either(x: str, y: str) -> str:
    return f"coalesce(nullif({x}, ''), {y})"


def each(xs: str, f, keep=None) -> str:
    out = f"list_transform({xs}, lambda e: {f('e')})"
    return f"list_filter({out}, lambda e: {keep('e')})" if keep else out


def lines(x: str) -> str:
    cut = f"string_split_regex({x}, {q(LINE_END)})"
    return f"(CASE WHEN {x} = '' THEN [] WHEN {cut}[-1] = '' THEN {cut}[:-2] ELSE {cut} END)"


def noise(x: str) -> str:
    d = r"\pN{1,4}"
    return "(" + " OR ".join([
        like(x, rf"\A[-—–_·•{_SP}]+\z"), like(x, rf"\A{d}\z"), like(x, rf"\A第{S}*{d}{S}*页(?:{S}*/{S}*共{S}*{d}{S}*页)?\z"), like(x, rf"(?i)\APage{S}+{d}(?:{S}+of{S}+{d})?\z"),
        f"contains({x}, '目 录')", f"(contains({x}, '目录') AND contains({x}, '...'))", f"length({x}) - length(replace({x}, '.', '')) >= 20", like(x, r"[\x00-\x08\x0b-\x1f\x7f]"),
    ]) + ")"


_APP = rf"附{S}*录{S}*[A-ZＡ-Ｚ]"
_NUM = r"\pN+(?:\.\pN+){1,4}"


def _hash(number: str, x: str) -> str:
    return f"concat(repeat('#', 2 + least(length({number}) - length(replace({number}, '.', '')), 2)), ' ', {x})"


def recovered(raw: str) -> str:
    p = rf"\A({_NUM}|第[一二三四五六七八九十百]+[章节条]|{_APP})[{_SP}、.．]*([^\n]{{2,80}})\z"
    x = strip(raw)
    return f"(CASE WHEN {like(x, p)} AND NOT starts_with({x}, '#') AND {like(strip(take(x, p, 2)), rf'\A[{HAN}A-Za-z]')} THEN {_hash(take(x, p), x)} ELSE {raw} END)"


def heading_of_line(x: str) -> str:
    p = rf"\A({_NUM})[、.．{_SP}]*([^\n]{{2,100}})\z"
    return (
        f"(CASE WHEN starts_with({x}, '#') THEN {x} WHEN {like(x, p)} THEN CASE WHEN {like(strip(take(x, p, 2)), rf'\A[{HAN}A-Za-z]')} THEN {_hash(take(x, p), x)} ELSE '' END "
        f"WHEN {like(x, rf'\A第[一二三四五六七八九十百千万]+[章节条][、.．{_SP}]*[^\n]{{2,100}}\z')} OR {like(x, rf'\A{_APP}{S}*[^\n]{{2,100}}\z')} THEN concat('## ', {x}) ELSE '' END)"
    )


def first_heading(x: str) -> str:
    p = rf"\A#{{1,4}}{S}+([^\n]+)\z"
    return f"coalesce({strip(take(f'list_filter({each(lines(x), strip)}, lambda e: {like("e", p)})[1]', p))}, '')"


def clean_category(x: str) -> str:
    y = strip_chars(squeeze(x), r" #\t\r\n")
    return either(f"substr({strip(sub(y, rf'\A(文档片段|全文){S}*\pN*', '', ''))}, 1, 80)", q(K.UNSORTED))


def clean_heading_title(x: str) -> str:
    y = strip(sub(clean_category(x), rf"\A\pN+(?:\.\pN+)*{S}*[、.．]?{S}*", "", ""))
    return strip(sub(y, rf"\A第[一二三四五六七八九十百]+[章节条]{S}*[、.．]?{S}*", "", ""))


def useful(x: str) -> str:
    c = clean_category(x)
    bad = [like(c, r"\A(?:\pN+|[A-ZＡ-Ｚ])(?:\.\pN+)*\z"), f"{c} IN ({', '.join(map(q, K.USELESS_HEADINGS))})", *[f"starts_with({c}, {q(p)})" for p in K.USELESS_PREFIXES], *[f"contains({c}, {q(p)})" for p in K.USELESS_PARTS]]
    return f"NOT ({' OR '.join(bad)})"


def subcategory(section: str, content: str) -> str:
    t = clean_heading_title(section)
    return clean_category(f"(CASE WHEN {t} = '' OR starts_with({t}, {q(K.PIECE)}) THEN {either(first_heading(content), t)} ELSE {t} END)")


def unique(xs: str, clean) -> str:
    """First occurrences of the cleaned values, in order."""
    c = f"list_filter({each(xs, clean)}, lambda e: e <> '')"
    return f"list_filter({c}, lambda e, i: list_position({c}, e) = i)"


def _keyword(t: str) -> str:
    t = strip_chars(sub(t, r"\A[A-Z]\.\pN+(?:\.\pN+)?", "", ""), " \\-_：:")
    bad = [f"length({t}) < 2", f"{t} IN ({', '.join(map(q, K.KEYWORD_STOPWORDS))})", like(t, r"\A\pN+(?:\.\pN+)*\z"), like(t, r"(?i)NUC|V\pN+")]
    return f"(CASE WHEN {' OR '.join(bad)} THEN '' ELSE substr({t}, 1, 32) END)"


def clean_keyword(x: str) -> str:
    return _keyword(clean_category(x))


def tokens(x: str) -> str:
    return f"list_filter({each(f'regexp_extract_all({x}, {q(f"[A-Za-z][A-Za-z0-9_]{{2,}}|[{HAN}][{HAN}A-Za-z0-9]{{1,18}}")})', clean_keyword)}, lambda e: e <> '')"


def core_text(x: str) -> str:
    y = sub(x, rf"(?m)^#{{1,6}}{S}+[^\n]*$")
    return f"substr({sub(y, r'\|[^\n]*?\|', ' ')}, 1, 1600)"


def family(x: str) -> str:
    s, letter = strip(x), r"\A([A-Za-zＡ-Ｚａ-ｚ])\.\pN+"
    n = take(s, r"\A(\pN+(?:\.\pN+)*)")
    return f"(CASE WHEN {like(s, letter)} THEN upper({take(s, letter)}) WHEN contains({n}, '.') THEN {sub(n, r'\.[^.]*\z')} ELSE {n} END)"


def prefix(x: str) -> str:
    return take(strip(x), r"\A(\pN+\.\pN+)(?:[^.]|\z)") if False else f"(CASE WHEN {like(strip(x), r'\A\pN+\.\pN+(?:[^.]|\z)')} THEN {take(strip(x), r'\A(\pN+\.\pN+)(?:[^.]|\z)')} ELSE '' END)"


def coverage_text(x: str) -> str:
    y = sub(x, rf"(?m)^#{{1,6}}{S}+[^\n]*$")
    return f"lower({sub(y, rf'[{_SP}`*_#|>：:，,。；;！？!?、（）()【】\[\]《》“”"\'‘’.\-—–]+')})"


def facts(x: str) -> str:
    rule = rf"\A\|?{S}*:?-{{3,}}:?{S}*(?:\|{S}*:?-{{3,}}:?{S}*)+\|?\z"
    kept = f"list_filter({each(lines(x), strip)}, lambda e: e <> '' AND NOT starts_with(e, '#') AND NOT {like('e', rule)})"
    plain = each(kept, lambda e: sub(sub(sub(e, rf"\A[-*+]{S}+", "", ""), rf"\A\pN+[、.．)]{S}*", "", ""), r"\*\*([^\n]*?)\*\*", r"\1"))
    cut = each(f"flatten({each(plain, lambda e: f'string_split({sub(e, rf"([。；;！？!?]){S}*", chr(92) + "1" + chr(1))}, chr(1))')})", strip)
    long = f"list_filter({each(cut, lambda e: f'{{{chr(39)}s{chr(39)}: {e}, {chr(39)}k{chr(39)}: {coverage_text(e)}}}')}, lambda e: length(e.k) >= 12)"
    return f"list_transform(list_filter({long}, lambda e, i: list_position(list_transform({long}, lambda o: o.k), e.k) = i), lambda e: e.s)"


def compact(x: str, n: int) -> str:
    y = strip(squeeze(x))
    return f"(CASE WHEN length({y}) <= {n} THEN {y} ELSE concat({sub(f'substr({y}, 1, {n})', f'{S}+' + chr(92) + 'z')}, '...') END)"


def version(x: str) -> str:
    n = take(x, rf"[vV]{S}*(\pN+(?:\.\pN+)*)")
    return f"(CASE WHEN {n} <> '' THEN concat('V', {n}) ELSE '' END)"


def ranked(values: str, keys: str, category: str, table: str) -> str:
    """A query: (keys, words) of the best ten tokens, from the list `values` and the list `category` of each row."""
    return f"""SELECT {keys}, list(t ORDER BY r) FILTER (WHERE r <= 10) AS words FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, pos) AS r FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys}, own ORDER BY n DESC, pos) AS ro FROM (
          SELECT {keys}, t, count(*) AS n, min(i) AS pos, any_value(list_contains(cats, t)) AS own FROM (
            SELECT {keys}, {category} AS cats, unnest({values}) AS t, generate_subscripts({values}, 1) AS i FROM {table}) GROUP BY {keys}, t))
      WHERE NOT own OR ro <= 3) GROUP BY {keys}"""


# --- common table expressions ---------------------------------------------------------------------

_PIECES = f"""list_filter({each(f"string_split(regexp_replace(list_aggregate(list_transform(list_filter({lines('markdown')}, lambda e: NOT {noise(strip('e'))}), lambda e: {recovered('e')}), 'string_agg', chr(10)), {q(chr(10) + '(#{1,4}' + S + ')')}, concat(chr(1), {q(chr(92) + '1')}), 'g'), chr(1))", strip)}, lambda e: e <> '')"""
_TOP, _ANY = rf"\A#{S}+([^\n]+)\z", rf"\A#{{1,4}}{S}+([^\n]+)\z"

CTE = {
    "d": corpus.SECTIONED_SQL,
    "p": f"SELECT *, coalesce({_PIECES}, []) AS pieces FROM d",
    "b0": f"SELECT file_index, source_doc, unnest(range(len(pieces))) AS block_index, unnest(pieces) AS content FROM p",
    "b1": f"SELECT *, {either(first_heading('content'), f"concat('{K.PIECE} ', block_index + 1)")} AS source_section FROM b0",
    "f0": f"""SELECT p.file_index, p.source_doc, stem, {each(lines('markdown'), strip)} AS ls, list(source_section ORDER BY block_index) FILTER (WHERE source_section IS NOT NULL) AS sections
              FROM p LEFT JOIN b1 ON b1.file_index = p.file_index GROUP BY ALL""",
    "f1": f"""SELECT *, {clean_category(f"coalesce({take(f'list_filter(ls[1:80], lambda e: {like("e", _TOP)})[1]', _TOP)}, CASE WHEN NOT starts_with(sections[1], '{K.PIECE}') THEN sections[1] END, stem)")} AS category,
              list_filter(list_transform(list_filter(ls, lambda e: {like('e', _ANY)}), lambda e: {take('e', _ANY)}), lambda e: {useful('e')}) AS raw FROM f0""",
    "f2": f"SELECT *, {unique(f'CASE WHEN len(raw) > 0 THEN raw ELSE list_filter(coalesce(sections, [])[1:12], lambda e: {useful("e")}) END', clean_category)}[1:12] AS headings FROM f1",
    "f3": f"SELECT *, list_filter(headings, lambda e: e <> category) AS others, list_concat([category], headings) AS seeds FROM f2",
    "f": f"""SELECT file_index, source_doc, category, headings,
              CASE WHEN len(others) > 0 THEN concat('本分类对应来源文档《', category, '》，用于归集与', array_to_string(others[1:4], '、'), '相关的知识条目。') ELSE concat('本分类对应来源文档《', category, '》，用于归集该文档中的知识条目。') END AS category_description,
              CASE WHEN len(others) > 0 THEN concat('本文件围绕《', category, '》展开，主要覆盖', array_to_string(others[1:6], '、'), '等主题。') ELSE concat('本文件围绕《', category, '》展开，用于沉淀来源文档中的主要知识条目。') END AS source_doc_description,
              {unique(f"flatten(list_transform(seeds, lambda s: list_append(list_filter(list_transform(string_split_regex(s, {q(rf'[{_SP},，、;；/／|｜（）()《》【】{chr(92) * 2}-]+')}), lambda e: {clean_category('e')}), lambda e: length(e) >= 2), s)))", clean_category)}[1:16] AS doc_keywords FROM f3""",
    "b2": f"SELECT b1.*, f.category, f.category_description, f.source_doc_description, f.doc_keywords, {subcategory('source_section', 'content')} AS subcategory FROM b1 JOIN f USING (file_index, source_doc)",
    "b3": f"SELECT *, {tokens('subcategory')} AS tt, {tokens('category')} AS ct, {tokens(core_text('content'))} AS xt, {tokens("array_to_string(doc_keywords[1:3], ' ')")} AS dt FROM b2",
    "b4": "SELECT *, list_concat(list_concat(list_concat(tt, tt), tt), xt) AS own0, list_concat(list_concat(list_concat(list_concat(tt, tt), tt), xt), dt) AS all0 FROM b3",
    "b5": f"SELECT *, list_filter({each('own0', clean_keyword)}, lambda e: e <> '') AS own, list_filter({each('all0', clean_keyword)}, lambda e: e <> '') AS al FROM b4",
    "k1": ranked("al", "file_index, source_doc, block_index", "ct", "b5"),
    "k2": ranked("own", "file_index, source_doc, block_index", "ct", "b5"),
    "b": f"""SELECT b5.*, coalesce(k1.words, []) AS words, coalesce(k2.words, []) AS plain_words, {family('source_section')} AS fam,
              list_transform(regexp_extract_all(source_section, {q(f'第{S}*({chr(92)}pN+){S}*页')}, 1), lambda e: CAST(e AS INTEGER)) AS pages
              FROM b5 LEFT JOIN k1 USING (file_index, source_doc, block_index) LEFT JOIN k2 USING (file_index, source_doc, block_index)""",
    "s0": "SELECT file_index, source_doc, source_section, subcategory, plain_words, any_value(tt) AS tt, any_value(fam) AS fam, min(block_index) AS first FROM b GROUP BY file_index, source_doc, source_section, subcategory, plain_words",
    "s1": "SELECT *, row_number() OVER (PARTITION BY file_index, source_doc ORDER BY first) - 1 AS idx FROM s0",
    "s": "SELECT *, min(idx) OVER (PARTITION BY file_index, source_doc, source_section, subcategory) AS own_idx FROM s1",
    "r0": f"""SELECT b.file_index, b.source_doc, b.block_index, o.subcategory AS name, abs(o.idx - m.own_idx) AS distance, CAST(b.fam <> '' AND b.fam = o.fam AS INTEGER) AS same,
              list_filter(b.words, lambda e: list_contains(o.plain_words, e)) AS w, list_filter(b.tt, lambda e, i: list_contains(o.tt, e) AND list_position(b.tt, e) = i) AS t
              FROM b JOIN (SELECT DISTINCT file_index, source_doc, source_section, subcategory, own_idx FROM s) m USING (file_index, source_doc, source_section, subcategory)
              JOIN s o ON o.file_index = b.file_index AND o.source_doc = b.source_doc AND o.subcategory <> b.subcategory WHERE {useful('o.subcategory')}""",
    "r1": f"""SELECT *, len(w) * 3.0::DOUBLE + len(t) * 2.0::DOUBLE + same * 2.0::DOUBLE - least(distance, 8) * 0.25::DOUBLE AS score,
              {unique("list_concat(list_transform(list_sort(list_transform(w, lambda e: {'n': -length(e), 'x': e})), lambda e: e.x), list_transform(list_sort(list_transform(t, lambda e: {'n': -length(e), 'x': e})), lambda e: e.x))", clean_category)}[1:3] AS reasons FROM r0""",
    "r2": "SELECT *, row_number() OVER (PARTITION BY file_index, source_doc, block_index, name ORDER BY score DESC, distance DESC, array_to_string(reasons, chr(1)) DESC, same DESC) AS rn FROM r1",
    "r3": "SELECT *, row_number() OVER (PARTITION BY file_index, source_doc, block_index ORDER BY score DESC, distance DESC, name DESC) AS n FROM r2 WHERE rn = 1",
    "r": """SELECT file_index, source_doc, block_index, CAST(n AS INTEGER) AS n, name AS title, score,
              concat(coalesce(nullif(concat_ws('；', CASE WHEN len(reasons) > 0 THEN concat('与当前小类共享核心语义：', array_to_string(reasons, '、')) END, CASE WHEN same = 1 THEN '来源结构处于同一章节组' END, CASE WHEN distance <= 2 THEN '章节位置接近' END), ''), '与当前小类存在可参考的相近主题'), '。') AS info,
              CASE WHEN score >= 5 THEN '高' WHEN score >= 2 OR distance <= 2 THEN '一般' ELSE '低' END AS relevance FROM r3 WHERE n <= 5""",
    # chunks
    "m0": f"SELECT *, {prefix('source_section')} AS pre, {prefix('source_section')} <> '' AND length({strip('content')}) < {K.PARENT_CHARS} AS parent FROM b",
    "m1": "SELECT *, sum(CAST(parent AS INTEGER)) OVER (PARTITION BY file_index, source_doc ORDER BY block_index) AS seg FROM m0",
    "m2": f"""SELECT *, CAST(seg > 0 AND (parent OR starts_with({strip('source_section')}, concat(first_value(pre) OVER w, '.'))) AS INTEGER) AS child, first_value(block_index) OVER w AS lead
              FROM m1 WINDOW w AS (PARTITION BY file_index, source_doc, seg ORDER BY block_index)""",
    "m3": "SELECT *, CASE WHEN min(child) OVER (PARTITION BY file_index, source_doc, seg ORDER BY block_index) = 1 THEN lead ELSE block_index END AS head FROM m2",
    "m": """SELECT file_index, source_doc, head AS block_index, arg_min(source_section, block_index) AS source_section, string_agg(content, concat(chr(10), chr(10)) ORDER BY block_index) AS content, arg_min(category, block_index) AS category,
              arg_min(subcategory, block_index) AS subcategory, arg_min(words, block_index) AS words, arg_min(category_description, block_index) AS category_description, list_sort(list_distinct(flatten(list(pages)))) AS pages, count(*) AS parts FROM m3 GROUP BY file_index, source_doc, head""",
}


def pack(parts: str, limit: int) -> str:
    unit = each(parts, lambda e: f"{{'d': CAST([] AS VARCHAR[]), 'c': {e}, 'n': length({e})}}")
    step = f"list_reduce({unit}, lambda a, e: CASE WHEN a.n + e.n > {limit} THEN {{'d': list_append(a.d, a.c), 'c': e.c, 'n': e.n}} ELSE {{'d': a.d, 'c': concat(a.c, chr(10), chr(10), e.c), 'n': a.n + e.n}} END)"
    return f"(SELECT list_append(r.d, r.c) FROM (SELECT {step} AS r))"


def paragraphs(x: str) -> str:
    return f"list_filter({each(f'string_split_regex({x}, {q(chr(10) + S + "*" + chr(10))})', strip)}, lambda e: e <> '')"


def chunk_ctes(limit: int) -> dict[str, str]:
    """Chunks of m. Sections are packed after each long one is cut, so the fold is one over runs between long ones."""
    mark = f"regexp_replace({strip('content')}, {q(chr(10) + '(#{2,4}' + S + ')')}, concat(chr(1), {q(chr(92) + '1')}), 'g')"
    return {
        "c0": f"SELECT *, list_filter({each(f'string_split({mark}, chr(1))', strip)}, lambda e: e <> '') AS sections, length({strip('content')}) > {limit} AS long FROM m",
        "c1": f"SELECT file_index, source_doc, block_index, len(sections) AS n_sections, unnest(range(len(sections))) AS si, unnest(sections) AS sec FROM c0 WHERE long",
        "c2": f"SELECT *, (length(sec) > {limit} OR n_sections = 1) AS big, sum(CAST(length(sec) > {limit} OR n_sections = 1 AS INTEGER)) OVER (PARTITION BY file_index, source_doc, block_index ORDER BY si) AS bigs FROM c1",
        "c3": "SELECT file_index, source_doc, block_index, big, bigs, CASE WHEN big THEN si ELSE -1 END AS k, min(si) AS si, list(sec ORDER BY si) AS secs FROM c2 GROUP BY ALL",
        "c4": f"SELECT *, CASE WHEN big THEN {paragraphs('secs[1]')} ELSE secs END AS parts FROM c3",
        "c5": f"SELECT *, {pack('parts', limit)} AS texts FROM c4",
        "c6": "SELECT file_index, source_doc, block_index, si, unnest(range(len(texts))) AS ti, unnest(texts) AS t FROM c5",
        "c7": f"SELECT *, row_number() OVER (PARTITION BY file_index, source_doc, block_index ORDER BY si, ti) AS i, {strip('t')} AS st FROM c6",
        "c8": f"""SELECT c0.* EXCLUDE (sections, long), 0 AS piece_index, block_index AS ord FROM c0 WHERE NOT long
                  UNION ALL BY NAME SELECT c0.* EXCLUDE (sections, long, content, source_section), st AS content, concat(source_section, ' / 片段 ', i) AS source_section, CAST(i AS INTEGER) AS piece_index, block_index * 100 + i AS ord FROM c7 JOIN c0 USING (file_index, source_doc, block_index) WHERE st <> ''""",
        "c": f"SELECT * FROM c8 WHERE length({strip('content')}) >= {K.MIN_CHUNK}",
    }


def query(last: str, select: str, extra: dict[str, str] | None = None) -> str:
    """SQL with the expressions up to `last`, then `extra`, then the select."""
    use: dict[str, str] = {}
    for name, sql in CTE.items():
        use[name] = sql
        if name == last:
            break
    use |= extra or {}
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({s})" for n, s in use.items()) + "\n" + select


def build_body(title: str, content: str) -> str:
    text = strip(sub(strip(content), rf"\A#{{1,4}}{S}+[^\n]+\n?", "", ""))
    nl = "chr(10), chr(10)"
    answers = (text, q(K.NOT_STATED), q(K.USE_RULE), q(K.NO_TOOLS), q(K.SOURCE_BODY))
    parts = ", ".join(f"{nl}, '## {i}. {n}', {nl}, {a}" for i, (n, a) in enumerate(zip(K.SECTION_TITLES, answers, strict=True), 1))
    return strip(f"concat('# ', {title}, {parts})")


def strip_denied(x: str) -> str:
    cut = f"string_split({sub(x, '([。！？' + chr(10) + '])', chr(92) + '1' + chr(1))}, chr(1))"
    return f"array_to_string(list_filter({cut}, lambda e: NOT {like('e', '(?i)(不涉及|无需|不需要|不得|禁止|不包括)[^' + chr(10) + ']{0,24}(函数|接口|api|工具|能力|查询)')}), '')"


def match_tokens(x: str) -> str:
    raw = f"list_filter(regexp_extract_all(lower({x}), {q(f'[a-z0-9_]{{3,}}|[{HAN}]{{2,}}')}), lambda e: e NOT IN ({', '.join(map(q, K.MATCH_STOPWORDS))}))"
    return f"list_distinct(list_concat({raw}, flatten(list_transform({raw}, lambda e: CASE WHEN {like('e', f'[{HAN}]')} AND length(e) > 4 THEN list_transform(range(1, length(e) - 2), lambda i: substr(e, i, 4)) ELSE [] END))))"


def tool_score(source: str, found: str, tool: dict) -> str:
    names = [n for k in ("name", "display_name") if (n := str(tool.get(k) or "").strip().lower())]
    literal = [f"contains(lower({source}), {q(n)})" for n in names] + [f"contains({sub(f'lower({source})', S + '+')}, {q(p)})" for p in tools.phrases_of(tool)]
    words = tools._significant(tools._tokens_of(f"{tool.get('description') or ''} {tool.get('trigger') or ''}"))
    n = f"len(list_filter({found}, lambda e: e IN ({', '.join(map(q, words)) or "''"})))"
    return f"CASE WHEN {' OR '.join(literal) or 'false'} THEN greatest({n}, 8) WHEN {n} >= 4 THEN {n} END"
