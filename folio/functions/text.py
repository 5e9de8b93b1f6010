"""Text rules as Column expressions.

Character classes are written out, because the JVM's, Python's and RE2's shorthands differ: SPACE is all
white space, `.` is [^\n], and lines end at \n alone unless a rule says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions import fixed as K

#: White space, for use within a character class. Single characters below 256 are one table for the JVM, and the rest
#: stands behind one test of its range, so that what is no white space is told by two steps and not by one for each range.
SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
S = f"[{SPACE}]"
HAN = r"一-鿿"
#: Ends of lines where a text is cut into lines, besides \r\n.
LINE_END = r"[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
TOKEN = rf"[A-Za-z][A-Za-z0-9_]{{2,}}|[{HAN}][{HAN}A-Za-z0-9]{{1,18}}"


#: The characters of SPACE, and those of a rule of dashes.
BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
DASHES = "-—–_·•" + BLANKS


# Ends are cut natively: a pattern that ends at \z is tried at each blank of a text, and texts are decoded for it.


def strip_left(x: Column) -> Column:
    return F.ltrim(x, F.lit(BLANKS))


def strip_right(x: Column) -> Column:
    return F.rtrim(x, F.lit(BLANKS))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANKS))


def strip_chars(x: Column, chars: str) -> Column:
    return F.btrim(x, F.lit(chars))


def squeeze(x: Column) -> Column:
    return F.regexp_replace(x, f"{S}+", " ")


def bind(value: Column, then) -> Column:
    """then(value), with the value computed once: inside lambdas nothing else shares repeated parts."""
    return F.transform(F.array(value), then)[0]


def once(f):
    """f of one column, with that column computed once."""

    def bound(x: Column) -> Column:
        return bind(x, lambda v: f(v))

    bound.__doc__ = f.__doc__
    return bound


def or_else(x: Column, other) -> Column:
    """x, or the other value where x is empty or null."""
    y = other if isinstance(other, Column) else F.lit(other)
    return bind(x, lambda v: F.when(v != "", v).otherwise(y))


def lines(x: Column) -> Column:
    """The lines of a text; a final line end starts no line."""
    return bind(F.split(F.replace(x, F.lit("\r\n"), F.lit("\n")), LINE_END), lambda cut: F.when(F.element_at(cut, -1) == "", F.slice(cut, F.lit(1), F.size(cut) - 1)).otherwise(cut))


def replaced(x: Column, mark: str, pattern: str, to: str) -> Column:
    """x with the pattern replaced; only a text that has the mark, which is part of all that matches, is searched."""
    return bind(x, lambda v: F.when(v.contains(mark), F.regexp_replace(v, pattern, to)).otherwise(v))


def matches(x: Column, pattern: str) -> Column:
    """The whole of x matches."""
    return x.rlike(f"\\A(?:{pattern})\\z")


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def first_group(x: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(x, pattern, group)


# --- lines ----------------------------------------------------------------------------------------


def normal_line(x: Column) -> Column:
    return strip(F.regexp_replace(F.translate(x, "\u00a0", " "), "[ \t]+", " "))


@once
def is_noise(x: Column) -> Column:
    """Rules of dashes, page numbers, entries of a table of contents, lines with control characters."""
    digits = r"\p{Nd}{1,4}"
    return any_of([
        (x != "") & (F.ltrim(x, F.lit(DASHES)) == ""),
        (F.length(x) <= 4) & matches(x, digits),
        x.startswith("第") & matches(x, rf"第{S}*{digits}{S}*页(?:{S}*/{S}*共{S}*{digits}{S}*页)?"),
        (x.startswith("P") | x.startswith("p")) & matches(x, rf"(?iu:Page){S}+{digits}(?:{S}+(?iu:of){S}+{digits})?"),
        x.contains("目 录") | (x.contains("目录") & x.contains("...")),
        F.length(x) - F.length(F.replace(x, F.lit("."))) >= 20,
        x.rlike(r"[\x00-\x08\x0b-\x1f\x7f]"),
    ])


_NUMBERED = r"\p{Nd}+(?:\.\p{Nd}+){1,4}"
_APPENDIX = rf"附{S}*录{S}*[A-ZＡ-Ｚ]"


def _depth(number: Column) -> Column:
    return F.lit(2) + F.least(F.length(number) - F.length(F.replace(number, F.lit("."))), F.lit(2))


def _marked(number: Column, x: Column) -> Column:
    return F.concat(F.repeat(F.lit("#"), _depth(number).cast("int")), F.lit(" "), x)


@once
def heading_of_line(x: Column) -> Column:
    """The Markdown heading of a line of extracted text, "" if it is none."""
    numbered = rf"\A({_NUMBERED})[、.．{SPACE}]*([^\n]{{2,100}})\z"
    title = strip(first_group(x, numbered, 2))
    return (
        F.when(x.startswith("#"), x)
        .when(x.rlike(numbered), F.when(title.rlike(rf"\A[{HAN}A-Za-z]"), _marked(first_group(x, numbered), x)).otherwise(""))
        .when(x.rlike(rf"\A第[一二三四五六七八九十百千万]+[章节条][、.．{SPACE}]*[^\n]{{2,100}}\z") | x.rlike(rf"\A{_APPENDIX}{S}*[^\n]{{2,100}}\z"), F.concat(F.lit("## "), x))
        .otherwise("")
    )


def recovered(raw: Column) -> Column:
    """A raw line of a document, as a heading if it is one."""
    pattern = rf"\A({_NUMBERED}|第[一二三四五六七八九十百]+[章节条]|{_APPENDIX})[{SPACE}、.．]*([^\n]{{2,80}})\z"

    def judge(x: Column) -> Column:
        good = x.rlike(pattern) & ~x.startswith("#") & strip(first_group(x, pattern, 2)).rlike(rf"\A[{HAN}A-Za-z]")
        return F.when(good, _marked(first_group(x, pattern), x)).otherwise(raw)

    return bind(strip(raw), judge)


def separate_headings(x: Column) -> Column:
    """Headings that got stuck to the paragraph before them get lines of their own."""
    at = F.instr(x, "前 言本指引")
    x = F.when(at > 1, F.substring(x, at, F.length(x))).otherwise(x)
    x = F.regexp_replace(x, rf"(?<=指引|说明|文件|策略|评价|内容|范围)(\p{{Nd}}+\.\p{{Nd}}+(?:\.\p{{Nd}}+){{0,3}})(?=[{HAN}A-Za-z])", "\n\n$1")
    x = F.regexp_replace(x, rf"(?<!\n)({_APPENDIX})(?=[{HAN}A-Za-z])", "\n\n$1")
    return strip(F.regexp_replace(x, "\n{3,}", "\n\n"))


@once
def stands_alone(x: Column) -> Column:
    """A line of extracted text that is a paragraph of its own."""
    return x.rlike(rf"\A([（(]?[一二三四五六七八九十]+[）)]?|[A-Za-z]|\p{{Nd}}+)[、.．)]{S}+") | x.rlike(f"{S}{{2,}}") | x.contains("\t")


def joined(current: Column, x: Column) -> Column:
    """Two lines of a paragraph as one text."""
    return (
        F.when(current == "", x)
        .when(current.rlike(r"[。；：:？！.;?!]\z"), F.concat(current, F.lit("\n"), x))
        .when(current.rlike(r"[A-Za-z0-9]\z") & x.rlike(r"\A[A-Za-z0-9]"), F.concat(current, F.lit(" "), x))
        .otherwise(F.concat(current, x))
    )


def compact_lines(raw: Column) -> Column:
    """The Markdown of the lines of extracted text."""
    kept = F.filter(F.transform(raw, normal_line), lambda x: (x != "") & ~is_noise(x))
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    close = lambda a: F.concat(a["done"], F.when(a["open"] != "", F.array(a["open"])).otherwise(F.array().cast("array<string>")))

    def step(a: Column, x: Column) -> Column:
        heading = heading_of_line(x)
        own = F.when(heading != "", heading).when(stands_alone(x), x)
        return F.when(own.isNotNull(), F.struct(F.concat(close(a), F.array(own)).alias("done"), F.lit("").alias("open"))).otherwise(F.struct(a["done"].alias("done"), joined(a["open"], x).alias("open")))

    return separate_headings(strip(F.aggregate(kept, empty, step, lambda a: F.array_join(close(a), "\n\n"))))


def first_heading(x: Column) -> Column:
    """The title of the first heading of up to four marks, "" without one."""
    pattern = rf"\A#{{1,4}}{S}+([^\n]+)\z"
    found = F.filter(F.transform(lines(x), strip), lambda y: y.startswith("#") & y.rlike(pattern))
    return F.coalesce(strip(first_group(F.get(found, F.lit(0)), pattern)), F.lit(""))


# --- categories and keywords ----------------------------------------------------------------------


def clean_category(x: Column) -> Column:
    x = strip_chars(squeeze(x), " #\t\r\n")
    return or_else(F.substring(strip(F.regexp_replace(x, rf"\A(文档片段|全文){S}*\p{{Nd}}*", "")), 1, 80), K.UNSORTED)


def clean_heading_title(x: Column) -> Column:
    x = strip(F.regexp_replace(clean_category(x), rf"\A\p{{Nd}}+(?:\.\p{{Nd}}+)*{S}*[、.．]?{S}*", ""))
    return strip(F.regexp_replace(x, rf"\A第[一二三四五六七八九十百]+[章节条]{S}*[、.．]?{S}*", ""))


def useful_heading(x: Column) -> Column:
    return bind(clean_category(x), _useful)


def _useful(c: Column) -> Column:
    return ~any_of([matches(c, r"(?:\p{Nd}+|[A-ZＡ-Ｚ])(?:\.\p{Nd}+)*"), c.isin(*K.USELESS_HEADINGS), *[c.startswith(p) for p in K.USELESS_PREFIXES], *[c.contains(p) for p in K.USELESS_PARTS]])


def subcategory_of(section: Column, content: Column) -> Column:
    titled = lambda t: F.when((t == "") | t.startswith(K.PIECE), or_else(first_heading(content), t)).otherwise(t)
    return clean_category(bind(clean_heading_title(section), titled))


def distinct_clean(values: Column, clean=clean_category) -> Column:
    return F.array_distinct(F.filter(F.transform(values, clean), lambda x: x != ""))


def _keyword(text: Column) -> Column:
    return bind(strip_chars(F.regexp_replace(text, r"\A[A-Z]\.\p{Nd}+(?:\.\p{Nd}+)?", ""), " -_：:"), _kept_keyword)


def _kept_keyword(text: Column) -> Column:
    bad = any_of([F.length(text) < 2, text.isin(*K.KEYWORD_STOPWORDS), matches(text, r"\p{Nd}+(?:\.\p{Nd}+)*"), text.rlike(r"(?iu)NUC|V\p{Nd}+")])
    return F.when(bad, "").otherwise(F.substring(text, 1, 32))


def clean_keyword(x: Column) -> Column:
    """"" for what is no keyword."""
    return _keyword(clean_category(x))


def clean_item_keyword(x: Column) -> Column:
    return _keyword(clean_taxonomy(x))


# A token begins with an ASCII letter or a Han character and has no white space, points or marks but "_". So for those that
# sort before "{" all that cleaning can change is their end, and the patterns are left out.


def _latin(t: Column) -> Column:
    return t < F.lit("{")


def _latin_keyword(t: Column) -> Column:
    def kept(u: Column) -> Column:
        return F.when((F.length(u) < 2) | u.rlike(r"(?i)nuc|v[0-9]"), "").otherwise(F.substring(u, 1, 32))

    return bind(F.rtrim(F.substring(t, 1, 80), F.lit("_")), kept)


def token_keyword(t: Column, clean=clean_keyword) -> Column:
    """clean_keyword() of a token."""
    return F.when(_latin(t), _latin_keyword(t)).otherwise(clean(t))


def again(t: Column, clean=clean_keyword) -> Column:
    """clean_keyword() of what it made of a token: a cut may have left marks at the end."""
    return F.when(_latin(t), bind(F.rtrim(t, F.lit("_")), lambda u: F.when(F.length(u) >= 2, u).otherwise(""))).otherwise(clean(t))


def tokens(x: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(x, F.lit(f"({TOKEN})"), F.lit(1)), lambda t: token_keyword(t)), lambda t: t != "")


def item_tokens(x: Column) -> Column:
    return F.filter(F.regexp_extract_all(x, F.lit(f"({TOKEN})"), F.lit(1)), lambda t: token_keyword(t, clean_item_keyword) != "")


def no_headings(x: Column) -> Column:
    """A text with the lines emptied that are headings of up to six marks."""
    return F.when(x.contains("#"), F.regexp_replace(x, rf"(?md)^#{{1,6}}{S}+[^\n]*$", "")).otherwise(x)


def core_text(content: Column) -> Column:
    return F.substring(F.regexp_replace(no_headings(content), r"\|[^\n]*?\|", " "), 1, 1600)


def family_key(section: Column) -> Column:
    """Sections with one key are numbered alike up to the last part."""
    return bind(strip(section), _family)


def _family(x: Column) -> Column:
    letter = rf"\A([A-Za-zＡ-Ｚａ-ｚ])\.\p{{Nd}}+"
    number = first_group(x, r"\A(\p{Nd}+(?:\.\p{Nd}+)*)")
    return F.when(x.rlike(letter), F.upper(first_group(x, letter))).when(number.contains("."), F.regexp_replace(number, r"\.[^.]*\z", "")).otherwise(number)


def section_prefix(section: Column) -> Column:
    return first_group(strip(section), r"\A(\p{Nd}+\.\p{Nd}+)(?!\.)")


def rank_tokens(values: Column, category_tokens: Column) -> Column:
    """The ten best tokens by count, then first place; at most three of them are the category's. Equal tokens stand together
    in the sorted values, so a count is the distance of two starts, and the work is a sort and native scans."""

    def ranked(v: Column) -> Column:
        def rows(s: Column) -> Column:
            t = lambda i: F.get(s, i)["t"]
            starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (t(i) != t(F.greatest(i - 1, F.lit(0)))))
            row = lambda at, i, k: F.struct((i - F.coalesce(F.get(at, k + 1), F.size(s))).alias("n"), F.get(s, i)["p"].alias("p"), t(i).alias("t"))
            return bind(starts, lambda at: F.transform(F.array_sort(F.transform(at, lambda i, k: row(at, i, k))), lambda r: r["t"]))

        placed = F.array_sort(F.transform(v, lambda t, i: F.struct(t.alias("t"), i.alias("p"))))
        return F.when(F.size(v) > 0, bind(placed, rows)).otherwise(F.array().cast("array<string>"))

    def capped(o: Column, c: Column) -> Column:
        some = F.slice(F.array_intersect(o, c), 1, 3)
        return F.slice(bind(some, lambda k: F.filter(o, lambda t: ~F.array_contains(c, t) | F.array_contains(k, t))), 1, 10)

    return bind(category_tokens, lambda c: bind(bind(values, ranked), lambda o: capped(o, c)))


# --- items ----------------------------------------------------------------------------------------


def clean_taxonomy(x: Column) -> Column:
    return F.substring(strip_chars(squeeze(strip(F.coalesce(x, F.lit("")))), " ：:，,。；;、[]"), 1, 80)


def clean_description(x: Column) -> Column:
    x = F.translate(squeeze(strip(F.coalesce(x, F.lit("")))), "\"'", "“’")
    return F.substring(strip_chars(x, " ：:，,；;"), 1, 180)


def clean_relation(x: Column) -> Column:
    x = F.regexp_replace(F.regexp_replace(clean_description(x), K.LEGACY_PHRASE, ""), K.LEGACY_SAME, "")
    return F.substring(strip_chars(x, " ：:，,。；;、"), 1, 120)


def clean_relevance(x: Column) -> Column:
    return bind(strip(F.coalesce(x, F.lit(""))), _relevance)


def _relevance(x: Column) -> Column:
    return F.when(x.isin(*K.RELEVANCE), x).when(x.isin(*K.RELEVANCE_HIGH), "高").otherwise("一般")


def clean_notes(values: Column) -> Column:
    return F.slice(distinct_clean(values, clean_description), 1, 5)


def risk_level(x: Column) -> Column:
    return bind(F.lower(strip(or_else(x, "low"))), lambda v: F.when(v.isin(*K.RISK_LEVELS), v).otherwise("low"))


def as_list(x: Column, trim=strip) -> Column:
    """The parts of a string that commas of any kind separate."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), "[,，、]"), lambda v: trim(v)), lambda v: v != "")


def guess_version(x: Column) -> Column:
    number = first_group(x, rf"[vV]{S}*(\p{{Nd}}+(?:\.\p{{Nd}}+)*)")
    return F.when(number != "", F.concat(F.lit("V"), number)).otherwise("")


def file_stem(x: Column) -> Column:
    return F.regexp_replace(x, r"(?<=[^.])\.[^.]+\z", "")


def safe_name(x: Column) -> Column:
    """A part of a file name."""
    x = F.regexp_replace(strip(F.lower(x)), r"[^\p{L}\p{N}_.-]+", "-")
    return or_else(strip_chars(F.regexp_replace(x, "-+", "-"), "-"), "kb-item")


def order_prefix(n: Column) -> Column:
    return F.format_string("%06d", F.greatest(F.coalesce(n.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")))


def compact(x: Column, limit: int) -> Column:
    """Text on one line, cut to the limit; no limit if it is 0 or less."""
    x = strip(squeeze(x))
    return x if limit <= 0 else bind(x, lambda v: F.when(F.length(v) <= limit, v).otherwise(F.concat(strip_right(F.substring(v, 1, limit)), F.lit("..."))))


#: What coverage doesn't look at, as SPACE is written: Latin-1 in one table, the rest behind one test of its range.
_UNSEEN = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0`*_#|>:,.;!?()\[\]\"'\-[\u1680-\uffff&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000：，。；！？、（）【】《》“”‘’—–]]]+"


def coverage_text(x: Column) -> Column:
    return F.lower(F.regexp_replace(no_headings(x), _UNSEEN, ""))


def fact_pairs(content: Column) -> Column:
    """The sentences of a text that say something, each once by what it says: array<struct<k, s>>, k what coverage sees."""
    table_rule = rf"\|?{S}*:?-{{3,}}:?{S}*(?:\|{S}*:?-{{3,}}:?{S}*)+\|?"
    begins = lambda x, *marks: any_of([x.startswith(m) for m in marks])

    def plain(x: Column) -> Column:
        x = F.when(begins(x, "-", "*", "+"), F.regexp_replace(x, rf"\A[-*+]{S}+", "")).otherwise(x)
        x = F.regexp_replace(x, rf"\A\p{{Nd}}+[、.．)]{S}*", "")
        return bind(x, lambda v: F.when(v.contains("**"), F.regexp_replace(v, r"\*\*([^\n]*?)\*\*", "$1")).otherwise(v))

    # the look-behind is tried at each character, and most lines have no such end
    cut = lambda x: F.when(x.rlike("[。；;！？!?]"), F.transform(F.split(x, rf"(?<=[。；;！？!?]){S}*"), strip)).otherwise(F.array(strip(x)))
    sentences = lambda x: bind(plain(x), cut)
    kept = F.filter(F.transform(lines(content), strip), lambda x: (x != "") & ~x.startswith("#") & ~(begins(x, "|", ":", "-") & matches(x, table_rule)))
    pairs = F.transform(F.flatten(F.transform(kept, sentences)), lambda s: F.struct(coverage_text(s).alias("k"), s.alias("s")))
    long = F.filter(pairs, lambda p: F.length(p["k"]) >= 12)

    def first_of_each(p: Column) -> Column:
        return bind(F.transform(p, lambda x: x["k"]), lambda keys: F.filter(p, lambda x, i: F.array_position(keys, x["k"]) == i + 1))

    return bind(long, first_of_each)


def fact_sentences(content: Column) -> Column:
    return F.transform(fact_pairs(content), lambda p: p["s"])
