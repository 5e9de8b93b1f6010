"""Tokens and ranked keywords of blocks, in Python over Arrow batches.

A block has hundreds of tokens, and each takes several steps: within a row those are lambdas that Spark interprets, which
took most of the time of parsing. The rules are those of core_text(), tokens() and rank_tokens() in folio.functions.text.
Arguments have to be plain columns: Spark doesn't find a Python function again whose arguments hold lambdas. The module goes
to the workers by value, so they need not have this package."""

from __future__ import annotations

import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as t

from folio.functions import fixed as K
from folio.functions import text as T

register_pickle_by_value(sys.modules[__name__])

_UNSORTED, _STOPWORDS = K.UNSORTED, frozenset(K.KEYWORD_STOPWORDS)
#: Cleaned tokens that a worker remembers; beyond that it starts over.
REMEMBERED = 200_000
_TOKEN = re.compile(T.TOKEN)
_PIECE = re.compile(r"\A(?:文档片段|全文)[0-9]*")
_NAMES = re.compile("nuc|v[0-9]", re.IGNORECASE | re.ASCII)


_BLANK = "[" + "".join(map(re.escape, T.BLANKS)) + "]"
_HEADING = re.compile(rf"^#{{1,6}}{_BLANK}+[^\n]*$", re.MULTILINE)
_CELLS = re.compile(r"\|[^\n]*?\|")


def core_of(content: str | None) -> str:
    text = content or ""
    if "#" in text:
        text = _HEADING.sub("", text)
    return (_CELLS.sub(" ", text) if "|" in text else text)[:1600]


def _bad(u: str) -> bool:
    return len(u) < 2 or bool(_NAMES.search(u))


def _clean(token: str) -> str:
    """text.token_keyword(): tokens have no blanks, points or marks but the "_" of those that begin with an ASCII letter."""
    if token < "{":
        u = token[:80].rstrip("_")
        return "" if _bad(u) else u[:32]
    u = _PIECE.sub("", token) or _UNSORTED
    return "" if _bad(u) or u in _STOPWORDS or (u.isascii() and u.isdigit()) else u[:32]


def _again(token: str) -> str:
    """text.again()"""
    if token >= "{":
        return _clean(token)
    u = token.rstrip("_")
    return u if len(u) >= 2 else ""


class _Memo(dict):
    def __init__(self, f):
        self.f = f

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = value = self.f(key)
        return value


_CLEAN, _TWICE = _Memo(_clean), _Memo(lambda token: _again(_clean(token)))


def tokens_of(text: str | None) -> list[str]:
    return [u for x in _TOKEN.findall(text or "") if (u := _CLEAN[x])]


def _bag(text: str | None) -> list[str]:
    return [u for x in _TOKEN.findall(text or "") if (u := _TWICE[x])]


def ranked(values: list[str], category: set[str]) -> list[str]:
    """The ten best tokens by count, then first place; at most three of them are the category's."""
    out, own = [], 0
    for token, _ in Counter(values).most_common():  # equal counts stay as they first came
        if token in category:
            own += 1
            if own > 3:
                continue
        out.append(token)
        if len(out) == 10:
            break
    return out


_LISTS = t.StructType([t.StructField("all", t.ArrayType(t.StringType())), t.StructField("own", t.ArrayType(t.StringType()))])


@F.arrow_udf(_LISTS)
def _keyword_lists(category: pa.Array, subcategory: pa.Array, content: pa.Array, more: pa.Array) -> pa.Array:
    every, plain = [], []
    for cat, sub, text, said in zip(category.to_pylist(), subcategory.to_pylist(), content.to_pylist(), more.to_pylist(), strict=True):
        own, known = _bag(sub) * 3 + _bag(core_of(text)), set(tokens_of(cat))
        plain.append(ranked(own, known))
        every.append(ranked(own + _bag(said), known))
    kind = pa.list_(pa.string())
    return pa.StructArray.from_arrays([pa.array(every, kind), pa.array(plain, kind)], ["all", "own"])


@F.arrow_udf(t.ArrayType(t.StringType()))
def _tokens(texts: pa.Array) -> pa.Array:
    return pa.array([tokens_of(x) for x in texts.to_pylist()], pa.list_(pa.string()))


def tokens(x: Column) -> Column:
    return _tokens(x)


def keyword_lists(category: Column, subcategory: Column, content: Column, more: Column) -> Column:
    """struct<all, own>: the best keywords of the subcategory (three times), of the text and of `more`, the document's; and
    the same without the document's."""
    return _keyword_lists(category, subcategory, content, more)
