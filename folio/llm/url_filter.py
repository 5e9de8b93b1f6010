"""URL filter: a weighted vocabulary, matched by one Aho-Corasick pass over each URL.

The vocabulary is a list of (term, weight): a term of weight STRICT rejects alone; soft terms add their weights, each term
once, and reject together from REJECT on. With the weight of every soft term at half of that, two different ones do. A
term counts only between boundaries: the characters next to it are not ASCII letters or digits (or there are none).
Rules for hosts and their paths go first: the longest one that fits decides.

A vocabulary and rules may be read from tables (load_vocabulary, load_rules) of at most MOST_TERMS rows, which become one
automaton for each worker process; more is an error, as the driver holds them.

Cases: a null URL has the empty host and path, meets no term and is allowed; a URL without "://" has the empty host and
path but its text is still searched for terms. Nothing is URL-decoded. URLs may be of any length and mix characters of any
width. Terms are compared in lower case; empty terms are refused; of a term listed twice the larger weight counts. Repeated
rows give repeated results; the result has one row for each row of the input; columns of the input that have a result's
name are replaced by judge() and nothing else of the input is read but the URL. An empty table gives an empty result. Work
is a map over the rows with a fixed automaton, so skew and size don't matter.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import forget

STRICT, SOFT, REJECT = 1.0, 0.5, 1.0
MOST_TERMS = 1_000_000
VOCABULARY = (
    *((t, STRICT) for t in ("porn", "xxx", "hentai", "camgirls", "escorts", "warez", "torrent", "phishing", "malware", "keygen")),
    *((t, SOFT) for t in ("sex", "adult", "casino", "bet", "poker", "dating", "pills", "loan", "free", "win", "hot", "cheap", "crack", "lottery", "nude")),
)
#: (verdict, host, path prefix); the host fits its subdomains too.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty without one. No pattern spans the whole URL, so none backtracks over it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: str | Column) -> Column:
    """After the first "://", up to "/", "?", "#" or the end; A-Z lower-cased."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.split(_rest(url), "[/?#]", 2)[0]
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    """From the host's end up to "?", "#" or the end."""
    url = F.col(url) if isinstance(url, str) else url
    whole = F.split(_rest(url), "[?#]", 2)[0]
    at = F.instr(whole, "/")
    return F.coalesce(F.when(at > 0, F.substring(whole, at, F.length(whole))), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, or null. Rules of one length: the one with the
    longer host, then the first by code point."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for v, h, p in ordered]
    return F.coalesce(*fits)


def load_vocabulary(terms: DataFrame, term: str = "term", weight: str = "weight") -> list[tuple[str, float]]:
    """A vocabulary from a table. Rows without a term or weight are left out."""
    rows = terms.filter(F.col(term).isNotNull() & F.col(weight).isNotNull()).select(term, F.col(weight).cast("double")).limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return [(r[0], r[1]) for r in rows]


def load_rules(rules: DataFrame) -> list[tuple[str, str, str]]:
    """Rules from a table (verdict, host, path). They become part of the plan, so they are few."""
    rows = rules.select("verdict", F.lower("host"), F.coalesce("path", F.lit("/"))).limit(1_001).collect()
    if len(rows) > 1_000:
        raise ValueError("more than 1000 rules")
    return [tuple(r) for r in rows]


_machines: dict = {}
forget.append(_machines.clear)


def _machine(terms: tuple[tuple[str, float], ...]):
    """The automaton of a vocabulary, made once for each worker process."""
    if terms not in _machines:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in terms:
            machine.add_word(term, (term, weight))
        if terms:
            machine.make_automaton()
        _machines[terms] = machine
    return _machines[terms]


def vocabulary_of(terms: Iterable[tuple[str, float]]) -> tuple[tuple[str, float], ...]:
    """Lower case, each term once, in order."""
    out: dict[str, float] = {}
    for term, weight in terms:
        if not term:
            raise ValueError("an empty term")
        out[term.lower()] = max(float(weight), out.get(term.lower(), float(weight)))
    return tuple(sorted(out.items()))


def vocabulary_counts(url: Column, vocabulary: Iterable[tuple[str, float]] = VOCABULARY) -> Column:
    """(strict, soft, weight): strict hits, different soft terms hit, and the sum of the soft terms' weights."""
    terms = vocabulary_of(vocabulary)

    @F.pandas_udf("strict int, soft int, weight double")
    def count(urls: pd.Series) -> pd.DataFrame:
        machine, rows = _machine(terms), []
        for url in urls:
            strict_hits, soft_hits = 0, {}
            text = url.lower() if url else ""
            for end, (term, weight) in machine.iter(text) if terms and text else ():
                start = end - len(term) + 1
                if (start and text[start - 1] in _ALNUM) or (end + 1 < len(text) and text[end + 1] in _ALNUM):
                    continue
                if weight >= STRICT:
                    strict_hits += 1
                else:
                    soft_hits[term] = weight
            rows.append((strict_hits, len(soft_hits), float(sum(soft_hits[t] for t in sorted(soft_hits)))))
        return pd.DataFrame(rows, columns=["strict", "soft", "weight"]).astype({"strict": "int32", "soft": "int32"})

    return count(url)


def judge(pages: DataFrame, url: str = "url", rules=RULES, vocabulary: Iterable[tuple[str, float]] = VOCABULARY, reject: float = REJECT) -> DataFrame:
    """Adds host, path, rule, verdict, strict_hits, soft_terms and soft_weight."""
    hits = F.col("__hits")
    rejects = (hits["strict"] >= 1) | (hits["weight"] >= reject)
    none = F.lit(None).cast("struct<verdict:string,rule:string>")
    found = rule_for(F.col("__parts.host"), F.col("__parts.path"), rules) if rules else none
    return (
        pages.withColumn("__hits", vocabulary_counts(F.col(url), vocabulary))
        .withColumn("__parts", F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")))
        .withColumn("__rule", found)
        .withColumns({
            "host": F.col("__parts.host"), "path": F.col("__parts.path"), "rule": F.col("__rule.rule"),
            "verdict": F.coalesce("__rule.verdict", F.when(rejects, F.lit("block")).otherwise(F.lit("allow"))),
            "strict_hits": hits["strict"], "soft_terms": hits["soft"], "soft_weight": hits["weight"],
        })
        .drop("__hits", "__parts", "__rule")
    )


def op4_url_vocabulary(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms")


def _oracle() -> str:
    lower = "lower(coalesce(url, ''))"
    one = lambda t: f"len(regexp_extract_all(regexp_replace({lower}, '([^a-z0-9])', '\\1\\1', 'g'), '(^|[^a-z0-9]){t}($|[^a-z0-9])'))"
    strict = " + ".join(one(t) for t, w in VOCABULARY if w >= STRICT)
    soft = " + ".join(f"CAST(regexp_matches({lower}, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INTEGER)" for t, w in VOCABULARY if w < STRICT)
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered) + f" WHEN strict_hits >= 1 OR soft_terms * {SOFT} >= {REJECT} THEN 'block' ELSE 'allow' END"
    return f"""
WITH a AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        CAST({strict} AS INTEGER) AS strict_hits, CAST({soft} AS INTEGER) AS soft_terms FROM a)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, {rule} AS rule, {verdict} AS verdict, strict_hits, soft_terms FROM b
"""


ORACLE = _oracle()
