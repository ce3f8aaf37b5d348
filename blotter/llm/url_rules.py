"""URL verdicts: host and path rules first, then pattern rules indexed by their rarest literal token.

A pattern rule is text with three marks: ``||`` at the start (start of a host
label), ``^`` (a separator or the end) and ``*`` (anything). Its literal tokens
are the runs of letters and digits that both ends delimit, so a URL that fits
the rule has each of them as a whole token. Token frequencies are counted over
all URLs; every rule is filed under its rarest token, a URL fetches the rules
of its own tokens, and only those run their regular expression. Rules without
a usable token run on every URL.

Everything is DataFrame functions. The rules travel as literals, so their
number is bounded by ``MAX_RULES``. Defined results: a null URL or one without
``://`` has an empty host and path, no rule and verdict allow; rows are
independent; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules are sent as literals with the plan; more than this many is refused.
MAX_RULES = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host, path.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Verdict and pattern.
PATTERN_RULES = (
    ("block", "||spam-farm^"),
    ("block", "||cheap-pills^"),
    ("block", "||casino-win^"),
    ("block", "||free-bets^"),
    ("block", "||ads-track^"),
    ("block", "||adult-x^"),
    ("block", "||doubleclick^"),
    ("block", "^ads^banner^"),
    ("block", "^click^redirect^"),
    ("allow", "^legal^notice^"),
)


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    pattern: str
    regex: str
    tokens: tuple[str, ...]


def compile_rule(verdict: str, pattern: str) -> PatternRule:
    """The regular expression and usable literal tokens of one pattern."""
    body, head = (pattern[2:], "(^|[/.])") if pattern.startswith("||") else (pattern, "")
    parts = {"^": "([^a-z0-9_%-]|$)", "*": ".*"}
    regex = head + "".join(parts.get(c) or re.sub(r"([\\.\[\]{}()+?|$*^])", r"\\\1", c) for c in body)
    tokens = [
        m.group()
        for m in re.finditer(r"[a-z0-9]+", body)
        if (head and m.start() == 0 or m.start() and body[m.start() - 1] != "*")
        and m.end() < len(body)
        and body[m.end()] != "*"
    ]
    return PatternRule(verdict, pattern, regex, tuple(dict.fromkeys(tokens)))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def url_tokens(url: Column) -> Column:
    """Distinct runs of letters and digits of the lower-cased URL."""
    return F.array_distinct(F.split(F.regexp_replace(lower_ascii(url), r"[^a-z0-9]+", " "), " "))


def rarest_tokens(pages: DataFrame, rules: list[PatternRule], url_col: str) -> dict[str, str]:
    """Each rule's token that the fewest URLs hold (ties: the first in
    alphabetical order). What comes to the driver is one count per literal
    token of the rules."""
    literals = sorted({t for r in rules for t in r.tokens})
    if not literals:
        return {}
    wanted = F.array(*[F.lit(t) for t in literals])
    found = pages.select(F.explode(F.array_intersect(url_tokens(pages[url_col]), wanted)).alias("token"))
    counts = {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}
    return {r.pattern: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in rules if r.tokens}


def url_verdicts(
    pages: DataFrame,
    host_rules: tuple = HOST_RULES,
    pattern_rules: tuple = PATTERN_RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """id, host, path, rule (of the longest fitting host rule, else null),
    verdict and pattern (the deciding pattern rule, else null). Among pattern
    rules an allow beats a block; nothing fitting allows."""
    if len(host_rules) + len(pattern_rules) > MAX_RULES:
        raise ValueError("too many rules for literals")
    rules = [compile_rule(v, p) for v, p in pattern_rules]
    index = rarest_tokens(pages, rules, url_col)
    url = pages[url_col]
    host, path = url_parts(url)
    base = pages.select(
        pages[id_col].alias(id_col), lower_ascii(F.coalesce(url, F.lit(""))).alias("_low"),
        host.alias("host"), path.alias("path"),
    )

    fitted = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(host_rules, key=lambda r: len(r[1] + r[2])):
        fits = (
            (F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)
        ) & F.col("path").startswith(rule_path)
        made = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fitted = F.when(fits, made).otherwise(fitted)

    def packed(r: PatternRule) -> Column:
        return F.struct(
            F.lit(0 if r.verdict == "allow" else 1).alias("rank"), F.lit(r.pattern).alias("pattern"),
            F.lit(r.regex).alias("regex"), F.lit(r.verdict).alias("verdict"),
        )

    kind = "array<struct<rank:int,pattern:string,regex:string,verdict:string>>"
    filed: dict[str, list[PatternRule]] = {}
    for r in rules:
        if r.pattern in index:
            filed.setdefault(index[r.pattern], []).append(r)
    everywhere = F.array(*[packed(r) for r in rules if r.pattern not in index]).cast(kind)
    candidates = everywhere
    if filed:
        table = F.create_map(*[x for t, rs in sorted(filed.items()) for x in (F.lit(t), F.array(*map(packed, rs)))])
        held = F.array_intersect(url_tokens(F.col("_low")), F.array(*[F.lit(t) for t in sorted(filed)]))
        fetched = F.flatten(F.transform(held, lambda t: F.element_at(table, t)))
        candidates = F.concat(everywhere, fetched.cast(kind))
    hits = F.filter(candidates, lambda r: F.regexp(F.col("_low"), r["regex"]))
    return base.select(
        id_col, "host", "path", fitted.alias("_fitted"), F.array_min(hits).alias("_hit"),
    ).select(
        id_col, "host", "path",
        F.col("_fitted.rule").alias("rule"),
        F.coalesce("_fitted.verdict", "_hit.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("_fitted").isNull(), F.col("_hit.pattern")).alias("pattern"),
    )


def verdict_sql(host_rules: tuple = HOST_RULES, pattern_rules: tuple = PATTERN_RULES) -> str:
    """DuckDB SQL that tests every rule on every URL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    longest = sorted(host_rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = {quoted(h)} OR ends_with(host, {quoted('.' + h)})) AND starts_with(path, {quoted(p)})" for _, h, p in longest]
    rule = " ".join(f"WHEN {f} THEN {quoted(h + p)}" for f, (_, h, p) in zip(fits, longest))
    verdict = " ".join(f"WHEN {f} THEN {quoted(v)}" for f, (v, _, _) in zip(fits, longest))
    patterns = sorted((compile_rule(v, p) for v, p in pattern_rules), key=lambda r: (r.verdict != "allow", r.pattern))
    match = " ".join(f"WHEN regexp_matches(low, {quoted(r.regex)}) THEN {quoted(r.pattern)}" for r in patterns)
    judged = " ".join(f"WHEN pattern = {quoted(r.pattern)} THEN {quoted(r.verdict)}" for r in patterns)
    return f"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS pos FROM pages),
rest AS (
  SELECT page_id, translate(u, '{UPPER}', '{LOWER}') AS low, CASE WHEN pos > 0 THEN substr(u, pos + 3) ELSE '' END AS r FROM cut),
parts AS (
  SELECT page_id, low, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (
  SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS by_host FROM parts),
matched AS (
  SELECT *, CASE WHEN rule IS NULL THEN CASE {match} END END AS pattern FROM ruled)
SELECT page_id, host, path, rule, coalesce(by_host, CASE {judged} END, 'allow') AS verdict, pattern FROM matched"""
