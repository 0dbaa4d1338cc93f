"""URL filter: host and path rules, then a weighted vocabulary of terms.

*Rules.*  A rule ``host/path`` fits its host and all subdomains if the
url's path starts with the rule's; the longest fitting rule decides.

*Vocabulary.*  Whole urls, query string and fragment included, A-Z
lower-cased, are scanned by an Aho-Corasick automaton.  A term counts only between boundaries: the
characters beside it are no ASCII letters or digits.  One strict term, or at
least ``least_soft`` distinct soft terms whose weights reach ``soft_limit``, reject the url.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms, each with its weight among soft ones.
STRICT = ["adult", "casino", "escort", "hentai", "malware", "phishing", "porn", "porno", "spam", "viagra", "warez", "xxx"]
SOFT = {
    "ads": 1, "banner": 1, "bets": 1, "bonus": 1, "cheap": 1, "click": 1, "coupon": 1, "crack": 1, "discount": 1, "farm": 1, "free": 1,
    "gambling": 2, "jackpot": 1, "keygen": 2, "loan": 1, "lottery": 1, "nude": 2, "pills": 1, "poker": 1, "promo": 1, "replica": 1,
    "sex": 2, "slots": 1, "track": 1, "tracker": 1, "torrent": 1, "win": 1, "winner": 1,
}
SOFT_LIMIT, LEAST_SOFT = 2, 2
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without ``://``: empty."""
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule (as text), null if none fits; of equally long ones the first in order of text."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p)).otherwise(out)
    return out


def automaton(strict=STRICT, soft=SOFT):
    import ahocorasick

    out = ahocorasick.Automaton()
    for term, weight in {**soft, **dict.fromkeys(strict, 0)}.items():
        out.add_word(term, (term, weight))
    out.make_automaton()
    return out


def hits(words, text: str) -> tuple[list[str], list[str], int]:
    """(distinct strict terms, distinct soft terms, weight of the soft ones) of a text."""
    strict, soft = set(), {}
    if not len(words):
        return [], [], 0
    for last, (term, weight) in words.iter(text):
        before, after = text[last - len(term) : last - len(term) + 1] if last >= len(term) else "", text[last + 1 : last + 2]
        if not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum()):
            if weight:
                soft[term] = weight
            else:
                strict.add(term)
    return sorted(strict), sorted(soft), sum(soft.values())


def judged(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT, least_soft: int = LEAST_SOFT
) -> DataFrame:
    """One row for each row: page_id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight.

    Null urls and urls without ``://`` have empty host and path and no rule.
    Hits are counted over whole urls of any length (null: none; without
    ``://`` over the whole text), also where a rule decides; a term counts
    once however often it stands there.  An empty table has no rows.  Repeated rows are judged alike; other
    columns are not read; a term that is both strict and soft is strict.
    """
    allow = {h + p: v for h, p, v in rules}

    @F.arrow_udf("struct<strict_hits: array<string>, soft_hits: array<string>, soft_weight: int>")
    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = automaton(strict, soft)
        for part in parts:
            found = [hits(words, t) for t in part.to_pylist()]
            kinds = pa.list_(pa.string()), pa.list_(pa.string()), pa.int32()
            yield pa.StructArray.from_arrays(
                [pa.array([f[i] for f in found], kinds[i]) for i in range(3)], names=["strict_hits", "soft_hits", "soft_weight"]
            )

    text = F.translate(F.coalesce(F.col(url_col), F.lit("")), _UPPER, _LOWER)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), text.alias("_text"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("h", scan(F.col("_text")))
    bad = (F.size("h.strict_hits") > 0) | ((F.size("h.soft_hits") >= least_soft) & (F.col("h.soft_weight") >= soft_limit))
    by_rule = F.lit(None).cast("string")
    for text_, verdict in allow.items():
        by_rule = F.when(F.col("rule") == text_, verdict).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(bad, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "h.strict_hits", "h.soft_hits", "h.soft_weight")


def sql(strict=STRICT, soft=SOFT, rules=RULES, soft_limit: int = SOFT_LIMIT, least_soft: int = LEAST_SOFT) -> str:
    """The query ``op7`` in DuckDB's SQL (hits as comma-separated text)."""
    def found(term: str) -> str:
        return f"regexp_matches(t, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    fits = lambda h, p: f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')"
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in ordered)
    by_rule = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in ordered)
    listed = lambda terms: "concat_ws(',', " + ", ".join(f"CASE WHEN {found(t)} THEN '{t}' END" for t in sorted(terms)) + ")"
    number = " + ".join(f"CAST({found(t)} AS INTEGER)" for t in soft)
    weight = " + ".join(f"CASE WHEN {found(t)} THEN {w} ELSE 0 END" for t, w in soft.items())
    upper = f"'{_UPPER}', '{_LOWER}'"
    return f"""
WITH r AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), {upper}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
u AS (SELECT *, CASE {rule} END AS rule, translate(url, {upper}) AS t FROM p),
h AS (SELECT *, {listed(strict)} AS strict_hits, {listed(soft)} AS soft_hits, {weight} AS soft_weight, {number} AS soft_number FROM u)
SELECT page_id, host, path, rule, CASE {by_rule} WHEN strict_hits <> '' OR (soft_number >= {least_soft} AND soft_weight >= {soft_limit}) THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits, CAST(soft_weight AS INTEGER) AS soft_weight
FROM h"""
