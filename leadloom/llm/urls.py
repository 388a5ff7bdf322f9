"""URL filter: weighted vocabulary counted by an Aho-Corasick automaton, with host rules on top.

Terms count only between boundaries (no ASCII letter or digit beside them). One strict term rejects
a URL; soft terms reject it when at least `least_soft` distinct ones occur whose weights add up to
`least_weight`. A host rule that fits decides alone, the longest first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from leadloom.llm.shared import pick, small_batches

# The vocabulary.
STRICT = (
    "adult", "casino", "escort", "gambling", "malware", "phishing", "poker", "porn", "porno",
    "sex", "spam", "viagra", "warez", "xxx",
)
SOFT = {
    "ad": 1.0, "ads": 1.0, "bet": 1.0, "bets": 1.0, "bonus": 1.0, "buy": 0.5, "cheap": 1.0,
    "click": 0.5, "coupon": 1.0, "crack": 1.0, "deal": 0.5, "deals": 0.5, "discount": 1.0,
    "download": 0.5, "farm": 0.5, "free": 1.0, "hack": 1.0, "hot": 0.5, "jackpot": 1.0,
    "loan": 1.0, "loans": 1.0, "lottery": 1.0, "meds": 1.0, "offer": 0.5, "pharmacy": 1.0,
    "pill": 1.0, "pills": 1.0, "popup": 1.0, "prize": 1.0, "promo": 1.0, "slots": 1.0,
    "sponsor": 0.5, "torrent": 1.0, "track": 1.0, "tracker": 1.0, "traffic": 0.5, "win": 1.0,
    "winner": 1.0,
}
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# Any two distinct soft terms reach this weight, so these always reject.
LEAST_SOFT = 2
LEAST_WEIGHT = 1.0

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PARTS = re.compile(r"([^/?#]*)([^?#]*)", re.DOTALL)


class Vocabulary(NamedTuple):
    strict: tuple[str, ...] = STRICT
    soft: dict[str, float] = SOFT
    least_soft: int = LEAST_SOFT
    least_weight: float = LEAST_WEIGHT

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term in {*self.strict, *self.soft}:
            found.add_word(term, term)
        if not len(found):
            return None
        found.make_automaton()
        return found


def parts(url: str | None) -> tuple[str, str]:
    """Host (lower case) and path of a URL; both empty without `://`."""
    if not isinstance(url, str):
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    host, path = _PARTS.match(rest).groups()
    return host.translate(_LOWER), path


def hits(url: str | None, automaton: ahocorasick.Automaton | None) -> set[str]:
    """The distinct terms that stand between boundaries anywhere in the URL."""
    if not isinstance(url, str) or automaton is None:
        return set()
    text = url.translate(_LOWER)
    plain = lambda c: c.isascii() and c.isalnum()
    found = set()
    for end, term in automaton.iter(text):
        start = end - len(term)
        if (start < 0 or not plain(text[start])) and (
            end + 1 >= len(text) or not plain(text[end + 1])
        ):
            found.add(term)
    return found


def rule_for(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple | None:
    """The longest rule (rule, path, verdict) whose host is the host or a parent of it."""
    best = None
    name = host
    while name:
        for rule in rules.get(name, ()):
            if path.startswith(rule[1]) and (best is None or len(rule[0]) > len(best[0])):
                best = rule
        _, dot, name = name.partition(".")
        if not dot:
            break
    return best


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    vocabulary: Vocabulary = Vocabulary(),
) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_terms, soft_terms): one row per input row.

    A missing URL, or one without `://`, has empty host and path, fits no rule and has its terms
    counted all the same (none if missing). Rows are judged one by one, so repeated rows get equal verdicts,
    an id may be null, and a table without rows gives none. Ties cannot occur between different
    rules that fit one URL, as these are of different length.
    """
    small_batches(pages.sparkSession)
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host, []).append((rule, slash + path, verdict))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = vocabulary.automaton()
        strict = set(vocabulary.strict)
        for frame in frames:
            out = []
            for url in frame["url"]:
                host, path = parts(url)
                terms = hits(url, automaton)
                hard = sorted(terms & strict)
                soft = sorted(t for t in terms if t not in strict)
                weight = sum(vocabulary.soft[t] for t in soft)
                bad = bool(hard) or (
                    len(soft) >= vocabulary.least_soft and weight >= vocabulary.least_weight
                )
                rule = rule_for(host, path, by_host)
                verdict = rule[2] if rule else "block" if bad else "allow"
                out.append((host, path, rule[0] if rule else None, verdict, hard, soft))
            result = pd.DataFrame(
                out, columns=["host", "path", "rule", "verdict", "strict_terms", "soft_terms"]
            )
            result.insert(0, "page_id", frame["page_id"].to_numpy())
            yield result

    source = pick(pages, page_id=id_col, url=url_col)
    id_type = source.schema["page_id"].dataType.simpleString()
    return source.mapInPandas(
        run,
        f"page_id {id_type}, host string, path string, rule string, verdict string, "
        "strict_terms array<string>, soft_terms array<string>",
    )


def oracle() -> str:
    """The same judgement in SQL, with one pattern per term."""
    lower = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = lambda term: f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    strict = " OR ".join(found(t) for t in STRICT)
    count = " + ".join(f"{found(t)}::INT" for t in SOFT)
    weight = " + ".join(f"{found(t)}::INT * {w}" for t, w in SOFT.items())
    fits = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        fits.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') "
            f"THEN {{'rule': '{rule}', 'verdict': '{verdict}'}}"
        )
    return f"""
WITH cut AS (
  SELECT page_id, {lower} AS low, coalesce(url, '') AS url,
    CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parted AS (
  SELECT page_id, low,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (SELECT *, CASE {' '.join(fits)} END AS fit FROM parted)
SELECT page_id, host, path, fit.rule AS rule,
  coalesce(fit.verdict, CASE WHEN ({strict}) OR (({count}) >= {LEAST_SOFT} AND ({weight}) >= {LEAST_WEIGHT})
    THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""
