"""URL filter with a weighted vocabulary: an Aho-Corasick automaton counts strict and soft terms.

Method. One automaton holds all terms. An occurrence counts where the characters beside it are no ASCII letters or digits
(or the text ends there). Each term has a weight: ``REJECT`` for strict ones, ``REJECT / SOFT_LIMIT`` for soft ones. A url whose distinct terms weigh
``REJECT`` together is rejected: by one strict term, or by ``SOFT_LIMIT`` soft ones. The whole url is looked at, its percent escapes decoded, in lower case,
with or without ``://``. Before that, rules decide: the longest one whose host is the url's host or a parent domain of it and whose path
begins the url's path.

Defined results. A null url, or one without ``://``, has an empty host and path and no rule; a null one is allowed. Escapes that are no UTF-8 are
read as U+FFFD, incomplete ones as they are. User info and port stay part of the host as it is written. Long urls are read in whole. Repeated rows and null ids come
back as they are. An empty table gives no rows. Of a term given twice the larger weight counts. Other columns are not looked at.

At scale. A projection without any shuffle. Rules are parameters; the vocabulary is one too, or a table of at most ``MOST_TERMS`` terms.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
STRICT = ("adult", "casino", "porn", "sex", "viagra", "xxx")
SOFT = ("bet", "bets", "cheap", "deal", "deals", "farm", "free", "lottery", "nude", "pills", "poker", "slots", "spam", "win")
SOFT_LIMIT, REJECT, MOST_TERMS = 2, 1.0, 1_000_000
VOCABULARY = {t: REJECT / SOFT_LIMIT for t in SOFT} | {t: REJECT for t in STRICT}


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for domain, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(domain + start)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def automaton(vocabulary: Mapping[str, float] = VOCABULARY):
    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def weighted(table: DataFrame) -> dict[str, float]:
    """The vocabulary of a table with the columns term and weight; null and empty terms and null weights are left out."""
    rows = table.where("length(term) > 0 and weight is not null").groupBy(F.lower("term").alias("term")).agg(
        F.max(F.col("weight").cast("double")).alias("weight")).limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"the vocabulary has more than {MOST_TERMS} terms")
    return {r["term"]: r["weight"] for r in rows}


def _solid(char: str) -> bool:
    return char.isascii() and char.isalnum()


def counts(found, text: str) -> tuple[int, int, float]:
    """Distinct strict and other terms that stand alone in a text, and the weight of all of them."""
    held: dict[str, float] = {}
    for end, (term, weight) in found.iter(text) if len(found) else ():
        start = end - len(term) + 1
        if (start == 0 or not _solid(text[start - 1])) and (end + 1 == len(text) or not _solid(text[end + 1])):
            held[term] = weight
    strict = sum(w >= REJECT for w in held.values())
    return strict, len(held) - strict, sum(held.values())


def judged(pages: DataFrame, rules=RULES, vocabulary: Mapping[str, float] | DataFrame = VOCABULARY) -> DataFrame:
    """page_id, host, path, rule, verdict and the numbers of strict and soft terms of every row of ``pages``."""
    terms_of = dict(vocabulary) if isinstance(vocabulary, Mapping) else weighted(vocabulary)

    @F.pandas_udf("n_strict int, n_soft int, weight double")
    def terms(texts: pd.Series) -> pd.DataFrame:
        found = automaton(terms_of)
        return pd.DataFrame([counts(found, unquote(t).lower()) for t in texts], columns=["n_strict", "n_soft", "weight"])

    url = F.coalesce(F.col("url"), F.lit(""))
    urls = pages.select("page_id", url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    seen = urls.select("*", rule.alias("rule"), says.alias("says"), terms("url").alias("terms"))
    method = F.when(F.col("terms.weight") >= REJECT - 1e-9, "block").otherwise("allow")
    return seen.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "terms.n_strict", "terms.n_soft")
