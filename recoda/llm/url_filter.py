"""URL verdicts: host and path rules first, then a weighted vocabulary.

The vocabulary is searched with one Aho-Corasick pass per URL.  A term counts
when the characters around it are not ASCII letters or digits (so ``essex`` does
not hold ``sex``).  Each distinct term counts once with its weight; a strict term
weighs as much as the limit, a soft one less, so one strict term or several
distinct soft ones reject.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, strings, worker_state

# The vocabulary and the weight that rejects.
STRICT_TERMS = ["porn", "porno", "xxx", "hentai", "milf", "camgirls", "cheap-pills", "spam-farm", "warez", "phishing"]
SOFT_TERMS = ["casino", "poker", "betting", "slots", "viagra", "pills", "spam", "adult", "sex", "nude", "escort",
              "dating", "torrent", "crack", "keygen", "replica", "loan", "cheap", "free", "win"]
LIMIT = 2
ALNUM = "abcdefghijklmnopqrstuvwxyz0123456789"
UPPER = ALNUM[:26].upper()

Rule = tuple[str, str, str]  # verdict, host, path


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, ALNUM[:26])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as raw pieces of the URL; both empty for null or no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (
        ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as ``host + path`` and its verdict; both null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    strict: Sequence[str] = tuple(STRICT_TERMS),
    soft: Sequence[str] = tuple(SOFT_TERMS),
    limit: int = LIMIT,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits per row of ``pages``.

    A fitting rule decides; among several the longest.  Else the vocabulary does,
    over the whole URL with A-Z lowered.  A null URL and one without ``://`` have
    empty host and path, fit no rule, and a null URL has no hits (allow).
    Repeated rows are judged one by one; an empty table gives no rows.
    """
    weights = {t: 1 for t in soft} | {t: limit for t in strict}

    def automaton():
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in weights.items():
            found.add_word(term, (term, weight))
        found.make_automaton()
        return found

    def count(batches):
        words = worker_state(("urls", tuple(weights.items())), automaton) if weights else None
        lower = {ord(a): b for a, b in zip(UPPER, ALNUM[:26], strict=True)}
        edge = frozenset(ALNUM)
        for rows in batches:
            strict_hits, soft_hits = [], []
            for u in strings(rows.column("url")):
                low = u.translate(lower)
                hits = set()
                for end, (term, weight) in words.iter(low) if words else ():
                    begin = end - len(term) + 1
                    before, after = low[begin - 1 : begin] if begin else "", low[end + 1 : end + 2]
                    if before not in edge and after not in edge:
                        hits.add((term, weight))
                strict_hits.append(sum(w >= limit for _, w in hits))
                soft_hits.append(sum(w < limit for _, w in hits))
            kept = dict(zip(rows.schema.names, rows.columns, strict=True))
            yield batch(**kept, strict_hits=("int32", strict_hits), soft_hits=("int32", soft_hits))

    thin = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    kind = thin.schema["page_id"].dataType.simpleString()
    hits = map_batches(thin, count, f"page_id {kind}, url string, strict_hits int, soft_hits int")
    host, path = url_parts(F.col("url"))
    parts = hits.select("page_id", host.alias("host"), path.alias("path"), "strict_hits", "soft_hits")
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    rejected = (F.col("strict_hits") * limit + F.col("soft_hits")) >= limit
    own = F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
    return parts.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "strict_hits", "soft_hits",
    )
