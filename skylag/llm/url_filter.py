"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick.

Rules and terms are tables. A rule names a host and a path prefix and fits that host and
all its subdomains; the longest rule wins, of equally long ones "block". The suffixes
of a url's host meet the rules in an equi-join, and a maximum picks the rule, so there
may be any number of rules. A url without a fitting rule is judged by its terms: an
automaton of all terms, ``MOST_TERMS`` at most, finds them in one pass, a boundary
check drops those inside a longer word, and the url is blocked where the weights of its
distinct terms reach 1: one strict term, or several soft ones.

Defined cases: a null url, an empty one and one without ``://`` have an empty
host and path, fit no rule and are judged by their terms (none in a null url).
Repeated rows are judged one by one; extra columns are kept by ``judge``, and
columns of the same names as its own are replaced. Rules and terms with a null are
left out; a term given twice has its larger weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import content_key, lower_ascii, materialise, table, unused

# Rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# Terms that block alone, and terms that block together.
STRICT = ("porn", "xxx", "hentai", "camgirl", "milf", "escorts")
SOFT = ("sex", "adult", "nude", "casino", "poker", "betting", "torrent", "warez", "viagra", "dating")
SOFT_HITS = 2
# Terms an automaton is built of, on the driver and in every task.
MOST_TERMS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a url; both empty where it has none."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def terms_table(spark: SparkSession, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """Terms with their weights: 1 for a strict one, a share of it for a soft one."""
    rows = [(t, 1.0) for t in strict] + [(t, 1.0 / soft_hits) for t in soft]
    return spark.createDataFrame(rows, "term string, weight double")


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, verdict, rule) of the ``urls`` (key, host, path) that a rule fits."""
    rules = rules.dropna(subset=["verdict", "host", "path"])
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    urls = urls.where("host <> ''").withColumn("labels", F.split("host", r"\."))
    labels = F.col("labels")
    # No suffix of more labels than a rule has.
    lengths = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))
    suffixes = F.transform(lengths, lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    met = urls.select("key", "path", F.explode(suffixes).alias("suffix")).join(named, "suffix")
    rule = F.concat("suffix", "prefix")
    best = F.max(F.struct(F.length(rule).alias("n"), F.col("verdict"), rule.alias("rule"))).alias("best")
    return met.where(F.col("path").startswith(F.col("prefix"))).groupBy("key").agg(best).select("key", "best.verdict", "best.rule")


def term_verdict(terms: list[tuple[str, float]]):
    """Column function: does the vocabulary block this url?

    Letters are compared in lower case; a term counts where no ASCII letter or
    digit stands right before or after it.
    """

    @F.pandas_udf("boolean")
    def blocked(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for term, weight in sorted(terms, key=lambda t: t[1]):
            automaton.add_word(term, (term, weight))
        automaton.make_automaton()

        def outside(char: str) -> bool:
            return not (char.isascii() and char.isalnum())

        def judge(url: str | None) -> bool:
            text = f" {url or ''} ".lower()
            found = {
                term: weight
                for end, (term, weight) in automaton.iter(text)
                if outside(text[end - len(term)]) and outside(text[end + 1])
            }
            return sum(found.values()) >= 1 - 1e-9

        for batch in urls:
            yield batch.map(judge).astype(bool)

    return blocked


def judge(pages: DataFrame, rules: DataFrame | None = None, terms: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule (null without one) and verdict (allow or block).

    ``rules`` are (verdict, host, path), ``terms`` (term, weight); by default those above.
    """
    spark = pages.sparkSession
    rules = rules_table(spark) if rules is None else rules
    terms = terms_table(spark) if terms is None else terms
    words = terms.dropna().where("term <> ''").select(F.lower("term").alias("term"), "weight").take(MOST_TERMS + 1)
    if len(words) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    host, path = host_and_path(F.col("url"))
    found = pages.withColumns({"host": host, "path": path})
    key = content_key("host", "path")
    fitting = materialise(fitting_rules(found.select(key.alias("key"), "host", "path"), rules), "fitting")
    at, verdict = unused("key"), unused("verdict")
    out = fitting.select(F.col("key").alias(at), F.col("verdict").alias(verdict), "rule")
    joined = found.drop("rule").withColumn(at, key).join(out, at, "left")
    # An empty vocabulary blocks nothing.
    blocked = term_verdict([tuple(w) for w in words])(F.col("url")) if words else F.lit(False)
    by_terms = F.when(blocked, "block").otherwise("allow")
    return joined.withColumn("verdict", F.coalesce(F.col(verdict), by_terms)).drop(at, verdict)


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    fits = "\n".join(
        f"    WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}') THEN '{v} {d}{p}'"
        for v, d, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    hit = "regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9])({})($|[^a-z0-9])')"
    soft = " + ".join(f"CAST({hit.format(t)} AS INTEGER)" for t in SOFT)
    return f"""
WITH parts AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), chosen AS (
  SELECT *, CASE
{fits}
    END AS fit,
    {hit.format("|".join(STRICT))} OR {soft} >= {SOFT_HITS} AS blocked
  FROM parts
)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
  CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 1) WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM chosen
"""


ORACLE_SQL = _oracle()
