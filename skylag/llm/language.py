"""Language identification by Bayesian evidence fusion.

Four kinds of evidence add up as log-probabilities for each language: the text,
by a naive Bayes model of hashed byte trigrams; the language a page or document
declares; the suffix of its address; and its host. How often each declared language
and suffix goes with a language is counted over all rows. A host's prior is its own
counts, smoothed by those of its domain, these by those of its top-level domain,
and these by those of all rows. A row's own text is taken out of the counts before
they judge it. Counts are grouped sums, combined before their shuffle.

The trigram model is fitted on a sample of about ``TRAINING_ROWS`` labelled rows,
taken by a hash of the id and shared out evenly, of each label ``FEWEST_ROWS`` at
least. Every label is a language: a label is two or three letters, so their number is
bounded, and counts of trigrams are held sparse. A language "und" of evenly spread trigrams stands for anything else. Rows are
rejected when "und" is likeliest or the likeliest has less than ``least`` of the
probability, which is more than an even share for any number of languages.

Defined cases: a null or empty text has no trigrams and is judged by the other
evidence; a text without letters is "und" and is rejected; null or empty declared
languages, suffixes and hosts are no evidence; without any labelled row all is
"und". Repeated rows are judged one by one; extra columns are kept, those named
like the columns added are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from skylag.llm.common import aside, content_key, materialise, table, without

TRAINING_ROWS = 8_000
FEWEST_ROWS = 20  # of a label, expected in the sample; all of a rarer one
BUCKETS = 1 << 14
COUNTED_AT_ONCE = 256  # languages whose counts a task holds
TRIGRAMS = 100  # a text counts for so many trigrams at most: they are not independent
SMOOTHING = 5.0
LEAST = 0.3  # low enough for a short text between two languages
ABOVE_FLOOR = 0.125  # of the way from an even share of all languages to certainty
BROADCAST_COUNTS = 5_000_000  # evidence keys times languages
OTHER = "und"

_LETTERS = re.compile(r"[^\W\d_]")
_PIECE = 1 << 20


def trigrams(text: str) -> np.ndarray:
    """How often each hash of three bytes stands in a text, A-Z in lower case.

    Each run of bytes that are no ASCII letter and no part of a longer character is one space.
    """
    data = text.encode("utf-8", "replace").lower()
    raw = np.frombuffer(data, dtype=np.uint8)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    start = letter.copy()
    start[1:] |= letter[:-1]
    raw = np.where(letter, raw, 32)[start].astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(len(raw) - 2, 0), _PIECE):
        some = raw[at : at + _PIECE + 2]
        codes = (some[:-2] << 16 | some[1:-1] << 8 | some[2:]) * np.uint32(2654435761)
        counts += np.bincount(codes >> np.uint32(18), minlength=BUCKETS)
    return counts


class Trigrams(NamedTuple):
    """Log-probabilities of trigrams by language, "und" last. Any trigram has ``base`` in a
    language; those of bucket b have ``more`` in the languages of entries start[b] to start[b + 1]."""

    start: np.ndarray
    language: np.ndarray
    more: np.ndarray
    base: np.ndarray

    def likelihoods(self, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        first, sizes = self.start[at], self.start[at + 1] - self.start[at]
        entries = np.arange(sizes.sum()) + np.repeat(first - sizes.cumsum() + sizes, sizes)
        more = np.repeat(counts[at], sizes) * self.more[entries]
        return np.bincount(self.language[entries], more, len(self.base)) + counts.sum() * self.base


def fit(rows: DataFrame, most: int = TRAINING_ROWS) -> tuple[list[str], Trigrams]:
    """Languages and their trigrams from a sample of labelled rows (id, text, label)."""
    label = language_tag(F.col("label"))
    labelled = rows.select("id", "text", label.alias("label")).where("label is not null and text is not null")
    sizes = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    names = sorted(sizes)
    # As many rows of each language, so that a rare one is learnt as well.
    want = max(most / max(len(names), 1), FEWEST_ROWS)
    share = [(name, at, min(1.0, want / sizes[name])) for at, name in enumerate(names)]
    shares = rows.sparkSession.createDataFrame(share, "label string, language int, share double")
    drawn = F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(1 << 30)) < F.col("share") * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = trigrams(text)
                at = np.flatnonzero(counts)
                if language not in found and len(found) >= COUNTED_AT_ONCE:
                    yield from made(found)
                    found.clear()
                found.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))[at] += counts[at]
        yield from made(found)

    def made(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for language, counts in found.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([language] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["language", "bucket", "n"])

    sample = labelled.join(F.broadcast(shares), "label").where(drawn).select("language", "text")
    sums = sample.mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    language, bucket, n = (c.to_numpy() for c in sums.toArrow().columns)  # of the sample alone
    order = np.lexsort((language, bucket))
    language, bucket, n = language[order], bucket[order], n[order]
    start = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    total = np.bincount(language, n, len(names)) + 0.5 * BUCKETS
    base = np.append(np.log(0.5 / total), -math.log(BUCKETS))
    return names, Trigrams(start, language, np.log1p(2.0 * n), base)


def text_likelihoods(logs: Trigrams):
    """Column function: log-likelihood of a text in each language, null without letters."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None):
            if not text or not _LETTERS.search(text):
                return None
            counts = trigrams(text)
            total = int(counts.sum())
            if not total:
                return None
            return logs.likelihoods(counts) * (min(total, TRIGRAMS) / total)

        for batch in texts:
            yield batch.map(one, na_action=None)

    return score


def language_tag(text: Column) -> Column:
    """The first part of a language tag in lower case; null if it is none."""
    tag = F.lower(F.regexp_extract(F.trim(text.cast("string")), r"^([A-Za-z]{2,3})(?:[-_]|$)", 1))
    return F.when(tag != "", tag)


def host_levels(host: Column) -> list[Column]:
    """A host, its domain and its top-level domain."""
    host = F.lower(F.regexp_extract(F.coalesce(host.cast("string"), F.lit("")), r"^(?:[^@/]*@)?([^:/?#]*)", 1))
    parts = F.split(host, r"\.")
    domain = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    return [F.when(x != "", x) for x in (host, domain, F.element_at(parts, -1))]


def address_suffix(url: Column) -> Column:
    """Top-level domain of a url and, after it, a first path segment of two letters."""
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*?\.([A-Za-z]+)(?::\d+)?(?:[/?#]|$)", 1))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return F.when((found != "") | (path != ""), F.concat_ws("/", *[F.when(x != "", x) for x in (found, path)]))


_EVIDENCE = ["_host", "_domain", "_top", "_declared", "_suffix"]


def least(languages: int) -> float:
    """Probability that the likeliest of so many languages, beside "und", must have."""
    even = 1 / (languages + 1)
    return round(max(LEAST, even + ABOVE_FLOOR * (1 - even)), 6)


def identify(rows: DataFrame, names: list[str], logs: Trigrams, drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with language, confidence and accepted.

    Read are text, declared, suffix and host of ``rows``, all strings. Columns in
    ``drop`` are not carried on.
    """
    rows = rows.select(*[c for c in rows.columns if c not in ("language", "confidence", "accepted")])
    inner = [*_EVIDENCE, "_ll", "_best", "_post", "_top_of", *[f"{x}{k}" for x in "knt" for k in _EVIDENCE]]
    rows, back = aside(rows, *inner)
    all_names = [*names, OTHER]
    suffix = F.when(F.col("suffix") != "", F.lower("suffix"))
    level = dict(zip(_EVIDENCE, [*host_levels(F.col("host")), language_tag(F.col("declared")), suffix], strict=True))
    scored = rows.withColumns({"_ll": text_likelihoods(logs)(F.col("text")), **level})
    best = F.expr("if(_ll is null, null, array_position(_ll, array_max(_ll)) - 1)").cast("int")
    scored = materialise(scored.withColumn("_best", best).drop(*drop), "likelihoods")

    seen = materialise(scored.where("_best is not null").groupBy(*_EVIDENCE, "_best").agg(F.count("*").alias("n")), "evidence")

    def counted(key: str) -> DataFrame:
        """Of each value, how often it goes with each language, and with any."""
        each = seen.where(F.col(key).isNotNull()).groupBy(key, "_best").agg(F.sum("n").alias("n"))
        found = each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_best", "n"))).alias("of"), F.sum("n").alias(f"t{key}"))
        places = F.sequence(F.lit(0), F.lit(len(all_names) - 1))
        dense = F.transform(places, lambda i: F.coalesce(F.col("of")[i], F.lit(0)))
        return found.select(key, dense.alias(f"n{key}"), f"t{key}")

    overall = [0] * len(all_names)
    for row in seen.groupBy("_best").agg(F.sum("n").alias("n")).collect():
        overall[row["_best"]] = row["n"]
    combos = scored.select(*_EVIDENCE).distinct()
    for key in _EVIDENCE:
        combos = combos.join(counted(key), key, "left")
    combos = materialise(combos, "priors")
    few = combos.count() * len(all_names) <= BROADCAST_COUNTS
    shown = [F.coalesce(F.col(k), F.lit("")).alias(f"k{k}") for k in _EVIDENCE]
    keyed = combos.select(*shown, *[f"{x}{k}" for k in _EVIDENCE for x in "nt"])
    met = F.lit(True)
    for k in _EVIDENCE:
        met = met & (F.coalesce(F.col(k), F.lit("")) == F.col(f"k{k}"))
    joined = scored.join(F.broadcast(keyed) if few else keyed, met, "left")

    def without_own(count: Column, own: Column) -> Column:
        return F.greatest(F.coalesce(count - own.cast("int"), F.lit(0)).cast("double"), F.lit(0.0))

    everything = sum(overall) + SMOOTHING * len(all_names)
    share = F.array(*[F.lit((n + SMOOTHING) / everything) for n in overall])
    joined = joined.withColumns({f"t{k}": without_own(F.col(f"t{k}"), F.col("_best").isNotNull()) for k in _EVIDENCE})

    def fused(share: Column, i: Column) -> Column:
        def count(key: str) -> Column:
            return without_own(F.get(f"n{key}", i), F.col("_best").eqNullSafe(i))

        prior = share
        for key in ("_top", "_domain", "_host"):
            prior = (count(key) + SMOOTHING * prior) / (F.col(f"t{key}") + SMOOTHING)
        found = F.log(prior)
        for key in ("_declared", "_suffix"):  # how much likelier the language is where this is declared
            with_key = (count(key) + SMOOTHING * share) / (F.col(f"t{key}") + SMOOTHING)
            found = found + F.log(with_key / share)
        return found + F.coalesce(F.get("_ll", i), F.lit(0.0))

    joined = joined.withColumn("_post", F.transform(share, fused)).withColumn("_top_of", F.array_max("_post"))
    weight = F.aggregate("_post", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("_top_of")))
    chosen = F.get(F.array(*map(F.lit, all_names)), (F.array_position("_post", F.col("_top_of")) - 1).cast("int"))
    lost = F.col("_ll").isNull() & F.col("_text")
    joined = joined.withColumns({"language": F.when(lost, OTHER).otherwise(chosen), "confidence": F.round(1 / weight, 6)})
    accepted = (F.col("language") != OTHER) & (F.col("confidence") >= least(len(names)))
    made = [c for c in rows.columns if c not in drop and c != "_text"]
    return back(joined.withColumn("accepted", accepted).select(*made, "language", "confidence", "accepted"))


def _documents(docs: DataFrame) -> DataFrame:
    """``docs`` as evidence: the lang column declares, the source is the host."""
    return docs.withColumns(
        {"declared": F.col("lang"), "host": F.col("source"), "suffix": F.lit(None).cast("string"), "_text": F.coalesce(F.length("text") > 0, F.lit(False))}
    )


def _pages(pages: DataFrame) -> DataFrame:
    """``pages`` as evidence: the html element declares, url gives suffix and host."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.withColumns(
        {
            "text": bare,
            "declared": F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z-]+)""", 1),
            "host": F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1),
            "suffix": address_suffix(F.col("url")),
            "_text": F.trim(bare) != "",
        }
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language is rejected.

    The verdict depends on text, lang and source; what is stored are keys of these.
    """
    names, logs = fit(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")))
    key = content_key("text", "lang", "source")
    rows = _documents(docs.select("text", "lang", "source", key.alias("key")))
    found = identify(rows, names, logs, drop=("text", "lang", "source", "declared", "suffix", "host"))
    gone = found.where(~F.coalesce("accepted", F.lit(False))).select("key").distinct()
    return without(docs, materialise(gone, "rejected"), key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and pages: id, language, confidence and accepted."""
    docs, pages = (table(spark, sf_dir, name) for name in ("documents", "pages"))
    names, logs = fit(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")))
    columns = ["table", "doc_id", "page_id", "text", "declared", "suffix", "host", "_text"]
    none = F.lit(None).cast("long")
    rows = _documents(docs).withColumns({"table": F.lit("documents"), "page_id": none}).select(*columns)
    rows = rows.union(_pages(pages).withColumns({"table": F.lit("pages"), "doc_id": none}).select(*columns))
    found = identify(rows, names, logs, drop=("text", "declared", "suffix", "host"))
    return found.select("table", "doc_id", "page_id", "language", "confidence", "accepted")
