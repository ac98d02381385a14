"""Benchmark decontamination by a broadcast hash set of test n-grams.

Texts and test items are cut into normalised words; an item's windows are its runs
of ``words`` words, or the whole item where it has fewer. The set of windows is
sent along with the plan as bitmaps of a fixed size. One pass over the documents
tests each position: the pair of words there, then the window. What passes, a few
positions of a thousand and every true hit, is verified by a join on the words
themselves, so a full bitmap costs time but no result.

Only expressions and joins are used. Rows with positions to verify are written to
the shared folder with a row number, so that texts are read and cut once; they are
never exploded word by word, and no text is shuffled.

Defined cases: a null text or item has no words, an item without words no window;
a null item_id marks documents but is not listed; equal items are listed once each
by their ids; repeated rows are judged one by one; without items nothing is hit.
Extra columns are kept; those named like the columns added are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import aside, content_key, lower_ascii, materialise, table, without

WORDS = 10
FILTER_BITS = 1 << 18
# Windows that are broadcast for the verifying join; above it both sides shuffle.
BROADCAST_WINDOWS = 1_000_000
# Fixed value: a word.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; an empty array for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # In a text of one-byte characters only, lower() touches A-Z alone and is faster.
    plain = F.length(text) == F.octet_length(text)
    return F.regexp_extract_all(F.when(plain, F.lower(text)).otherwise(lower_ascii(text)), F.lit(WORD), 0)


def windows_of(items: DataFrame, words: int = WORDS) -> DataFrame:
    """Distinct (item_id, len, window) of the test items."""
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w"))
    cut = cut.withColumn("len", F.least(F.size("w"), F.lit(words))).where("len > 0")
    starts = F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)
    windows = F.transform(starts, lambda i: F.slice("w", i, F.col("len")))
    return cut.select("item_id", "len", F.explode(windows).alias("window")).distinct()


def _bitmap(hashes: DataFrame, bits: int) -> Column:
    """A literal array of longs in which the bit of each hash is set.

    ``bits`` / 64 numbers at most come to the driver, whatever there is to hash.
    """
    place = F.pmod(F.col("h"), F.lit(bits))
    words = (
        hashes.select(F.shiftright(place, 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    longs = [0] * (bits // 64)
    for word, value in words:
        longs[word] = value
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def _in(bitmap: Column, h: Column, bits: int) -> Column:
    place = F.pmod(h, F.lit(bits))
    return F.getbit(F.get(bitmap, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1


def _hits(starts: Column, length: int, whole: Column, bits: int) -> Column:
    """start, len and words of those starts whose ``length`` words the bitmap holds."""

    def window(i: Column) -> Column:
        return F.slice("_w", i, length)

    fits = F.filter(starts, lambda i: (i <= F.size("_w") - length + 1) & _in(whole, F.xxhash64(window(i)), bits))
    return F.transform(fits, lambda i: F.struct(i.alias("start"), F.lit(length).alias("len"), window(i).alias("window")))


def with_candidates(docs: DataFrame, windows: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with ``n_words`` and ``maybe``: start, len and words of every position
    whose window the bitmaps hold."""
    lengths = [row.len for row in windows.select("len").distinct().collect()]  # ten at most
    found = docs.withColumn("_w", words_of(F.col("text")))
    found = found.withColumn("n_words", F.size("_w").cast("long"))
    none = F.array().cast("array<struct<start:int,len:int,window:array<string>>>")
    if not lengths:
        return found.withColumn("maybe", none).drop("_w")
    pairs = _bitmap(windows.select(F.xxhash64(F.get("window", F.lit(0)), F.get("window", F.lit(1))).alias("h")), bits)
    whole = _bitmap(windows.select(F.xxhash64("window").alias("h")), bits)
    every = F.when(F.size("_w") > 0, F.sequence(F.lit(1), F.size("_w"))).otherwise(F.array().cast("array<int>"))

    def pair(i: Column) -> Column:
        return F.xxhash64(F.get("_w", i - 1), F.get("_w", i))

    found = found.withColumn("_p", F.filter(every, lambda i: _in(pairs, pair(i), bits)))
    parts = [_hits(F.col("_p") if n > 1 else every, n, whole, bits) for n in sorted(lengths)]
    return found.withColumn("maybe", F.concat(none, *parts)).drop("_w", "_p")


def _covered() -> Callable:
    """Words in the union of the spans: starts in order, the end reached so far."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(done, span):
        end = F.greatest(done["end"], span["start"] + span["len"])
        return F.struct((done["n"] + end - F.greatest(done["end"], span["start"])).cast("int").alias("n"), end.alias("end"))

    return lambda spans: F.aggregate(F.array_sort(spans), zero, add, lambda done: done["n"].cast("long"))


def _verified(docs: DataFrame, items: DataFrame, words: int, bits: int, drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The marked rows of ``docs``, written with a number ``_row``, and their hits
    (_row, span, item_id)."""
    windows = materialise(windows_of(items, words), "windows")
    marked = with_candidates(docs, windows, bits).drop(*drop).withColumn("_row", F.monotonically_increasing_id())
    marked = materialise(marked, "marked")
    asked = marked.where(F.size("maybe") > 0).select("_row", F.explode("maybe").alias("m"))
    asked = asked.select("_row", F.struct("m.start", "m.len").alias("span"), "m.window")
    few = windows.count() <= BROADCAST_WINDOWS
    return marked, asked.join(F.broadcast(windows) if few else windows, "window").select("_row", "span", "item_id")


def decontaminate(
    docs: DataFrame, items: DataFrame, words: int = WORDS, bits: int = FILTER_BITS, drop: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted), spans (start and length in
    words, from 1) and contaminated. Columns in ``drop`` are not carried on."""
    added = ["n_words", "n_hit", "item_ids", "spans", "contaminated"]
    docs, back = aside(docs.select(*[c for c in docs.columns if c not in added]), "maybe", "_w", "_p", "_row")
    marked, hits = _verified(docs, items, words, bits, drop)
    hits = hits.groupBy("_row").agg(F.collect_set("span").alias("spans"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    hits = hits.withColumn("n_hit", _covered()(F.col("spans")))
    found = marked.drop("maybe").join(hits, "_row", "left").drop("_row")
    return back(found).withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
            "item_ids": F.coalesce("item_ids", F.array().cast("array<string>")),
            "spans": F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<start:int,len:int>>")),
            "contaminated": F.coalesce(F.col("n_hit") > 0, F.lit(False)),
        }
    )


def without_contaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, bits: int = FILTER_BITS) -> DataFrame:
    """Documents of ``docs`` in which no window of an item occurs. What is stored are keys
    of texts and their candidates."""
    key = content_key("text")
    marked, hits = _verified(docs.select(key.alias("key"), "text"), items, words, bits, drop=("text",))
    gone = marked.join(hits.select("_row").distinct(), "_row").select("key").distinct()
    return without(docs, materialise(gone, "contaminated"), key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark"), drop=("text",))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
hits AS (
  SELECT p.r, p.i, l.n, x.item_id
  FROM places p JOIN lengths l ON p.i + l.n - 1 <= len(p.w)
  JOIN windows x ON x.n = l.n AND x.gram = array_to_string(p.w[p.i:p.i + l.n - 1], ' ')
), covered AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""
