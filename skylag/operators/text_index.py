"""A search over text fields by an inverted index, scored by BM25.

The index is three tables below one path: ``postings``, a row for each word of each
field of each document, stored by word; ``terms``, in how many documents a word
stands in a field; ``fields``, how many documents have the field and how many words it
has on average. A search reads the folders its words hash to, and in them the row
groups whose range holds them; the documents are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.functions.text import NOT_A_WORD, query_words
from skylag.session import materialise

# The usual constants of the formula.
K1 = 1.2
B = 0.75
BUCKETS = 64
# Scores are rounded, so that the order does not depend on the order of a sum.
DIGITS = 9


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text.cast("string")), NOT_A_WORD), lambda w: w != "")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def build_index(docs: DataFrame, path: str, key: str, fields: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write the index of ``fields`` of ``docs``, whose rows ``key`` names; replaces one
    that is there. A NULL key names no document, rows of one key are several."""
    named = [F.struct(F.lit(name).alias("field"), _tokens(F.col(name)).alias("words")) for name in fields]
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.inline(F.array(*named)))
    texts = texts.where(F.size("words") > 0)
    # Fields are short, so a word is counted inside its row.
    counted = F.transform(
        F.array_distinct("words"),
        lambda w: F.struct(w.alias("word"), F.size(F.filter("words", lambda x: x == w)).alias("tf")),
    )
    rows = texts.select("key", "field", F.size("words").alias("length"), F.inline(counted))
    placed = rows.withColumn("_bucket", _bucket(F.col("word"), buckets))
    # The key is the last in the order: a word that most documents have is spread.
    order = ["_bucket", "word", "field", "key"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").partitionBy("_bucket")
    writer.option("parquet.bloom.filter.enabled#word", "true").parquet(f"{path}/postings")
    stored = docs.sparkSession.read.parquet(f"{path}/postings")
    terms = stored.groupBy("_bucket", "field", "word").agg(F.count("*").alias("df"))
    terms.repartitionByRange("_bucket", "word").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/terms")
    sizes = texts.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("average"))
    sizes.write.mode("overwrite").parquet(f"{path}/fields")
    docs.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/about")


def postings(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """Postings of the words of a query, with the weight of each word in its field."""
    pairs = [(name, word) for name, text in fields.items() for word in query_words(text)]
    buckets = spark.read.parquet(f"{path}/about").first()[0]
    asked = spark.createDataFrame(pairs, "field string, word string")
    places = sorted({r[0] for r in asked.select(_bucket(F.col("word"), buckets)).collect()})  # of the query's words
    words = sorted({word for _, word in pairs})

    def read(table: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/{table}")
        return rows.where(F.col("_bucket").isin(places) & F.col("word").isin(words)).drop("_bucket")

    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    sizes = spark.read.parquet(f"{path}/fields")
    # A row for each word asked for, whatever the size of the index.
    weights = read("terms").join(F.broadcast(asked), ["field", "word"]).join(sizes, "field")
    weights = weights.select("field", "word", "average", idf.alias("idf"))
    return read("postings").join(F.broadcast(weights), ["field", "word"])


def hits(spark: SparkSession, path: str, **fields: str | None) -> DataFrame:
    """(key, Relevance) of documents that share a word with every field given.

    Relevance is the sum of the BM25 scores of the words in their fields. A field
    whose text has no word does not count; with none, nothing is found.
    """
    wanted = {name: text for name, text in fields.items() if text and query_words(text)}
    if not wanted:
        return spark.createDataFrame([], "key string, Relevance double")
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("average"))
    scored = postings(spark, path, wanted).withColumn("score", F.col("idf") * F.col("tf") * (K1 + 1) / norm)
    found = scored.groupBy("key").agg(F.sum("score").alias("score"), F.count_distinct("field").alias("met"))
    return found.where(F.col("met") == len(wanted)).select("key", F.round("score", DIGITS).alias("Relevance"))


def top(spark: SparkSession, path: str, docs: DataFrame, key: str, n: int, **fields: str | None) -> DataFrame:
    """The ``n`` most relevant documents with their Relevance, ties by key; exact."""
    best = hits(spark, path, **fields).orderBy(F.desc("Relevance"), "key").limit(n)
    return with_documents(best, docs, key).orderBy(F.desc("Relevance"), key)


def with_documents(found: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Documents of the hits, with Relevance as last column. The hits are written first,
    so the planner knows how few they are."""
    few = materialise(found.select(F.col("key").alias(key), "Relevance"), "hits")
    return docs.join(few, key).select(*docs.columns, "Relevance")
