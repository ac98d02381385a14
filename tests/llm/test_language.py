"""Language identification: held-out accuracy, evidence and odd rows."""

import itertools

from pyspark.sql import functions as F

from skylag.llm import language
from skylag.llm.common import on_workers, table


def test_held_out_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    names, logs = language.fit(seen)
    held = docs.where("doc_id % 2 = 1").withColumn("truth", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    got = language.identify(language._documents(held), names, logs)
    right, total = got.select(F.avg((F.col("language") == F.col("truth")).cast("int")), F.count("*")).first()
    assert total and right > 0.95
    assert got.where("not accepted").count() <= 0.02 * total


def _model(spark):
    rows = [(i, "the house and the garden of the king " * 3, "en") for i in range(20)]
    rows += [(100 + i, "das haus und der garten des königs " * 3, "de-AT") for i in range(20)] + [(200, None, "fr"), (201, "x", None)]
    return language.fit(spark.createDataFrame(rows, "id long, text string, label string"))


def test_evidence_beside_the_text(spark):
    on_workers(spark)
    names, logs = _model(spark)
    assert names == ["de", "en"]
    schema = "doc_id long, text string, declared string, host string, suffix string, _text boolean, language string"
    rows = [(i, "the garden of the king and the house", "en", "a.example.com", "com", True, "own") for i in range(30)]
    rows += [(50 + i, "der garten des königs und das haus", "de_DE", "b.example.de", "de", True, "own") for i in range(30)]
    rows += [
        (100, None, None, "x.b.example.de", "de", False, "own"), (101, None, "en", None, None, False, "own"),
        (102, "", None, None, None, False, "own"), (103, "123 ... !!!", "en", "a.example.com", "com", True, "own"),
        (104, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 3, None, "c.example.net", "net", True, "own"), (104, "king " * 100_000, None, None, "", True, "own"),
    ]
    got = language.identify(spark.createDataFrame(rows, schema).withColumn("extra", F.lit(1)), names, logs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.language, r.accepted))
    assert all(by[i] == [("en", True)] for i in range(30)) and all(by[50 + i] == [("de", True)] for i in range(30))
    assert by[100] == [("de", True)] and by[101] == [("en", True)]
    assert by[103] == [("und", False)]
    assert sorted(by[104]) == [("en", True), ("und", False)]


def test_pages_declare_and_have_addresses(spark):
    url = spark.createDataFrame([("https://m.x.co.uk/fr/a",), ("http://h.de?x",), ("nothing",), (None,)], "url string")
    got = url.select(language.address_suffix(F.col("url")).alias("s"), *[c.alias(n) for n, c in zip("hdt", language.host_levels(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)), strict=True)]).collect()
    assert [tuple(r) for r in got] == [("uk/fr", "m.x.co.uk", "co.uk", "uk"), ("de", "h.de", "h.de", "de"), (None,) * 4, (None,) * 4]


def test_clean_documents_stay(spark):
    on_workers(spark)
    rows = [(i, "the house and the garden of the king", "en", "s", 1) for i in range(10)] + [(90, "77 88", "en", "s", 1), (91, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, confidence int")
    kept = language.accepted_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(10)) and kept.where("doc_id = 90").count() == 0
    assert language.accepted_documents(docs.limit(0)).count() == 0


def test_every_label_is_a_language(spark):
    """Sixty labels of words of their own; the one most rows have crowds out none."""
    on_workers(spark)
    tags = ["".join(x) for x in itertools.islice(itertools.product("abcdefghijklmnopqrst", "uvw"), 60)]
    text = {tag: f"{tag}{tag[::-1]} {tag[0] * 3}{tag} {tag}{tag[1] * 2}{tag[0]} " * 3 for tag in tags}
    rows = [(i * 100 + k, text[tag], tag, f"{tag}.example") for i, tag in enumerate(tags) for k in range(100 if not i else 3)]
    rows += [(90_000 + i, text[tag], None, None) for i, tag in enumerate(tags)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names, logs = language.fit(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")))
    assert names == sorted(tags)
    got = {r.doc_id: r.language for r in language.identify(language._documents(docs), names, logs).collect()}
    assert [got[90_000 + i] for i in range(60)] == tags
    assert language.accepted_documents(docs).count() == len(rows)


def test_least_confidence_can_reject_for_any_number_of_languages(spark):
    assert all(language.least(n) > 1 / (n + 1) for n in range(1, 100)) and language.least(4) == language.LEAST
    on_workers(spark)
    names, logs = _model(spark)
    rows = [(i, text, None, None) for i, text in enumerate(["the garden of the king and the house", "der garten des königs und das haus"] * 3)]
    docs = spark.createDataFrame([*rows, (9, None, None, None)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify(language._documents(docs), names, logs).collect()}
    assert got[9].language in names and 1 / 3 < got[9].confidence and not got[9].accepted
    assert all(got[i].accepted for i in range(6))


def test_columns_of_any_name_stay_as_they_are(spark):
    on_workers(spark)
    names = ["_ll", "_best", "_host", "declared", "accepted", "key", "_text"]
    rows = [(i, f"the quick brown fox jumps over the lazy dog number {i} and runs away", "en", "s", *names) for i in range(30)]
    rows += [(99, "0123 !!", None, None, *names)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])
    kept = language.accepted_documents(docs).collect()
    assert len(kept) == 30 and all(list(r)[4:] == names for r in kept)
