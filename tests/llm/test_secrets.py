"""Secret scans against Python's own patterns, and the linking of parts."""

import random
import re

from pyspark.sql import functions as F

from skylag.llm import secrets as s

PYTHON = [
    ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def _base(text):
    found = []
    for number, (_, pattern, group, least) in enumerate(PYTHON):
        found += [(m.start(), number, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{PYTHON[k][0]}:{a}:{e}" for a, k, e in sorted(found))


def _scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit(1))
    rows = s.scan(docs).select("doc_id", s.listed(F.col("base")).alias("b"), s.listed(F.col("spans")).alias("s"), s.redacted(F.col("text"), F.col("spans")).alias("r"))
    return rows.orderBy("doc_id").collect()


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(2)
    bits = ["password", "PassWd", "secret", "token", "api_key", "apiKEY", ":", "=", " ", '"', "'", "AKIA", "AKIAQ7", "abcdef", "0123456789abcdef01234567", "Zz9", "\n", "é😀", "ſecret"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "token=" + "a" * 100_000, "secret=token :abcdefg", "x" * 50_000 + " token: abcdef"]
    for row, text in zip(_scan(spark, texts), texts, strict=True):
        assert row.b == _base(text)
        assert set(filter(None, row.b.split(","))) <= set(row.s.split(","))


def test_weak_parts_need_their_complements(spark):
    key, value = "AKIA" + "A" * 20, "Zx9abcdefghijklmnopqrstu"
    far = " word" * 60
    texts = [
        f"{key} {value}", f"{value}", f"{key}{far} {value}", "user=joe at https://a.example",
        f"user=joe {value} https://a.example/x", f"https://a.example {value}", f"user=joe {value}",
    ]
    kinds = [[x.split(":")[0] for x in filter(None, r.s.split(","))] for r in _scan(spark, texts)]
    assert kinds == [["access", "value"], [], ["access"], [], ["id", "value", "endpoint"], [], ["id", "value"]]


def test_distance_is_the_gap_between_spans(spark):
    """A long token is linked on either side of its identifier, up to 200 code points away."""
    key = "AKIA" + "Q7" * 8
    texts, want = [], []
    for size in (24, 300, 511, 1200, 5000):
        token = ("Zx9-" * size)[:size]
        for gap in (1, 10, 200, 201):
            for lead in (0, 690):
                blank = " " * gap
                texts += [" " * lead + token + blank + key, " " * lead + key + blank + token]
                want += [gap <= 200] * 2
    texts.append(" https://a.example/" + "p" * 400 + f" user=joe {'Zx9-' * 8}")
    rows = _scan(spark, texts)
    assert ["value:" in r.s for r in rows[:-1]] == want
    assert "endpoint:" in rows[-1].s and "Zx9" not in "".join(r.r for r, near in zip(rows, want, strict=False) if near)


def test_redaction_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, "é token = 'abcdefgh', then", 25), (2, "plain", 5), (3, None, None), (1, "é token = 'abcdefgh', then", 25)], "doc_id long, text string, n_chars long")
    rows = s.without_secrets(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.n_chars) for r in rows] == [(1, "é [redacted]', then", 19)] * 2 + [(2, "plain", 5), (3, None, None)]
    assert s.without_secrets(docs.limit(0)).columns == docs.columns and s.scan(docs.limit(0)).count() == 0


def test_columns_of_any_name_stay_as_they_are(spark):
    names = ["base", "weak", "spans", "more", "key", "_row"]
    docs = spark.createDataFrame([(1, "token = 'abcdefgh'", *names), (2, "plain", *names), (3, None, *names)], ["doc_id", "text", *names])
    rows = s.without_secrets(docs).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["[redacted]'", "plain", None] and all(list(r)[2:] == names for r in rows)
    assert s.scan(docs).where("doc_id = 1").select("weak", "more", "key", "_row").first() == ("weak", "more", "key", "_row")


def test_many_spans_in_one_text(spark):
    one = "token=abcdefg1 x "
    many = one * 6_000
    docs = spark.createDataFrame([(1, many)], "doc_id long, text string")
    row = s.scan(docs).select(F.size("base").alias("n"), F.element_at("base", -1)["end"].alias("end")).first()
    assert (row.n, row.end) == (6_000, len(many) - 3)
    assert s.without_secrets(docs).first().text == "[redacted] x " * 6_000
