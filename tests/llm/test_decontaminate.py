"""Decontamination against a scan of every window."""

import random
import re

from skylag.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def _brute(text, items):
    words, hit, found = _words(text), set(), set()
    for item_id, item in items:
        w = _words(item)
        n = min(10, len(w))
        for window in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def test_hits_equal_a_scan(spark):
    rng = random.Random(1)
    some = [f"w{i}" for i in range(60)] + ["É", "é", "x1"]
    items = [(i, " ".join(rng.choices(some, k=k))) for i, k in enumerate([30, 14, 10, 9, 3, 1])]
    items += [(6, items[0][1]), (None, "lonely words here"), (7, None), (8, " ,;"), (0, items[0][1])]
    docs = [(i, " ".join(rng.choices(some, k=rng.randint(0, 80)))) for i in range(30)]
    docs += [(50, "a " + items[0][1].upper() + " b"), (51, items[1][1].replace(" ", ", ") + "."), (52, None), (53, ""), (54, "Lonely, WORDS here"), (50, "a b"), (55, "k " * 30_000 + items[2][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'own' AS spans")
    for bits in (1 << 18, 1 << 6):  # a full bitmap finds no more and no less
        got = d.decontaminate(table, spark.createDataFrame(items, "item_id long, text string"), bits=bits)
        rows = sorted((r.doc_id, r.text or "", r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got.collect())
        want = sorted((i, t or "", *(b := _brute(t, items)), b[1] > 0) for i, t in docs)
        assert rows == want


def test_clean_documents_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x y z"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("q", "b c d")], "item_id string, text string")
    assert [r.doc_id for r in d.without_contaminated(docs, items).orderBy("doc_id").collect()] == [2, 3]
    assert d.without_contaminated(docs, items.limit(0)).count() == 3
    assert d.decontaminate(docs.limit(0), items).count() == 0


def test_columns_of_any_name_stay_as_they_are(spark):
    names = ["n_words", "maybe", "_w", "_p", "_row", "key", "spans"]
    docs = spark.createDataFrame([(1, "a b c d", *names), (2, "x y", *names)], ["doc_id", "text", *names])
    items = spark.createDataFrame([("q", "b c d")], "item_id string, text string")
    assert [tuple(r) for r in d.without_contaminated(docs, items).collect()] == [(2, "x y", *names)]
    row = d.decontaminate(docs, items).where("doc_id = 1").first()
    assert (row.n_words, row.maybe, row["_w"], row["_p"], row["_row"], row.key) == (4, *names[1:6])
