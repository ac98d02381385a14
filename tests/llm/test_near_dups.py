"""Near duplicates against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from skylag.llm import near_dups
from skylag.llm.common import on_workers
from skylag.llm.components import components


def _groups(texts, words):
    sets = {}
    for doc_id, text in texts:
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and (common := len(sets[a] & sets[b])) and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)
    ]
    label, before = {i: i for i in sets}, None
    while label != before:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


def _texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    out, number = [], 10
    for group in range(12):
        base = rng.choices(words, k=rng.randint(30, 300))
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 22)):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append((number, " ".join(text)))
            number += 1
    return out + [(1, None), (2, ""), (3, "one"), (4, "One"), (5, "one two"), (6, " \n "), (7, "x " * 50_000), (8, "X " * 60_000)]


def test_components_equal_all_pairs(spark):
    on_workers(spark)
    for words in (2, 5):
        texts = _texts()
        docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit("own"))
        got = near_dups.near_duplicates(docs, words).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _groups(texts, words)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_dense_group_around_the_threshold(spark, monkeypatch):
    """Edits at random depth: some pairs of a group are linked, some only through others, some not."""
    on_workers(spark)
    monkeypatch.setattr(near_dups, "CUT", 64)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=150)
    texts = []
    for i in range(260):
        text = list(base)
        for _ in range(rng.randint(1, 26)):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append((i, " ".join(text)))
    got = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 2).collect()
    want = _groups(texts, 2)
    assert len({x for _, x in want.values()}) > 5
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_one_of_each_group_stays(spark):
    on_workers(spark)
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(4, long, "a"), (2, long + " end", "b"), (9, "other text", "c"), (9, "other text", "c"), (None, long, "d"), (7, None, "e"), (8, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = near_dups.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in kept.collect()) == [(0, "d"), (2, "b"), (7, "e"), (8, "f"), (9, "c")]
    assert near_dups.deduplicated(docs.limit(0)).count() == 0


def test_rows_that_share_a_doc_id_are_judged_by_their_texts(spark):
    on_workers(spark)
    long, other = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(1, long), (1, other), (2, long + " x"), (3, other + " x"), (5, "five six seven eight nine ten"), (5, long + " y"), (6, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("own"))
    got = sorted((r.doc_id, r.component_id) for r in near_dups.near_duplicates(docs).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 1), (5, 5), (6, 6), (6, 6)]
    kept = sorted((r.doc_id, r.text or "", r.kept) for r in near_dups.deduplicated(docs).collect())
    assert kept == sorted((i, t or "", "own") for i, t in rows if i not in (2, 3) and t != long + " y")
    many = docs.union(docs).union(docs)
    assert sorted((r.doc_id, r.text or "", r.kept) for r in near_dups.deduplicated(many).collect()) == kept


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 5), (301, 300), (300, 301)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[1000:]
    assert (near_dups.sketch(pool) == np.maximum(near_dups.sketch(a), near_dups.sketch(b))).all()
    close, far = pool[:1900], pool[1990:]
    sizes = np.array([2000.0, 2000.0]), np.array([1900.0, 1010.0])
    left = np.stack([near_dups.sketch(a)] * 2)
    right = np.stack([near_dups.sketch(close), near_dups.sketch(far)])
    assert near_dups.hopeful(left, right, *sizes, 80).tolist() == [True, False]
    assert 0.2 < (left[0] == near_dups.sketch(b)).mean() < 0.5  # a third is shared
