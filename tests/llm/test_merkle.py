"""The manifest against trees built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from skylag.llm import merkle


def _h(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*fields) -> str:
    return _h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def _tree(leaves):
    """(last node, for each leaf its siblings as (left, right))."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            beside = i ^ 1
            text = level[beside] if beside < len(level) else ""
            paths[leaf].append((text, "") if beside < i else ("", text))
        level = [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def _brute(rows):
    """{(group, key, leaf): (subroot, root, steps)} of rows (group, key, leaf)."""
    groups = {}
    for group, key, leaf in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g]), *_tree([x[2] for x in sorted(groups[g])])) for g in order}
    root, upper = _tree([trees[g][1] for g in order])
    out = {}
    for g, above in zip(order, upper):
        members, subroot, paths = trees[g]
        for (known, key, leaf), path in zip(members, paths):
            out.setdefault((g, key if known else None, leaf), []).append((subroot, root, path + above))
    return out


def _random_rows(sizes):
    dice = random.Random(3)
    rows = [(g, dice.choice([None, *range(n)]) if n > 3 else i, _h(g or "", str(i % 7))) for g, n in sizes.items() for i in range(n)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16, "b": 17, "": 1}, {None: 5, "": 33, "é": 2, "z": 3, "日": 257, **{f"g{i}": 1 for i in range(20)}},
])
def test_trees_are_those_built_by_hand(spark, sizes):
    rows = _random_rows(sizes)
    table = spark.createDataFrame(rows, "lang string, doc_id long, digest string")
    made = merkle.manifest(table, F.col("lang"), F.col("doc_id"), F.col("digest"), lang=F.col("lang"))
    got = {}
    for r in merkle.verified(made, "leaf").collect():
        assert r.verified and r.folded_root == r.root
        got.setdefault((r.lang, r.key, r.leaf), []).append((r.subroot, r.root, [(s.left, s.right) for s in r.steps]))
    want = _brute(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_a_changed_row_is_found(spark, tmp_path):
    docs = [(i, None if i % 3 else "s", ["en", None, "de"][i % 3], None if i % 4 == 0 else 2**63 - 1 - i % 2, None if i % 5 == 0 else "té" * i, "x") for i in range(50)]
    docs += docs[:3] + [(None, "s", "en", 1, "no key", "y")]
    table = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string, root string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    rows = merkle.query(spark, str(tmp_path)).collect()
    want = _brute([(d[2], d[0], _leaf(d[0], d[1], d[2], d[3], d[4])) for d in docs])
    assert len(rows) == len(docs)
    by_id = {d[0]: d for d in docs}
    for r in rows:
        import zlib

        d = by_id[r.doc_id]
        subroot, root, path = next(x for x in want[(d[2], r.doc_id, r.leaf)] if _h(*[a + b for a, b in x[2]]) == r.proof_sha256)
        touched = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and d[3] is not None and d[3] < 2**63 - 1
        node = _leaf(d[0], d[1], d[2], d[3] + touched, d[4]) if touched else r.leaf
        for left, right in path:
            node = _h(left, node, right)
        assert (r.subroot, r.root, r.folded_root, r.verified) == (subroot, root, node, not touched)
    assert any(not r.verified for r in rows)


def test_an_empty_table(spark):
    table = spark.createDataFrame([], "lang string, doc_id long, digest string")
    assert merkle.manifest(table, F.col("lang"), F.col("doc_id"), F.col("digest")).count() == 0
