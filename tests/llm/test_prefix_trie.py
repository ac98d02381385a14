"""The trie against one built in Python."""

import hashlib
import random
import zlib

import pytest

from skylag.llm import prefix_trie
from skylag.llm.common import on_workers


def _brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, len(whole) == d))
    children = {p: 0 for p in members}
    leaves, saved = dict(children), dict(children)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, found in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(found) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, found in members.items():
        ends = ",".join(map(str, sorted(c for c, e in found if e)))
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in found), len(p), parent, len(found), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows(seed, count, longest):
    dice = random.Random(seed)
    rows = []
    for conv in range(count):
        conv = conv if conv % 11 else conv * 100
        rows += [(conv, t, dice.choice(["user", "", None]), dice.choice(["a", "bé", None, "long text " * 3])) for t in range(dice.randint(1, longest))]
    return rows


CASES = {
    "short": _rows(1, 60, 4),
    "long": _rows(2, 40, 30),
    "alike": [(c, t, "user", f"turn {t}") for c in range(120) for t in range(17 if c % 2 else 16)],
    "odd": [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (7, 3, "a", "b"), (100, 1, "ab", ""), (201, 1, "a", "b"), (1, 2, "a", "x" * 100_000)],
}


@pytest.mark.parametrize("case", CASES)
def test_nodes_are_those_of_a_trie(spark, case, tmp_path):
    on_workers(spark)
    table = spark.createDataFrame([(*r, "x", 1) for r in CASES[case]], "conv_id long, turn long, role string, text string, path string, n long")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    rows = prefix_trie.query(spark, str(tmp_path)).collect()
    got = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows]
    assert sorted(got, key=repr) == _brute(CASES[case])


def test_digests_fold_lists_in_order(spark, monkeypatch):
    on_workers(spark)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    ids = {"a": [-20, -3, 0, 9, 10, 11, 500], "b": [4]}
    table = spark.createDataFrame([(p, c) for p, cs in ids.items() for c in cs], "path string, conv_id long")
    want = {p: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest() for p, cs in ids.items()}
    assert {r.path: r.ends_sha256 for r in prefix_trie._ends(table).collect()} == want


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert prefix_trie.query(spark, str(tmp_path)).count() == 0
