"""Preference pairs: prefixes, masks and odd conversations."""

from skylag.llm import preferences as p

T = "pair_id long, turn int, role string, text string"


def _made(spark, chosen, rejected):
    rows = p.preference_pairs(p.pair_tables(spark.createDataFrame(chosen, T), spark.createDataFrame(rejected, T))).collect()
    return {r.pair_id: r for r in rows}


def test_prompt_once_and_masks(spark):
    chosen = [(1, 0, "user", "hi é"), (1, 2, "assistant", "good"), (1, 1, "system", "s")]
    rejected = [(1, 0, "user", "hi é"), (1, 1, "system", "s"), (1, 2, "assistant", "bad <|im_end|>"), (1, 3, "user", "no")]
    row = _made(spark, chosen, rejected)[1]
    assert row.n_prompt_turns == 2
    assert row.prompt == "<|im_start|>user\nhi é<|im_end|>\n<|im_start|>system\ns<|im_end|>\n"
    assert row.chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    (span,) = row.chosen_mask
    assert row.chosen[span.start : span.end] == "good<|im_end|>"
    (span,) = row.rejected_mask
    assert row.rejected[span.start : span.end] == "bad <| im_end|><|im_end|>"
    assert row.rejected.endswith("<|im_start|>user\nno<|im_end|>\n")


def test_odd_conversations(spark):
    same = [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    chosen = [*same, (3, 0, None, None), (3, None, "user", "first"), (4, 0, "user", "x"), (5, 0, "user", "a"), (5, 0, "user", "a"), (None, 0, "user", "n"), (6, 0, "assistant", "y" * 200_000)]
    rejected = [*same, (3, 0, "", ""), (3, None, "user", "first"), (5, 0, "user", "a"), (6, 0, "assistant", "z"), (7, 0, "assistant", "only")]
    got = _made(spark, chosen, rejected)
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (2, "", "", [])
    assert got[3].n_prompt_turns == 2 and got[3].prompt.startswith("<|im_start|>user\nfirst")
    assert (got[4].prompt, got[4].rejected) == ("", "") and got[4].chosen
    assert got[5].n_prompt_turns == 1 and got[5].chosen and not got[5].rejected
    assert got[6].chosen_mask[0].end == 200_000 + len("<|im_start|>assistant\n<|im_end|>")
    assert got[7].chosen == "" and got[7].rejected_mask
    assert p.preference_pairs(p.pair_tables(*[spark.createDataFrame([], T)] * 2)).count() == 0


def test_replies_of_neighbours_are_swapped(spark):
    rows = [(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"), (1, 0, "assistant", "a1"), (2, 0, "user", "q2"), (4, 0, "assistant", "a4")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: ([t.text for t in r.chosen], [t.text for t in r.rejected]) for r in p.swapped_replies(turns).collect()}
    assert got == {0: (["q0", "a0", "bye"], ["q0", "a1", "bye"]), 1: (["a1"], ["a0"]), 2: (["q2"], ["q2"]), 4: (["a4"], [])}
