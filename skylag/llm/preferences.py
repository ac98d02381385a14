"""Preference pairs of conversations as training text.

The longest common prefix of turns of the chosen and the rejected conversation is
rendered once, as the prompt; what is left of either is its completion. A mask
lists the spans of a completion that are learnt: the texts of assistant turns with
their end mark, not the headers and not other roles' turns.

Only expressions and grouped aggregates are used. Turns meet once, by
conversation, in arrays that become the texts of one output row; everything else
happens inside the row.

Defined cases: turns are ordered by turn, then role, then text, repeated rows are
turns of their own; a null role or text is an empty one; null turns come first and
a null key is a conversation of its own; marks inside a text are broken up so that
they cannot open or close a turn; equal conversations have empty completions; a
pair with one side missing has an empty prompt and an empty completion there; an
empty table gives an empty one. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import table

# Marks of a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"

_TURNS = "array<struct<role:string,text:string>>"


def gathered(turns: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the turns (turn, role, text) of each conversation in order."""
    turn = F.struct("turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    lists = turns.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias(name))
    return lists.withColumn(name, F.transform(name, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit("\n"), _safe(turn["text"]), F.lit(f"{CLOSE}\n"))


def render(turns: Column) -> Column:
    """Text of an array of turns."""
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column) -> Column:
    """Spans (start, end) in code points of ``render(turns)`` that are learnt."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(_safe(turn["role"])) + len(OPEN) + 1
        end = start + F.length(_safe(turn["text"])) + len(CLOSE)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == LEARNT, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, add, lambda done: done["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x.eqNullSafe(y), F.lit(False)))
    differs = F.array_position(same, F.lit(False)).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(F.size(same))


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs``, with arrays of turns chosen and rejected, as n_prompt_turns, prompt,
    chosen, chosen_mask, rejected and rejected_mask beside its other columns."""
    none = F.array().cast(_TURNS)
    rows = pairs.withColumns({f"_{c}": F.coalesce(F.col(c), none) for c in ("chosen", "rejected")})
    rows = rows.withColumn("n_prompt_turns", common_turns(F.col("_chosen"), F.col("_rejected")))

    def rest(side: str) -> Column:
        turns = F.col(f"_{side}")
        return F.slice(turns, F.col("n_prompt_turns") + 1, F.size(turns))

    made = {"prompt": render(F.slice("_chosen", F.lit(1), F.col("n_prompt_turns")))}
    for side in ("chosen", "rejected"):
        made |= {side: render(rest(side)), f"{side}_mask": mask(rest(side))}
    return rows.withColumns(made).drop("_chosen", "_rejected")


def pair_tables(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Pairs (key, chosen, rejected) of two tables of turns (key, turn, role, text)."""
    return gathered(chosen, key, "chosen").join(gathered(rejected, key, "rejected"), key, "full")


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs (conv_id, chosen, rejected) of conversations without judged alternatives.

    Chosen is the conversation; in rejected its last assistant turn gives way to that
    of its neighbour, whose id differs in the last bit, or goes if there is none.
    """
    rows = gathered(conversations, "conv_id", "chosen")
    places = F.filter(F.sequence(F.lit(0), F.size("chosen") - 1), lambda i: F.get("chosen", i)["role"] == LEARNT)
    rows = rows.withColumn("at", F.array_max(places)).withColumn("reply", F.get("chosen", F.col("at"))["text"])
    replies = rows.where("conv_id is not null").select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("reply").alias("other"))
    rows = rows.join(replies, "conv_id", "left")
    other = F.when(F.col("other").isNotNull(), F.array(F.struct(F.lit(LEARNT).alias("role"), F.col("other").alias("text")))).otherwise(F.array().cast(_TURNS))
    swapped = F.concat(F.slice("chosen", F.lit(1), F.col("at")), other, F.slice("chosen", F.col("at") + 2, F.size("chosen")))
    return rows.select("conv_id", "chosen", F.when(F.col("at").isNull(), F.col("chosen")).otherwise(swapped).alias("rejected"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = preference_pairs(swapped_replies(turns))
    masks = {f"{side}_mask": _listed(f"{side}_mask") for side in ("chosen", "rejected")}
    return made.withColumns(masks).select("conv_id", "n_prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations
), lasts AS (
  SELECT conv_id, max(i) AS place, arg_max(text, i) AS reply FROM turns WHERE role = 'assistant' GROUP BY conv_id
), sides AS (
  SELECT conv_id, 'chosen' AS side, role, text, i FROM turns
  UNION ALL
  SELECT t.conv_id, 'rejected', t.role, CASE WHEN t.i = l.place THEN o.reply ELSE t.text END,
    t.i - CASE WHEN t.i > l.place AND o.reply IS NULL THEN 1 ELSE 0 END
  FROM turns t LEFT JOIN lasts l USING (conv_id) LEFT JOIN lasts o ON o.conv_id = xor(t.conv_id, 1)
  WHERE l.place IS NULL OR t.i <> l.place OR o.reply IS NOT NULL
), same AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.i, r.i) AS i,
    coalesce(c.role = r.role AND c.text = r.text, false) AS equal
  FROM (SELECT * FROM sides WHERE side = 'chosen') c
  FULL JOIN (SELECT * FROM sides WHERE side = 'rejected') r ON c.conv_id = r.conv_id AND c.i = r.i
), prefix AS (
  SELECT conv_id, CAST(coalesce(min(i) FILTER (NOT equal) - 1, max(i)) AS INTEGER) AS n FROM same GROUP BY conv_id
), shown AS (
  SELECT s.conv_id, side, i, n, role, length(replace(role, '<|im_', '<| im_')) + 13 AS head,
    '<|im_start|>' || replace(role, '<|im_', '<| im_') || chr(10) || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS shown
  FROM sides s JOIN prefix USING (conv_id)
), placed AS (
  SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, side, i > n ORDER BY i) - length(shown) AS place FROM shown
), texts AS (
  SELECT conv_id, any_value(n) AS n_prompt_turns,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'chosen' AND i <= n), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'chosen' AND i > n), '') AS chosen,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'rejected' AND i > n), '') AS rejected,
    coalesce(string_agg((place + head)::BIGINT || ':' || (place + length(shown) - 1)::BIGINT, ',' ORDER BY i)
      FILTER (side = 'chosen' AND i > n AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg((place + head)::BIGINT || ':' || (place + length(shown) - 1)::BIGINT, ',' ORDER BY i)
      FILTER (side = 'rejected' AND i > n AND role = 'assistant'), '') AS rejected_mask
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask FROM texts
"""
