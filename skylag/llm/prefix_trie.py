"""Trie of conversations: a node for each distinct sequence of first turns.

Turns of a conversation stand in columns, one for each of ``BLOCK`` positions, and a
ROLLUP over the columns makes all prefixes of a block at once; grouping_id tells how
deep each is. Conversations longer than a block go on in further rows, keyed by the node
they reached: its key is a running sum, over the blocks before, of digests of their
turns and places, so the rows of all blocks are rolled up together and the number of
steps does not depend on the longest conversation. A second ROLLUP, over the nodes,
sums up subtrees; what lies below a block is added up first, each block giving its
sums to the blocks it goes on from.

The conversations that end at a node are digested in the order of their ids: ids lie
in lists of at most ``IDS`` consecutive ones, made by grouping, and a task folds the
lists of a node one after another, so no list of all of them is ever held.

Defined cases: turns are ordered by turn, nulls first, then role, then text, and
repeated rows are turns of their own; a null role or text is an empty one; rows without
conversation take no part; a conversation without turns ends at the root; an empty
table has no node, not even a root. A turn is named by 128 bits of a digest of role
and text, a node by 180. The turns of one conversation are numbered in one task, which
sorts them on disk; a conversation of b blocks gives b * b / 2 rows of sums. Other
columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.llm.common import materialise, table

BLOCK = 8
IDS = 4096

_T = [f"t{i}" for i in range(1, BLOCK + 1)]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn) with positions from 1; ``turn`` names role and text and
    ends in the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    name = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32)
    turn = F.concat(name, F.lit(":"), F.length("text").cast("string"))
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), turn.alias("turn"))


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n) of conversations with turns."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("n"))


def rebuilt(turns: DataFrame, base: Column, shared: Column) -> tuple[DataFrame, DataFrame]:
    """Lengths and turns of conversations whose first ``shared`` turns, less than a
    block, are those of the conversation ``base``, if there is one."""
    own = lengths(turns).withColumns({"base": base, "shared": shared})
    convs = own.join(lengths(turns).select(F.col("conv_id").alias("base"), F.col("n").alias("given")), "base", "left")
    convs = convs.withColumn("given", F.least("shared", F.coalesce("given", F.lit(0))))
    convs = materialise(convs.withColumn("n", F.col("given") + F.greatest(F.col("n") - F.col("shared"), F.lit(0))), "convs")
    heads = turns.where(F.col("pos") <= BLOCK).select(F.col("conv_id").alias("base"), "pos", "turn")
    heads = convs.select("conv_id", "base", "given").join(heads, "base").where("pos <= given").select("conv_id", "pos", "turn")
    rest = turns.join(convs.select("conv_id", "given", "shared"), "conv_id").where("pos > shared")
    rest = rest.select("conv_id", (F.col("pos") - F.col("shared") + F.col("given")).alias("pos"), "turn")
    return convs.select("conv_id", "n"), heads.union(rest)


def _rolled(rows: DataFrame, measures: str) -> DataFrame:
    """ROLLUP over the positions, in each block and under each key; ``g`` positions are
    given in a row."""
    turns = ", ".join(_T)
    text = f"SELECT block, key, {turns}, {BLOCK} - bit_count(grouping_id()) AS g, {measures} FROM {{rows}} GROUP BY block, key, ROLLUP ({turns})"
    made = rows.sparkSession.sql(text, rows=rows)
    last = F.when(F.col("g") > 0, F.get(F.array(*_T), F.col("g") - 1))
    # A conversation that ended before a position has no prefix of that length.
    return made.withColumn("last", last).where("g = 0 or last is not null")


def _parts() -> list[Column]:
    """Three numbers of 60 bits that stand for the turns of a block at its place."""
    digest = F.sha2(F.concat_ws(",", F.col("block").cast("string"), *_T), 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(3)]


def _key(sums: list[Column]) -> Column:
    return F.concat_ws(":", *[x.cast("decimal(38,0)").cast("string") for x in sums])


def _next_key() -> Column:
    """The key of the block that goes on from a full one."""
    old = F.split("key", ":")
    return _key([F.get(old, F.lit(i)).cast("decimal(38,0)") + part for i, part in enumerate(_parts())])


def _path(turns: list[Column], full: Column | None = None) -> Column:
    """The name of a node: block, key and turns; of a full block the next one's key."""
    name = F.concat_ws(",", F.col("block").cast("string"), F.col("key"), *turns)
    if full is not None:
        name = F.when(full, F.concat_ws(",", (F.col("block") + 1).cast("string"), _next_key())).otherwise(name)
    return F.sha2(name, 256)


def _rows(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, n, block, key, t1, ...): the blocks of conversations, one at least."""
    at = F.col("pos") - 1
    columns = [F.max(F.when(at % BLOCK == i, F.col("turn"))).alias(name) for i, name in enumerate(_T)]
    blocks = turns.groupBy("conv_id", F.floor(at / BLOCK).alias("block")).agg(*columns)
    rows = convs.join(blocks, "conv_id", "left").withColumn("block", F.coalesce("block", F.lit(0).cast("long")))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(part).over(before), F.lit(0)) for part in _parts()]
    return rows.withColumn("key", _key(sums))


def _nodes(rows: DataFrame) -> DataFrame:
    """Nodes of all blocks with what they add to the sums of their subtrees."""
    made = _rolled(rows, "min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS longest")
    depth = F.col("g") + F.col("block") * BLOCK
    chars = F.coalesce(F.substring_index("last", ":", -1).cast("long"), F.lit(0))
    leaf = (F.col("longest") == depth).cast("long")
    made = made.where("g > 0 or block = 0")
    return made.select("block", "key", *_T, "g", "conv_id", "n_convs", leaf.alias("leaves"), ((F.col("n_convs") - 1) * chars).alias("saved"))


def _below(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(block, key, leaves, saved, children) of each block but the first: the sums of all
    nodes below the node it goes on from, and how many children that node has."""
    own = nodes.where("block > 0").groupBy("block", "key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count_if(F.col("g") == 1).alias("children")
    )
    # One conversation of a block leads to all blocks it goes on from.
    way = rows.where("block > 0").select(F.col("conv_id").alias("of"), F.col("block").alias("up"), F.col("key").alias("up_key"))
    met = own.join(way, (F.col("of") == F.col("conv_id")) & (F.col("up") <= F.col("block")))
    children = F.max(F.when(F.col("up") == F.col("block"), F.col("children")))
    sums = met.groupBy("up", "up_key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), children.alias("children"))
    return sums.select((F.col("up") - 1).alias("block"), F.col("up_key").alias("next"), "leaves", "saved", "children")


def _totals(nodes: DataFrame, below: DataFrame) -> DataFrame:
    """Nodes with the sums of their subtrees and the number of their children."""
    more = below.select(F.col("block").alias("_block"), "next", *[F.col(c).alias(f"_{c}") for c in ("leaves", "saved", "children")])
    full = F.col("g") == BLOCK
    nodes = nodes.withColumn("_next", F.when(full, _next_key()))
    nodes = nodes.join(more, (F.col("_next") == F.col("next")) & (F.col("block") == F.col("_block")), "left")
    nodes = nodes.withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("leaves", "saved")})
    # Levels are named d here: inside the sums g would be that of the result.
    nodes = nodes.select("block", "key", *_T, F.col("g").alias("d"), "conv_id", "n_convs", "leaves", "saved", F.coalesce("_children", F.lit(0)).alias("children"))
    counts = ", ".join(f"count_if(d = {i}) AS c{i}" for i in range(1, BLOCK + 1))
    own = f"max(CASE WHEN d = {BLOCK} THEN children ELSE 0 END) AS c{BLOCK + 1}"
    made = _rolled(nodes, f"min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaves) AS leaves, sum(saved) AS saved, {counts}, {own}")
    children = F.get(F.array(*[f"c{i}" for i in range(1, BLOCK + 2)]), F.col("g"))
    made = made.where("g > 0 or block = 0")
    return made.select("block", "key", *_T, "g", "conv_id", "n_convs", "leaves", "saved", children.alias("children"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, digest) of rows (path, ids) that come path after path and in order."""
    last, digest, done = None, None, []
    schema = pa.schema([("path", pa.string()), ("ends_sha256", pa.string())])

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], schema=schema)

    for batch in batches:
        for path, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path == last:
                digest.update(b"," + ids.encode())
                continue
            if last is not None:
                done.append((last, digest.hexdigest()))
                if len(done) >= 10_000:
                    yield rows()
                    done.clear()
            last, digest = path, hashlib.sha256(ids.encode())
    if last is not None:
        done.append((last, digest.hexdigest()))
        yield rows()


def _ends(rows: DataFrame) -> DataFrame:
    """(path, ends_sha256) from the conversations (path, conv_id) that end at each path."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    lists = rows.groupBy("path", F.floor(F.col("conv_id") / IDS).alias("part")).agg(ids.alias("ids"))
    ordered = lists.repartition("path").sortWithinPartitions("path", "part").select("path", "ids")
    return ordered.mapInArrow(_folded, "path string, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of conversations ``convs`` (conv_id, n) with turns (conv_id, pos, turn)."""
    rows = materialise(_rows(convs, turns), "rows")
    nodes = materialise(_nodes(rows), "nodes")
    totals = _totals(nodes, materialise(_below(nodes, rows), "below"))
    above = [F.when(F.col("g") > i, F.col(t)) for i, t in enumerate(_T, 1)]
    names = [_path([F.col(t) for t in _T], F.col("g") == BLOCK).alias("path"), _path(above).alias("above")]
    depth = (F.col("g") + F.col("block") * BLOCK).cast("long")
    totals = totals.select(depth.alias("depth"), "conv_id", "n_convs", "leaves", "saved", "children", *names)
    totals = materialise(totals, "totals")
    # The root is the parent of many: its name goes to them as one number.
    least = convs.agg(F.min("conv_id").alias("least")).scalar()
    parents = totals.select(F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    inner = totals.where("depth > 1").join(parents, "above")
    outer = totals.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, least))
    last = rows.where(F.col("n") <= (F.col("block") + 1) * BLOCK)
    ends = last.select(_path([F.col(t) for t in _T], F.col("n") == (F.col("block") + 1) * BLOCK).alias("path"), "conv_id")
    return outer.unionByName(inner).join(_ends(ends), "path", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialise(numbered(table(spark, sf_dir, "conversations")), "turns")
    key = F.col("conv_id")
    return prefix_trie(*rebuilt(turns, key - key % 100, F.crc32(key.cast("string").cast("binary")) % 6))


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS id, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), joined AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.id, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.id, t.chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), lists AS (
  SELECT conv_id, coalesce(ids, []) AS ids, coalesce(lens, []) AS lens FROM convs
  LEFT JOIN (SELECT conv_id, list(id ORDER BY part, pos) AS ids, list(chars ORDER BY part, pos) AS lens FROM joined GROUP BY conv_id) USING (conv_id)
), prefixes AS (
  SELECT conv_id, d, ids[1:d] AS path, CASE WHEN d > 0 THEN lens[d] ELSE 0 END AS chars, d = len(ids) AS ends
  FROM lists, unnest(range(len(ids) + 1)) AS u(d)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf, (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
), sums AS (
  SELECT path[1:k] AS path, k AS d, count(*) FILTER (nodes.d = k + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM nodes, unnest(range(nodes.d + 1)) AS u(k) GROUP BY path[1:k], k
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path AND s.d = n.d LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""
