"""Merkle manifest of a data set: a digest of every row, one tree for each group.

Leaves have ranks in their group; a node is labelled with the interval of leaf ranks it
covers. A child lies in its parent's interval, and what the parent's interval has
beyond the child's is the sibling. A group's last node is its subroot; subroots
are the leaves of a second tree of the same kind, whose last node is the root.

Ranks come from one sort by ranges: a row's place in its range plus the rows of its
group in the ranges before, one number per range and group. Levels are dealt in bands of
``BAND``: nodes of a band that cover the same ``2 ** BAND`` nodes below lie in one
bucket, a row of at most ``2 ** (BAND + 1)`` labelled nodes. Buckets are built upwards
by grouped aggregation. Downwards a node joins the bucket its interval lies in, once a
band, takes its siblings there and adds the path its bucket has from the band above;
so only the lowest join has as many rows as there are leaves. Texts are read where
they lie: only digests are shuffled.

Defined cases: a null is ``-`` and differs from an empty text; rows without a key
come first in their group, a null group is a group of its own; rows of one key are
ordered by digest; a group of one row is its own subroot, and a single subroot is the
root; a count that cannot grow by one stays as it is; an empty table gives an empty
one. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.llm.common import materialise, table

BAND = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Steps of a proof, from the leaf up: what stands left and right of the node.
_STEPS = "array<struct<left:string,right:string>>"


def digest_of(fields: list[Column]) -> Column:
    """Hex digest of a row: each field as ``-`` or byte count, colon and value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """Digest of the tree's last node, from a leaf and the steps of its proof."""
    return F.aggregate(steps, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def proof_text(steps: Column) -> Column:
    """Siblings of a proof, one after another."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 in each group, and ``n``, the rows of the group.

    The place of a row is the last key, so equal rows do not share one range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    spread = rows.withColumn("_place", F.monotonically_increasing_id())
    parts = spread.repartitionByRange(*keys, "_place").sortWithinPartitions(*keys, "_place").drop("_place")
    # The number has the partition in its upper bits, the place in it below.
    parts = materialise(parts.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    parts = parts.withColumn("_part", F.shiftright("_at", 33))
    counts = parts.groupBy("_part", group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    in_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", group, "_first", before.alias("_before"), F.sum("_n").over(in_group).alias("n"))
    placed = parts.join(offsets, ["_part", group])
    return placed.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def _height(n: str | Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _labelled(digests: Column, level: int, step: int) -> Column:
    """Nodes of one level of a bucket, with their own and their parent's interval."""

    def node(digest: Column, i: Column) -> Column:
        at = F.shiftleft(F.col("block"), BAND - step) + i
        above = F.shiftright(at, 1)

        def bound(place: Column, bits: int) -> Column:
            return F.least(F.shiftleft(place, bits), F.col("n"))

        return F.struct(
            F.shiftleft(at, level).alias("lo"), bound(at + 1, level).alias("hi"),
            F.shiftleft(above, level + 1).alias("plo"), bound(above + 1, level + 1).alias("phi"), digest.alias("digest"),
        )

    return F.transform(digests, node)


def _paired(digests: Column) -> Column:
    """The level above: every two digests, and a last one alone, become their digest."""
    places = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / 2).cast("int"))
    return F.transform(places, lambda i: F.sha2(F.concat(F.get(digests, i * 2), F.coalesce(F.get(digests, i * 2 + 1), F.lit(""))), 256))


def _buckets(units: DataFrame, band: int) -> DataFrame:
    """Rows (g, n, block, nodes, top) of a band from its lowest nodes (g, n, at, digest)."""
    members = F.array_sort(F.collect_list(F.struct("at", "digest")))
    rows = units.groupBy("g", "n", F.shiftright("at", BAND).alias("block")).agg(members.alias("members"))
    rows = rows.withColumn("l0", F.col("members.digest")).withColumn("steps", F.least(F.lit(BAND), _height("n") - band * BAND))
    for step in range(BAND):
        rows = rows.withColumn(f"l{step + 1}", F.when(F.col("steps") > step, _paired(F.col(f"l{step}"))))
    none = _labelled(F.array().cast("array<string>"), 0, 0)
    labelled = [F.when(F.col("steps") > s, _labelled(F.col(f"l{s}"), band * BAND + s, s)).otherwise(none) for s in range(BAND)]
    tops = F.coalesce(*[F.get(F.col(f"l{s}"), F.lit(0)) for s in range(BAND, 0, -1)])
    return rows.select("g", "n", "block", F.concat(*labelled).alias("nodes"), tops.alias("top"))


def _siblings(lo: Column) -> Column:
    """Steps inside a bucket of the node whose interval starts at ``lo``."""

    def beside(s: Column) -> Column:
        covers = (s["lo"] <= lo) & (lo < s["hi"])
        alone = (s["plo"] == s["lo"]) & (s["phi"] == s["hi"])
        return (s["plo"] <= lo) & (lo < s["phi"]) & (~covers | alone)

    def step(s: Column) -> Column:
        left, right = F.when(s["hi"] <= lo, s["digest"]), F.when(s["lo"] > lo, s["digest"])
        return F.struct(F.coalesce(left, F.lit("")).alias("left"), F.coalesce(right, F.lit("")).alias("right"))

    return F.transform(F.filter("nodes", beside), step)


def proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Proofs and last nodes of the trees of ``leaves`` (g, rank, n, digest, ...).

    The first table is ``leaves`` with ``steps``, the second is (g, top), a row a group.
    """
    most = leaves.agg(F.max("n")).first()[0] or 1
    bands = -(-(most - 1).bit_length() // BAND)
    higher = [_height("n") > band * BAND for band in range(bands + 1)]
    units, buckets = leaves.select("g", "n", F.col("rank").alias("at"), "digest"), []
    tops = units.where("n = 1").select("g", F.col("digest").alias("top"))
    for band in range(bands):
        found = materialise(_buckets(units.where(higher[band]), band), "buckets")
        buckets.append(found)
        tops = tops.union(found.where(~higher[band + 1]).select("g", "top"))
        units = found.select("g", "n", F.col("block").alias("at"), F.col("top").alias("digest"))
    none = F.array().cast(_STEPS)
    above = None
    for band in range(bands - 1, -1, -1):
        held = buckets[band].select("g", "block", "nodes")
        if above is None:
            held = held.withColumn("upper", none)
        else:
            held = held.join(above.select("g", F.col("at").alias("block"), F.col("steps").alias("upper")), ["g", "block"], "left")
            held = held.withColumn("upper", F.coalesce("upper", none))
        if band:
            below = buckets[band - 1].where(higher[band]).select("g", F.col("block").alias("at"))
        else:
            below = leaves.withColumn("at", F.col("rank"))
        below = below.withColumn("block", F.shiftright("at", BAND))
        lo = F.shiftleft(F.col("at"), band * BAND)
        steps = F.concat(F.coalesce(_siblings(lo), none), F.coalesce("upper", none))
        above = below.join(held, ["g", "block"], "left").withColumn("steps", steps).drop("block", "nodes", "upper")
    return (leaves.withColumn("steps", none) if above is None else above.drop("at")), tops


def manifest(rows: DataFrame, group: Column, key: Column, digest: Column, **kept: Column) -> DataFrame:
    """(key, leaf, steps, subroot, root) of every row, and the columns ``kept``.

    ``steps`` lead from the leaf over the subroot to the root.
    """
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = rows.select(name.alias("g"), key.alias("key"), digest.alias("digest"), *[c.alias(n) for n, c in kept.items()])
    paths, tops = proofs(ranked(leaves, "g", ["key", "digest"]))
    groups = materialise(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("top").alias("digest")), "subroots")
    upper, roots = proofs(ranked(groups, "g", ["of"]))
    ends = upper.join(roots, "g").select(F.col("of").alias("g"), F.col("digest").alias("subroot"), F.col("top").alias("root"), F.col("steps").alias("_upper"))
    whole = paths.join(materialise(ends, "subroots"), "g").withColumn("steps", F.concat("steps", "_upper"))
    return whole.select("key", F.col("digest").alias("leaf"), "steps", "subroot", "root", *kept)


def verified(proven: DataFrame, claimed: str) -> DataFrame:
    """``proven`` with ``folded_root``, from the leaf that a row has in ``claimed``, and
    ``verified``, whether that is the root."""
    done = proven.withColumn("folded_root", folded(F.col(claimed), F.col("steps")))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in FIELDS]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n = F.col("n_chars")
    grown = [F.coalesce(F.try_add(n, F.lit(1).cast("long")), n) if c == "n_chars" else F.col(c) for c in FIELDS]
    leaf = digest_of(fields)
    claimed = F.when(touched, digest_of(grown)).otherwise(leaf)
    proven = verified(manifest(docs, F.col("lang"), F.col("doc_id"), leaf, claimed=claimed), "claimed")
    return proven.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"), "folded_root", "verified"
    )


ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, leaf, claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
      CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) ELSE leaf END AS claimed
    FROM docs
  )
), nodes AS (
  SELECT lang, 0 AS level, r AS i, n, leaf AS d FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (
  SELECT lang, level AS top, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
), uppers AS (
  SELECT 0 AS level, r AS i, n, subroot AS d FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM uppers WHERE n > 1 GROUP BY level, i // 2, n
), paths AS (
  SELECT leaf.doc_id, leaf.lang, leaf.r, node.level, CASE WHEN beside.i < node.i THEN beside.d ELSE '' END AS lft,
    CASE WHEN beside.i > node.i THEN beside.d ELSE '' END AS rgt
  FROM leaves leaf
  JOIN nodes node ON node.lang IS NOT DISTINCT FROM leaf.lang AND node.i = leaf.r >> node.level AND node.n > 1
  LEFT JOIN nodes beside ON beside.lang IS NOT DISTINCT FROM node.lang AND beside.level = node.level AND beside.i = xor(node.i, 1)
  UNION ALL
  SELECT leaf.doc_id, leaf.lang, leaf.r, s.top + node.level, CASE WHEN beside.i < node.i THEN beside.d ELSE '' END,
    CASE WHEN beside.i > node.i THEN beside.d ELSE '' END
  FROM leaves leaf JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaf.lang
  JOIN uppers node ON node.i = s.r >> node.level AND node.n > 1
  LEFT JOIN uppers beside ON beside.level = node.level AND beside.i = xor(node.i, 1)
), lists AS (
  SELECT lang, r, list({'l': coalesce(lft, ''), 'r': coalesce(rgt, '')} ORDER BY level) AS steps FROM paths GROUP BY lang, r
), folds AS (
  SELECT leaf.lang, leaf.r, leaf.claimed AS d, 1 AS k, coalesce(steps, []) AS steps
  FROM leaves leaf LEFT JOIN lists ON lists.lang IS NOT DISTINCT FROM leaf.lang AND lists.r = leaf.r
  UNION ALL
  SELECT lang, r, sha256(steps[k].l || d || steps[k].r), k + 1, steps FROM folds WHERE k <= len(steps)
), ends AS (
  SELECT lang, r, d, sha256(coalesce(list_aggregate(list_transform(steps, lambda s: s.l || s.r), 'string_agg', ''), '')) AS proof_sha256 FROM folds WHERE k = len(steps) + 1
)
SELECT leaf.doc_id, leaf.leaf, s.subroot, root.d AS root, e.proof_sha256, e.d AS folded_root, e.d = root.d AS verified
FROM leaves leaf JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaf.lang
JOIN ends e ON e.lang IS NOT DISTINCT FROM leaf.lang AND e.r = leaf.r
CROSS JOIN (SELECT d FROM uppers WHERE n = 1) root
"""
