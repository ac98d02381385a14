"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct shingles of ``words`` words. Equal sets are
one node, named by their smallest doc_id, so that copies never meet in pairs. A
node's sketch has ``REGISTERS`` registers: the minimum of exponential variates of
its shingles, on a scale of powers of ``BASE``, cut to 16 bits. Registers of a
union are the larger of two; equal registers are as likely as sets are similar.

Bands of registers propose pairs. In a bucket each node is first held against one
centre, the node that meets most others. In buckets that still hold several
components, registers then rule out the pairs of different components that are
hopelessly far below the threshold, by their joint likelihood. Nodes left in a bucket
meet with their full sets, and each set is held against all others of other
components there. So every pair that shares a bucket is in one component already, or
was decided; only the links found leave a bucket, one for each two components.

At a similarity of exactly 0.8 a pair shares no bucket with a probability of
three in a million, at 0.85 of one in ten thousand million.

Defined cases: a null text or one without words is a node of its own that links
with nothing; fewer words than a shingle has are one shingle; rows that share a doc_id
are judged by their texts, each for itself, and are not linked by the id; a null
doc_id takes no part, has no component and is kept; an empty table gives an empty
one. Extra columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import materialise, table, unused, without
from skylag.llm.components import components

REGISTERS = 256
ROWS = 6
BANDS = REGISTERS // ROWS
BASE = 1.01
PERCENT = 80
# A pair is rejected by its registers where the threshold is less likely than the
# best estimate by more than this: odds of one in a million under the threshold.
HOPELESS = 12.0
# Equal registers below which a pair at the threshold is out of the question: six
# standard deviations.
FEWEST_EQUAL = 0.65
# Nodes of a bucket compared in one go; larger buckets are cut, and the cuts meet in pairs.
CUT = 4096
# Ids that are broadcast to pick their texts; above it they are joined by shuffle.
BROADCAST_IDS = 2_000_000

_RNG = np.random.default_rng(20240229)
_MULTIPLY = (_RNG.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWEST = 400  # what is added so that the largest minimum still has a register above 0


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``words`` words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    length = min(words, len(found))
    out = hashes[: len(hashes) - length + 1].copy()
    for k in range(1, length):
        out = (out ^ (out >> np.uint64(29))) * _MIX + hashes[k : len(hashes) - length + 1 + k]
    if length < words:
        out = out ^ np.uint64(length)
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return np.unique(out ^ (out >> np.uint64(29)))


def sketch(elements: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    low = elements.astype(np.uint32)[:, None]
    least = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 512):
        block = low[at : at + 512] * _MULTIPLY
        block += _ADD
        np.minimum(least, block.min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(_LOWEST + 1 - np.log(exponential) / math.log(BASE)), 0, 65535).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    bands = registers[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX, bands.shape[:2]).copy()
    for k in range(ROWS):
        out = (out ^ (out >> np.uint64(31)) ^ bands[:, :, k]) * _MIX
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def hopeful(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Rows whose registers do not rule out a similarity of ``percent``.

    The likelihood is joint in the counts of larger, smaller and equal registers,
    given the sizes of both sets.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - more - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.concatenate((np.linspace(0, 1, 101)[None, :] * top, np.minimum(percent / 100, top)), axis=1)

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = share(u - v * grid), share(v - u * grid)
    tiny = 1e-9
    likely = (
        more[:, None] * np.log(np.maximum(up, tiny))
        + less[:, None] * np.log(np.maximum(down, tiny))
        + equal[:, None] * np.log(np.maximum(1 - up - down, tiny))
    )
    best = grid[np.arange(len(grid)), likely.argmax(axis=1)]
    return (best >= percent / 100) | (likely.max(axis=1) - likely[:, -1] <= HOPELESS)


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, h, n_shingles, of, sketch): ``of`` names the set, null for an empty one,
    ``h`` the text among those of its doc_id."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sketches = [], [], []
            for text in batch.column(1).to_pylist():
                elements = shingles(text, words)
                sizes.append(len(elements))
                names.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                sketches.append(sketch(elements).tobytes() if len(elements) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "h", "n_shingles", "of", "sketch"],
            )

    return _texts(docs).mapInArrow(make, "doc_id long, h long, n_shingles long, of binary, sketch binary")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, band, n, node, size) of nodes that share a band with another one, n in all."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                if some.num_rows:
                    keys = band_keys(_registers(some.column(2)))
                    repeat = [np.repeat(some.column(c).to_numpy(zero_copy_only=False), BANDS) for c in (0, 1)]
                    band = np.tile(np.arange(BANDS, dtype=np.int32), some.num_rows)
                    columns = [pa.array(x) for x in (keys.ravel(), band, *repeat)]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "band", "node", "size"])

    rows = nodes.select("node", "size", "sketch").mapInArrow(bands, "bucket long, band int, node long, size long")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(shared, "bucket").select("bucket", "band", "n", "node", "size")


def _near_in_size(a: str, b: str, percent: int):
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _contents(buckets: DataFrame, nodes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """(node, size, sketch, text) of the nodes in shared buckets."""
    met = nodes.join(buckets.select("node").distinct(), "node", "left_semi")
    ids = materialise(met.select("doc_id", "h"), "bucket-nodes")
    few = ids.count() <= BROADCAST_IDS
    texts = _texts(docs).join(F.broadcast(ids) if few else ids, ["doc_id", "h"], "left_semi")
    texts = texts.dropDuplicates(["doc_id", "h"]) if repeated else texts
    return materialise(nodes.join(texts, ["doc_id", "h"]).select("node", "size", "sketch", "text"), "contents")


def _decide(pairs: DataFrame, contents: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are linked, by registers and then by full sets."""
    columns = ("size", "sketch", "text")
    sides = [contents.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", *[f"{c}_{s}" for c in columns for s in "ab"])

    def by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, np.zeros(0, dtype=np.uint64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (2, 3)]
                keep = hopeful(_registers(batch.column(4)), _registers(batch.column(5)), *sizes, percent)
                likely, keep = batch.filter(pa.array(keep)), []
                for text_a, text_b in zip(likely.column(6).to_pylist(), likely.column(7).to_pylist(), strict=True):
                    if text_b != last:
                        last, one = text_b, shingles(text_b, words)
                    other = shingles(text_a, words)
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    keep.append(100 * common >= percent * (len(one) + len(other) - common))
                yield likely.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(by_sets, "a long, b long")


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, each with its label."""
    named = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return named.join(spread.where("low < high").select("bucket"), "bucket", "left_semi")


def _with_centre(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): each node with one centre, that of its buckets which meets most nodes."""
    met = buckets.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = buckets.join(met, "node")
    first = F.struct((-F.col("met")).alias("rank"), F.col("node").alias("b"), F.col("size").alias("size_b"))
    centre = ranked.groupBy("bucket").agg(F.min(first).alias("c"))
    pairs = buckets.join(centre.select("bucket", "c.*"), "bucket").where("node <> b").where(_near_in_size("size", "size_b", percent))
    return pairs.groupBy(F.col("node").alias("a")).agg(F.min(F.struct("rank", "b")).alias("c")).select("a", "c.b")


CELL = ["bucket", "low", "high"]


def _cells(rows: DataFrame) -> DataFrame:
    """``rows`` of buckets as rows of cells: a cell for each pair of cuts of a bucket.
    Most buckets have one cut and one cell."""
    cuts = F.greatest(F.ceil(F.col("n") / CUT), F.lit(1)).cast("int")
    cut = rows.withColumn("cut", F.pmod(F.xxhash64("node"), cuts).cast("int"))
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    return other.withColumns({"low": F.least("cut", "other"), "high": F.greatest("cut", "other")}).drop("other")


def _each_cell(rows: DataFrame, make, schema: str) -> DataFrame:
    """``make`` of the columns of each cell, as numpy arrays, one cell at a time."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def made() -> pa.RecordBatch:
            cell = pa.Table.from_batches(held)
            return make({c: cell.column(c).to_numpy() for c in cell.column_names})

        for batch in batches:
            of = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(len(CELL))], axis=1)
            bounds = [0, *(np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1).tolist(), len(of)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                if low == high:
                    continue
                if held and tuple(of[low]) != now:
                    yield made()
                    held.clear()
                now = tuple(of[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield made()

    return rows.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(cells, schema)


def _likely_rows(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(cell, node, label, cut): of the rows of open buckets, those with a pair of different
    components that their registers do not rule out. A pair counts in the first band it shares."""

    def likely(cell: dict[str, np.ndarray]) -> pa.RecordBatch:
        size, label, cut = cell["size"], cell["label"], cell["cut"]
        registers = np.stack([np.frombuffer(x, np.uint16) for x in cell["sketch"]])
        bands = band_keys(registers)
        names, of = np.unique(label, return_inverse=True)
        order = np.lexsort((names, np.bincount(of))).argsort()[of]  # small components first
        across = cell["low"][0] != cell["high"][0]
        keep = np.zeros(len(size), dtype=bool)
        for x in np.flatnonzero(order < order.max()):
            fits = (order > order[x]) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            at = np.flatnonzero(fits & (cut != cut[x]) if across else fits)
            at = at[(bands[at] == bands[x]).argmax(axis=1) == cell["band"][0]]
            at = at[(registers[at] == registers[x]).sum(axis=1) >= FEWEST_EQUAL * REGISTERS]
            if len(at):
                own = np.broadcast_to(registers[x], (len(at), REGISTERS))
                at = at[hopeful(own, registers[at], np.full(len(at), float(size[x])), size[at].astype(float), percent)]
            keep[at] = True
            keep[x] |= len(at) > 0
        columns = [*CELL, "node", "label", "cut"]
        return pa.RecordBatch.from_arrays([pa.array(cell[c][keep]) for c in columns], columns)

    cells = _cells(rows).join(nodes.select("node", "sketch"), "node").select(*CELL, "band", "node", "size", "label", "cut", "sketch")
    return _each_cell(cells, likely, "bucket long, low int, high int, node long, label long, cut int")


def _links_of_cells(rows: DataFrame, contents: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links by full sets between nodes of different components of a cell, as many
    as tie these components together."""

    def links(cell: dict[str, np.ndarray]) -> pa.RecordBatch:
        sets = [shingles(text, words) for text in cell["text"]]
        node, cut, sizes = cell["node"], cell["cut"], np.array([len(x) for x in sets])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        _, of = np.unique(cell["label"], return_inverse=True)
        order = np.bincount(of).argsort(kind="stable").argsort()[of]
        across = cell["low"][0] != cell["high"][0]
        found = []
        in_x = np.zeros(len(codes) + 1, dtype=bool)
        # Each node against all others; those of the largest component have then met all.
        for x in np.flatnonzero(order < order.max()):
            apart = of != of[x]
            if across:
                apart &= cut != cut[x]
            if not apart.any():
                continue
            own = codes[starts[x] : starts[x] + sizes[x]]
            in_x[own] = True
            common = np.add.reduceat(in_x[codes].astype(np.int64), starts)
            in_x[own] = False
            for y in np.flatnonzero(apart & (100 * common >= percent * (sizes[x] + sizes - common))):
                if of[y] != of[x]:
                    found.append((node[x], node[y]))
                    of[of == of[y]] = of[x]  # tied from now on
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    cells = rows.join(contents.select("node", "text"), "node").select(*CELL, "node", "label", "cut", "text")
    return _each_cell(cells, links, "a long, b long")


def link_components(nodes: DataFrame, docs: DataFrame, words: int, percent: int, repeated: bool) -> DataFrame:
    """(node, label) of the nodes that are linked with another one. ``repeated`` tells that
    a row, doc_id and text, may be there more than once."""
    buckets = materialise(_buckets(nodes), "buckets")
    contents = _contents(buckets, nodes, docs, repeated)
    links = materialise(_decide(_with_centre(buckets, percent), contents, words, percent), "links")
    labels = materialise(components(links), "labels")
    likely = materialise(_likely_rows(_open(buckets, labels), nodes, percent), "likely-rows")
    found = materialise(_links_of_cells(likely, contents, words, percent), "links")
    return materialise(components(links.union(found)), "labels") if found.take(1) else labels


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, h, n_shingles, least, least_h) of every row: the smallest doc_id of its
    component and the text that stands for it; null for rows that take no part."""
    rows = materialise(sketched(docs, words), "sketches")
    sets = rows.where("doc_id is not null and of is not null")
    first = sets.groupBy("of").agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.min_by("n_shingles", "doc_id").alias("size"), F.min_by("sketch", "doc_id").alias("sketch")
    )
    # The table is written, so its numbers stay.
    numbered = first.select("of", "first.doc_id", "first.h", "size", "sketch", F.monotonically_increasing_id().alias("node"))
    nodes = materialise(numbered, "nodes")
    repeated = bool(sets.groupBy("doc_id", "h").count().where("count > 1").take(1))
    labels = link_components(nodes, docs, words, percent, repeated)
    named = nodes.select("of", "node", "doc_id", "h").join(labels, "node", "left")
    least = named.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "h")).alias("l"))
    of_set = named.join(least, "label", "left").select(
        "of", F.coalesce("l.doc_id", "doc_id").alias("least"), F.coalesce("l.h", "h").alias("least_h")
    )
    return rows.select("doc_id", "h", "n_shingles", "of").join(of_set, "of", "left").drop("of")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    found = _classes(docs, words, percent).select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; of
    rows that repeat a doc_id and a text one stays."""
    stands = F.col("least").isNull() | F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("least")) & (F.col("h") == F.col("least_h")))
    found = materialise(_classes(docs, words, percent).select("doc_id", "h", stands.alias("kept")), "components")
    keys = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    left = without(docs, found.where("not kept").select("doc_id", "h").distinct(), *keys)
    again = found.where("kept and doc_id is not null").groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h")
    again = materialise(again, "repeated-rows")
    if not again.take(1):
        return left
    few = again.count() <= BROADCAST_IDS
    names = [unused("key"), unused("key")]
    more = again.toDF(*names)
    once = left.withColumns(dict(zip(names, keys, strict=True))).join(F.broadcast(more) if few else more, names, "left_semi")
    return without(left, again, *keys).unionByName(once.dropDuplicates(names).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)
