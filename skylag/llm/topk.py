"""Exact top-k search by term-at-a-time accumulation.

A vector is a sparse row of integer weights. Candidates are packed into blocks, in
which each dimension has a posting list: the rows with a weight there, and the
weights. A block of query rows is answered against a block of candidates term by
term: the query weights of a dimension, times its postings, are added into dense
score arrays. Each query then selects its best of the block by partition, and the
bests of all blocks are merged.

Every stated query meets every block of candidates. Blocks have bounded sizes and are
dealt over a grid of cells: a query block goes to all cells of one row, a block of
candidates to all cells of one column. A cell is one unit of work: it holds its query
blocks, reads its candidates one block after the other, and gives the bests of each
query once. Neither side is broadcast or collected. The number of cells follows the
cores, not the blocks, so what is shuffled grows with the vectors; it grows with the
blocks only where a row's queries would exceed ``TILE_BYTES``.

Defined cases: vectors that are null, empty or hold null or non-finite components
take no part; shorter vectors have no weight in the dimensions they lack; rows that
share a query's vec_id are not its candidates; repeated candidate rows count one by
one, repeated query rows are answered together, once; an empty table gives an empty
one. Columns other than vec_id and embedding play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.llm.common import materialise, table

K = 20
SCALE = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
STRIPE = 256
# Cells of the grid for each core.
CELLS = 4
# Queries, and what is best for them so far, that a cell may hold.
TILE_BYTES = 64_000_000
FOUND_BYTES = 24


_BLOCK = pa.schema([("kind", pa.string()), ("ids", pa.binary()), ("weights", pa.binary())])


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks (block, kind, ids, weights): up to ``rows`` vectors as one matrix of whole
    numbers of that kind, in the order of their ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []

        def block() -> pa.RecordBatch:
            wide = max(map(len, held))
            weights = np.zeros((len(held), wide), dtype="<i8")
            for row, vector in zip(weights, held, strict=True):
                row[: len(vector)] = vector
            order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
            kind = next(t for t in ("<i2", "<i4", "<i8") if abs(weights).max(initial=0) <= np.iinfo(t).max)
            row = {"kind": kind, "ids": np.array(ids, dtype="<i8")[order].tobytes(), "weights": weights[order].astype(kind).tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        for batch in batches:
            ids_of, vectors_of = batch.column(0).to_pylist(), batch.column(1)
            for vec_id, vector in zip(ids_of, vectors_of, strict=True):
                ids.append(vec_id)
                held.append(vector.values.to_numpy(zero_copy_only=False))
                if len(ids) >= rows:
                    yield block()
                    ids, held = [], []
        if ids:
            yield block()

    packed = vectors.mapInArrow(pack, "kind string, ids binary, weights binary")
    return materialise(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _matrix(kind: str, ids: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, "<i8")
    return numbers, np.frombuffer(weights, kind).reshape(len(numbers), -1)


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products (queries x candidates), term at a time over the postings.

    Scores are kept as single-precision numbers where every sum is exact in these,
    as longs elsewhere, in stripes that stay in a core's cache.
    """
    wide = min(queries.shape[1], candidates.shape[1])
    top = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(candidates.astype(float)).max(initial=0)) * wide
    kind = np.float32 if top < 2**24 else np.int64
    terms = queries[:, :wide].astype(kind)
    columns = np.ascontiguousarray(candidates[:, :wide].T.astype(kind))
    out = np.zeros((len(queries), len(candidates)), dtype=kind)
    for low in range(0, len(candidates), STRIPE):
        postings = []
        for term in range(wide):
            weights = columns[term, low : low + STRIPE]
            rows = np.flatnonzero(weights)
            # A posting for most rows is scattered as the whole column.
            postings.append((slice(None), weights) if 2 * len(rows) > len(weights) else (rows, weights[rows]))
        for first in range(0, len(queries), STRIPE):
            of = terms[first : first + STRIPE]
            scores = np.zeros((len(of), min(STRIPE, len(candidates) - low)), dtype=kind)
            added = np.empty_like(scores)
            for term, (rows, weights) in enumerate(postings):
                if isinstance(rows, slice):
                    np.multiply(of[:, term, None], weights, out=added)
                    scores += added
                elif len(rows):
                    scores[:, rows] += of[:, term, None] * weights
            out[first : first + STRIPE, low : low + STRIPE] = scores
    return out


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows, ties to smaller ids; ``ids`` is sorted. Rows
    below ``least`` are known not to be among them."""
    left, right = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
    if left < right:
        scores, ids = np.delete(scores, slice(left, right)), np.delete(ids, slice(left, right))
    if least is not None:
        keep = np.flatnonzero(scores >= least)
        scores, ids = scores[keep], ids[keep]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order].astype(np.int64)


class _Asked:
    """A query block of a cell, and the best candidates met so far."""

    def __init__(self, kind: str, ids: bytes, weights: bytes, k: int):
        self.ids, self.terms = _matrix(kind, ids, weights)
        self.k = k
        none = np.empty(0, dtype=np.int64)
        self.best = [(none, none)] * len(self.ids)

    def meet(self, ids: np.ndarray, weights: np.ndarray) -> None:
        for at, (own, scores) in enumerate(zip(self.ids.tolist(), _scores(self.terms, weights), strict=True)):
            known = self.best[at]
            least = known[1][-1] if len(known[1]) == self.k else None
            new = _best(scores, ids, own, self.k, least)
            if len(new[0]):
                both = [np.concatenate(pair) for pair in zip(known, new, strict=True)]
                order = np.lexsort((both[0], -both[1]))[: self.k]
                self.best[at] = both[0][order], both[1][order]

    def found(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.best]
        columns = np.repeat(self.ids, counts), *(np.concatenate(c) for c in zip(*self.best, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def integer_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of every vector that takes part."""
    whole = vectors.where("embedding is not null and size(embedding) > 0 and vec_id is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    weights = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return whole.where(~bad).select(F.col("vec_id").cast("long").alias("vec_id"), weights.alias("weights"))


def _sizes(blocks: DataFrame) -> tuple[int, int, int, int]:
    """Blocks, their rows, their bytes, and the bytes of the largest."""
    row = blocks.agg(
        F.count("*"), F.sum(F.length("ids") / 8), F.sum(F.length("weights").cast("long")), F.max(F.length("weights"))
    ).first()
    return tuple(int(n or 0) for n in row)


def _grid(asked: tuple[int, int, int, int], held: tuple[int, int, int, int], k: int, cells: int) -> tuple[int, int]:
    """Rows and columns of the grid: about ``cells``, of the shape that moves the least.

    A further column moves all queries, and what is found for them, once more; a further
    row moves all candidates once more. A row has no more queries than a cell may hold.
    """
    blocks, number, size, largest = asked
    found = k * FOUND_BYTES
    column, row = size + number * found, max(1, held[2])
    fit = max(1, TILE_BYTES // max(1, largest + QUERY_ROWS * found))
    rows = max(math.ceil(blocks / fit), round(math.sqrt(cells * column / row)))
    columns = math.ceil(cells / max(1, rows))
    columns = max(1, min(held[0], columns))
    rows = max(rows, math.ceil(cells / columns))
    return max(1, min(blocks, rows)), columns


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query.

    Both sides are (vec_id, weights).
    """
    asked, held = _packed(queries, QUERY_ROWS), _packed(candidates, BLOCK_ROWS)
    rows, columns = _grid(_sizes(asked), _sizes(held), k, CELLS * asked.sparkSession.sparkContext.defaultParallelism)
    # Queries come before candidates in their cell.
    left = asked.select(
        F.pmod(F.xxhash64("block"), F.lit(rows)).alias("row"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"),
        F.lit(False).alias("candidates"), "kind", "ids", "weights",
    )
    right = held.select(
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"),
        F.pmod(F.xxhash64("block"), F.lit(columns)).alias("column"),
        F.lit(True).alias("candidates"), "kind", "ids", "weights",
    )
    cell = (F.col("row") * columns + F.col("column")).cast("int").alias("cell")
    dealt = left.unionByName(right).select(cell, "candidates", "kind", "ids", "weights")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked_here = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                cell, candidates, *block = (column[row].as_py() for column in batch.columns)
                if cell != at:
                    yield from (block.found() for block in asked_here)
                    at, asked_here = cell, []
                if not candidates:
                    asked_here.append(_Asked(*block, k))
                elif asked_here:
                    ids, weights = _matrix(*block)
                    for queries_of in asked_here:
                        queries_of.meet(ids, weights)
        yield from (block.found() for block in asked_here)

    cells = dealt.repartitionById(rows * columns, F.col("cell")).sortWithinPartitions("cell", "candidates")
    found = cells.mapInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_rows(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("vec_id % 20 = 0").dropDuplicates(["vec_id"]), vectors)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER o <= 20
"""
