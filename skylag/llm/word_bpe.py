"""BPE by a table of distinct words, for a tokenizer that drops white space.

Encoding. Tasks pack their documents into compressed chunks and deal these to
blocks of about ``block_chars`` characters: the only shuffle of texts. Each block
reports its distinct words; the words, shuffled by word and sorted, are encoded once
each, and codes and pieces go back to the blocks that asked for them. There the words of every
document, by position, are replaced by them. A common word is one row for each
block, however often it occurs. A word that does not come back is an error.

Decoding joins ids to the pieces of the vocabulary, whose size the tokenizer
bounds; a tokenizer file without a decoder joins pieces by one space, as the
library does. The ids of each distinct word are decoded by this join, once, where it
was encoded, and the decoded text of a document is that of its words. A join in Spark
would shuffle the ids of all words again; ``decode_documents`` is that join, for ids
that come from elsewhere.

Defined cases: a null text is an empty one and has no ids; strings of special
tokens inside a text are those tokens; repeated rows are encoded row by row; extra
columns are kept, those named n_tokens, ids or decoded are replaced; an empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.llm.common import table

BLOCK_CHARS = 16_000_000
CHUNK_CHARS = 1_000_000
# Words a task gathers before it packs them by block.
LINES_HELD = 500_000
# Runs between white space whose codes a task remembers, beside those of one text.
RUNS_HELD = 50_000

# Texts of these characters are split here; others by the library's own steps. Left
# out: separators that only Python takes for white space, and characters whose lower
# case is not one character of the same range.
_LAST = 0x233
_INSIDE = [chr(c) for c in range(_LAST + 1) if not 0x1C <= c <= 0x1F and len(chr(c).lower()) == 1 and ord(chr(c).lower()) <= _LAST]
_PLAIN = re.compile(f"[{re.escape(''.join(_INSIDE))}‐-‧‰-⁞€]*")
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ȳ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")


class Vocabulary:
    """Words of texts, ids of words and pieces of ids of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        steps = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_in = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = {i: piece for piece, i in pieces.items()}

    def plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def words(self, text: str) -> list[str]:
        """Words in order; a special token is the word of its own string."""
        if self.plain(text):
            return [w for run in text.lower().split() for w in _WORDS.findall(run)]
        found = []
        for part in self.special_in.split(text) if self.special_in else [text]:
            if part in self.special:
                found.append(part)
            elif part:
                part = self.tokenizer.normalizer.normalize_str(part)
                found += [w for w, _ in self.split.pre_tokenize_str(part)]
        return found

    def encode(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for piece, _ in self.to_bytes.pre_tokenize_str(word) for t in self.tokenizer.model.tokenize(piece)]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this Python worker, kept from task to task."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _packed(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, batches[0].schema, options=options) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _chunks(docs: DataFrame, blocks: int, chunk_chars: int) -> DataFrame:
    """Rows (block, payload): documents in compressed chunks, dealt to blocks."""
    place = docs.columns.index("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, part, number = [], 0, TaskContext.get().partitionId(), 0

        def chunk() -> pa.RecordBatch:
            block = zlib.crc32(f"{part}:{number}".encode()) % blocks
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([_packed(held)], pa.binary())], ["block", "payload"]
            )

        for batch in batches:
            start = 0
            for at, text in enumerate(batch.column(place).to_pylist(), 1):
                size += len(text or "") + 64
                if size >= chunk_chars:
                    held.append(batch.slice(start, at - start))
                    yield chunk()
                    held, size, number, start = [], 0, number + 1, at
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield chunk()

    # Not fewer partitions than other shuffles have: both sides of the grouping by
    # block then use this one, and its texts are shuffled once.
    parts = max(blocks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return docs.mapInArrow(pack, "block int, payload binary").repartition(parts, "block")


def _words_of_blocks(chunks: DataFrame, path: str, text_at: int) -> DataFrame:
    """Rows (block, word): the distinct words of each block."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        by_block: dict[int, tuple[set, set]] = {}
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                runs, others = by_block.setdefault(block, (set(), set()))
                for text in _unpacked(payload.as_py()).column(text_at).to_pylist():
                    if text:
                        if known.plain(text):
                            runs.update(text.lower().split())
                        else:
                            others.update(known.words(text))
        for block, (runs, others) in by_block.items():
            for run in runs:
                others.update(_WORDS.findall(run))
            found = list(others)
            for at in range(0, len(found), 50_000):
                some = found[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(some), pa.int32()), pa.array(some, pa.string())], ["block", "word"]
                )

    return chunks.mapInArrow(words, "block int, word string")


def words_for_blocks(words: DataFrame, path: str) -> DataFrame:
    """Rows (block, size, payload): of ``words`` (block, word), the lines word, codes and
    decoded of some words of a block, compressed; ``size`` before that. Codes are the ids
    of the word in decimal, decoded the pieces these are joined to, both by spaces.

    Rows of a word come together and one after another, so each distinct word of a
    batch is encoded and its ids joined to their pieces once.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, count, codec = vocabulary(path), {}, 0, pa.Codec("zstd", compression_level=6)
        # The vocabulary in the order of its ids: the join is by position.
        pieces = pa.array([known.pieces.get(i) for i in range(max(known.pieces) + 1)], pa.string())

        def lines() -> pa.RecordBatch:
            texts = ["\n".join(found).encode() for found in held.values()]
            packed = [codec.compress(text, asbytes=True) for text in texts]
            columns = [pa.array(list(held), pa.int32()), pa.array(map(len, texts), pa.int64()), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "size", "payload"])

        for batch in batches:
            runs = pc.run_end_encode(batch.column(1)) if batch.num_rows else None
            if runs is None:
                continue
            distinct = runs.values.to_pylist()
            found = pa.array(map(known.encode, distinct), pa.list_(pa.int32()))
            met = pa.ListArray.from_arrays(found.offsets, pieces.take(found.values))
            texts = [
                "\t".join(x)
                for x in zip(
                    distinct,
                    pc.binary_join(found.cast(pa.list_(pa.string())), " ").to_pylist(),
                    pc.binary_join(met, " ").to_pylist(),
                    strict=True,
                )
            ]
            blocks, start = batch.column(0).to_pylist(), 0
            for text, end in zip(texts, runs.run_ends.to_pylist(), strict=True):
                for block in blocks[start:end]:
                    held.setdefault(block, []).append(text)
                start = end
            count += batch.num_rows
            if count >= LINES_HELD:
                yield lines()
                held, count = {}, 0
        if held:
            yield lines()

    placed = words.repartition("word").sortWithinPartitions("word")
    return placed.mapInArrow(pack, "block int, size long, payload binary")


# What is made of a document: from its ids in decimal and its decoded text, both
# as bytes and joined by spaces, a value for each column of its schema.
Finish = tuple[T.StructType, Callable[[bytes, bytes], tuple]]


def ids_and_text(codes: bytes, decoded: bytes) -> tuple:
    ids = np.array(codes.split(), dtype=np.int32)
    return len(ids), ids, decoded.decode()


def digests(codes: bytes, decoded: bytes) -> tuple:
    count = codes.count(b" ") + 1 if codes else 0
    return count, hashlib.sha256(codes).hexdigest(), hashlib.sha256(decoded).hexdigest()


_COUNT = T.StructType().add("n_tokens", T.LongType())
IDS: Finish = (T.StructType([*_COUNT]).add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType()), ids_and_text)
DIGESTS: Finish = (T.StructType([*_COUNT]).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType()), digests)


def encode_documents(
    docs: DataFrame,
    path: str,
    finish: Finish = IDS,
    keep: list[str] | None = None,
    block_chars: int = BLOCK_CHARS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """``docs`` with n_tokens, ids and decoded text, or what ``finish`` makes of them.

    Of the columns of ``docs``, those in ``keep`` are returned, by default all.
    """
    made, make = finish
    docs = docs.select(*[c for c in docs.columns if c not in made.names])
    docs = docs.withColumn("text", F.col("text").cast("string"))
    text_at = docs.columns.index("text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = _chunks(docs, max(1, -(-chars // block_chars)), chunk_chars)
    codes = words_for_blocks(_words_of_blocks(chunks, path, text_at), path)
    kept = [c for c in docs.columns if keep is None or c in keep]
    schema = T.StructType([*docs.select(kept).schema.fields, *made.fields])
    kinds = [pa.int64() if f.dataType == T.LongType() else pa.string() if f.dataType == T.StringType() else pa.list_(pa.int32()) for f in made]

    def assemble(chunk_rows: pa.Table, code_rows: pa.Table) -> pa.Table:
        known = vocabulary(path)
        # Codes and decoded text of a word in one value, which takes less than two.
        of_word: dict[str, bytes] = {}
        for size, payload in zip(code_rows.column("size").to_pylist(), code_rows.column("payload"), strict=True):
            text = pa.decompress(payload.as_py(), size, codec="zstd", asbytes=True)
            for line in text.split(b"\n"):
                word, found = line.split(b"\t", 1)
                of_word[word.decode()] = found
        of_run: dict[str, tuple[bytes, bytes]] = {}

        def codes_of(words: list[str]) -> tuple[bytes, bytes]:
            found = [x for x in (of_word[w].split(b"\t") for w in words) if x[0]]
            return b" ".join([c for c, _ in found]), b" ".join([d for _, d in found])

        tables = []
        for payload in chunk_rows.column("payload"):
            table, made_rows = _unpacked(payload.as_py()), []
            for text in table.column(text_at).to_pylist():
                if not text:
                    made_rows.append(make(b"", b""))
                elif known.plain(text):
                    runs = text.lower().split()
                    if len(of_run) > RUNS_HELD:
                        of_run.clear()
                    for run in set(runs).difference(of_run):
                        of_run[run] = codes_of(_WORDS.findall(run))
                    found = [x for x in map(of_run.__getitem__, runs) if x[0]]
                    made_rows.append(make(b" ".join([c for c, _ in found]), b" ".join([d for _, d in found])))
                else:
                    made_rows.append(make(*codes_of(known.words(text))))
            table = table.select(kept)
            columns = list(zip(*made_rows, strict=True)) or [[] for _ in made]
            for field, kind, values in zip(made, kinds, columns, strict=True):
                table = table.append_column(field.name, pa.array(values, kind))
            tables.append(table)
        return pa.concat_tables(tables)

    return chunks.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(assemble, schema)


def pieces_table(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary as rows (id, piece)."""
    return spark.createDataFrame(sorted(vocabulary(path).pieces.items()), "id int, piece string")


def decode_documents(encoded: DataFrame, pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, decoded) from rows (key, ids) by a join of ids to pieces.

    Each distinct list of ids is decoded once. A key is expected once; a list of
    no ids, or null, decodes to an empty text.
    """
    rows = encoded.select(key, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    lists = rows.select("ids").distinct().select(F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("of"), "ids")
    placed = lists.select("of", F.posexplode("ids").alias("at", "id")).join(pieces, "id", "left")
    texts = placed.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    texts = texts.select("of", F.array_join(F.col("pieces.piece"), " ").alias("decoded"))
    keyed = rows.select(key, F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("of"))
    return keyed.join(texts, "of", "left").select(key, F.coalesce("decoded", F.lit("")).alias("decoded"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), DIGESTS, keep=["doc_id"])
