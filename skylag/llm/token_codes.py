"""Token ids as directly addressable codes.

A token stream is stored in segments of whole documents. An id is cut into
chunks of ``widths`` bits, the lowest first. Level 0 holds the first chunk of every
token of the segment; a continuation bit per code says whether the token goes
on, and level k+1 holds the next chunk of just those that do. The place of a
token on the next level is the number of continuation bits set before it: a rank
directory keeps that number for every ``RANK_BITS`` bits, so any token is read
by two look-ups a level, without decoding what stands before it.

A written set is a Parquet table, one row per segment, sorted by document within
a file part. Parts follow each other in document order, so the start of a part is
the sum of the parts before it: one number per file part reaches the driver.

Defined cases: a null text is an empty one and holds the end id alone; documents
of the same id are ordered by a hash of their text, a null id comes first; an
empty table gives no segment. Columns other than doc_id and text are not stored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import table
from skylag.session import work_path

END_ID = 2
WIDTHS = (8, 8, 16)
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 18
WORDS_KEPT = 500_000

# Characters for which the splits below are those of the tokenizer: Latin letters
# and common punctuation. Other texts go through the tokenizer as a whole.
_PLAIN = re.compile("[\x00-ɏ‐-‧‰-⁞€]*")
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_PIECES = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# A space between two other white spaces belongs to a longer piece; any other
# space starts one, so that what stands between spaces can be encoded alone.
_INNER_SPACE = re.compile(f" (?<=[{_SPACE}] )[{_SPACE}]")




def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: its own where it
    prints, else the next of those from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) if b in prints else chr(256 + rest.index(b)) for b in range(256)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, by a byte-level BPE.

    Equal to encoding each text by the tokenizers library; what was encoded
    before, up to ``WORDS_KEPT`` words, is looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        pieces, found = self.pieces, []
        for piece in _PIECES.findall(word):
            codes = pieces.get(piece)
            if codes is None:
                merged = self.merge(piece.encode().decode("latin-1").translate(self.letters))
                codes = pieces[piece] = struct.pack(f"<{len(merged)}I", *[t.id for t in merged])
            found.append(codes)
        return b"".join(found)

    def __call__(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special) or _INNER_SPACE.search(text):
            return self._library(text)
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        if len(self.pieces) > WORDS_KEPT:
            self.pieces.clear()
        first, *rest = text.split(" ")
        words = self.words
        for word in set(rest).difference(words):
            words[word] = self._word(" " + word)
        return self._word(first) + b"".join(map(words.__getitem__, rest))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _chunk_type(bits: int) -> str:
    return "<u1" if bits <= 8 else "<u2" if bits <= 16 else "<u4"


def pack(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> dict[str, list[bytes]]:
    """Levels of one segment: codes, continuation bitmap and rank directory of each."""
    if sum(widths) < 32 and ids.size and int(ids.max()) >> sum(widths):
        raise ValueError(f"ids need more than {sum(widths)} bits")
    codes, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint64)
    for bits in widths:
        if not rest.size and codes:
            break
        codes.append((rest & ((1 << bits) - 1)).astype(_chunk_type(bits)).tobytes())
        more = (rest >> bits) > 0
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        blocks = np.add.reduceat(more, np.arange(0, more.size, RANK_BITS)) if more.size else np.zeros(0)
        ranks.append(np.concatenate(([0], np.cumsum(blocks)[:-1])).astype("<u4").tobytes() if more.size else b"")
        rest = rest[more] >> bits
    return {"codes": codes, "bitmaps": bitmaps, "ranks": ranks}


_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class Segment:
    """Random access to the tokens of one packed segment."""

    def __init__(self, codes, bitmaps, ranks, widths=WIDTHS):
        self.levels = [
            (np.frombuffer(c, _chunk_type(bits)), np.frombuffer(b, np.uint8), np.frombuffer(r, "<u4"), bits)
            for c, b, r, bits in zip(codes, bitmaps, ranks, widths, strict=False)
        ]

    def at(self, places: np.ndarray) -> np.ndarray:
        """Ids at these places, each found by rank alone."""
        out = np.zeros(places.size, dtype=np.uint32)
        where, place, shift = np.arange(places.size), places.astype(np.int64), 0
        for codes, bitmap, ranks, bits in self.levels:
            out[where] |= codes[place].astype(np.uint32) << shift
            goes_on = (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            where, place = where[goes_on], place[goes_on]
            if not place.size:
                break
            place = self._rank(bitmap, ranks, place)
            shift += bits
        return out

    @staticmethod
    def _rank(bitmap, ranks, place):
        """Bits set before each place: the directory's count and the bytes after it."""
        block, byte = place // RANK_BITS, place >> 3
        count = ranks[block].astype(np.int64)
        for k in range(RANK_BITS // 8):
            at = block * (RANK_BITS // 8) + k
            inside = at < byte
            if not inside.any():
                break
            count[inside] += _ONES[bitmap[at[inside]]]
        return count + _ONES[bitmap[byte] & ((1 << (place & 7)) - 1)]

    def all(self) -> np.ndarray:
        """All ids at once: the set bits of a level are the codes of the next."""
        out = np.zeros(self.levels[0][0].size, dtype=np.uint32)
        where, shift = np.arange(out.size), 0
        for codes, bitmap, _, bits in self.levels:
            out[where] |= codes.astype(np.uint32) << shift
            where = where[np.unpackbits(bitmap, count=where.size, bitorder="little").astype(bool)]
            shift += bits
        return out


_SEGMENT = pa.schema(
    [
        ("part", pa.int64()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("codes", pa.list_(pa.binary())),
        ("bitmaps", pa.list_(pa.binary())),
        ("ranks", pa.list_(pa.binary())),
    ]
)
_SEGMENT_DDL = (
    "part long, first long, n_tokens long, doc_ids array<long>, lengths array<long>,"
    " codes array<binary>, bitmaps array<binary>, ranks array<binary>"
)


def write_codes(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    widths: tuple[int, ...] = WIDTHS,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode the texts of ``docs`` and write them under ``path`` in doc_id order.

    One shuffle, of the texts, by ranges of (doc_id, hash of the text). A segment
    ends with the document that fills it, so a task holds one segment and one
    batch of texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids, held, size, first = [], [], 0, 0

        def segment() -> pa.RecordBatch:
            row = pack(np.frombuffer(b"".join(held), "<u4"), widths)
            row |= {"part": part, "first": first, "n_tokens": size, "doc_ids": doc_ids}
            row["lengths"] = [len(x) // 4 for x in held]
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                held.append((encode_text(text) if text else b"") + end)
                size += len(held[-1]) // 4
                if size >= segment_tokens:
                    yield segment()
                    doc_ids, held, size, first = [], [], 0, first + size
        if doc_ids:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(encode, _SEGMENT_DDL).write.option("compression", "uncompressed").parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """The segments under ``path`` with ``start``, the tokens of the set before each."""
    segments = spark.read.schema(_SEGMENT_DDL).parquet(path)
    sizes = sorted(segments.groupBy("part").agg(F.sum("n_tokens")).collect())  # one row per file part
    starts, before = [], 0
    for part, size in sizes:
        starts.append((part, before))
        before += size
    parts = F.broadcast(spark.createDataFrame(starts, "part long, before long"))
    return segments.join(parts, "part").withColumn("start", F.col("before") + F.col("first")).drop("before")


def read_documents(segments: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """doc_id, start, n_tokens and ids (array of int) of every document stored."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Segment(row["codes"], row["bitmaps"], row["ranks"], widths).all().astype(np.int64)
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                offsets = np.concatenate(([0], ends)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int64())),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return segments.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids array<long>")


def checksums(segments: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every document stored."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(Segment(row["codes"], row["bitmaps"], row["ranks"], widths).all().astype("<u4").tobytes())
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_at(segments: DataFrame, places: DataFrame, widths: tuple[int, ...] = WIDTHS, tile: int = SEGMENT_TOKENS) -> DataFrame:
    """``places`` (column ``place``, a token's number in the set) with the id there.

    A segment is found by the tiles of ``tile`` tokens that it touches, then each
    place in it by rank. Places outside the set are left out.
    """
    wanted = places.select(F.col("place").cast("long").alias("place")).withColumn("tile", F.floor(F.col("place") / tile))
    last = F.col("start") + F.col("n_tokens") - 1
    tiled = segments.withColumn("tile", F.explode(F.sequence(F.floor(F.col("start") / tile), F.floor(last / tile))))
    inside = (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n_tokens"))
    spans = tiled.select("tile", "start", "n_tokens")
    asked = wanted.join(spans, "tile").where(inside).groupBy("start").agg(F.collect_list("place").alias("places"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array(row["places"], dtype=np.int64)
                ids = Segment(row["codes"], row["bitmaps"], row["ranks"], widths).at(places - row["start"])
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(ids.astype(np.int64))], ["place", "id"])

    return segments.join(asked, "start").select("start", "codes", "bitmaps", "ranks", "places").mapInArrow(look, "place long, id long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_path(spark, "token-codes")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    write_codes(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(read_codes(spark, path))
