"""Token codes: round trips, random access and the ids of the tokenizers library."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skylag.llm import token_codes as codes
from skylag.llm.common import on_workers

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=2000))
def test_any_token_is_read_by_rank(ids):
    ids = np.array(ids, dtype="<u4")
    segment = codes.Segment(**codes.pack(ids))
    assert (segment.all() == ids).all()
    places = np.arange(len(ids))[::-1]
    assert (segment.at(places) == ids[places]).all()


def test_ids_too_wide_for_the_levels_are_refused():
    with pytest.raises(ValueError, match="bits"):
        codes.pack(np.array([1 << 20]), widths=(8, 8))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab A'sreé1²\n\t .,-Σ\x1c\x85\xa0İ​日"), max_size=20))
def test_ids_are_those_of_the_library(text):
    one = codes.encoder(PATH)
    assert np.frombuffer(one(text), "<u4").tolist() == one.tokenizer.encode(text, add_special_tokens=False).ids


def test_documents_come_back_in_order(spark, tmp_path, library):
    on_workers(spark)
    texts = [(5, "five words  are here\n \nnow", "x"), (1, None, "y"), (3, "", "x"), (2, "the " * 30_000, "z"), (5, "twin", "x"), (None, "<|endoftext|> é", "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, codes string")
    codes.write_codes(docs, str(tmp_path / "codes"), PATH, segment_tokens=50)
    segments = codes.read_codes(spark, str(tmp_path / "codes"))
    got = sorted(codes.read_documents(segments).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 5, 5]
    want = {(i, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t, _ in texts}
    assert {(r.doc_id, tuple(r.ids)) for r in got} == want
    assert [r.start for r in got] == [sum(len(x.ids) for x in got[:n]) for n in range(len(got))]
    sums = {(r.start, r.ids_crc32) for r in codes.checksums(segments).collect()}
    assert sums == {(r.start, zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))) for r in got}
    stream = [i for r in got for i in r.ids]
    places = [0, 7, 29_000, len(stream) - 1, len(stream)]
    found = codes.tokens_at(segments, spark.createDataFrame([(p,) for p in places], "place long"), tile=64)
    assert {r.place: r.id for r in found.collect()} == {p: stream[p] for p in places[:-1]}


def test_no_documents_no_segments(spark, tmp_path):
    on_workers(spark)
    codes.write_codes(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), PATH)
    assert codes.checksums(codes.read_codes(spark, str(tmp_path / "none"))).count() == 0
