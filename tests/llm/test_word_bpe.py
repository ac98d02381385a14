"""BPE by distinct words against the tokenizers library."""

import hashlib
import random

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skylag.llm import word_bpe
from skylag.llm.common import on_workers

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab A'sreéßȺŸ1²\n\t .,-Σ\x1c\x85\xa0İ​日"), max_size=20))
def test_words_give_the_ids_of_the_library(text):
    known = word_bpe.vocabulary(PATH)
    ids = [i for word in known.words(text) for i in known.encode(word)]
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


def _same(texts):
    known = word_bpe.vocabulary(PATH)
    for at in range(0, len(texts), 10_000):
        some = texts[at : at + 10_000]
        for text, want in zip(some, LIBRARY.encode_batch(some, add_special_tokens=False)):
            assert [i for word in known.words(text) for i in known.encode(word)] == want.ids, repr(text)


def test_every_code_point_alone_and_beside_a_letter():
    points = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    _same([f"{c} a{c} {c}B" for c in points])


def test_random_strings():
    dice = random.Random(11)
    _same(["".join(chr(dice.choice((dice.randint(0, 0x24F), dice.randint(0x20, 0x7E)))) for _ in range(dice.randint(1, 12))) for _ in range(20_000)])
    _same(["AƁUJA Ɗan", "Saƙon Ɓera", "ƐYƐ"])


TEXTS = [
    (1, "Hello, the world's end", "a"), (2, None, "b"), (3, "", "c"), (4, "  \n ", "d"), (5, "<|endoftext|>Éa", "e"),
    (1, "Hello, the world's end", "a"), (6, "word other " * 20_000, "f"), (None, "日本 Σας 12", "g"),
]


def test_documents_are_encoded_and_decoded(spark):
    on_workers(spark)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, ids string")
    done = word_bpe.encode_documents(docs, PATH, block_chars=1000, chunk_chars=100)
    rows = done.collect()
    assert done.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"] and len(rows) == len(TEXTS)
    for row in rows:
        ids = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert (row.n_tokens, row.ids, row.decoded) == (len(ids), ids, LIBRARY.decode(ids, skip_special_tokens=False))
    once = done.where("doc_id > 1")
    joined = word_bpe.decode_documents(once, word_bpe.pieces_table(spark, PATH)).collect()
    assert {r.doc_id: r.decoded for r in joined} == {r.doc_id: r.decoded for r in once.collect()}


def test_digests_and_an_empty_table(spark):
    on_workers(spark)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, other string").drop("other")
    row = word_bpe.encode_documents(docs.where("doc_id = 5"), PATH, word_bpe.DIGESTS).first()
    ids = LIBRARY.encode(TEXTS[4][1], add_special_tokens=False).ids
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert word_bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_a_word_that_does_not_come_back_is_an_error(spark, monkeypatch):
    on_workers(spark)
    whole = word_bpe.words_for_blocks
    monkeypatch.setattr(word_bpe, "words_for_blocks", lambda words, path: whole(words.where("word <> 'world'"), path))
    docs = spark.createDataFrame(TEXTS[:1], "doc_id long, text string, other string")
    with pytest.raises(Exception, match="KeyError"):
        word_bpe.encode_documents(docs, PATH).collect()
