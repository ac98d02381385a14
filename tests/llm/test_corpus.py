"""The pipeline against its stages by brute force."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from oracle import connect
from test_decontaminate import _brute
from test_near_dups import _groups
from test_secrets import _base


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_pipeline(spark, sf_dir, con):
    """Clean documents in known languages come through encoded; copies, benchmark passages and secrets do not."""
    docs = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    label = {i: x for i, (_, x) in _groups(docs, 5).items()}
    want = {i for i, text in docs if label[i] == i and not _brute(text, items)[1]}
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(rows) == want
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    for doc_id, text in docs:
        if doc_id in rows and not _base(text):
            assert rows[doc_id].ids == library.encode(text or "", add_special_tokens=False).ids
        elif doc_id in rows:
            assert "redacted" in "".join(rows[doc_id].decoded.split()).replace("</w>", "")


def test_documents_in_no_known_language_go(spark, sf_dir):
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    planted = ["Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5, "天地玄黄宇宙洪荒日月盈昃辰宿列张" * 10, "0123 4567 !!"]
    rows = spark.createDataFrame([(-1 - i, x) for i, x in enumerate(planted)], "doc_id long, text string")
    kept = corpus_pipeline.known_language(spark, docs.unionByName(rows, allowMissingColumns=True), sf_dir)
    assert kept.where("doc_id < 0").count() == 0 and kept.count() == docs.count()
