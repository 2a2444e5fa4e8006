"""What the workers that decode are given."""

import os

import pytest

from stmtscope.llm import pieces


@pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary file")
def test_decoding_takes_spellings_only(spark, monkeypatch):
    taken = []
    real = pieces.share
    monkeypatch.setattr(pieces, "share", lambda session, value: (taken.append(value), real(session, value))[1])
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert found == {1: "the cat sat", 2: ""}
    assert isinstance(taken[0], pieces.Vocabulary) and isinstance(taken[1], list)
