"""Token counts at prefixes against the public library, which encodes every prefix."""

import random

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from stmtscope.llm import token_counts as tc

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    " leading, double  spaces and trailing ",
    "   ",
    "▁marks ▁▁ in▁text",
    "schön élan 日本語のテキスト 🙂🙂 \x00 \t\n tabs",
    "<s> </s> <unk> <0x41> [INST]",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa bbbbbbbbb 0000000000000 ----------",
    "naïvely re-establishing https://example.com/a?b=c&d=e",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=tc.model_path())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    alphabet = "aeinrst lo,.\n▁é日🙂0-" + " " * 4
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(60)]


def encoded(library, texts):
    return [len(x) for x in library.encode(texts, num_threads=1)]


def test_every_prefix(spark, library, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = {r.doc_id: r.counts for r in tc.prefix_counts(docs).collect()}
    for i, text in enumerate(texts):
        assert tables[i] == encoded(library, [text[:n] for n in range(len(text) + 1)]), repr(text)


def test_questions_by_columns_and_by_operator(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = tc.prefix_counts(docs)
    for limit in (0, 1, 5, 20):
        asked = table.select(
            "doc_id",
            tc.tokens_of_prefix(F.col("counts"), F.size("counts") - 1).cast("long").alias("n_tokens"),
            tc.longest_prefix(F.col("counts"), F.lit(limit)).alias("fitting_chars"),
        )
        told = tc.token_counts(docs, limit).select("doc_id", "n_tokens", "fitting_chars")
        want = sorted(told.collect())
        assert sorted(asked.collect()) == want
        for r in want:
            counts = [c.counts for c in table.where(F.col("doc_id") == r.doc_id).collect()][0] if r.doc_id < 3 else None
            if counts:
                assert r.fitting_chars == max(i for i, c in enumerate(counts) if c <= limit)


def test_given_documents(spark, library, sf_dir="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tc.token_counts(docs, 4096).collect()}
    ids = sorted(rows)
    assert got == dict(zip(ids, zip([len(rows[i].encode()) for i in ids], encoded(library, [rows[i] for i in ids]))))


def test_edges(edge_docs, no_docs, library):
    rows = edge_docs.collect()
    got = sorted(map(tuple, tc.token_counts(edge_docs, 10).drop("fitting_chars").collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in rows]
    assert got == sorted(want, key=str)
    assert tc.token_counts(no_docs, 10).count() == 0 and tc.prefix_counts(no_docs).count() == 0


def test_a_long_text_without_spaces(spark, library):
    text = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert tc.token_counts(docs, 10).first().n_tokens == len(library.encode(text))
