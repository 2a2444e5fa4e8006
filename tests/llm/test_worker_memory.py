"""What a worker holds besides its rows stays small."""

import tracemalloc

import numpy as np
import pyarrow as pa

from stmtscope.llm import lm_score, near_dup, quality_vote, words

MB = 1 << 20


def batch():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}x{i % 7}" for i in range(5000)]
    texts = [" ".join(vocabulary[i] for i in rng.integers(0, 5000, 400)) for _ in range(2000)]
    n = pa.array(np.arange(len(texts)))
    return pa.RecordBatch.from_arrays([n, n, pa.array(texts)], names=["doc_id", "text_hash", "text"])


def peak(rows) -> float:
    tracemalloc.start()
    try:
        for _ in rows:
            pass
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def test_text_passes_hold_little_at_a_time():
    whole = batch()
    assert whole.column("text").nbytes > 4 * MB
    words._tables.clear()
    assert peak(near_dup._features(5)(iter([whole]))) < 48
    model = quality_vote.fit(np.zeros(0, np.int64), *[np.zeros(0, np.int64)] * 3, np.zeros(2))
    scored = (model.latent(len(p), *quality_vote.features(p, of)) for b, w in words.chunks(iter([whole])) for _, p, of in quality_vote.blocks(b, w))
    assert peak(scored) < 72


def test_counting_holds_little_at_a_time():
    words._tables.clear()
    assert peak(lm_score._count_words(iter([batch()]))) < 80
