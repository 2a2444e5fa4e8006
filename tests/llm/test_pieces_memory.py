"""A worker holds a few megabytes of text at a time, whatever the batch."""

from stmtscope.llm.pieces import MOST_PAIRS, text_chunks

MB = 1 << 20


def test_chunks_of_a_large_batch_are_small_and_cover_it():
    sizes = [MB // 4, 0, MB // 2, MB, 10] * 40
    chunks = list(text_chunks(sizes))
    assert [row for begin, end in chunks for row in range(begin, end)] == list(range(len(sizes)))
    assert max(sum(sizes[begin:end]) for begin, end in chunks) <= 5 * MB
    assert MOST_PAIRS * 130 <= 64 * MB  # bytes of a remembered pair
