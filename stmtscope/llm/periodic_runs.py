"""Runs of repeated word sequences (every maximal stretch with a period), exactly.

A run of smallest period q holds at least three periods.  Short periods are found by direct
scans: lag q, equal words, long enough stretches.  Longer ones fall into scales, each for the
periods from ``low`` to ``high = 1.5 * low``.  At a scale, the word sequences of ``high`` words are
hashed and the minima of all windows of ``2 * low - high + 1`` of them kept.  In a run, a sequence
that is at least as long as the period repeats at multiples of the period only, and the windows
that hold a minimum are repeated one period on; so two neighbouring equal minima stand
exactly q apart.  Each such pair is extended to both sides by comparing words, so hashes
only propose and never decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.token_counts import text_slices
from stmtscope.llm.words import mix

MIN_LENGTH = 24
REPEATS = 3  # periods in a run, at least
DIRECT = 16  # longest period found by a scan of its own
RUNS_TYPE = "array<struct<start:long, length:long, period:long>>"


def needed(period: int) -> int:
    """Least length of a run."""
    return max(MIN_LENGTH, REPEATS * period)


def direct_runs(words: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Begin and end of each stretch of period ``lag`` that is long enough."""
    same = np.zeros(len(words) - lag + 2, np.int8)
    same[1:-1] = words[lag:] == words[:-lag]
    edges = np.flatnonzero(np.diff(same))
    begins, ends = edges[::2], edges[1::2] + lag
    for i in np.flatnonzero(ends - begins >= needed(lag)).tolist():
        yield int(begins[i]), int(ends[i])


def folded(values: np.ndarray, width: int, smaller) -> np.ndarray:
    """``smaller`` (minimum or maximum) of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = smaller(values[:-size], values[size:])
        size *= 2
    return smaller(values[: len(values) - width + size], values[width - size :]) if size < width else values


class SequenceHashes:
    """Hashes of all word sequences of a length; lengths are asked for in growing order."""

    def __init__(self, words: np.ndarray):
        self.size, self.hash = 1, mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))

    @staticmethod
    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mix(left * np.uint64(0xD1B54A32D192ED03) + (right ^ (right >> np.uint64(29))))

    def of(self, length: int) -> np.ndarray:
        while 2 * self.size <= length:
            self.hash = self.joined(self.hash[: -self.size], self.hash[self.size :])
            self.size *= 2
        rest = length - self.size
        return self.joined(self.hash[:-rest], self.hash[rest:]) if rest else self.hash


def seeds(hashes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring equal window minima ``low`` to ``high`` apart: lag and position, ordered."""
    window = 2 * low - high + 1
    minima = folded(hashes, window, np.minimum)
    # A hash is a minimum if the largest of the minima of its windows is the hash itself.
    edge = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(folded(np.concatenate([edge, minima, edge]), window, np.maximum) == hashes)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    lag = np.diff(at)
    pair = (hashes[at[1:]] == hashes[at[:-1]]) & (lag >= low) & (lag <= high)
    lag, at = lag[pair], at[:-1][pair]
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def equal_length(left: np.ndarray, right: np.ndarray) -> int:
    """Leading words in which the two agree."""
    n, done, step = min(len(left), len(right)), 0, 64
    while done < n:
        differ = np.flatnonzero(left[done : min(done + step, n)] != right[done : min(done + step, n)])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, 2 * step
    return n


def stretch(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """Begin and end of the longest stretch around ``at`` with period ``lag``."""
    after = equal_length(words[at:], words[at + lag :])
    before = equal_length(words[:at][::-1], words[: at + lag][::-1])
    return at - before, at + after + lag


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a sequence of word numbers: (start, length, smallest period), ordered."""
    n = len(words)
    longest = n // REPEATS
    found: dict[tuple[int, int], int] = {}  # a stretch's smallest period

    def add(begin: int, end: int, lag: int) -> None:
        if end - begin >= needed(lag):
            found[begin, end] = min(lag, found.get((begin, end), lag))

    if n >= MIN_LENGTH:
        for lag in range(1, min(DIRECT, longest) + 1):
            for begin, end in direct_runs(words, lag):
                add(begin, end, lag)
    low = DIRECT + 1
    if longest >= low:
        hashes = SequenceHashes(words)
        # A run of a longer period repeats a sequence of that many words.
        ordered = np.sort(hashes.of(low))
        if not (ordered[1:] == ordered[:-1]).any():
            low = longest + 1
    while low <= longest:
        high = min(low + low // 2, longest)
        lags, places = seeds(hashes.of(high), low, high)
        for lag in np.unique(lags).tolist():
            at = places[np.searchsorted(lags, lag) : np.searchsorted(lags, lag, "right")]
            i = 0
            while i < len(at):
                begin, end = stretch(words, int(at[i]), lag)
                add(begin, end, lag)
                i = max(i + 1, int(np.searchsorted(at, end - lag)))
        low = high + 1
    return sorted((begin, end - begin, lag) for (begin, end), lag in found.items())


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period of every run, ordered by start,
    then period) and ``collapsed``, the text's words joined by spaces without those that a run
    holds after its first period.

    Words are runs of characters other than space and 0x09-0x0D.  A null or empty text has no
    words, no runs and an empty collapsed text.  Rows are handled alone, so repeated rows and
    ids give repeated results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                sizes, counts, flat, texts = [], [], [], []
                for text in part.column("text").to_pylist():
                    words = text.encode().split() if text else []
                    number = dict(zip(words, range(len(words))))
                    runs = runs_of(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                    sizes.append(len(words))
                    counts.append(len(runs))
                    flat.extend(runs)
                    if runs:
                        kept = np.ones(len(words), bool)
                        for start, length, period in runs:
                            kept[start + period : start + length] = False
                        words = [words[i] for i in np.flatnonzero(kept).tolist()]
                    texts.append(b" ".join(words).decode())
                columns = np.array(flat, np.int64).reshape(-1, 3).T
                rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
                first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(first), rows), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS_TYPE}, collapsed string")
