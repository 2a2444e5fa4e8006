"""Log-bilinear language model, trained by noise-contrastive estimation.

Words are counted over all training documents.  Every word with at least ``MIN_COUNT`` of
them has vectors of its own, so the modelled vocabulary grows with the corpus.  A word's
probability is a product of three softmaxes: its unit (the most frequent words are units of
their own, all others share a few by their last two bytes), its class inside the unit
(about the root of the unit's vocabulary; one more class has the words below the threshold),
and the word inside its class.  All three see the two words before by their own vectors,

    unit:         (x_a + y_b) . q_u + bias_u
    class, word:  f . q_w + bias_w,     f = bounded (x_a + y_b, s_b)

where x is A r and y is B r for a unit, plus what a word of its own has learned, and s_b
sums up which words follow b.  Words below the threshold have the history vector of their
unit, and their count plus one inside their class, with one more place for words never seen.

The unit model is fitted on the driver to the counts of all unit triples, against noise
drawn from the unit frequencies and summed exactly.  Then each word's vectors move from its
unit's (or class's): history vectors by Newton steps on the gradients that one pass over the
texts adds up per word, target vectors by one Newton step from a second such pass.  Features
are bounded and both kinds of vectors are drawn to their start values, so that words with
few tokens stay near them.

Texts are cut into words twice: to count them, and to write them as codes, which all later
passes read.  Each word's vectors are fitted in the task that owns its sums.

Held in memory are the triples (``UNITS ** 3``), a table of ``SLOTS`` word counts, in which
the more frequent of two words with equal slot stays, and the vocabulary with its vectors.
Counts of all other words reach the documents by a join; none of them is frequent.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import Scratch, share, shared_value
from stmtscope.llm.words import Words, chunks, mix

UNITS = 128
OWN_UNITS = 96  # of frequent words; the first is the end of a text
SHARED_UNITS = UNITS - OWN_UNITS
SLOTS = 1 << 18
SIZE = 16  # of the vectors
NOISE = 10  # noise samples per token
EPOCHS, RATE, HISTORIES = 40, 0.05, 2048  # histories in a training step
PASS_BYTES, PASS_TOKENS = 1 << 20, 1 << 18  # of text handled at once
MIN_COUNT = 32  # of a word with vectors of its own
HISTORY_PRIOR, TARGET_PRIOR = 30.0, 200.0  # tokens that a word's start values weigh as much as
NEWTON_STEPS, SETTLED = 6, 1e-5
DAMPING = 0.7  # of history vectors, since those of both words before are fitted at once
FEATURE_SIZE = 0.15  # of its spread: features are nearly signs
BLOCK = 1 << 18  # scores held at once, so that they stay near the processor
FEATURE_BLOCK = 1 << 13  # tokens whose hidden vectors are held at once
LEAST_SUM, MOST_SUM = 1e-20, 1e30  # between them a sum of exponentials lost nothing in single floats
MOST_COUNTED = 1_000_000  # distinct words that a task holds before it sends their counts
END = int(mix(np.array([0xE0F], np.uint64)).view(np.int64)[0])


def shared_unit(words: Words) -> np.ndarray:
    last = words.data[words.end - 1].astype(np.uint64)
    before = words.data[np.maximum(words.end - 2, words.start)].astype(np.uint64)
    return (mix(last * np.uint64(256) + before) % np.uint64(SHARED_UNITS)).astype(np.int16)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shared unit of each token, an end after each text; first token of each text."""
    n_texts = len(words.first) - 1
    is_end = np.zeros(len(words.hash) + n_texts, bool)
    is_end[words.first[1:] + np.arange(n_texts)] = True
    hashes = np.full(len(is_end), END, np.int64)
    hashes[~is_end] = words.hash.view(np.int64)
    units = np.zeros(len(is_end), np.int16)
    units[~is_end] = shared_unit(words)
    return hashes, units, words.first + np.arange(n_texts + 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words, each once as long as few words are held."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, units, n = (np.concatenate(x) for x in zip(*held))
        keys, at, spot = np.unique(keys, return_index=True, return_inverse=True)
        return keys, units[at], np.bincount(spot, n).astype(np.int64)

    def rows(counted: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(counted[0]), 1 << 17):
            columns = [pa.array(x[i : i + (1 << 17)]) for x in counted]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "unit", "n"])

    for _, words in chunks(batches, chunk_bytes=PASS_BYTES):
        hashes, units, _ = tokens(words)
        order = np.argsort(hashes)  # equal words have equal units, so any order of theirs will do
        hashes = hashes[order]
        at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        held.append((hashes[at], units[order[at]], np.diff(np.append(at, len(hashes)))))
        if sum(len(x[0]) for x in held) > MOST_COUNTED:
            held = [merged()]
            if len(held[0][0]) > MOST_COUNTED:
                yield from rows(held.pop())
    if held:
        yield from rows(merged())


@dataclass
class Lexicon:
    """Words with their counts, and what follows from the counts of all words."""

    word: np.ndarray
    count: np.ndarray
    unit: np.ndarray
    own: np.ndarray  # number of a word with vectors of its own, else -1
    place: np.ndarray  # index of a word by hash, the next free place after it; -1 is free
    n_tokens: int
    n_words: int
    unit_total: np.ndarray  # of a shared unit: tokens + words + 1; of the others: 1

    def codes(self, hashes: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Index of each token in the table; of a token outside it, -1 less its shared unit."""
        mask = len(self.place) - 1
        spot = hashes & mask
        at = self.place[spot]
        open_ = np.flatnonzero((at >= 0) & (self.word[at] != hashes))
        while len(open_):
            spot[open_] = (spot[open_] + 1) & mask
            at[open_] = self.place[spot[open_]]
            open_ = open_[(at[open_] >= 0) & (self.word[at[open_]] != hashes[open_])]
        return np.where(at >= 0, at, -1 - shared).astype(np.int32)

    def units_and_numbers(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit of each token, and its number if it has vectors of its own, else -1."""
        at = np.maximum(codes, -1)
        return np.where(codes >= 0, self.unit[at], OWN_UNITS - 1 - codes).astype(np.int64), self.own[at]

    def look_up(self, hashes: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether each token is in the table, its count (else 0), its unit and its number."""
        codes = self.codes(hashes, shared)
        return codes >= 0, self.count[np.maximum(codes, -1)], *self.units_and_numbers(codes)

    @property
    def vocabulary(self) -> np.ndarray:
        """Index of each word with vectors of its own, by number."""
        return np.flatnonzero(self.own >= 0)


def places(word: np.ndarray) -> np.ndarray:
    place = np.full(1 << max(4, (2 * len(word)).bit_length()), -1, np.int32)
    mask = len(place) - 1
    left, spot = np.arange(len(word), dtype=np.int32), word & mask
    while len(left):
        free = place[spot] < 0
        place[spot[free]] = left[free]  # of several words the last one stays
        out = place[spot] != left
        left, spot = left[out], (spot[out] + 1) & mask
    return place


def lexicon(counts: DataFrame) -> Lexicon:
    """From (word, unit, n); ``SLOTS`` rows, the vocabulary and sums per unit reach the driver."""
    slot = F.col("word").bitwiseAND(F.lit(SLOTS - 1))
    top = counts.groupBy(slot.alias("slot")).agg(F.max(F.struct("n", "word", "unit")).alias("x"))
    tables = [top.select("x.word", "x.n", "x.unit").toArrow(), counts.where(F.col("n") >= MIN_COUNT).select("word", "n", "unit").toArrow()]
    word, n, unit = (np.concatenate([t.column(c).to_numpy() for t in tables]) for c in ("word", "n", "unit"))
    word, at = np.unique(word, return_index=True)
    n, unit = n[at], unit[at]
    sums = counts.groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow()
    tokens_of, words_of = np.zeros(SHARED_UNITS), np.zeros(SHARED_UNITS)
    tokens_of[sums.column("unit").to_numpy()] = sums.column("n").to_numpy()
    words_of[sums.column("unit").to_numpy()] = sums.column("words").to_numpy()
    n_tokens, n_words = int(tokens_of.sum()), int(words_of.sum())

    own = np.lexsort((word, -n, word != END))[:OWN_UNITS]
    units = (OWN_UNITS + unit).astype(np.int16)
    units[own] = np.arange(len(own))
    np.subtract.at(tokens_of, unit[own], n[own])
    np.subtract.at(words_of, unit[own], 1)
    number = np.full(len(word), -1, np.int32)
    modelled = np.flatnonzero((n >= MIN_COUNT) & (units >= OWN_UNITS))
    number[modelled] = np.arange(len(modelled))
    # A last entry, so that index -1 of a word that is not there can be read.
    last = lambda x, value: np.append(x, np.array([value], x.dtype))
    table = Lexicon(last(word, 0), last(n, 0), last(units, 0), last(number, -1), places(word), n_tokens, n_words, np.ones(UNITS))
    table.unit_total[OWN_UNITS:] = tokens_of + words_of + 1
    return table


def histories(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of the two tokens before each token; before a text stands the end unit 0."""
    one, two = np.zeros_like(units), np.zeros_like(units)
    one[1:], two[2:] = units[:-1], units[:-2]
    begin = first[:-1]
    one[begin], two[begin] = 0, 0
    second = begin + 1
    two[second[second < first[1:]]] = 0
    return two, one


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Values of each text, the first of which are given, as bytes."""
    buffers = [None, pa.py_buffer((first * values.itemsize).astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, buffers).cast(pa.binary())


CODED = "row long, doc_id long, held_out boolean, codes binary, others binary"


def _code(shared):
    """Texts as codes of their tokens, and the hashes of those outside the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lexicon = shared_value(shared)
        for batch, words in chunks(batches, chunk_bytes=PASS_BYTES):
            hashes, units, first = tokens(words)
            codes = table.codes(hashes, units)
            outside = np.flatnonzero(codes < 0)
            columns = [_binary(codes, first), _binary(hashes[outside], np.searchsorted(outside, first))]
            kept = [batch.column(c) for c in ("row", "doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays(kept + columns, names=["row", "doc_id", "held_out", "codes", "others"])

    return run


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of coded texts with about ``PASS_TOKENS`` tokens (a longer text is a slice of its
    own), their codes, the hashes of tokens outside the table, and the first token of each text."""
    values = lambda a, kind: np.frombuffer(b"".join(a.to_pylist()), kind)
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("codes")).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + PASS_TOKENS, side="right")))
            piece = batch.slice(begin, end - begin)
            first = np.append(0, ends[begin:end] - done)
            yield piece, values(piece.column("codes"), np.int32), values(piece.column("others"), np.int64), first
            begin = end


def _count_triples(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lexicon = shared_value(shared)
        total = np.zeros(UNITS**3, np.int64)
        for _, codes, _, first in coded(batches):
            units, _ = table.units_and_numbers(codes)
            two, one = histories(units, first)
            total += np.bincount((two * UNITS + one) * UNITS + units, minlength=UNITS**3)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 17):
            part = at[i : i + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["triple", "n"])

    return run


def train(counts: np.ndarray) -> np.ndarray:
    """log10 probability of each unit after each history, from triple counts (two, one, unit)."""
    return (unit_scores(fit(counts)) / np.log(10)).astype(np.float32).ravel()


def unit_scores(p: dict[str, np.ndarray]) -> np.ndarray:
    """Log-probability of each unit (column) after each history (row)."""
    two, one = np.divmod(np.arange(UNITS * UNITS), UNITS)
    scores = (p["r"][two] @ p["a"] + p["r"][one] @ p["b"]) @ p["q"].T + p["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


def fit(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters of the unit model, from triple counts (two, one, unit).

    Full products over ``HISTORIES`` histories a step; Adam; the same result in each run."""
    counts = counts.reshape(UNITS * UNITS, UNITS).astype(np.float64)
    total = counts.sum()
    noise = (counts.sum(axis=0) + 1) / (total + UNITS)
    rng = np.random.default_rng(11)
    p = {
        "r": rng.normal(0, 0.1, (UNITS, SIZE)),
        "a": np.eye(SIZE) * 0.3,
        "b": np.eye(SIZE) * 0.7,
        "q": rng.normal(0, 0.1, (UNITS, SIZE)),
        "bias": np.log(noise),
    }
    if not total:  # nothing seen: all units alike
        p["q"][:] = 0
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    seen = counts.sum(axis=1)
    used = np.flatnonzero(seen)
    two, one = np.divmod(np.arange(UNITS * UNITS), UNITS)
    log_noise, step = np.log(NOISE * noise), 0
    # Histories of like weight are stepped through together, so that steps weigh alike.
    for epoch in range(EPOCHS if total else 0):
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 50
        order = rng.permutation(used)
        for i in range(0, len(order), HISTORIES):
            h = order[i : i + HISTORIES]
            hidden = p["r"][two[h]] @ p["a"] + p["r"][one[h]] @ p["b"]
            delta = hidden @ p["q"].T + p["bias"] - log_noise
            is_data = 1 / (1 + np.exp(-delta))
            n = counts[h]
            # Derivative of the sum of log sigmoid(delta) over data and log sigmoid(-delta) over noise.
            slope = n * (1 - is_data) - seen[h][:, None] * (NOISE * noise) * is_data
            slope /= n.sum()
            grad_hidden = slope @ p["q"]
            grad_r = np.zeros_like(p["r"])
            np.add.at(grad_r, two[h], grad_hidden @ p["a"].T)
            np.add.at(grad_r, one[h], grad_hidden @ p["b"].T)
            grads = {
                "r": grad_r,
                "a": p["r"][two[h]].T @ grad_hidden,
                "b": p["r"][one[h]].T @ grad_hidden,
                "q": slope.T @ hidden,
                "bias": slope.sum(axis=0),
            }
            step += 1
            for k, g in grads.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p[k] += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return p


class Sums:
    """Sums of float rows by a number below ``size``, of which a chunk has few."""

    def __init__(self, size: int, width: int):
        self.total = np.zeros((size, width), np.float32)
        self.seen = np.zeros(size, bool)
        self.short = np.zeros(size, np.int32)

    def add(self, numbers: np.ndarray, columns: Iterable[np.ndarray], begin: int = 0) -> None:
        here = np.zeros(len(self.seen), bool)
        here[numbers] = True
        used = np.flatnonzero(here)
        self.seen[used] = True
        self.short[used] = np.arange(len(used))
        numbers = self.short[numbers].astype(np.int64)
        found = np.stack([np.bincount(numbers, column, len(used)) for column in columns], axis=1)
        self.total[used, begin : begin + found.shape[1]] += found

    def rows(self) -> Iterator[pa.RecordBatch]:
        numbers = np.flatnonzero(self.seen)
        for i in range(0, len(numbers), ROWS):
            yield from _number_rows(numbers[i : i + ROWS], self.total[numbers[i : i + ROWS]])


def _number_rows(numbers: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(numbers), ROWS):
        part, values = numbers[i : i + ROWS], sums[i : i + ROWS].astype(np.float32)
        offsets = np.arange(len(part) + 1, dtype=np.int32) * np.int32(values.shape[1] * 4)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
        sums = pa.Array.from_buffers(pa.binary(), len(part), buffers)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), sums], names=["number", "sums"])


def _add_up(width: int, finish=None):
    """Sums by number; ``finish`` makes of them the rows that a number's task passes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        held_rows = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            numbers, sums = (np.concatenate(x) for x in zip(*held))
            numbers, spot = np.unique(numbers, return_inverse=True)
            return numbers, np.stack([np.bincount(spot, column, len(numbers)) for column in sums.T], axis=1)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("sums").to_pylist()), np.float32)
            held.append((batch.column("number").to_numpy(), values.reshape(-1, width)))
            held_rows += batch.num_rows
            if held_rows > 2 * len(held[0][0]) + ROWS:
                held = [merged()]
                held_rows = len(held[0][0])
        if held:
            numbers, sums = merged()
            held.clear()
            for i in range(0, len(numbers), FITTED):
                part, values = numbers[i : i + FITTED], sums[i : i + FITTED]
                yield from _number_rows(part, values if finish is None else finish(part, values))

    return run


def added_up(rows: DataFrame, size: int, width: int, finish=None) -> np.ndarray:
    """Sums by number over all tasks, and what ``finish`` makes of them in the task that owns
    the number; one row per number reaches the driver."""
    got = rows.repartition("number").mapInArrow(_add_up(width, finish), NUMBERED).toArrow()
    total = np.zeros((size, width), np.float32)
    for batch in got.to_batches():
        values = np.frombuffer(b"".join(batch.column("sums").to_pylist()), np.float32)
        total[batch.column("number").to_numpy()] = values.reshape(-1, width)
    return total


NUMBERED = "number int, sums binary"
ROWS = 1 << 14  # of a batch
FITTED = 1 << 11  # numbers whose vectors are fitted at once


def numbers_of(units: np.ndarray, own: np.ndarray) -> np.ndarray:
    """History number of each token: its unit, or beyond the units its own number."""
    return np.where(own >= 0, UNITS + own, units)


def _signed(hashes: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
    """``values`` with the sign of bits 40 to 40 + SIZE of the hashes: a 0 is a minus."""
    minus, bits = ~(hashes >> 40).astype(np.uint32), values.astype(np.float32).view(np.uint32)
    for k in range(SIZE):
        yield ((minus << np.uint32(31 - k) & np.uint32(1 << 31)) ^ bits).view(np.float32)


def _history_sums(shared, unit_model):
    """Per history number: the gradient of its vector, and a signed sum of the words after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lexicon = shared_value(shared)
        gains, expected = shared_value(unit_model)
        n_history = UNITS + len(table.vocabulary)
        sums = Sums(n_history, 3 * SIZE)
        rarities = 1 - np.log(table.count + 1.0) / np.log(table.n_tokens + 1.0)
        for _, codes, others, first in coded(batches):
            units, own = table.units_and_numbers(codes)
            at = np.maximum(codes, -1)
            hashes = table.word[at]
            hashes[codes < 0] = others
            two, one = histories(units, first)
            history = two * UNITS + one
            two, one = histories(numbers_of(units, own), first)
            gradients = [gains[k][units] - expected[k][history] for k in range(SIZE)]
            for side, before in enumerate((one, two)):
                sums.add(before, gradients, side * SIZE)
            sums.add(one, _signed(hashes, rarities[at]), 2 * SIZE)
        yield from sums.rows()

    return run


@dataclass
class Vectors:
    """Vectors by history number: what a word adds to the hidden vector as the first and as
    the second word before, and what follows it."""

    two: np.ndarray
    one: np.ndarray
    after: np.ndarray
    q: np.ndarray  # of the units
    bias: np.ndarray
    usual: np.ndarray  # size of each feature

    def __post_init__(self):
        """Features are bounded, since a target's vector comes from their mean and spread."""
        self.scale = 1 / self.usual[:SIZE]
        self.after = np.tanh(self.after / self.usual[SIZE:])
        self.units = across(self.q, self.bias)

    def hidden(self, two: np.ndarray, one: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Hidden vectors of the tokens, each with a one behind, some at a time."""
        for i in range(0, len(one), FEATURE_BLOCK):
            part = slice(i, min(i + FEATURE_BLOCK, len(one)))
            h = np.ones((part.stop - i, SIZE + 1), np.float32)
            np.add(np.take(self.two, two[part], axis=0), np.take(self.one, one[part], axis=0), out=h[:, :SIZE])
            yield part, h

    def bounded(self, hidden: np.ndarray, one: np.ndarray, out: np.ndarray) -> None:
        """Features of tokens, one per row of ``out``."""
        hidden = hidden * self.scale
        out[:, :SIZE] = np.tanh(hidden, out=hidden)
        out[:, SIZE:] = np.take(self.after, one, axis=0)


def unit_gradients(p: dict[str, np.ndarray], scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of a hidden vector: what the unit that comes adds, and what is expected after
    a history.  By component."""
    return p["q"].T.astype(np.float32), (np.exp(scores) @ p["q"]).T.astype(np.float32)


def _steps(q: np.ndarray, chance: np.ndarray, gradient: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What to add to the hidden vector of each row: the maximum of the likelihood of ``n``
    tokens whose gradient at 0 is known, where units have ``chance``, by Newton steps."""
    at = np.zeros_like(gradient)
    mean = chance @ q
    target = gradient / n[:, None]
    products = (q[:, :, None] * q[:, None]).reshape(len(q), -1)
    outer = lambda x: x[:, :, None] * x[:, None]
    spread_of = lambda p, mean: (p @ products).reshape(-1, SIZE, SIZE) - outer(mean)
    prior = spread_of(chance, mean) * (HISTORY_PRIOR / n)[:, None, None] + np.eye(SIZE) * 1e-6

    def tilt(x, rows):
        return chance[rows] * np.exp(np.minimum(x @ q.T - (x * mean[rows]).sum(axis=1)[:, None], 50))

    def pull(x, rows):
        return (prior[rows] @ x[:, :, None])[:, :, 0]

    def gain(x, rows):
        likelihood = (x * target[rows]).sum(axis=1) - np.log(tilt(x, rows).sum(axis=1))
        return likelihood - (x * pull(x, rows)).sum(axis=1) / 2

    rows = np.arange(len(at))  # those that still move
    best = gain(at, rows)
    for _ in range(NEWTON_STEPS):
        x = at[rows]
        p = tilt(x, rows)
        p /= p.sum(axis=1, keepdims=True)
        expected = p @ q
        spread = spread_of(p, expected)
        slope = target[rows] - (expected - mean[rows]) - pull(x, rows)
        step = np.linalg.solve(spread + prior[rows], slope[:, :, None])[:, :, 0]
        new = gain(x + step, rows)
        worse = np.flatnonzero(new < best[rows])
        for _ in range(12):  # a step that loses is halved
            if not len(worse):
                break
            step[worse] /= 2
            new[worse] = gain(x[worse] + step[worse], rows[worse])
            worse = worse[new[worse] < best[rows[worse]]]
        step[worse], new[worse] = 0, best[rows[worse]]
        at[rows], best[rows] = x + step, new
        rows = rows[np.abs(step).max(axis=1, initial=0) > SETTLED]
        if not len(rows):
            break
    return at


def start_vectors(p: dict[str, np.ndarray], scores: np.ndarray, seen: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the second and the first word before: vectors of the units, and how often each unit
    (column) is expected after a unit (row).  ``seen`` counts each history."""
    sides = []
    joint = np.exp(scores).reshape(UNITS, UNITS, UNITS) * (seen.reshape(UNITS, UNITS, 1) + 1e-3)
    for axis, start in ((1, p["r"] @ p["a"]), (0, p["r"] @ p["b"])):
        chance = joint.sum(axis=axis)
        sides.append((start, chance / chance.sum(axis=1, keepdims=True)))
    return sides


def _history_vectors(shared, starts, q: np.ndarray):
    """From the sums of some numbers: vectors of each as the first and as the second word
    before, fitted from its unit's, and unchanged the sums of the words after it."""

    def finish(numbers: np.ndarray, sums: np.ndarray) -> np.ndarray:
        table: Lexicon = shared_value(shared)
        fitted = np.flatnonzero(numbers >= UNITS)
        word = table.vocabulary[numbers[fitted] - UNITS]
        unit = numbers.astype(np.int64)
        unit[fitted] = table.unit[word]
        out = [None, None, sums[:, 2 * SIZE :]]
        for side, (start, chance) in enumerate(shared_value(starts)):
            out[side] = start[unit]
            gradient = sums[fitted, (1 - side) * SIZE : (2 - side) * SIZE]
            out[side][fitted] += DAMPING * _steps(q, chance[unit[fitted]], gradient, table.count[word].astype(np.float64))
        return np.concatenate(out, axis=1)

    return finish


def history_vectors(p: dict[str, np.ndarray], starts, seen: np.ndarray, table: Lexicon, fitted: np.ndarray) -> Vectors:
    """Vectors of all numbers; ``fitted`` has a row per number with what ``_history_vectors`` gave."""
    n = np.concatenate([seen.reshape(UNITS, UNITS).sum(axis=0), table.count[table.vocabulary]]).astype(np.float64)
    sides = [fitted[:, :SIZE], fitted[:, SIZE : 2 * SIZE]]
    for side, (start, _) in zip(sides, starts):
        side[:UNITS] = start
    after = fitted[:, 2 * SIZE :]
    after = after - n[:, None] * after.sum(axis=0, dtype=np.float64) / max(1.0, n.sum())
    after /= n[:, None] + HISTORY_PRIOR
    share = n / max(1.0, n.sum())
    size = lambda x: share @ (x - share @ x) ** 2
    usual = FEATURE_SIZE * np.sqrt(np.concatenate([size(sides[0]) + size(sides[1]), size(after)]) + 1e-12)
    return Vectors(*(np.ascontiguousarray(x, np.float32) for x in (*sides, after, p["q"], p["bias"], usual)))


def _target_sums(shared, vectors):
    """Per word of its own, then per shared unit for its other words: the sum of features.
    After them the products of the features with each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lexicon = shared_value(shared)
        v: Vectors = shared_value(vectors)
        n_own = len(table.vocabulary)
        n_items = n_own + SHARED_UNITS
        sums = Sums(n_items + 2 * SIZE, 2 * SIZE)
        for _, codes, _, first in coded(batches):
            units, own = table.units_and_numbers(codes)
            two, one = histories(numbers_of(units, own), first)
            tail = np.flatnonzero(units >= OWN_UNITS)
            item = np.where(own[tail] >= 0, own[tail], n_own + units[tail] - OWN_UNITS)
            two, one = two[tail], one[tail]
            f = np.empty((2 * SIZE, len(tail)), np.float32)
            for part, h in v.hidden(two, one):
                v.bounded(h[:, :SIZE], one[part], f[:, part].T)
            sums.add(item, f)
            sums.total[n_items:] += f @ f.T
            sums.seen[n_items:] = True
        yield from sums.rows()

    return run


@dataclass
class Classes:
    """Classes inside the shared units: vectors and log-weights of the vocabulary's words, class
    by class; then the same of the classes, unit by unit, the last class of a unit being its
    words without vectors."""

    class_of: np.ndarray  # by word number
    rank: np.ndarray  # by word number: its place in the class order
    of_words: list[np.ndarray]  # of each class, by ``across``
    word_first: np.ndarray  # first place of each class
    of_classes: list[np.ndarray]  # of each shared unit, by ``across``
    class_first: np.ndarray  # first class of each shared unit


def target_classes(table: Lexicon, sums: np.ndarray) -> Classes:
    """Discriminants (one Newton step from the parent's) on the whitened mean features."""
    vocabulary = table.vocabulary
    n_own = len(vocabulary)
    unit = np.concatenate([table.unit[vocabulary].astype(np.int64) - OWN_UNITS, np.arange(SHARED_UNITS)])
    weight = np.append(table.count[vocabulary] + 1.0, table.unit_total[OWN_UNITS:])
    np.subtract.at(weight[n_own:], unit[:n_own], weight[:n_own])  # what the other words have
    f = sums[: n_own + SHARED_UNITS]
    n = weight.sum()
    mean = f.sum(axis=0, dtype=np.float64) / n
    spread = sums[n_own + SHARED_UNITS :].astype(np.float64) / n - np.outer(mean, mean)
    value, direction = np.linalg.eigh((spread + spread.T) / 2)
    kept = value > max(1e-9, 1e-5 * value[-1])
    white = np.where(kept, direction / np.sqrt(np.where(kept, value, 1.0)), 0.0)
    z = np.empty((len(f), 2 * SIZE))  # sums
    for i in range(0, len(f), ROWS):
        part = slice(i, i + ROWS)
        z[part] = (f[part] - weight[part, None] * mean) @ white

    def moved(total, weights, parent):
        """Mean of each, drawn towards its parent's."""
        return parent + (total - weights[:, None] * parent) / (weights[:, None] + TARGET_PRIOR)

    group = lambda x, by, size: np.stack([np.bincount(by, c, size) for c in x.T], axis=1)
    unit_weight = np.bincount(unit, weight, SHARED_UNITS)
    unit_mean = group(z, unit, SHARED_UNITS) / unit_weight[:, None]
    # Neighbours in the direction that spreads most share a class.
    along = z[:n_own, -1] / weight[:n_own]
    order = np.lexsort((along, unit[:n_own]))
    in_unit = np.bincount(unit[:n_own], minlength=SHARED_UNITS)
    n_classes = np.ceil(np.sqrt(in_unit)).astype(np.int64)
    class_first = np.append(0, np.cumsum(n_classes + 1))
    place = np.arange(n_own) - np.append(0, np.cumsum(in_unit))[unit[order]]
    class_of = np.zeros(n_own + SHARED_UNITS, np.int64)
    class_of[order] = class_first[unit[order]] + place * n_classes[unit[order]] // np.maximum(1, in_unit[unit[order]])
    class_of[n_own:] = class_first[1:] - 1
    size = class_first[-1]
    class_weight, class_unit = np.bincount(class_of, weight, size), np.repeat(np.arange(SHARED_UNITS), n_classes + 1)
    class_mean = moved(group(z, class_of, size), class_weight, unit_mean[class_unit])

    def discriminant(own, parent, weights):
        q = (own - parent) @ white.T
        bias = np.log(weights) - ((own**2).sum(axis=1) - (parent**2).sum(axis=1)) / 2 - q @ mean
        return q.astype(np.float32), bias.astype(np.float32)

    words, word_bias = np.empty((n_own, 2 * SIZE), np.float32), np.empty(n_own, np.float32)
    for i in range(0, n_own, ROWS):  # in class order
        at = order[i : i + ROWS]
        parent, part = class_mean[class_of[at]], slice(i, i + ROWS)
        words[part], word_bias[part] = discriminant(moved(z[at], weight[at], parent), parent, weight[at])
    classes, class_bias = discriminant(class_mean, unit_mean[class_unit], class_weight)
    rank = np.zeros(n_own, np.int64)
    rank[order] = np.arange(n_own)
    word_first = np.append(0, np.cumsum(np.bincount(class_of[:n_own], minlength=size)))
    parts = lambda q, bias, first: [across(q[a:b], bias[a:b]) for a, b in zip(first[:-1], first[1:])]
    of_words, of_classes = parts(words, word_bias, word_first), parts(classes, class_bias, class_first)
    return Classes(class_of, rank, of_words, word_first, of_classes, class_first)


def across(q: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Vectors as columns, below them their biases, for rows that end in a one; a product with
    a transposed view takes several times as long."""
    return np.concatenate([q.T, bias[None]])


class Choices:
    """Log-probabilities of choices, where the score of each is a product.  The space of one
    block of scores is used again and again; logarithms are taken at the end, of all at once."""

    def __init__(self, n: int):
        self.picked = np.zeros(n, np.float32)
        self.sums = np.ones(n, np.float32)
        self.held = np.empty(BLOCK, np.float32)
        self.ones = np.ones(1024, np.float32)
        self.place = np.arange(1024)

    def add(self, begin: int, f: np.ndarray, q: np.ndarray, chosen: np.ndarray) -> None:
        """From place ``begin`` on, the chosen column of ``q`` (made by ``across``) in each row of f."""
        n, width = len(f), q.shape[1]
        step = max(1, BLOCK // width)
        if width > len(self.ones):
            self.ones = np.ones(width, np.float32)
            self.held = np.empty(max(BLOCK, width), np.float32)
        if min(step, n) > len(self.place):
            self.place = np.arange(min(step, n))
        for i in range(0, n, step):
            rows = min(step, n - i)
            scores = self.held[: rows * width].reshape(rows, width)
            np.matmul(f[i : i + rows], q, out=scores)
            self.picked[begin + i : begin + i + rows] = scores[self.place[:rows], chosen[i : i + rows]]
            np.exp(scores, out=scores)
            np.matmul(scores, self.ones[:width], out=self.sums[begin + i : begin + i + rows])

    def lost(self, begin: int, end: int) -> np.ndarray:
        """Places whose scores were too large or small for exp."""
        sums = self.sums[begin:end]
        return begin + np.flatnonzero(~((sums > LEAST_SUM) & (sums < MOST_SUM)))

    def mend(self, places: np.ndarray, f: np.ndarray, q: np.ndarray) -> None:
        """``places`` once more, with scores from their highest."""
        step = max(1, BLOCK // q.shape[1])
        for i in range(0, len(places), step):
            scores = f[i : i + step] @ q
            high = scores.max(axis=1)
            self.picked[places[i : i + step]] -= high
            self.sums[places[i : i + step]] = np.exp(scores - high[:, None]).sum(axis=1)

    def log(self) -> np.ndarray:
        return self.picked - np.log(self.sums)


def _grouped_choices(f: np.ndarray, group: np.ndarray, columns: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """Log-probability of the chosen column of each row's group, 0 if there is no other; rows are in
    the order of their groups."""
    choices = Choices(len(f))
    runs = [run for run in _runs(group) if columns[run[2]].shape[1] > 1]
    for begin, end, at in runs:
        choices.add(begin, f[begin:end], columns[at], chosen[begin:end])
    if len(choices.lost(0, len(f))):
        for begin, end, at in runs:
            lost = choices.lost(begin, end)
            choices.mend(lost, f[lost], columns[at])
    return choices.log()


def log_probabilities(v: Vectors, c: Classes, table: Lexicon, log_p: np.ndarray, units, own, first) -> np.ndarray:
    """log10 probability of each token; of a word without vectors: that of its class, in
    which it has its count plus one of ``other_places``."""
    two, one = histories(units, first)
    score = log_p[(two * UNITS + one) * UNITS + units].astype(np.float64)
    two, one = histories(numbers_of(units, own), first)
    # Tokens of the shared units by class, and so by unit: equal ones are one slice.
    tail = np.flatnonzero(units >= OWN_UNITS)
    class_of = np.where(own[tail] >= 0, c.class_of[own[tail]], c.class_first[units[tail] - OWN_UNITS + 1] - 1)
    order = np.argsort(class_of.astype(np.min_scalar_type(len(c.of_words))), kind="stable")
    class_of, tail = class_of[order], tail[order]
    place = np.zeros(len(units), np.int64)
    place[tail] = np.arange(len(tail))
    f = np.ones((len(tail), 2 * SIZE + 1), np.float32)
    with np.errstate(over="ignore", under="ignore"):  # such scores are taken up once more
        for part, h in v.hidden(two, one):
            at = np.flatnonzero((two[part] >= UNITS) | (one[part] >= UNITS))
            choices, rows, chosen = Choices(len(at)), np.take(h, at, axis=0), units[part][at]
            choices.add(0, rows, v.units, chosen)
            lost = choices.lost(0, len(at))
            choices.mend(lost, rows[lost], v.units)
            score[part][at] = choices.log() / np.log(10)
            at = np.flatnonzero(units[part] >= OWN_UNITS)
            features = np.ones((len(at), 2 * SIZE + 1), np.float32)
            v.bounded(np.take(h, at, axis=0)[:, :SIZE], one[part][at], features[:, : 2 * SIZE])
            f[place[part][at]] = features
        unit = units[tail] - OWN_UNITS
        log_p_tail = _grouped_choices(f, unit, c.of_classes, class_of - c.class_first[unit])
        own = own[tail]
        rank = np.where(own >= 0, c.rank[own], 0) if len(c.rank) else own
        log_p_tail += _grouped_choices(f, class_of, c.of_words, rank - c.word_first[class_of])
    score[tail] += log_p_tail / np.log(10)
    return score


def _runs(group: np.ndarray) -> list[tuple[int, int, int]]:
    """First place, place after the last, and value of each run of equal values."""
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    return list(zip(begin.tolist(), np.append(begin[1:], len(group)).tolist(), group[begin].tolist()))


def other_places(table: Lexicon) -> np.ndarray:
    """Per unit: tokens + words + 1 of its words without vectors."""
    vocabulary = table.vocabulary
    return table.unit_total - np.bincount(table.unit[vocabulary], table.count[vocabulary] + 1.0, UNITS)


def _score(shared, model, vectors, inner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Lexicon = shared_value(shared)
        log_p: np.ndarray = shared_value(model)
        places = np.log10(table.n_tokens + table.n_words + 1)
        other = np.log10(other_places(table))
        log_counts = np.log10(table.count + 1.0)  # 0 for a token outside the table
        for batch, codes, rest, first in coded(batches):
            found = codes >= 0
            units, number = table.units_and_numbers(codes)
            log_count = log_counts[np.maximum(codes, -1)]
            base = log_count - places
            score = log_probabilities(shared_value(vectors), shared_value(inner), table, log_p, units, number, first)
            score += np.where((units < OWN_UNITS) | (number >= 0), 0.0, log_count - other[units])
            sums = lambda x: pa.array(np.add.reduceat(x, first[:-1]))  # noqa: E731  each text has its end
            n = np.diff(first)
            # Tokens outside the table, by text and word.
            text = np.repeat(np.arange(len(n)), n)[~found]
            order = np.lexsort((rest, text))
            text, rest = text[order], rest[order]
            new = np.ones(len(rest), bool)
            new[1:] = (text[1:] != text[:-1]) | (rest[1:] != rest[:-1])
            at = np.flatnonzero(new)
            offsets = pa.array(np.searchsorted(text[at], np.arange(len(n) + 1)).astype(np.int32))
            times = np.diff(np.append(at, len(rest)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(n.astype(np.int64)),
                    sums(found.astype(np.int64)),
                    sums(base),
                    sums(score),
                    pa.ListArray.from_arrays(offsets, pa.array(rest[at])),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "words", "times"],
            )

    return run


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "words array<long>, times array<int>"
)


TASKS_PER_CORE = 2  # of the passes that count and add up


def lm_scores(docs: DataFrame, folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``; other columns are ignored) with held_out,
    n_tokens, n_known, train_tokens, base_score (add-one word frequencies) and score, both
    log10 probabilities of the whole text with its end.

    Rows whose crc32(doc_id as text) modulo ``folds`` is ``held_out_fold`` do not train; a
    row without doc_id trains.  A null text is an empty one: only its end counts.
    Repeated rows each count and are each scored.  Without training rows the lexicon is
    empty and all units are equally likely.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
        docs = docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(fold == held_out_fold, F.lit(False)).alias("held_out"),
            "text",
        )
        # Few long tasks: each passes on at most a row per word of the vocabulary and pass.
        n_tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        counted = docs.where(~F.col("held_out")).select("text").coalesce(n_tasks).mapInArrow(_count_words, "word long, unit short, n long")
        counts = scratch.keep(counted.groupBy("word").agg(F.max("unit").alias("unit"), F.sum("n").alias("n")))
        table = lexicon(counts)
        shared = share(spark, table)
        docs = scratch.keep(docs.mapInArrow(_code(shared), CODED))
        training = docs.where(~F.col("held_out")).select("codes", "others").coalesce(n_tasks)
        triples = training.mapInArrow(_count_triples(shared), "triple long, n long")
        triples = triples.groupBy("triple").agg(F.sum("n").alias("n")).toArrow()  # at most UNITS**3 rows
        dense = np.zeros(UNITS**3, np.int64)
        dense[triples.column("triple").to_numpy()] = triples.column("n").to_numpy()
        p = fit(dense)
        scores = unit_scores(p)
        model = share(spark, (scores / np.log(10)).astype(np.float32).ravel())
        gradients = share(spark, unit_gradients(p, scores))
        n_own = len(table.vocabulary)
        seen = dense.reshape(UNITS * UNITS, UNITS).sum(axis=1)
        starts = start_vectors(p, scores, seen)
        finish = _history_vectors(shared, share(spark, starts), p["q"])
        fitted = added_up(training.mapInArrow(_history_sums(shared, gradients), NUMBERED), UNITS + n_own, 3 * SIZE, finish)
        vectors = share(spark, history_vectors(p, starts, seen, table, fitted))
        rows = training.mapInArrow(_target_sums(shared, vectors), NUMBERED)
        sums = added_up(rows, n_own + SHARED_UNITS + 2 * SIZE, 2 * SIZE)
        inner = share(spark, target_classes(table, sums))
        scored = scratch.keep(docs.mapInArrow(_score(shared, model, vectors, inner), SCORED))
        rest = (
            scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
            .select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
            .join(counts.select("word", "n"), "word")
            .groupBy("row")
            .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
        )
        more = F.coalesce("more", F.lit(0.0))
        result = scored.join(rest, "row", "left").select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(table.n_tokens).cast("long").alias("train_tokens"),
            (F.col("base_score") + more).alias("base_score"),
            (F.col("score") + more).alias("score"),
        )
        return scratch.result(result)
