"""Exact token counts at every prefix of a text, by dynamic programming over its prefixes.

For a BPE vocabulary the pieces of a prefix are those of one shorter prefix and one more
piece: the one whose neighbourhood with that prefix's last piece merging would leave alone.
So one walk over a text finds, for every prefix, its last piece and its token count,
``count[end] = count[start] + 1``, and no prefix is ever encoded.  The table of counts answers
truncation and budget questions for any limit later on.

No piece of the vocabulary crosses from a character to a following mark, so the walk may
start anew at every run of spaces: a marked word's counts at its own prefixes are found once
and remembered, and a text's table is those counts plus the tokens of the words before.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.pieces import FIRST_OTHER, ID_BITS, MARK, Vocabulary

MODEL = "piece_bpe_32k.model"
RUNS = re.compile(f"{MARK}+[^{MARK}]*")
REMEMBERED_BYTES = 256 << 20  # of words and their counts, per worker
ENTRY_BYTES = 200  # of a remembered word besides its characters
CHUNK_BYTES = 4 << 20  # of text whose tables are held at once


def model_path(name: str = MODEL) -> str:
    """Place of a public vocabulary file; a name with a slash is a place already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], list[int], set[int]]:
    """Pieces with scores, the ids of the byte pieces, and ids no text gets: plain values."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(n)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    skip = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    whole = [s for i, (p, s) in enumerate(pieces) if i not in skip and not model.is_byte(i) and len(p) > 1]
    if any(s != int(s) for s in whole):
        raise ValueError(f"{path} holds no BPE vocabulary")
    return pieces, byte_ids, skip


class PrefixCounter(dict):
    """Marked words (without their first mark) with the counts at their prefixes, as 4-byte
    numbers; a word asked for the first time is walked."""

    def __init__(self, pieces, byte_ids, skip):
        super().__init__()
        self.vocabulary = Vocabulary(pieces, byte_ids, skip, bpe=True)
        self.size = 0
        # The last word walked, and by prefix length its last piece and its tokens.
        self.before, self.last, self.count = "", [0], [0]

    def __missing__(self, word: str) -> bytes:
        counts = self.walk(MARK + word)
        self.size += ENTRY_BYTES + 5 * len(word)
        if self.size > REMEMBERED_BYTES:
            self.clear()
            self.size = ENTRY_BYTES + 5 * len(word)
        self[word] = counts
        return counts

    def walk(self, word: str) -> bytes:
        """Token counts of the prefixes of ``word``, from one character on.  Prefixes that it
        shares with the word before are known already."""
        v = self.vocabulary
        number_of, reach, apart = v.ids.get, v.reach.get, v.apart.get
        last, count, before = self.last, self.count, self.before
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del last[shared + 1 :], count[shared + 1 :]
        self.before = word
        for end in range(shared + 1, len(word) + 1):
            start = end - reach(word[end - 3 : end], 2) if end > 2 else 0
            if start < 0:
                start = 0
            while True:  # the longest piece that may stand last
                number = number_of(word[start:end])
                if number is None and start == end - 1:
                    number = FIRST_OTHER + ord(word[start])
                if number is not None:
                    if start:
                        pair = last[start] << ID_BITS | number
                        fits = apart(pair)
                        if fits is None:
                            fits = v.stay_apart(pair)
                    else:
                        fits = end == 1 or v.merges(word[:end])[2] is not None
                    if fits:
                        break
                start += 1
            last.append(number)
            count.append(count[start] + (1 if number < FIRST_OTHER else len(word[start].encode())))
        return array("i", count[1:]).tobytes()

    def learn(self, texts: Iterable[str | None]) -> None:
        """Walk the words of some texts that are not remembered, in sorted order."""
        new: set[str] = set()
        for text in texts:
            if text:
                new.update(self.words(text))
        for word in sorted(new.difference(self)):
            self[word]

    def words(self, text: str) -> list[str]:
        if self.vocabulary.crossing:
            return [text.replace(" ", MARK)]
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in RUNS.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def table(self, text: str | None) -> np.ndarray:
        """Tokens of the first 0, 1, 2, ... code points of ``text``."""
        if not text:
            return np.zeros(1, np.int32)
        words = self.words(text)
        table = np.frombuffer(b"".join(map(self.__getitem__, words)), np.int32).copy()
        # The mark put before the text stands for the empty prefix.
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        tokens = table[np.cumsum(sizes) - 1]
        table += np.repeat((np.cumsum(tokens) - tokens).astype(np.int32), sizes)
        table[0] = 0
        return table


def counter_of(held: dict) -> PrefixCounter:
    """The counter of a worker, kept with the broadcast value, so that later tasks of the worker
    know the words of earlier ones."""
    if "counter" not in held:
        held["counter"] = PrefixCounter(*held["vocabulary"])
    return held["counter"]


def text_slices(batch: pa.RecordBatch, column: str = "text", chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``chunk_bytes`` of text each."""
    begin = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if i > begin and size + length > chunk_bytes:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += length
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def prefix_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and ``counts``, whose entry i is the number of tokens that the vocabulary's
    library gives for the first i code points of the text; the last one is for all of it.

    A null or empty text has the one entry 0.  Rows are handled alone, so repeated rows and ids
    give repeated results; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": read_vocabulary(model_path(model))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").to_pylist()
                counter.learn(texts)
                tables = [counter.table(t) for t in texts]
                first = np.concatenate([[0], np.cumsum([len(t) for t in tables])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate(tables)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "counts"])

    return _ids_and_texts(docs).mapInArrow(run, "doc_id long, counts array<int>")


def tokens_of_prefix(counts: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points; null beyond the text."""
    return F.get(counts, n_chars)


def longest_prefix(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens.  Counts may fall from
    one prefix to the next, where characters merge, so this is the last prefix that fits."""
    from_end = F.array_position(F.reverse(F.transform(counts, lambda c: c <= budget)), True)
    return F.when(from_end > 0, F.size(counts).cast("long") - from_end)


def token_counts(docs: DataFrame, limit: int, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``fitting_chars``, the code points of the
    longest prefix of at most ``limit`` tokens, all read from the table of each text.

    A null or empty text has none of all.  Rows are handled alone, as by ``prefix_counts``.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": read_vocabulary(model_path(model))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for batch in batches:
            for part in text_slices(batch):
                tokens, fitting, texts = [], [], part.column("text").to_pylist()
                counter.learn(texts)
                for text in texts:
                    table = counter.table(text)
                    tokens.append(int(table[-1]))
                    # Backwards from the end, where most texts fit at once.
                    fitting.append(len(table) - 1 if table[-1] <= limit else int(np.flatnonzero(table <= limit)[-1]))
                sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), sizes, pa.array(tokens, pa.int64()), pa.array(fitting, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens", "fitting_chars"],
                )

    return _ids_and_texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fitting_chars long")
