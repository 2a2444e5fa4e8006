"""SentencePiece encoding and decoding with a public piece vocabulary.

A text is marked (one leading space, spaces as the mark) and cut into marked words, which
no piece of the vocabulary crosses.  The distinct marked words of a chunk that
are not remembered are sorted; walking them in that order is a depth-first walk of their trie, so the forward
state of a common prefix is computed once and reused.  The forward state at a prefix is the
best last piece and where it begins:

* for a unigram vocabulary, the piece that gives the largest sum of scores;
* for a BPE vocabulary, the one piece that merging would leave at the end.  Merging gives a
  prefix exactly the pieces in which every two neighbours would stay apart if merged on
  their own, so a piece may follow the best last piece of the shorter prefix only if the two
  form such a pair.  The ids then equal those of the merges.

Characters the vocabulary lacks become one piece per UTF-8 byte.  Decoding is exact for
every text: also the mark character itself is written as bytes.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import share, shared_value

MARK = "▁"
OWN_MARK = "\ud800"  # a mark that the text itself holds; no valid text has this character
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RUNS = re.compile(f"{MARK}+[^{MARK}]*")
CHUNK_BYTES = 4 << 20  # of text whose new words share one walk, and of ids decoded at once
MOST_WORDS = 200_000  # marked words remembered by a worker between walks
ID_BITS = 22
FIRST_OTHER = 1 << 21  # piece numbers are below it, all code points fit above it
MOST_PAIRS = 400_000  # neighbour pairs remembered by a worker


class Vocabulary:
    """Pieces with ids and scores; made on the driver, broadcast to the workers."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], skip: set[int], bpe: bool):
        self.bpe = bpe
        self.ids = {piece: i for i, (piece, _) in enumerate(pieces) if i not in skip and i not in set(byte_ids)}
        self.pieces = [piece for piece, _ in pieces]
        self.scores = [score for _, score in pieces]
        self.score = {piece: pieces[i][1] for piece, i in self.ids.items()}
        self.byte_ids = byte_ids
        self.unknown = min(self.score.values()) - 10.0
        # No piece has a mark behind another character, so a text may be cut before each run of
        # marks; else it stays whole.
        self.crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        # Longest piece with these last three characters.
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            if len(piece) > 2:
                self.reach[piece[-3:]] = max(len(piece), self.reach.get(piece[-3:], 0))
        self.spelled = [b""] * len(pieces)
        for piece, i in self.ids.items():
            self.spelled[i] = piece.replace(MARK, " ").encode()
        for value, i in enumerate(byte_ids):
            self.spelled[i] = bytes([value])
        self.apart: dict[int, bool] = {}
        self.merge_steps: dict[str, tuple] = {}
        self.known: dict[str, bytes] = {}  # ids of marked words, as 4-byte numbers

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(n)]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        skip = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        # In a BPE vocabulary the scores of the merged pieces only give their order.
        merged = [s for i, (p, s) in enumerate(pieces) if i not in skip and not model.is_byte(i) and len(p) > 1]
        return cls(pieces, byte_ids, skip, bpe=all(s == int(s) for s in merged))

    def merges(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """How a piece is merged, best-scored neighbours first, leftmost of equals: the score
        of each merge, and the first and the last part before each one and at the end."""
        found = self.merge_steps.get(piece)
        if found is None:
            parts, scores, firsts, lasts = list(piece), [], [], []
            while True:
                firsts.append(parts[0])
                lasts.append(parts[-1])
                pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
                if not pairs:
                    break
                score, i = min(pairs)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                scores.append(-score)
            scores.append(float("-inf"))
            if len(parts) > 1:  # merging never makes this piece
                lasts = firsts = None
            found = self.merge_steps[piece] = scores, firsts, lasts
        return found

    def stay_apart(self, pair: int) -> bool:
        """Whether merging the two pieces together never merges across their border."""
        if len(self.apart) >= MOST_PAIRS:
            self.apart.clear()
        left_scores, _, lasts = self.merges(self.spelling(pair >> ID_BITS))
        right_scores, firsts, _ = self.merges(self.spelling(pair & (1 << ID_BITS) - 1))
        apart = lasts is not None and firsts is not None
        i = j = 0
        while apart:
            one, two = left_scores[i], right_scores[j]
            across = self.score.get(lasts[i] + firsts[j])
            if across is not None and across > one and across >= two:
                apart = False
            elif one >= two:
                if one == float("-inf"):
                    break
                i += 1
            else:
                j += 1
        self.apart[pair] = apart
        return apart

    def spelling(self, number: int) -> str:
        return self.pieces[number] if number < FIRST_OTHER else chr(number - FIRST_OTHER)

    def marked_words(self, text: str) -> list[str]:
        """Marked words, each without its first mark."""
        text = text.replace(MARK, OWN_MARK)
        if self.crossing:
            return [text.replace(" ", MARK)]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in RUNS.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def walk(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Piece numbers of each of the sorted words; a character without a piece has its code
        point plus ``FIRST_OTHER``."""
        reach, number_of, known = self.reach.get, self.ids.get, self.apart.get
        begin, last, best = [0], [0], [0.0]  # forward states along the current path
        before = ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del begin[shared + 1 :], last[shared + 1 :], best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                far = end - reach(word[end - 3 : end], 2) if end > 2 else 0
                highest = None
                for start in range(far if far > 0 else 0, end):
                    number = number_of(word[start:end])
                    if number is None:
                        if start < end - 1:
                            continue
                        number = FIRST_OTHER + ord(word[start])
                    if self.bpe:
                        if start:
                            pair = last[start] << ID_BITS | number
                            apart = known(pair)
                            if not (self.stay_apart(pair) if apart is None else apart):
                                continue
                        begin.append(start)
                        last.append(number)
                        break
                    total = best[start] + (self.scores[number] if number < FIRST_OTHER else self.unknown)
                    if highest is None or total > highest:
                        highest, state = total, (start, number)
                if highest is not None:
                    begin.append(state[0])
                    last.append(state[1])
                    best.append(highest)
            numbers, end = [], len(word)
            while end:
                numbers.append(last[end])
                end = begin[end]
            numbers.reverse()
            before = word
            yield numbers

    def as_bytes(self, numbers: list[int]) -> bytes:
        """4-byte ids; a character without a piece becomes one id per UTF-8 byte."""
        if max(numbers) >= FIRST_OTHER:
            ids = []
            for n in numbers:
                if n < FIRST_OTHER:
                    ids.append(n)
                else:
                    ids.extend(self.byte_ids[b] for b in self.spelling(n).replace(OWN_MARK, MARK).encode())
            numbers = ids
        return array("i", numbers).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as 4-byte numbers."""
        known, cut = self.known, self.marked_words
        if len(known) > MOST_WORDS:
            known.clear()
        new: set[str] = set()
        for text in texts:
            if text:
                new.update(cut(text))
        order = sorted(new.difference(known))
        del new
        for word, numbers in zip(order, self.walk(MARK + w for w in order)):
            known[word] = self.as_bytes(numbers)
        return [b"".join(map(known.__getitem__, cut(t))) if t else b"" for t in texts]

    def decode(self, ids: list[int]) -> str:
        return spelled_text(self.spelled, ids)


def spelled_text(spelled: list[bytes], ids: list[int]) -> str:
    """The text of some ids, whose spellings are given."""
    return b"".join(map(spelled.__getitem__, ids))[1:].decode(errors="replace")


def text_chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``CHUNK_BYTES`` of text."""
    begin = size = 0
    for i, length in enumerate(lengths):
        if size > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += length
    if lengths:
        yield begin, len(lengths)


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``token_ids`` of every text of ``docs``.

    A null or empty text has no ids.  Rows are handled alone, so repeated rows and ids give
    repeated results; columns other than doc_id and text are ignored.
    """
    shared = share(docs.sparkSession, Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared_value(shared)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for begin, end in text_chunks(sizes):
                ids = vocabulary.encode(batch.column("text").slice(begin, end - begin).to_pylist())
                n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                first = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(first), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), pa.array(n), lists],
                    names=["doc_id", "n_tokens", "token_ids"],
                )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, token_ids) with the ``text`` that the ids spell."""
    # Spellings only: a worker that decodes has no use for the rest of the vocabulary.
    shared = share(encoded.sparkSession, Vocabulary.load(model).spelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled: list[bytes] = shared_value(shared)
        for batch in batches:
            lists = batch.column("token_ids")
            ids = lists.flatten().to_numpy()
            first = np.concatenate([[0], np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy())]).tolist()
            sizes = [4 * (b - a) for a, b in zip(first[:-1], first[1:])]
            for begin, end in text_chunks(sizes):
                texts = [spelled_text(spelled, ids[a:b].tolist()) for a, b in zip(first[begin:end], first[begin + 1 : end + 1])]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    columns = encoded.select("doc_id", "n_tokens", "token_ids")
    return columns.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>, text string")
