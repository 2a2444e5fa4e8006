"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers.  A block of rows is stored by slices: for each attribute
and each bit of its (offset) values one bitmap over the block's rows.  A query's scores are
added up by bitmap arithmetic for all rows of a block at once: for every bit j of the
query's weights, the slices b of the attributes that have this bit are summed with weight
2**(j+b) by carry-save adders, which reduce the bitmaps of one weight, three at a time, to
one of that weight and one carry.  What is left is one bitmap per bit of the score.

The k best rows are then found from the most significant score slice down: rows with the
bit set win while they are no more than k, else the search goes on among them.  Rows left
with equal scores at the boundary are resolved by the smaller vec_id.

Row blocks and query blocks meet by a join on the block number; the best rows of each
block are merged by a ranked window, of which each task first keeps its own k best.

Bitmaps hold scores of any size.  Where the largest component and the widest vector allow a
score that does not fit 64 bits, scores are summed as Python integers and merged as decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stmtscope.llm.scratch import Scratch

BLOCK_ROWS = 16_384
BLOCK_QUERIES = 256
GROUPS = 4  # of query blocks; each row block meets each group in a task of its own
LARGEST = 1 << 52  # absolute quantised value that takes part: doubles are whole numbers up to here
LONGEST = (1 << 63) - 1


def quantised(vector, scale: float):
    """Integer components; null if the vector is null or any component is null, infinite, not
    a number or too large."""
    exact = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double") * scale) <= float(LARGEST)),
    )
    return F.when(fits, exact)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (attributes x bits x words of 64 rows) of values minus each attribute's least."""
    least = values.min(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
    offset = (values - least).astype(np.uint64)
    bits = max(1, int(offset.max()).bit_length()) if offset.size else 1
    n_words = -(-len(values) // 64)
    padded = np.zeros((n_words * 64, values.shape[1]), np.uint64)
    padded[: len(values)] = offset
    out = np.empty((values.shape[1], bits, n_words), np.uint64)
    for b in range(bits):
        plane = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        out[:, b] = np.packbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little").view(np.uint64)
    return out, least


def add_slices(columns: dict[int, list[np.ndarray]], n_words: int) -> list[np.ndarray]:
    """Sum of weighted bitmaps, one bitmap per bit; ``columns[w]`` holds arrays of bitmaps
    (rows) of weight 2**w."""
    sums = []
    while columns:
        weight = len(sums)
        todo = np.concatenate(columns.pop(weight, [np.zeros((1, n_words), np.uint64)]))
        carries = []
        while len(todo) > 1:
            t = max(1, len(todo) // 3)
            a, b = todo[:t], todo[t : 2 * t]
            c = todo[2 * t : 3 * t] if len(todo) > 2 else np.zeros((t, n_words), np.uint64)
            differ = a ^ b
            carries.append((a & b) | (differ & c))
            todo = np.concatenate([differ ^ c, todo[3 * t :]])
        if carries:
            columns.setdefault(weight + 1, []).extend(carries)
        sums.append(todo[0])
    return sums


def weighted(slices: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Score slices of the rows for non-negative weights of the attributes."""
    columns: dict[int, list[np.ndarray]] = {}
    for j in range(int(weights.max(initial=0)).bit_length()):
        having = np.flatnonzero(weights >> j & 1)
        if len(having):
            for b in range(slices.shape[1]):
                columns.setdefault(j + b, []).append(slices[having, b])
    return add_slices(columns, slices.shape[2])


def subtracted(a: list[np.ndarray], b: list[np.ndarray], n_words: int) -> list[np.ndarray]:
    """a - b + 2**n for n slices, so that order is kept and nothing is negative."""
    n = max(len(a), len(b), 1)
    zero = np.zeros(n_words, np.uint64)
    carry, out = ~zero, []
    for i in range(n):
        x = a[i] if i < len(a) else zero
        y = ~b[i] if i < len(b) else ~zero
        out.append(x ^ y ^ carry)
        carry = (x & y) | (carry & (x ^ y))
    return [*out, carry]


def rows_in(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def best_rows(score: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k best rows of the bitmap ``rows``; equal ones by smaller number."""
    sure, open_ = np.zeros_like(rows), rows
    need = k
    for plane in reversed(score):
        high = open_ & plane
        n = count(high)
        if n > need:
            open_ = high
        else:
            sure |= high
            need -= n
            open_ = open_ & ~plane
            if not need:
                break
    return np.sort(np.concatenate([rows_in(sure), rows_in(open_)[:need]]))


class Block:
    """Index of one block of rows, ordered by vec_id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.slices, self.least = slices_of(self.values)
        every = np.zeros(self.slices.shape[2] * 64, np.uint8)
        every[: len(ids)] = 1
        self.every = np.packbits(every, bitorder="little").view(np.uint64)

    def search(self, query_id: int, query: np.ndarray, k: int, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and scores of the query's k best rows other than itself; ``wide`` scores are
        Python integers."""
        width = max(len(query), self.values.shape[1])
        weights = np.zeros(width, np.int64)
        weights[: len(query)] = query
        weights = weights[: self.values.shape[1]]
        n_words = self.slices.shape[2]
        score = subtracted(
            weighted(self.slices, np.maximum(weights, 0)), weighted(self.slices, np.maximum(-weights, 0)), n_words
        )
        rows = self.every.copy()
        for own in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            rows[own // 64] &= ~np.uint64(1 << (own % 64))
        found = best_rows(score, rows, k)
        # Python integers where 64 bits may not do.
        best = self.values[found].astype(object if wide else np.int64)
        exact = sum((int(w) * best[:, d] for d, w in enumerate(weights) if w), np.zeros(len(found), best.dtype))
        return self.ids[found], exact


def _packed(ids: np.ndarray, vectors: pa.ListArray) -> tuple[bytes, bytes, int]:
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    values = np.zeros((len(ids), width), np.int64)  # shorter vectors end in zeros
    values[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
    return ids.tobytes(), values.tobytes(), width


def _blocks(size: int):
    """The vectors of a partition as one block of bytes, or as blocks of up to ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        for begin in range(0, len(whole), size):
            part = whole.slice(begin, size)
            ids, values, width = _packed(part.column("vec_id").to_numpy(), part.column("q").combine_chunks())
            block = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "ids": [ids], "v": [values], "width": pa.array([width], pa.int32())}
            )

    return run


def _search(k: int, wide: bool):
    score = pa.decimal128(38, 0) if wide else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, Block] | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if last is None or last[0] != row["block"]:
                    ids = np.frombuffer(row["ids"], np.int64)
                    values = np.frombuffer(row["v"], np.int64).reshape(len(ids), row["width"])
                    last = row["block"], Block(ids, values)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["query_v"], np.int64).reshape(len(query_ids), row["query_width"])
                found = [last[1].search(int(i), q, k, wide) for i, q in zip(query_ids, queries)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, [len(x) for x, _ in found])),
                        pa.array(np.concatenate([x for x, _ in found])),
                        pa.array([Decimal(s) for _, x in found for s in x] if wide else np.concatenate([x for _, x in found]), score),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame, k: int = 20, scale: float = 64.0, query_every: int = 20, column: str = "embedding"
) -> DataFrame:
    """For every row of ``vectors`` (``vec_id`` and a vector column; others are ignored) whose
    vec_id is divisible by ``query_every``: the ``k`` highest inner products of its
    quantised vector, ``floor(scale * x)``, with those of all other rows.

    Returns query_id, rank (from 1), vec_id and score; equal scores by smaller vec_id.  Rows
    without vec_id, with a null vector, or with a null, infinite or not-a-number component
    (or one above 2**52 when quantised) take no part.  A score beyond a long is given as the
    nearest long, but ranked by its exact value.  Shorter vectors count as ending in zeros; an empty one scores 0 everywhere.  Repeated rows with one vec_id are one row each
    as candidates, none of them for the query with that id; equal repeated queries are asked once.
    """
    with Scratch(vectors.sparkSession) as scratch:
        rows = scratch.keep(
            vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col(column), scale).alias("q")).where(
                "vec_id IS NOT NULL AND q IS NOT NULL"
            )
        )
        packed = "block int, ids binary, v binary, width int"
        magnitude = F.array_max(F.transform("q", lambda x: F.abs(x)))
        n_rows, width, most = rows.agg(F.count("*"), F.max(F.size("q")), F.max(magnitude)).first()
        wide = (width or 0) * (most or 0) ** 2 > LONGEST
        n_blocks = -(-n_rows // BLOCK_ROWS) or 1
        index = scratch.keep(rows.repartition(n_blocks).mapInArrow(_blocks(2 * BLOCK_ROWS), packed))
        queries = rows.where(F.col("vec_id") % query_every == 0).dropDuplicates(["vec_id", "q"])
        asked = queries.mapInArrow(_blocks(BLOCK_QUERIES), packed).select(
            F.pmod(F.xxhash64("ids"), F.lit(GROUPS)).alias("part"),
            F.col("ids").alias("query_ids"),
            F.col("v").alias("query_v"),
            F.col("width").alias("query_width"),
        )
        # The stated search of some rows against all others: every query block goes to every row block.
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        parts = F.sequence(F.lit(0).cast("long"), F.lit(GROUPS - 1).cast("long"))
        found = (
            asked.join(index.withColumn("part", F.explode(parts)), ["block", "part"])
            .select("block", "ids", "v", "width", "query_ids", "query_v", "query_width")
            .mapInArrow(_search(k, wide), f"query_id long, vec_id long, score {'decimal(38,0)' if wide else 'long'}")
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        score = F.col("score")
        if wide:
            score = F.greatest(F.lit(-LONGEST - 1).cast("decimal(38,0)"), F.least(F.lit(LONGEST).cast("decimal(38,0)"), score)).cast("long")
        return scratch.result(
            ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
        )
