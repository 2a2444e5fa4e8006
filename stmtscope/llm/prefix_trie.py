"""Prefix trie of conversations, as burst tries.

A conversation is the sequence of its turn ids.  At first one container holds the suffixes of
all conversations under the root.  A container that is too large for a task bursts: the
turns that all its suffixes begin with, and the branching point behind them, become trie heads,
and the suffixes go to new containers by their next turn id.  A head's suffixes thus lie
in as many containers as it has children, and no group of conversations that share an
opening, however large, goes to one task.  The remaining containers are dealt to tasks,
sorted, and swept into nodes; sums over the nodes of a container are added to the heads above.

Equal conversations are one suffix with a count, so copies never make a container large.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stmtscope.llm.scratch import Scratch

ID_BYTES = 16  # of a turn id
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
CONTAINER_ROWS = 8192  # suffixes of a container that is swept
CONTAINER_TURNS = 1 << 18  # and their turns; one conversation is never cut
BROADCAST_HEADS = 20_000  # heads of one round that are broadcast
LIST_BITS = 16  # conversation numbers are listed in ranges of 2^16
SEQUENCE = "conv_id long, path binary, words array<int>"
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def sequences(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``path``, its turn ids one after the other, and ``words`` of
    each turn.

    Turns are ordered by ``turn``, null first; turns of one number by the id of their content, so
    repeated rows are repeated turns.  A null role or text is empty; rows without conv_id
    belong to no conversation.  The rows of a conversation meet ordered in one task, which
    passes them on as it reads them; of a turn only the id and the number of words travel.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(content)).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
    )
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "id")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, paths, words = None, [], []

        def packed(rows):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                ],
                names=["conv_id", "path", "words"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column("conv_id").to_numpy()
            ids = b"".join(batch.column("id").to_pylist())
            counts = batch.column("words").to_numpy()
            begins = np.concatenate([[0], np.flatnonzero(np.diff(convs)) + 1, [len(convs)]]).tolist()
            done = []
            for begin, end in zip(begins[:-1], begins[1:]):
                conv = int(convs[begin])
                if current is not None and conv != current:
                    done.append((current, b"".join(paths), np.concatenate(words)))
                    paths, words = [], []
                current = conv
                paths.append(ids[begin * ID_BYTES : end * ID_BYTES])
                words.append(counts[begin:end])
            if done:
                yield packed(done)
        if current is not None:
            yield packed([(current, b"".join(paths), np.concatenate(words))])

    return ordered.select("conv_id", "id", "words").mapInArrow(joined, SEQUENCE)


def part(path: Column, begin: Column | int, length: Column | int | None = None) -> Column:
    """Some turns of a path, counted from 0; to its end without a length."""
    count = F.length(path) if length is None else F.lit(length) * ID_BYTES
    return F.substring(path, (F.lit(begin) * ID_BYTES + 1).cast("int"), count.cast("int"))


def with_shared_openings(convs: DataFrame, every: int, turns: Column) -> DataFrame:
    """Each conversation c with its first turns, ``turns`` of them (an expression of conv_id),
    replaced by those of conversation c - c % ``every``; by none where there is no such one.
    A conversation of fewer turns gives or loses all it has."""
    base = F.col("conv_id") - F.col("conv_id") % every
    openings = convs.where(F.col("conv_id") == base).select(
        F.col("conv_id").alias("base"), F.col("path").alias("base_path"), F.col("words").alias("base_words")
    )
    n = turns.cast("int")
    rest = F.slice("words", n + 1, F.greatest(F.size("words") - n, F.lit(0)))
    opening = F.when(F.col("base").isNull(), F.array().cast("array<int>")).otherwise(F.slice("base_words", F.lit(1), n))
    return convs.join(openings, base == F.col("base"), "left").select(
        "conv_id",
        F.concat(F.coalesce(part(F.col("base_path"), 0, n), F.lit(b"")), part(F.col("path"), n)).alias("path"),
        F.concat(opening, rest).alias("words"),
    )


def ends_digests(convs: DataFrame) -> DataFrame:
    """For each sequence that several conversations have: the smallest of them, and the SHA-256
    of their numbers, ascending and joined by commas.

    Numbers are listed in ranges of 2^16, and one task reads the lists of a sequence in order: the
    digest goes on from list to list, which are never put together.
    """
    key = F.sha2("path", 256).alias("key")
    lists = (
        convs.select(key, "conv_id")
        .groupBy("key", F.shiftright("conv_id", LIST_BITS).alias("range"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select("key", "range", F.element_at("ids", 1).alias("least"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, least, digest = None, None, None
        for batch in batches:
            done = []
            for key, first, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "least", "ids"))):
                if key == current:
                    digest.update(b",")
                else:
                    if current is not None:
                        done.append((least, digest.hexdigest()))
                    current, least, digest = key, first, hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["conv_id", "ends"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([least]), pa.array([digest.hexdigest()])], names=["conv_id", "ends"])

    ordered = lists.repartition("key").sortWithinPartitions("key", "range")
    return ordered.select("key", "least", "ids").mapInArrow(digested, "conv_id long, ends string")


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence: ``n`` conversations, the smallest of them, their digest."""
    alone = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    distinct = convs.groupBy("path", "words").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    return distinct.join(ends_digests(convs), "conv_id").select(
        "conv_id", "path", "words", "n", F.when(F.col("n") == 1, alone).otherwise(F.col("ends")).alias("ends")
    )


def _shared_turns(first: Column, last: Column) -> Column:
    """Turns that two paths have in common from their beginning."""
    n = (F.least(F.length(first), F.length(last)) / ID_BYTES).cast("int")
    same = F.transform(F.sequence(F.lit(0), n - 1), lambda i: part(first, i, 1) == part(last, i, 1))
    differ = F.array_position(same, False).cast("int")
    return F.when(n == 0, 0).when(differ == 0, n).otherwise(differ - 1)


def burst(rows: DataFrame, scratch: Scratch, max_rows: int, max_turns: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffixes in containers small enough to sweep, and the heads above them.

    A row is a distinct sequence with the ``depth`` of its container's top node, the container's
    ``box`` (a digest of the turns above its suffixes), the smallest conversation ``above`` that
    top node, and the boxes of all ``heads`` above.  The first and the last path of a container
    tell the turns all its paths share, so a round bursts through them at once; there are as many
    rounds as one path has branching heads.
    """
    ready, heads = [], []
    while True:
        sizes = rows.groupBy("box").agg(F.count("*").alias("rows"), F.sum(F.length("path") / ID_BYTES - F.col("depth")).alias("turns"))
        large = (F.col("rows") > 1) & ((F.col("rows") > max_rows) | (F.col("turns") > max_turns))
        large_boxes, n = scratch.keep_and_count(sizes.where(large).select("box"), F.lit(True))
        if n == 0:
            ready.append(rows)
            break
        # Few of all containers are too large, at most one in max_rows suffixes.
        small_side = F.broadcast if n <= BROADCAST_HEADS else lambda df: df
        ready.append(rows.join(small_side(large_boxes), "box", "left_anti"))
        inside = rows.join(small_side(large_boxes), "box", "left_semi")
        ends = inside.groupBy("box").agg(
            F.min(F.struct("path", "words")).alias("first"),
            F.max("path").alias("last"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n"),
            F.first("depth").alias("depth"),
            F.first("above").alias("above"),
            F.first("heads").alias("heads"),
        )
        top = scratch.keep(
            ends.withColumn("branch", _shared_turns(F.col("first.path"), F.col("last"))).select(
                "box", "conv_id", "n", "depth", "branch", "above", "heads",
                F.slice(F.col("first.words"), F.lit(1), F.col("branch")).alias("words"),
            )
        )
        heads.append(top)
        branching = top.select("box", "branch", F.col("conv_id").alias("head_conv"))
        met = inside.join(small_side(branching), "box")
        ending = F.length("path") == F.col("branch") * ID_BYTES
        # The one sequence that ends at the branching point belongs to the head itself.
        heads[-1] = scratch.keep(top.join(met.where(ending).select("box", "ends"), "box", "left"))
        below = met.where(~ending).select(
            "conv_id", "path", "words", "n", "ends",
            (F.col("branch") + 1).alias("depth"),
            F.unhex(F.md5(part(F.col("path"), 0, F.col("branch") + 1))).alias("box"),
            F.col("head_conv").alias("above"),
            F.concat("heads", F.array("box")).alias("heads"),
        )
        rows = scratch.keep(below)
    return _union(ready), _union(heads) if heads else None


def _union(parts: list[DataFrame]) -> DataFrame:
    total = parts[0]
    for df in parts[1:]:
        total = total.unionByName(df)
    return total


def sweep_container(depth: int, above: int | None, rows: list[tuple]) -> tuple[list, ...]:
    """Nodes of a container from its sorted rows (path, words, n, conv_id, ends), the top node
    first; by column of ``NODE``."""
    parent, at_depth, words, n, conv, ends = [], [], [], [], [], []
    stack: list[int] = []  # nodes from the top to the last one
    before = b""
    for path, path_words, count, conv_id, digest in rows:
        length = len(path) // ID_BYTES
        shared = depth
        if stack:
            most = min(len(before), len(path))
            at = shared * ID_BYTES
            while at < most and before[at : at + ID_BYTES] == path[at : at + ID_BYTES]:
                at += ID_BYTES
            shared = at // ID_BYTES
            del stack[shared - depth + 1 :]
        for d in range(shared + 1 if stack else depth, length + 1):
            parent.append(stack[-1] if stack else -1)
            stack.append(len(at_depth))
            at_depth.append(d)
            words.append(path_words[d - 1] if d else 0)
            n.append(0)
            conv.append(conv_id)
            ends.append(NO_ENDS)
        last = stack[-1]
        n[last], ends[last] = count, digest
        conv[last] = min(conv[last], conv_id)
        before = path
    size = len(at_depth)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):  # children come behind their parents
        saved[i] += (n[i] - 1) * words[i]
        leaves[i] = leaves[i] or 1
        up = parent[i]
        if up >= 0:
            n[up] += n[i]
            conv[up] = min(conv[up], conv[i])
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    parents = [above if up < 0 else conv[up] for up in parent]
    return conv, at_depth, parents, n, children, leaves, saved, ends


def sweep(rows: DataFrame) -> DataFrame:
    """Nodes of all containers; the top node of each has the ``heads`` above it."""
    dealt = rows.repartition("box").sortWithinPartitions("box", "path")
    columns = ("box", "depth", "above", "heads", "path", "words", "n", "conv_id", "ends")
    kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in NODE.split(", ")] + ["heads"]

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held = None, []  # of the current container: box, depth, above, heads; its rows

        def nodes() -> pa.RecordBatch:
            found = sweep_container(top[1], top[2], held)
            above = [top[3]] + [None] * (len(found[0]) - 1)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*found, above], kinds)], names=names)

        for batch in batches:
            for box, depth, above, heads, *row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if top is None or box != top[0]:
                    if held:
                        yield nodes()
                    top, held = (box, depth, above, heads), []
                held.append(tuple(row))
        if held:
            yield nodes()

    return dealt.select(*columns).mapInArrow(swept, f"{NODE}, heads array<binary>")


def head_nodes(heads: DataFrame, swept: DataFrame) -> DataFrame:
    """Nodes of the heads: each head's chain of turns down to its branching point, with the
    sums over all containers and heads below."""
    tops = swept.where(F.col("heads").isNotNull())
    own = F.aggregate(
        F.slice("words", F.greatest(F.col("depth"), F.lit(1)), F.col("branch") - F.greatest(F.col("depth"), F.lit(1)) + 1),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    below = tops.select("heads", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")).unionByName(
        heads.select("heads", F.lit(0).cast("long").alias("leaves"), (own * (F.col("n") - 1)).alias("saved"))
    )
    sums = (
        below.select(F.posexplode("heads").alias("at", "box"), F.size("heads").alias("size"), "leaves", "saved")
        .groupBy("box")
        .agg(
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
            F.count_if(F.col("at") == F.col("size") - 1).alias("children"),
        )
    )
    chain = heads.join(sums, "box").select(
        "*", F.explode(F.sequence("depth", "branch")).alias("at")
    )
    turn_words = F.when(F.col("at") > 0, F.get("words", (F.col("at") - 1).cast("int"))).otherwise(0).cast("long")
    deeper = W.partitionBy("box").orderBy(F.col("at").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    bottom = F.col("at") == F.col("branch")
    return chain.withColumn("own", F.sum(turn_words * (F.col("n") - 1)).over(deeper)).select(
        "conv_id",
        F.col("at").cast("long").alias("depth"),
        F.when(F.col("at") == F.col("depth"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("own")).alias("saved_tokens"),
        F.when(bottom & F.col("ends").isNotNull(), F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(
    spark: SparkSession, convs: DataFrame, max_rows: int = CONTAINER_ROWS, max_turns: int = CONTAINER_TURNS
) -> DataFrame:
    """The trie of ``convs`` (see ``sequences``), a row per node: the smallest conversation that
    begins with it (``conv_id``), ``depth``, the parent's conversation (null at the root),
    conversations, children and leaves below, ``saved_tokens`` (words of turns that need not be
    stored again) and ``ends_sha256`` of the conversations that end there.

    A conversation without turns ends at the root; without any conversation there is no node.
    The limits choose the plan, never the result.  A conversation's turn ids (20 bytes a
    turn, no texts) travel as one row, as a document's text does.
    """
    with Scratch(spark) as scratch:
        rows = scratch.keep(
            distinct_sequences(scratch.keep(convs)).select(
                "*",
                F.lit(0).alias("depth"),
                F.lit(b"").alias("box"),
                F.lit(None).cast("long").alias("above"),
                F.array().cast("array<binary>").alias("heads"),
            )
        )
        ready, heads = burst(rows, scratch, max_rows, max_turns)
        swept = sweep(ready)
        if heads is None:
            return scratch.result(swept.drop("heads"))
        swept = scratch.keep(swept)
        return scratch.result(swept.drop("heads").unionByName(head_nodes(heads, swept)))
