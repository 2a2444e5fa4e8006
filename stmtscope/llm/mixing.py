"""Mixing sources to target weights by temperature.

A source with the token share p gets a weight in proportion to p**a.  The exponent a lies
between 0 (all sources alike) and 1 (shares as they are); bisection finds the smallest one
at which no source is repeated more than ``max_repeats`` times or, if an entropy is asked
for, the largest one at which the weights reach it.  The weights times the budget are the
sources' token budgets.

A budget is realised as a sequence of blocks.  A source's documents are dealt by hash to as
many blocks as the root of the number of all documents.  In every epoch the blocks come in an order of
their own, and documents in each block too.  Whole epochs take everything; the last one
takes the longest beginning of its sequence that fits the rest of the budget, to the
document.  Only block sums and the documents of one block per source are ever ordered, so no
source, however large, meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stmtscope.llm.scratch import Scratch

LEVELS = 5  # bisection steps per pass over the sources
PASSES = 5
WORDS = r"[^\x20\x09-\x0D]+"


def key_of(*parts: Column | str) -> Column:
    """Hash by which blocks and documents are ordered."""
    return F.md5(F.concat_ws("|", *parts))


def bisect(sources: DataFrame, wanted) -> float:
    """Smallest exponent on the grid of 2**-(LEVELS * PASSES) for which ``wanted(sums)`` is true,
    or 1; ``sums`` holds the exponent ``a``, ``z`` (sum of p**a), ``zl`` (sum of p**a * ln p) and
    the least and largest share.  One pass evaluates all midpoints of ``LEVELS`` steps."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * i / 2**LEVELS for i in range(2**LEVELS)]
        weight = lambda a: F.pow("share", F.lit(a))
        found = sources.agg(
            F.min("share").alias("least"),
            F.max("share").alias("most"),
            *[F.sum(weight(a)).alias(f"z{i}") for i, a in enumerate(points)],
            *[F.sum(weight(a) * F.log("share")).alias(f"zl{i}") for i, a in enumerate(points)],
        ).first()
        if found["least"] is None:
            return 1.0
        a_step = (high - low) / 2**LEVELS
        i = next(
            (
                i
                for i, a in enumerate(points)
                if wanted({"a": a, "z": found[f"z{i}"], "zl": found[f"zl{i}"], "least": found["least"], "most": found["most"]})
            ),
            2**LEVELS,
        )
        if i == 0:
            return low
        low, high = low + (i - 1) * a_step, low + i * a_step
    return high


def entropy(sums: dict) -> float:
    """Of the weights p**a / z."""
    return math.log(sums["z"]) - sums["a"] * sums["zl"] / sums["z"]


def plan(scratch: Scratch, sized: DataFrame, budget: float | None, max_repeats: float, entropy_at_least: float | None):
    """Per source: its weight and how many whole epochs and further tokens it gets, from
    ``sized`` (source, n_tokens)."""
    totals = scratch.keep(sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(total or 1)))

    def tokens_per_weight(sums: dict) -> float:
        """Budget in shares of all tokens, over z.  Without a budget the largest source
        comes exactly once."""
        return budget / sums["z"] if budget is not None else sums["most"] ** (1 - sums["a"])

    if entropy_at_least is None:
        a = bisect(shares, lambda s: tokens_per_weight(s) * s["least"] ** (s["a"] - 1) <= max_repeats)
    else:
        a = bisect(shares, lambda s: entropy(s) < entropy_at_least)
        sums = shares.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.sum(F.pow("share", F.lit(a)) * F.log("share")).alias("zl")).first()
        if a > 0 and sums["z"] and entropy({"a": a, **sums.asDict()}) < entropy_at_least:
            a -= 2.0 ** -(LEVELS * PASSES)
    sums = shares.agg(
        F.sum(F.pow("share", F.lit(a))).alias("z"), F.max("share").alias("most")
    ).first()
    if sums["z"] is None:
        rate = 0.0
    else:
        rate = tokens_per_weight({"a": a, "z": sums["z"], "most": sums["most"]})
    # Rounded, so that a whole number of epochs is not missed by the last bit.
    wanted = F.round(F.pow("share", F.lit(a)) * rate * total, 3)
    planned = shares.select(
        "source",
        F.round(F.pow("share", F.lit(a)) / F.lit(sums["z"] or 1.0), 9).alias("weight"),
        F.floor(wanted / F.col("tokens")).cast("int").alias("epochs"),
        F.floor(wanted - F.floor(wanted / F.col("tokens")) * F.col("tokens")).cast("long").alias("rest"),
    )
    # Sources without any token cost nothing and come once.
    free = totals.where("tokens = 0").select(
        "source", F.lit(0.0).alias("weight"), F.lit(1).alias("epochs"), F.lit(0).cast("long").alias("rest")
    )
    return planned.unionByName(free), a


def mix(
    docs: DataFrame,
    budget: float | None = 1.0,
    max_repeats: float = 4.0,
    entropy_at_least: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, and ``text`` or ``n_tokens``), each as often as
    the mixture takes it, with epoch (from 0), block, block_rank (place of the block in its
    source's epoch, from 1), n_tokens and weight (of the source).

    ``budget`` is in shares of all tokens; None takes what is needed for the largest source to
    come exactly once, so that no row is lost.  Tokens are words, unless n_tokens is given.
    A null source counts as the empty name, a null text has no tokens.  Rows with equal doc_id
    are rows of their own, ordered as one.  Columns of ``docs`` other than those are kept;
    columns named like the new ones are replaced.
    """
    with Scratch(docs.sparkSession) as scratch:
        n_tokens = F.col("n_tokens") if "n_tokens" in docs.columns else F.regexp_count("text", F.lit(WORDS))
        docs = docs.select(
            *[c for c in docs.columns if c not in ("n_tokens", "epoch", "block", "block_rank", "weight")],
            F.coalesce(n_tokens.cast("long"), F.lit(0)).alias("n_tokens"),
        )
        name = F.coalesce("source", F.lit("")).alias("mix_source")
        doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc")
        n_blocks = math.ceil(math.sqrt(docs.count())) or 1
        block = F.pmod(F.conv(F.substring(key_of(doc.cast("string")), 1, 12), 16, 10).cast("long"), F.lit(n_blocks))
        sized = scratch.keep(docs.select(name, doc, block.alias("block"), "n_tokens"))
        planned, a = plan(scratch, sized.withColumnRenamed("mix_source", "source"), budget, max_repeats, entropy_at_least)
        planned = scratch.keep(planned.withColumnRenamed("source", "mix_source"))

        text = lambda c: F.col(c).cast("string")
        last_epoch = key_of("mix_source", text("block"), text("epochs"))
        in_source = Window.partitionBy("mix_source").orderBy(last_epoch, "block").rowsBetween(Window.unboundedPreceding, 0)
        blocks = scratch.keep(
            sized.groupBy("mix_source", "block")
            .agg(F.sum("n_tokens").alias("tokens"))
            .join(planned, "mix_source")
            .withColumn("until", F.sum("tokens").over(in_source))
            .withColumn("whole", (F.col("rest") > 0) & (F.col("until") <= F.col("rest")))
            .withColumn("partly", (F.col("until") > F.col("rest")) & (F.col("until") - F.col("tokens") < F.col("rest")))
        )
        # The block in which a source's budget ends: its documents in order, up to the last that fits.
        cut = blocks.where("partly").select(
            "mix_source", "block", "epochs", (F.col("rest") - F.col("until") + F.col("tokens")).alias("room")
        )
        ordered = sized.join(cut, ["mix_source", "block"]).withColumn("key", key_of(text("doc"), text("epochs")))
        in_block = Window.partitionBy("mix_source").orderBy("key", "doc")  # equal documents stand and fall together
        ends = (
            ordered.withColumn("until", F.sum("n_tokens").over(in_block))
            .where("until <= room")
            .groupBy("mix_source")
            .agg(F.max(F.struct("key", "doc")).alias("end"))
        )
        in_epoch = Window.partitionBy("mix_source", "epoch").orderBy(key_of("mix_source", text("block"), text("epoch")), "block")
        turns = (
            blocks.join(ends, "mix_source", "left")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
            .withColumn("block_rank", F.row_number().over(in_epoch))
            .withColumn("cut", (F.col("epoch") == F.col("epochs")) & F.col("partly"))
            .where("epoch < epochs OR whole OR cut")
            .groupBy("mix_source", "block", "weight")
            .agg(F.collect_list(F.struct("epoch", "block_rank", "cut", "end")).alias("turns"))
        )
        turns = scratch.result(turns)
    own = [c for c in docs.columns if c != "n_tokens"]
    turn = F.col("turn")
    place = F.struct(key_of(text("doc"), turn["epoch"].cast("string")).alias("key"), F.col("doc"))
    return (
        docs.withColumns({"mix_source": name, "doc": doc, "block": block})
        .join(turns, ["mix_source", "block"])
        .withColumn("turn", F.explode("turns"))
        .where(~turn["cut"] | F.coalesce(place <= turn["end"], F.lit(False)))
        .select(*own, "n_tokens", turn["epoch"].alias("epoch"), "block", turn["block_rank"].alias("block_rank"), "weight")
    )
