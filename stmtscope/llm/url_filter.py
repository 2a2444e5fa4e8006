"""URL filter: host rules first, a character language-model ratio for all other URLs.

URLs that a rule decides are the training data: those allowed train one variable-order
Markov model over characters, those blocked another.  Both are smoothed by Witten-Bell
interpolation: a context of k characters gives its own counts as much weight as it has seen
symbols and leaves the rest to the context one character shorter.  A URL's score is the
difference of its two log-likelihoods per character.  A held-out fifth of the training
URLs sets the score from which URLs are allowed.

The log-ratio of a position is a sum over context lengths: what a stored n-gram adds to the
shorter one, or, where the n-gram was never seen, what its context gives away to the shorter
one.  So a lookup table of n-grams and contexts is all that scoring needs.  It is whole at
every size; up to 2**SLOT_BITS rows are broadcast, a larger table is joined by shuffle with
the distinct n-grams of the URLs, whose few frequent ones are broadcast to the rows.
Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stmtscope.llm.scratch import Scratch

ORDER = 3  # characters of context at most
SLOT_BITS = 18
HOT_BITS = 16
BIN = 0.005  # of the calibrated score
SCORE_LIMIT = 20.0  # scores beyond it fall into the outermost bins
UNIFORM = 1.0 / 256  # probability of any character without context
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path, verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ``://``."""
    at = F.coalesce(F.instr(url, F.lit("://")), F.lit(0))
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Longest rule that fits (host and path as one string) and its verdict; else nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def with_ngrams(rows: DataFrame) -> DataFrame:
    """A row per position of ``subject`` and context length: gram, context, order."""
    marked = F.concat(F.lit(START * ORDER), F.col("subject"), F.lit(END))
    chars = rows.withColumn("chars", F.regexp_extract_all(marked, F.lit("(?s)."), F.lit(0)))
    at_position = lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(ORDER)),
        lambda k: F.struct(
            k.alias("order"),
            F.array_join(F.slice("chars", i - k, k), "").alias("context"),
            F.array_join(F.slice("chars", i - k, k + 1), "").alias("gram"),
        ),
    )
    positions = F.sequence(F.lit(ORDER + 1), F.size("chars"))
    exploded = chars.withColumn("n_positions", F.size("chars") - ORDER).withColumn(
        "x", F.explode(F.flatten(F.transform(positions, at_position)))
    )
    return exploded.select(*rows.columns, "n_positions", "x.order", "x.context", "x.gram")


def key_of(kind: str, order: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(kind), order.cast("int"), text)


def train(scratch: Scratch, labelled: DataFrame) -> DataFrame:
    """(key, value) of n-grams and contexts, from ``labelled`` (subject, verdict, n)."""
    weight = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, F.col("n")).otherwise(0))
    grams = (
        with_ngrams(labelled)
        .groupBy("order", "context", "gram")
        .agg(weight("allow").alias("allow"), weight("block").alias("block"))
    )
    same_context = Window.partitionBy("order", "context")
    for side in ("allow", "block"):
        grams = grams.withColumn(f"{side}_n", F.sum(side).over(same_context)).withColumn(
            f"{side}_types", F.count(F.when(F.col(side) > 0, True)).over(same_context)
        )
    grams = scratch.keep(grams)

    def probability(side: str, shorter: Column) -> Column:
        n, types = F.col(f"{side}_n"), F.col(f"{side}_types")
        return F.when(n > 0, (F.col(side) + types * shorter) / (n + types)).otherwise(shorter)

    def given_away(side: str) -> Column:
        n, types = F.col(f"{side}_n"), F.col(f"{side}_types")
        return F.when(n > 0, F.log(types / (n + types))).otherwise(0.0)

    levels, ratio = [], F.log(F.col("allow_p")) - F.log(F.col("block_p"))
    shorter = None
    for order in range(ORDER + 1):
        level = grams.where(F.col("order") == order)
        if shorter is None:
            level = level.withColumns({"allow_q": F.lit(UNIFORM), "block_q": F.lit(UNIFORM), "ratio_q": F.lit(0.0)})
        else:
            level = level.withColumn("suffix", F.substring("gram", 2, order)).join(shorter, "suffix").drop("suffix")
        level = level.withColumns({f"{s}_p": probability(s, F.col(f"{s}_q")) for s in ("allow", "block")})
        level = scratch.keep(level.withColumn("ratio", ratio))
        shorter = level.select(
            F.col("gram").alias("suffix"),
            F.col("allow_p").alias("allow_q"),
            F.col("block_p").alias("block_q"),
            F.col("ratio").alias("ratio_q"),
        )
        levels.append(
            level.select(
                key_of("gram", F.col("order"), F.col("gram")).alias("key"),
                (F.col("ratio") - F.col("ratio_q")).alias("value"),
            )
        )
        levels.append(
            level.groupBy("order", "context")
            .agg(F.first(given_away("allow") - given_away("block")).alias("value"))
            .select(key_of("context", F.col("order"), F.col("context")).alias("key"), "value")
        )
    table = levels[0]
    for other in levels[1:]:
        table = table.unionByName(other)
    return scratch.keep(table)


def looked_up(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``grams`` (gram_key, context_key and other columns) with what each adds to the log-ratio."""
    found = grams.join(
        model.select(F.col("key").alias("gram_key"), F.col("value").alias("gram_value")), "gram_key", "left"
    ).join(model.select(F.col("key").alias("context_key"), F.col("value").alias("context_value")), "context_key", "left")
    value = F.coalesce("gram_value", "context_value", F.lit(0.0))
    return found.withColumn("value", value).drop("gram_value", "context_value")


def scored(scratch: Scratch, rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` (subject and other columns) with ``score``, the log-ratio per character.

    A model of up to 2**SLOT_BITS rows is broadcast.  A larger one meets each distinct n-gram
    of the rows once.  Of these, the frequent ones (at least one in 2**HOT_BITS of all
    positions and orders, so at most 2**HOT_BITS in number) are then broadcast to the rows, and
    the others, none of which is frequent, are joined by shuffle.
    """
    columns = rows.columns
    small = model.count() <= 1 << SLOT_BITS  # rows of two numbers
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if not small:
        rows = scratch.keep(rows)
    grams = with_ngrams(rows).select(
        "row",
        *columns,
        "n_positions",
        key_of("gram", F.col("order"), F.col("gram")).alias("gram_key"),
        key_of("context", F.col("order"), F.col("context")).alias("context_key"),
    )
    if small:
        found = looked_up(grams, F.broadcast(model)).groupBy("row", *columns, "n_positions")
        summed = found.agg(F.sum("value").alias("total"))
    else:
        distinct = grams.groupBy("gram_key", "context_key").agg(F.count("*").alias("n"))
        distinct = scratch.keep(looked_up(distinct, model.hint("merge")))
        total = distinct.agg(F.sum("n")).first()[0] or 0
        frequent = F.col("n") * (1 << HOT_BITS) >= total
        hot = distinct.where(frequent).select("gram_key", F.col("value").alias("hot_value"))
        # Numbers of the row only: the texts stay where they are until the sums come back.
        keys = grams.select("row", "gram_key").join(F.broadcast(hot), "gram_key", "left")
        rare = keys.where("hot_value IS NULL").join(
            distinct.where(~frequent).select("gram_key", "value").hint("merge"), "gram_key"
        )
        parts = keys.where("hot_value IS NOT NULL").select("row", F.col("hot_value").alias("value")).unionByName(
            rare.select("row", "value")
        )
        totals = parts.groupBy("row").agg(F.sum("value").alias("total"))
        n_positions = F.size(F.regexp_extract_all(F.concat("subject", F.lit(END)), F.lit("(?s)."), F.lit(0)))
        summed = rows.join(totals, "row").withColumn("n_positions", n_positions)
    return summed.select(*columns, (F.col("total") / F.col("n_positions")).alias("score"))


def calibrate(scratch: Scratch, labelled: DataFrame, model: DataFrame) -> float:
    """Score from which URLs are allowed: the one with the best mean of the two classes'
    hit rates (of several, the lowest), in the middle between the scores next to it.  0 if a
    class is missing."""
    score = F.greatest(F.lit(-SCORE_LIMIT), F.least(F.lit(SCORE_LIMIT), F.col("score")))
    bins = (
        scored(scratch, labelled, model)
        .groupBy(F.floor(score / BIN).alias("bin"))
        .agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("allow"),
            F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("block"),
        )
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 * SCORE_LIMIT / BIN + 1 bins
    everything = Window.partitionBy()
    missed = lambda side: F.try_divide(F.coalesce(F.sum(side).over(below), F.lit(0)), F.sum(side).over(everything))
    before = F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))
    rates = bins.select(
        "bin", ((before + F.col("bin")) / 2).alias("middle"), (1 - missed("allow") + missed("block")).alias("rate")
    )
    best = rates.where("rate IS NOT NULL").orderBy(F.desc("rate"), "bin").first()
    return best["middle"] * BIN if best else 0.0


def filter_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row of ``pages`` (``page_id``, ``url``; other columns are ignored) with host,
    path, rule (null where none fits), verdict (allow or block) and score.

    Without a fitting rule, URLs that score at least the calibrated value are allowed.  A
    null URL, or one without ``://``, has an empty host and path and is scored as such; if
    no URL meets a rule of either kind, all scores are 0 and everything is allowed.
    """
    with Scratch(pages.sparkSession) as scratch:
        host, path = host_and_path(F.col("url"))
        parts = pages.select("page_id", host.alias("host"), path.alias("path"))
        rule, decided = rule_of(F.col("host"), F.col("path"), rules)
        judged = parts.withColumns({"rule": rule, "decided": decided})
        subject = F.concat("host", "path")
        labelled = scratch.keep(
            judged.where("decided IS NOT NULL")
            .groupBy(subject.alias("subject"), F.col("decided").alias("verdict"))
            .agg(F.count("*").alias("n"))
        )
        held_out = F.crc32(F.encode("subject", "utf-8")) % 5 == 0
        model = train(scratch, labelled.where(~held_out))
        threshold = calibrate(scratch, labelled.where(held_out), model)
        found = scored(scratch, judged.withColumn("subject", subject), model)
        verdict = F.coalesce("decided", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
        return scratch.result(found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score"))
