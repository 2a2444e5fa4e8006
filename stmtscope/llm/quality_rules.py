"""Quality rules: plain text measures, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are estimated: one from the whole corpus, one from its
trusted documents.  A document's score is the mean, over its n-grams, of the logarithm of
trusted over corpus probability; every document whose score reaches a fixed threshold
passes.  The n-grams are single words and pairs of neighbouring word shapes (runs of small
letters, of capitals and of digits become one character each), so that also words never seen
before count by how they are written.

Everything is a DataFrame expression.  Counting shuffles sums per slot; scoring is a narrow
pass in which each task holds the table of ``SLOTS`` weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import Scratch

SLOTS = 1 << 16
SMOOTHING = 4.0  # added to every slot's count
THRESHOLD = -0.4  # mean log-ratio of an n-gram
WINDOW = 5  # words
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def shapes_of(text: Column) -> Column:
    """The words of the text with runs of small letters, of capitals and of digits shrunk."""
    letters = F.regexp_replace(F.regexp_replace(text, r"\p{Ll}+", "a"), r"\p{Lu}+", "A")
    return words_of(F.regexp_replace(letters, "[0-9]+", "0"))


def slots_of(words: Column, shapes: Column) -> Column:
    """Slot of each n-gram."""
    slot = lambda *x: F.pmod(F.xxhash64(*x), F.lit(SLOTS)).cast("int")
    single = F.transform(words, lambda w: slot(w))
    pairs = F.transform(
        F.slice(shapes, 2, F.greatest(F.size(shapes) - 1, F.lit(0))),
        lambda s, i: slot(F.lit(1), F.get(shapes, i), s),
    )
    return F.concat(single, pairs)


def repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``words``) plus ``n_repeat_words``: words inside windows of ``WINDOW``
    words that the text holds at least twice.  Windows are compared by 64-bit hash."""
    words = F.col("words")
    at = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    docs = docs.withColumn("windows", F.when(F.size("words") >= WINDOW, hashes))
    # Only texts with a repeat are ordered by window.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    docs = docs.withColumn("ordered", F.when(repeats, ordered))
    same = lambda x, i: F.get(F.col("ordered"), i)["h"].eqNullSafe(x["h"])
    spots = F.transform(
        F.filter("ordered", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"]
    )
    covered = F.aggregate(
        F.sort_array(spots),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda state, spot: F.struct(
            (spot + WINDOW).alias("end"), (state["n"] + spot + WINDOW - F.greatest(spot, state["end"])).alias("n")
        ),
        lambda state: state["n"],
    )
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("windows", "ordered")


def weights(scratch: Scratch, docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: the log-ratio of every slot, as an array.  ``docs`` (doc_id, text) is the
    corpus, ``trusted`` (doc_id) names the target documents."""
    # Labels grow with the corpus, so both sides are dealt by doc_id whatever their size.
    targets = trusted.select("doc_id", F.lit(1).alias("is_trusted")).distinct().hint("shuffle_hash")
    marked = docs.join(targets, "doc_id", "left")
    # Columns of their own, so that the lambdas below do not split the text again per word.
    split = marked.select("is_trusted", words_of(F.col("text")).alias("words"), shapes_of(F.col("text")).alias("shapes"))
    counts = scratch.keep(
        split.select("is_trusted", F.explode(slots_of(F.col("words"), F.col("shapes"))).alias("slot"))
        .groupBy("slot")
        .agg(F.count("*").alias("corpus"), F.count("is_trusted").alias("target"))
    )
    every = docs.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    totals = counts.agg(F.sum("corpus").alias("corpus_n"), F.sum("target").alias("target_n"))
    corpus_n, target_n = (x or 0 for x in totals.first())
    share = lambda name, n: (F.coalesce(name, F.lit(0)) + SMOOTHING) / (n + SMOOTHING * SLOTS)
    # Without trusted documents there is nothing to hold against any document.
    ratio = F.log(share("target", target_n) / share("corpus", corpus_n)) if target_n else F.lit(0.0)
    table = every.join(counts, "slot", "left").select("slot", ratio.alias("weight"))
    in_order = F.sort_array(F.collect_list(F.struct("slot", "weight")))  # SLOTS entries
    return scratch.keep(table.agg(F.transform(in_order, lambda x: x["weight"]).alias("weights")))


def quality_rules(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``; other columns are ignored) with n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept.

    A null text has no words.  ``score`` is 0 for a text without words; such texts fail the
    base rules anyway.  Rows of equal text get equal results; a row without doc_id is judged
    like any other but is never trusted.
    """
    with Scratch(docs.sparkSession) as scratch:
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        table = weights(scratch, docs, trusted)
        model = scratch.spark.createDataFrame(table.collect(), table.schema)  # SLOTS numbers
        lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        split = docs.select(
            "doc_id",
            F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            lines.alias("lines"),
            words_of(F.col("text")).alias("words"),
            shapes_of(F.col("text")).alias("shapes"),
        )
        measured = repeated_words(split).select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            "n_repeat_words",
            slots_of(F.col("words"), F.col("shapes")).alias("slots"),
        )
        total = F.aggregate("slots", F.lit(0.0), lambda sum_, slot: sum_ + F.get(F.col("weights"), slot))
        judged = measured.withColumn("weights", model.scalar()).withColumns(
            {
                "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
                "score": F.when(F.size("slots") > 0, total / F.size("slots")).otherwise(0.0),
            }
        )
        return judged.select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.col("score") >= THRESHOLD)).alias("kept"),
            "score",
        )
