"""Nested block comments, as built-in column expressions (no UDF).

A regular expression cannot count, so a text in which a comment opens inside a comment is
folded over its atoms (a sign that may matter, or all between two such signs) with a small state:
where it is, and the sign before.  Outside comments it follows quotes, brackets and line
comments, inside it counts openings and closings.  The fold writes the text with each such comment
emptied, after which no comment nests.  It runs block by block, so that only a block's part of
the text is appended to at a time; no depth is too large.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A comment that opens inside a comment.  Possessive, and each try ends at the next opening or
# closing, so the search is linear.
NESTED = r"/\*(?:[^*/]++|\*(?!/)|/(?!\*))*+/\*"
ATOM = r"[/*'\"\[\]\-\r\n]|[^/*'\"\[\]\-\r\n]++"
BLOCK = 512  # atoms folded at a time

# Where the fold is; a positive number is the depth of a block comment.
CODE, STRING, BRACKET, QUOTED, LINE = 0, -1, -2, -3, -4


def _state(mode: Column, before: Column, out: Column) -> Column:
    return F.struct(mode.cast("int").alias("mode"), before.alias("before"), out.alias("out"))


def _step(state: Column, atom: Column) -> Column:
    mode, before, out = state["mode"], state["before"], state["out"]
    none = F.lit("")
    copied = F.concat(out, atom)

    def to(new: int | Column, sign: Column = none, text: Column = copied) -> Column:
        return _state(F.lit(new) if isinstance(new, int) else new, sign, text)

    code = (
        F.when((before == "]") & (atom == "]"), to(BRACKET))  # a doubled bracket goes on
        .when(atom == "'", to(STRING))
        .when(atom == '"', to(QUOTED))
        .when(atom == "[", to(BRACKET))
        .when((before == "-") & (atom == "-"), to(LINE))
        .when((before == "/") & (atom == "*"), to(1))
        .when((atom == "/") | (atom == "-"), to(CODE, atom))
        .otherwise(to(CODE))
    )
    closes = (before == "*") & (atom == "/")
    comment = (
        F.when(closes & (mode == 1), to(CODE, none, F.concat(out, F.lit("*/"))))
        .when(closes, to(mode - 1, none, out))
        .when((before == "/") & (atom == "*"), to(mode + 1, none, out))
        .when((atom == "*") | (atom == "/"), to(mode, atom, out))
        .otherwise(to(mode, none, out))
    )
    return (
        F.when(mode > 0, comment)
        .when(mode == CODE, code)
        .when(mode == BRACKET, F.when(atom == "]", to(CODE, atom)).otherwise(to(mode)))
        .when(
            ((mode == STRING) & (atom == "'"))
            | ((mode == QUOTED) & (atom == '"'))
            | ((mode == LINE) & ((atom == "\r") | (atom == "\n"))),
            to(CODE),
        )
        .otherwise(to(mode))
    )


def _folded(atoms: Column) -> Column:
    start = _state(F.lit(CODE), F.lit(""), F.lit(""))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(atoms) - 1) / BLOCK).cast("int")),
        lambda i: F.slice(atoms, i * BLOCK + 1, F.lit(BLOCK)),
    )

    def block(state: Column, some: Column) -> Column:
        begin = _state(state["mode"], state["before"], F.lit(""))
        return F.aggregate(some, begin, _step, lambda s: _state(s["mode"], s["before"], F.concat(state["out"], s["out"])))

    return F.aggregate(blocks, start, block, lambda s: s["out"])


def has_nested_comment(text: Column) -> Column:
    """Whether a comment may open inside a comment (or inside a quoted text that looks so)."""
    return F.contains(text, F.lit("/*")) & F.rlike(text, F.lit(NESTED))


def flat_comments(text: Column) -> Column:
    """``text`` with every block comment that holds others emptied.  A comment that is never
    closed is emptied to the end of the text and stays open."""
    # The atoms are bound to a name, so they are cut once.
    atoms = F.array(F.regexp_extract_all(text, F.lit(ATOM), F.lit(0)))
    return F.when(has_nested_comment(text), F.element_at(F.transform(atoms, _folded), 1)).otherwise(text)
