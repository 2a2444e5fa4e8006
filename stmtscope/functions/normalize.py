"""Statement text normalisation as built-in column expressions (no UDF).

A statement is rewritten so that executions differing only in literals, comments
or spacing get the same text:

* string literals become ``{STR}``, integer/decimal/hex literals ``{##}``;
* real (``1e5``) and money (``$5``) literals, names and ``@params`` stay;
* comments, which may nest, go, runs of whitespace become one space, the ends are trimmed and a
  minus sign directly before ``{##}`` is dropped;
* after a dynamic-SQL call name (``sp_executesql...`` or ``sp_prepare``) the next
  string literal is the statement itself, so it is kept.

Each of the three rewrites is one ``regexp_replace`` of the form
``\\G(tokens to keep)(token to replace)``: ``\\G`` ties every match to the end of
the one before, so text is always consumed token by token and a quote inside a
comment, or a digit inside a name, is never mistaken for a literal.  All
quantifiers are possessive: matching is linear in the text and needs no stack, so
very long statements are safe.  ``regexp_replace`` is code-generated, so the whole
load stays in one generated stage.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from stmtscope.functions.comments import flat_comments
from stmtscope.schema import (
    BATCH,
    EXECUTE_PREFIX,
    EXECUTE_SQL_PREFIX,
    NUMBER_MARK,
    PREPARE_CALL,
    RPC,
    STRING_MARK,
)

# Whitespace, as the body of a character class: ASCII controls 9-13, next-line and
# the Unicode separators.
SPACE = r"\t-\r\x{85}\p{Z}"

# Character classes.  ASCII members are written out one by one: the regex engine tests
# such a class with a single table look-up, and a range or property with a call each.
_DIGITS = string.digits
_START = "@#_" + string.ascii_letters
_PART = _START + "$" + _DIGITS
_WIDE_PART = _PART + r"\p{L}\p{Nd}"
# The other ASCII characters that are tokens by themselves.
_PUNCTUATION = r"\t\n\x0B\f\r !%&()*+,:;<=>?\]\\^`{|}~"


def _any(*tokens: str) -> str:
    return "(?:" + "|".join(tokens) + ")"


# --- tokens.  An open quote, bracket or comment runs to the end of the text. ---
_NAME = rf"(?:[{_START}][{_PART}]*+|\p{{L}})(?:[\p{{L}}\p{{Nd}}][{_WIDE_PART}]*+)?+"
_STRING = r"[Nn]?+'[^']*+(?:''[^']*+)*+(?:'|\z)"
_BRACKETED = r"\[[^\]]*+(?:\]\][^\]]*+)*+(?:\]|\z)"
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+(?:"|\z)'
_LINE_COMMENT = r"--[^\r\n]*+"
_BLOCK_COMMENT = r"/\*[^*]*+(?:\*(?!/)[^*]*+)*+(?:\*/|\z)"
_HEX = rf"0[xX][{string.hexdigits}]*+"
_MONEY = rf"\p{{Sc}}[.{_DIGITS}]++"
_REAL = rf"(?:[{_DIGITS}]++\.?+[{_DIGITS}]*+|\.[{_DIGITS}]++)[eE][+-]?+[{_DIGITS}]++"
_DECIMAL = rf"[{_DIGITS}]++\.?+[{_DIGITS}]*+|\.[{_DIGITS}]++"
# Signs that start no token here, control characters, and the rest of Unicode.
_LONE = (
    rf"-(?!-)|/(?!\*)|\.(?![{_DIGITS}])|\p{{Sc}}(?![.{_DIGITS}])"
    r"|[\x00-\x08\x0E-\x1F\x7F]|[^\x00-\x7F\p{L}\p{Sc}]"
)
# The tokens that every pass but the last keeps, the most frequent first.
_KEPT = [
    rf"[{_PUNCTUATION}]++",
    rf"(?![Nn]'){_NAME}",
    _REAL,
    _BRACKETED,
    _QUOTED,
    _LINE_COMMENT,
    _BLOCK_COMMENT,
    _MONEY,
    _LONE,
]

# --- pass 1: string literals ---
_NOT_STRING = _any(*_KEPT, _HEX, _DECIMAL)
STRING_PASS = rf"\G({_NOT_STRING}*+)(?:{_STRING})"
# A dynamic-SQL call name with everything up to and including its statement.
_CALL = (
    rf"(?:{EXECUTE_SQL_PREFIX}[{_WIDE_PART}]*+|{PREPARE_CALL}(?![{_WIDE_PART}]))"
    rf"{_NOT_STRING}*+(?:{_STRING})?+"
)
DYNAMIC_STRING_PASS = rf"\G({_any(_CALL, _NOT_STRING)}*+)(?:{_STRING})"

# --- pass 2: numbers (any string still present is a kept dynamic statement) ---
NUMBER_PASS = rf"\G({_any(*_KEPT, _STRING)}*+)(?:{_HEX}|{_DECIMAL})"

# --- pass 3: comments ---
_NOT_COMMENT = _any(r"[^'\"\[/\-]++", _STRING, _BRACKETED, _QUOTED, r"-(?!-)", r"/(?!\*)")
COMMENT_PASS = rf"\G({_NOT_COMMENT}*+)(?:{_LINE_COMMENT}|{_BLOCK_COMMENT})"

# A text in which every quote, bracket and block comment is closed.
BALANCED = (
    r"\A(?:[^'\"\[/\-]++|-(?!-)|/(?!\*)|--[^\r\n]*+|'[^']*+'|\[[^\]]*+(?:\]\][^\]]*+)*+\]"
    r'|"[^"]*+"'
    r"|/\*[^*]*+(?:\*(?!/)[^*]*+)*+\*/)*+\z"
)

# --- pass 4: whitespace, where it is not a single space already ---
SPACE_PASS = rf" [{SPACE}]++|[{SPACE}&&[^ ]][{SPACE}]*+"


def _replace(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def is_balanced(text: Column) -> Column:
    """Whether every quote, bracket and (nested) block comment of a statement is closed."""
    return F.rlike(flat_comments(F.coalesce(text, F.lit(""))), F.lit(BALANCED))


def normalize_sql(text: Column, reject_unbalanced: bool = False, flat: Column | None = None) -> Column:
    """Literal-, comment- and spacing-free form of a statement; NULL gives ''.

    Block comments nest.  With ``reject_unbalanced`` a statement that leaves a quote, a bracket
    or a comment open gives '' too, as a parser that rejects it would.  ``flat`` is the text without
    nested comments, if it is a column already: the fold behind ``flat_comments`` is not
    code-generated, and a column of its own keeps the rest in generated code.
    """
    raw = F.coalesce(text, F.lit(""))
    flat = flat_comments(raw) if flat is None else flat

    def has(part: str) -> Column:
        return F.contains(raw, F.lit(part))

    dynamic = has(EXECUTE_SQL_PREFIX) | has(PREPARE_CALL)
    x = (
        F.when(~has("'"), flat)
        .when(dynamic, _replace(flat, DYNAMIC_STRING_PASS, "$1" + STRING_MARK))
        .otherwise(_replace(flat, STRING_PASS, "$1" + STRING_MARK))
    )
    x = _replace(x, NUMBER_PASS, "$1" + NUMBER_MARK)
    x = F.when(has("--") | has("/*"), _replace(x, COMMENT_PASS, "$1")).otherwise(x)
    x = F.trim(_replace(x, SPACE_PASS, " "))
    x = F.replace(x, F.lit("-" + NUMBER_MARK), F.lit(NUMBER_MARK))
    return F.when(F.rlike(flat, F.lit(BALANCED)), x).otherwise(F.lit("")) if reject_unbalanced else x


def qualified_name(text: Column, object_name: Column) -> Column:
    """Schema-qualified procedure name: the space-delimited word of the call text that
    holds the first occurrence of ``object_name``.

    A text with fewer than two spaces gives the bare object name; a name that is not
    enclosed by two spaces gives ''.
    """
    space = F.lit(" ")
    text = F.coalesce(text, F.lit(""))
    name = F.coalesce(object_name, F.lit(""))
    at = F.position(name, text)
    head = F.substring(text, F.lit(1), at - 1)
    tail = F.substring(text, at, F.length(text))
    word = F.concat(F.substring_index(head, " ", -1), F.substring_index(tail, " ", 1))
    enclosed = (
        (F.length(name) > 0)
        & (at > 0)
        & F.contains(head, space)
        & F.contains(tail, space)
        & ~F.startswith(name, space)
    )
    few_spaces = F.length(text) - F.length(F.replace(text, space, F.lit(""))) < 2
    return (
        F.when(few_spaces, name)
        .when(enclosed, F.regexp_replace(word, rf"^[{SPACE}]+|[{SPACE}]+$", ""))
        .otherwise(F.lit(""))
    )


def fingerprint_text(
    event_type: Column,
    object_name: Column,
    text: Column,
    capture_schema_name: bool = False,
    reject_unbalanced: bool = False,
    flat: Column | None = None,
) -> Column:
    """Text that identifies a statement.

    Batches and dynamic-SQL calls are normalised; any other procedure call is known by
    its name alone, or by its qualified name when ``capture_schema_name`` is set.
    """
    name = F.coalesce(object_name, F.lit(""))
    dynamic = F.startswith(name, F.lit(EXECUTE_PREFIX)) | (name == PREPARE_CALL)
    plain_call = (event_type == RPC) & ~dynamic
    called = qualified_name(text, name) if capture_schema_name else name
    return F.when(plain_call, called).otherwise(normalize_sql(text, reject_unbalanced, flat))


def statement_text(event_type: Column, statement: Column, batch_text: Column) -> Column:
    """Raw statement text of an event; NULL text is ''."""
    raw = F.when(event_type == BATCH, batch_text).otherwise(statement)
    return F.coalesce(raw, F.lit(""))
