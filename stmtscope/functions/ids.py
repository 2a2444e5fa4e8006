"""Stable 60-bit ids: the same text gives the same id in every run and session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(text: Column) -> Column:
    """First 15 hex digits of the MD5 as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def text_id(text: Column) -> Column:
    """Id of a raw statement text."""
    return stable_id(text)


def norm_id(database_name: Column, norm_text: Column) -> Column:
    """Fingerprint id: normalised text within its database."""
    return stable_id(F.concat(database_name, F.lit(", "), norm_text))
