"""Expressions on texts that several operators share.  White space is ``[\\x20\\x09-\\x0D]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(text, F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as no column of the frame has."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def with_text(df: DataFrame, kept: list[str]) -> tuple[DataFrame, int]:
    """The kept columns for tasks that read the text, and the place of the text among them.

    A kept column of strings is the text itself and is sent once, null where it is null; else
    the text comes as one more column behind the others.
    """
    at = [c.lower() for c in kept].index("text") if "text" in map(str.lower, kept) else -1
    if at >= 0 and df.select(kept[at]).schema[0].dataType == T.StringType():
        return df.select(*kept), at
    (text,) = free_names(df, "whole_text")
    return df.select(*kept, whole(F.col("text")).alias(text)), len(kept)


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is.  ``lower`` does that for texts of ASCII alone."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def partitions(spark) -> int:
    """The session's number of shuffle partitions, which grows with the cluster and the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
