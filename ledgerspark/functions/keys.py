"""Surrogate keys, and their short form for shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the columns as text, joined with ``-``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(
        F.concat_ws("-", *[F.coalesce(part.cast("string"), F.lit(NULL_MARK)) for part in parts])
    )


# Bytes behind a text that is no digest, so that it never has the length of a packed one.
_PAD = "00" * 17


def pack(key: Column) -> Column:
    """A surrogate key as 16 bytes; any other text as more bytes. Equal only for equal texts.

    Hexadecimal text is stored and shuffled at full length by the fast codecs.
    """
    other = F.concat(key.cast("binary"), F.unhex(F.lit(_PAD)))
    return F.when(key.rlike("^[0-9a-f]{32}\\z"), F.unhex(key)).otherwise(other)


def unpack(packed: Column) -> Column:
    """The text that :func:`pack` was given."""
    size = F.length(packed)
    text = F.substring(packed, F.lit(1), size - len(_PAD) // 2).cast("string")
    return F.when(size == 16, F.lower(F.hex(packed))).otherwise(text)
