"""Scalar column expressions.

All of them compile to Catalyst expressions, so they stay inside whole-stage
codegen and are identical in every task regardless of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# fixed value: the characters Python's str.strip() and regex \s treat as ASCII whitespace
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace (tabs and newlines too, unlike a
    plain ``trim``, which removes spaces only). A character-set trim, no regex."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def blank_or_null(c) -> Column:
    """True when the value is null or only whitespace."""
    col = _col(c)
    return col.isNull() | (strip_ws(col) == F.lit(""))


def ascii_only(c) -> Column:
    """Drop every non-ASCII character (the ``encode('ascii', 'ignore')`` idiom)."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def split_fields(c, sep: str = "\t") -> Column:
    """Split a delimited line keeping trailing empty fields (limit -1)."""
    return F.split(_col(c), sep, -1)


def key_string(key: Sequence[str]) -> Column:
    """Stable text form of a (possibly composite) natural key; a null part has a
    spelling of its own, so such rows are hashed like any other."""
    cols = [F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in key]
    return cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)


def hex_bucket(key: Sequence[str], salt: str, width: int = 8) -> Column:
    """Integer from the first ``width`` hex digits of md5(key || salt)."""
    digest = F.md5(F.concat(key_string(key), F.lit(salt)))
    return F.conv(F.substring(digest, 1, width), 16, 10).cast("bigint")


def hash_unit(key: Sequence[str], salt: str) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from the row key."""
    return hex_bucket(key, salt, 8) / F.lit(4294967296.0)


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(z)))


def entropy_term(p) -> Column:
    """-p ln p, with 0 ln 0 = 0 (natural log)."""
    p = _col(p)
    return F.when(p > 0, -p * F.log(p)).otherwise(F.lit(0.0))
