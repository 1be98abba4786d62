"""Text helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six ASCII white-space characters: space and \\x09-\\x0D.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column used inside a lambda is otherwise evaluated again for every
    element; binding it to the lambda variable of a one-element array is not.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """All words of the text in order; an empty array for null or blank text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` in order, in lists cut at white space about every
    ``size`` bytes, so that a very long text is never split up as one list."""
    at = 0
    while at < len(data):
        stop = len(data)
        if at + size < stop:
            space = _SPACE.search(data, at + size)
            stop = space.end() if space else stop
        yield data[at:stop].split()     # bytes.split(): exactly the six ASCII spaces
        at = stop
