"""Text expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Unicode and Python's str.split() count as white space. Java's \s is ASCII only.
SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


#: The same with an ASCII and range test first, which Java's matcher decides faster on ordinary text.
SPACES = r"[\x09-\x20\x{85}-\x{3000}&&" + SPACE + "]+"

#: The same characters as a string.
SPACE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body uses it. A null value stays null inside."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode white space included."""
    return F.trim(c, F.lit(SPACE_CHARS))


def collapse(c: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def content_hash(c: Column) -> Column:
    """SHA-256 of the text with white space collapsed; null for null."""
    return F.sha2(collapse(c), 256)
