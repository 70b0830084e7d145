"""Text functions whose edge cases differ from Spark's nearest built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as blank (all code points up to the space) and as ASCII.
BLANK = "".join(map(chr, range(0x21)))
NOT_ASCII = r"[^\x00-\x7F]"


def words(text: Column) -> Column:
    """Split on single spaces; neighbouring spaces yield empty words."""
    return F.split(text, " ", -1)


def is_blank(text: Column) -> Column:
    """True for text of control characters and spaces only; a no-break space is not blank."""
    return F.ltrim(text, F.lit(BLANK)) == ""


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, where a character past U+FFFF counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def ascii_only(text: Column) -> Column:
    """The text without its non-ASCII characters."""
    return F.regexp_replace(text, NOT_ASCII, "")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def join_texts(texts: Column, separator: str = ",") -> Column:
    """Join an array; a NULL element keeps its place as an empty text."""
    return F.array_join(F.transform(texts, or_empty), separator)


def to_bytes(text: Column) -> Column:
    """The bytes of a text; also of a text that was cast from bytes that are no UTF-8."""
    return text.cast("binary")


def from_bytes(data: Column) -> Column:
    """Bytes read as UTF-8, with U+FFFD for what is not."""
    return F.make_valid_utf8(data.cast("string"))
