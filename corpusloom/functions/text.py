"""Text expressions: splitting into pieces, bytes, stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of the Unicode standard, as a regex class body.
UNICODE_SPACE = (
    r"\t\n\x0B\f\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# The published pre-split of the 50,257-token byte-level vocabulary.
SUBWORD_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{UNICODE_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{UNICODE_SPACE}]+(?![^{UNICODE_SPACE}])|[{UNICODE_SPACE}]+"
)

# Letters, digits, or one other visible character; drops white space.
WORD_SPLIT = rf"\p{{L}}+|\p{{N}}+|[^{UNICODE_SPACE}\p{{L}}\p{{N}}]"

# Control tokens of the chat format, in id order, and end of text.
CHAT_TOKENS = {
    "system": "<|system|>",
    "user": "<|user|>",
    "assistant": "<|assistant|>",
    "end_turn": "<|end_turn|>",
}
END_OF_TEXT = "<|endoftext|>"


def quote_regex(text: str) -> str:
    """Escape for a Java regex."""
    return "".join("\\" + c if c in r"\.[]{}()<>*+-=!?^$|" else c for c in text)


def pieces(text: Column, pattern: str = SUBWORD_SPLIT, specials: tuple[str, ...] = ()) -> Column:
    """Split text into pieces; a special string becomes a piece of its own.

    Text between special strings is split on its own, so white space in front of a
    special string behaves like white space at the end of a text.
    """
    split = lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    if not specials:
        return split(text)
    any_special = "|".join(quote_regex(s) for s in specials)
    segments = F.split(text, f"(?={any_special})|(?<={any_special})")
    by_segment = F.transform(
        segments, lambda s: F.when(s.isin(*specials), F.array(s)).otherwise(split(s))
    )
    return F.when(text.rlike(any_special), F.flatten(by_segment)).otherwise(split(text))


def latin(text: Column) -> Column:
    """One character per UTF-8 byte: U+0000 to U+00FF stand for the byte values."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def from_latin(text: Column) -> Column:
    """Undo :func:`latin`; malformed byte runs become U+FFFD."""
    return F.make_valid_utf8(F.encode(text, "ISO-8859-1").cast("string"))


def byte_ids(text: Column) -> Column:
    """UTF-8 bytes as ids 0..255, in one pass over the text."""
    characters = F.filter(F.split(latin(text), ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.ascii(c).cast("int"))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(text, rf"^[{UNICODE_SPACE}\x1C-\x1F]+|[{UNICODE_SPACE}\x1C-\x1F]+\z", "")


def missing(text: Column) -> Column:
    """Null and empty are missing; white space alone is not."""
    return F.coalesce(text, F.lit("")) == ""
