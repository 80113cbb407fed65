"""Text expressions: words, code points, record ends and normalisation.

Every function takes a column (or its name) and returns a column, so all of it runs
inside the JVM and fuses with the scan that feeds it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 29 code points a word may not contain. `(?U)\s` covers all but the four
# separators U+001C..U+001F; the possessive `++` spares the matcher its backtracking.
WHITESPACE = r"(?U)[\s\x1c-\x1f]++"

# Characters of a piece of text, to which the rest of its last word is added.
PIECE = 1 << 16

# Characters that end a record and are therefore never counted.
RECORD_ENDS = ("\n", "\r")

BYTE_ORDER_MARK = "﻿"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: Column | str) -> Column:
    """Array of words; holds '' where the text starts or ends with whitespace."""
    return F.split(column(text), WHITESPACE)


def pieces(text: Column | str, size: int | None = None) -> Column:
    """Array of consecutive parts of about `size` characters that make up the text and do not cut
    a word. Possessive, so the matcher keeps no positions to return to."""
    return F.regexp_extract_all(column(text), F.lit(rf"(?sU).{{1,{size or PIECE}}}+[^\s\x1c-\x1f]*+"), F.lit(0))


def line_pieces(text: Column | str, size: int | None = None) -> Column:
    """Array of consecutive parts of about `size` characters that make up the text, each of whole
    records: a part ends with a record end, the last one with the text."""
    size = size or PIECE
    t = column(text)
    cut = F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{size}}}+[^\r\n]*+(?:\r\n|\r|\n|\z)"), F.lit(0))
    return F.when(F.char_length(t) <= size, F.array(t)).otherwise(cut)


def split_code_points(text: Column | str) -> Column:
    """Array of one-code-point strings; [''] for the empty text."""
    return F.split(column(text), "")


def code_point_key(char: Column | str) -> Column:
    """`U+XXXX` name of a one-character string, four hex digits at least."""
    return F.format_string("U+%04X", F.ascii(column(char)))


def unify_record_ends(text: Column | str) -> Column:
    """CRLF and lone CR become LF."""
    return F.replace(F.replace(column(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip_record_end(text: Column | str) -> Column:
    """Drop every CR and LF at the end."""
    return F.rtrim(column(text), F.lit("\r\n"))


def split_lines(text: Column | str) -> Column:
    """Array of records as a file reader would see them: a final record end opens no new record."""
    t = column(text)
    # Each part is used once, since a generator works out every use of an expression anew.
    bare = F.regexp_replace(t, r"(?:\r\n|\r|\n)\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(unify_record_ends(bare), "\n"))


def normalize_text(text: Column | str) -> Column:
    """One leading byte-order mark dropped, LF record ends only, final LF present."""
    t = column(text)
    bare = F.when(F.startswith(t, F.lit(BYTE_ORDER_MARK)), F.substr(t, F.lit(2))).otherwise(t)
    unified = unify_record_ends(bare)
    return F.when(F.endswith(unified, F.lit("\n")), unified).otherwise(F.concat(unified, F.lit("\n")))


def decode_utf8(content: Column | str, invalid: str = "strict") -> Column:
    """Bytes to text. `strict` fails the query on invalid UTF-8, `replace` puts U+FFFD,
    `null` gives NULL so that the caller can route the row to a reject table."""
    text = column(content).cast("string")
    if invalid == "strict":
        return F.validate_utf8(text)
    if invalid == "replace":
        return F.make_valid_utf8(text)
    if invalid == "null":
        return F.try_validate_utf8(text)
    raise ValueError(f"invalid must be strict, replace or null, not {invalid!r}")


def byte_length(text: Column | str) -> Column:
    return F.octet_length(column(text)).cast("bigint")


def sha256(content: Column | str) -> Column:
    return F.sha2(column(content), 256)
