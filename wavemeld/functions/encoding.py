"""Repair of text whose encoding went wrong."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A letter's UTF-8 bytes read as Windows-1252, and the letter.
DOUBLE_ENCODED = (("Ã¦", "æ"), ("Ã†", "Æ"), ("Ã¥", "å"), ("Ã¸", "ø"))
DOUBLE_ENCODED_MORE = (("Ã…", "Å"), ("Ã˜", "Ø"))
# Fixed value: a stray byte that stands for a plain letter.
STRAY = ("í", "i")


def fix_double_encoding(text: Column | str, more: bool = False) -> Column:
    """Undo UTF-8 that was encoded twice; ``more`` also repairs Å and Ø."""
    c = F.col(text) if isinstance(text, str) else text
    for wrong, right in DOUBLE_ENCODED + (DOUBLE_ENCODED_MORE if more else ()):
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


# Fixed value: a letter of several bytes in valid UTF-8, its bytes written as Latin-1 letters.
UTF8_LETTER = ("(?:[\\xC2-\\xDF][\\x80-\\xBF]|\\xE0[\\xA0-\\xBF][\\x80-\\xBF]|[\\xE1-\\xEC\\xEE\\xEF][\\x80-\\xBF]{2}"
               "|\\xED[\\x80-\\x9F][\\x80-\\xBF]|\\xF0[\\x90-\\xBF][\\x80-\\xBF]{2}|[\\xF1-\\xF3][\\x80-\\xBF]{3}"
               "|\\xF4[\\x80-\\x8F][\\x80-\\xBF]{2})")


def fix_bytes(raw: Column | str) -> Column:
    """Text of a binary cell: valid UTF-8 as it is, stretches that are not as Latin-1.

    Bytes are cut into plain runs, valid UTF-8 letters and other bytes, so a cell
    that mixes both encodings keeps its correct letters; only bytes that are no
    valid UTF-8 are reinterpreted.
    """
    c = F.col(raw) if isinstance(raw, str) else raw
    latin = F.decode(c, "ISO-8859-1")
    runs = F.regexp_extract_all(latin, F.lit(f"({UTF8_LETTER}|[\\x00-\\x7F]+|[\\x80-\\xFF])"), F.lit(1))
    mixed = F.array_join(F.transform(runs, lambda run: F.when(
        run.rlike(f"^{UTF8_LETTER}"), F.decode(F.encode(run, "ISO-8859-1"), "UTF-8"))
        .otherwise(F.replace(run, F.lit(STRAY[0]), F.lit(STRAY[1])))), "")
    return F.coalesce(F.try_validate_utf8(c.cast("string")), mixed)


def fix_encode(cell: Column | str, dtype: str = "string", more: bool = False) -> Column:
    """Repair a string or binary cell."""
    return fix_double_encoding(fix_bytes(cell) if dtype == "binary" else cell, more)
