"""Encoding and delimiter of a file, from its first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.text import BOM, _col, decode_cp1252

# Byte-order marks, the four-byte ones first because one starts like a two-byte one.
BYTE_ORDER_MARKS = (
    ("EFBBBF", "utf-8-sig"), ("FFFE0000", "utf-32le"), ("0000FEFF", "utf-32be"), ("FFFE", "utf-16le"), ("FEFF", "utf-16be"),
)
# NUL bytes in the first bytes that mean two-byte text.
NUL_WINDOW, NUL_LIMIT = 2000, 50
# Candidate delimiters in order of preference.
DELIMITERS = (",", ";", "|", "\t")


def _utf8(head: Column, whole: Column) -> Column:
    """UTF-8 validity, forgiving a character that the end of the sample, but not of the file, cuts off."""
    size = F.octet_length(head)
    end = F.hex(F.substring(head, size - 2, F.lit(3)))
    # The last lead byte without all its followers: one of any length, two before it, three before it.
    cut = F.when(end.rlike("[C-F].$"), 1).when(end.rlike("[EF].[89AB].$"), 2).when(end.rlike("^F.[89AB].[89AB].$"), 3).otherwise(0)
    valid = F.is_valid_utf8(head.cast("string"))
    return valid | (~whole & (cut > 0) & F.is_valid_utf8(F.substring(head, F.lit(1), size - cut).cast("string")))


def sniff_encoding(c: Column | str, whole: Column | bool = False) -> Column:
    """Byte-order mark, else many NULs, else valid UTF-8, else windows-1252.

    ``whole``: the sample is all of the file, so its last character is not cut off.
    """
    head = _col(c)
    start = F.hex(F.substring(head, 1, 4))
    first = F.decode(F.substring(head, 1, NUL_WINDOW), "ISO-8859-1")
    nuls = F.length(first) - F.length(F.replace(first, F.lit("\0"), F.lit("")))
    whole = F.lit(whole) if isinstance(whole, bool) else F.coalesce(whole, F.lit(False))
    out = F.when(nuls > NUL_LIMIT, "utf-16").when(_utf8(head, whole), "utf-8").otherwise("cp1252")
    for mark, name in reversed(BYTE_ORDER_MARKS):
        out = F.when(start.startswith(mark), name).otherwise(out)
    return out


def decode_head(c: Column | str, encoding: Column | str) -> Column:
    """The sample as text, without a byte-order mark."""
    head, enc = _col(c), _col(encoding)
    even = F.substring(head, F.lit(1), F.octet_length(head) - F.octet_length(head) % 4)
    text = (
        F.when(enc.isin("utf-16le", "utf-16"), F.decode(even, "UTF-16LE"))
        .when(enc == "utf-16be", F.decode(even, "UTF-16BE"))
        .when(enc.isin("utf-32le", "utf-32be"), F.decode(even, "UTF-32"))
        .when(enc == "cp1252", decode_cp1252(F.decode(head, "ISO-8859-1")))
        .otherwise(F.make_valid_utf8(head.cast("string")))
    )
    return F.replace(text, F.lit(BOM), F.lit(""))


def first_line(c: Column | str) -> Column:
    """The first line that is not blank, null if there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"(?m)^[^\S\r\n]*[^\s].*$", 0), F.lit(""))


def sniff_delimiter(c: Column | str) -> Column:
    """The candidate that occurs most in a line; earlier candidates win ties."""
    line = F.coalesce(_col(c), F.lit(""))
    counts = [
        F.struct(
            (F.length(line) - F.length(F.replace(line, F.lit(d), F.lit("")))).alias("n"),
            F.lit(-i).alias("preference"),
            F.lit(d).alias("delimiter"),
        )
        for i, d in enumerate(DELIMITERS)
    ]
    return F.array_max(F.array(*counts))["delimiter"]


def header_fields(line: Column | str, delimiter: Column | str) -> Column:
    """Column names of a header line; quoted names may hold the delimiter."""
    text, sep = _col(line), _col(delimiter)
    # Each field with the separator behind it, found in one scan: quoted parts may hold separators.
    fields = F.regexp_extract_all(F.concat(text, sep), F.concat(F.lit(r'((?:"[^"]*+"|[^"'), sep, F.lit(r']++|"(?![^"]*"))*+)['), sep, F.lit("]")), F.lit(1))
    unquoted = F.transform(
        fields,
        lambda f: F.replace(F.regexp_replace(f, r'^\s*"(.*)"\s*$', "$1"), F.lit('""'), F.lit('"')),
    )
    return F.when(F.length(text) > 0, unquoted).otherwise(F.array().cast("array<string>"))
