"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters trimmed from the ends of a cell.
WHITESPACE = " \t\n\r\x0b\x0c"
BOM = "﻿"

# Fixed value: how the whole country is named in the panels.
NATION = "Estados Unidos Mexicanos"

# Bytes 0x80-0x9f of windows-1252. The five unassigned ones
# (81, 8d, 8f, 90, 9d) keep their latin-1 meaning.
CP1252_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Both-ends trim of any ASCII white space (``trim`` alone drops blanks only)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def squeeze(c: Column | str) -> Column:
    """White-space runs become one blank, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def norm_header(c: Column | str) -> Column:
    """Column name for comparison: no BOM, squeezed, lower case; null becomes ''."""
    return F.coalesce(F.lower(squeeze(F.replace(_col(c), F.lit(BOM), F.lit("")))), F.lit(""))


def _accent_tables() -> tuple[str, str, dict[str, str]]:
    # Rule: a character stands for the ASCII part of its compatibility decomposition.
    src, dst, longer = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        ascii_part = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            src.append(chr(point))
            dst.append(ascii_part)
        elif ascii_part:
            longer[chr(point)] = ascii_part
    return "".join(src), "".join(dst), longer


_ACCENTED, _PLAIN, _LONGER = _accent_tables()


def _ranges(chars: Iterable[str]) -> str:
    """Characters as the inside of a class, neighbours as one range."""
    points = sorted(map(ord, chars))
    ends = [p for p in points if p + 1 not in _LONGER_POINTS]
    starts = [p for p in points if p - 1 not in _LONGER_POINTS]
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends))


_LONGER_POINTS = frozenset(map(ord, _LONGER))
# The look-ahead passes over ASCII at once, before any range is tried.
_COMPOUND = rf"(?=[^\x00-\x7F])[{_ranges(_LONGER)}]"


def strip_accents(c: Column | str) -> Column:
    """Accents go, ligatures and other compound characters are taken apart; every other non-ASCII character goes.

    Characters that stand for one letter are translated. Only a text with something left
    is searched for compound characters, and each distinct one it holds is replaced once.
    """
    def plain(single: Column) -> Column:
        table = F.create_map(*[F.lit(x) for pair in _LONGER.items() for x in pair])
        found = F.array_distinct(F.regexp_extract_all(single, F.lit(_COMPOUND), F.lit(0)))
        apart = F.aggregate(found, single, lambda text, ch: F.replace(text, ch, F.element_at(table, ch)))
        return F.when(F.length(single) == F.octet_length(single), single).otherwise(F.regexp_replace(apart, r"[^\x00-\x7F]", ""))

    c = _col(c)
    folded = F.get(F.transform(F.array(F.translate(c, _ACCENTED, _PLAIN)), plain), F.lit(0))
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(folded)


# Fixed pattern: what separates the parts of a slug.
NOT_IN_SLUGS = "[^a-zA-Z0-9]+"


def slugify(c: Column | str) -> Column:
    """ASCII, lower case, runs of other characters as one ``_``; null becomes ''."""
    body = F.regexp_replace(strip_accents(c), NOT_IN_SLUGS, "_")
    return F.coalesce(F.lower(F.trim(body, F.lit("_"))), F.lit(""))


def decode_cp1252(c: Column | str) -> Column:
    """Text that was read as latin-1 but written as windows-1252."""
    return F.translate(_col(c), CP1252_BYTES.decode("latin-1"), CP1252_BYTES.decode("cp1252"))


def fix_mojibake(c: Column | str) -> Column:
    """Undo UTF-8 text read as latin-1; clean text comes back unchanged."""
    c = _col(c)
    # encode() raises above U+00FF and decode() on malformed bytes, hence the nesting.
    latin = F.encode(c, "ISO-8859-1")
    repaired = F.when(F.is_valid_utf8(latin.cast("string")), F.decode(latin, "UTF-8")).otherwise(c)
    ascii_only = F.length(c) == F.octet_length(c)
    return F.when(ascii_only, c).when(c.rlike(r"^[\x00-\xFF]*$"), repaired).otherwise(c)


def to_double(c: Column | str) -> Column:
    """Number or null, never an error."""
    return strip(_col(c).cast("string")).try_cast("double")


def metric_like(c: Column | str, text: str) -> Column:
    """Contains ``text``, ignoring case and accents on both sides."""
    needle = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return F.coalesce(F.lower(strip_accents(c)).contains(needle), F.lit(False))


def is_national(c: Column | str, nation: str = NATION) -> Column:
    return F.coalesce(_col(c) == nation, F.lit(False))


# Unit of a metric by words of its text, first match wins.
UNIT_WORDS = (
    ("money", ("millones de pesos",)),
    ("count", ("unidades",)),
    ("index", ("ndice",)),
)


def unit_class(c: Column | str) -> Column:
    """Unit class of a metric text: money, count, index or other."""
    text = F.lower(_col(c))
    out = F.lit("other")
    for unit, words in reversed(UNIT_WORDS):
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        out = F.when(hit, unit).otherwise(out)
    return out


def fmt_money(c: Column | str) -> Column:
    """Whole units with thousands separators and a leading $."""
    return F.concat(F.lit("$"), F.format_number(_col(c), 0))


def fmt_count(c: Column | str) -> Column:
    return F.format_number(_col(c), 0)


def fmt_pct(c: Column | str) -> Column:
    """One decimal and a percent sign, no thousands separator."""
    return F.format_string("%.1f%%", _col(c).cast("double"))
