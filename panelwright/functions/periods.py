"""Years, quarters and dates written in the many ways the sources use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.text import _col, strip

# How the sources write a quarter (start of text, or anywhere),
# and the last month it covers.
QUARTER_WORDS = (
    (3, "t1", ("1er",)),
    (6, "t2", ("2do", "2º")),
    (9, "t3", ("3er",)),
    (12, "t4", ("4to", "4º")),
)
# Cumulative periods as words that must all be present.
CUMULATIVE_WORDS = ((6, ("6", "mes")), (9, ("9", "mes")), (12, ("anual",)), (12, ("año",)))

# The period labels of the second rule, exact or contained.
EXACT_QUARTERS = (("T1", 3), ("T2", 6), ("T3", 9), ("T4", 12))
CONTAINED_PERIODS = (("6 Meses", 6), ("9 Meses", 9), ("12 Meses", 12), ("Año", 12), ("Anual", 12), ("Anio", 12))

# Ordinal that opens a quarter text.
ORDINAL_QUARTERS = (("Primer", 1), ("Segundo", 2), ("Tercer", 3), ("Cuarto", 4))

QUARTER_PERIODS = tuple(name for name, _ in EXACT_QUARTERS)


def _first_match(rules: list[tuple[Column, int]], default: Column) -> Column:
    out = default
    for condition, month in reversed(rules):
        out = F.when(condition, F.lit(month)).otherwise(out)
    return out


def _any(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def _all(conditions) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def period_month(c: Column | str) -> Column:
    """Last month of a period text (strict rule); unknown text gives null."""
    text = F.lower(strip(c))
    rules = [
        (text.startswith(start) | _any(text.contains(word) for word in words), month)
        for month, start, words in QUARTER_WORDS
    ]
    rules += [(_all(text.contains(word) for word in words), month) for month, words in CUMULATIVE_WORDS]
    return _first_match(rules, F.lit(None).cast("int"))


def is_cumulative(c: Column | str) -> Column:
    """True when the strict rule reads the text as a running total, not a quarter."""
    text = F.lower(strip(c))
    quarter = _any(
        text.startswith(start) | _any(text.contains(word) for word in words)
        for _, start, words in QUARTER_WORDS
    )
    return F.coalesce(~quarter & period_month(c).isNotNull(), F.lit(False))


def period_month_exact(c: Column | str) -> Column:
    """Second rule: exact quarter names, known totals, anything else December."""
    text = F.coalesce(strip(c), F.lit(""))
    rules = [(text == name, month) for name, month in EXACT_QUARTERS]
    rules += [(text.contains(name), month) for name, month in CONTAINED_PERIODS]
    return _first_match(rules, F.lit(12))


def period_month_loose(c: Column | str) -> Column:
    """Third rule: contains T1, T2 or T3, everything else (totals too) December."""
    text = F.coalesce(_col(c), F.lit(""))
    return _first_match([(text.contains(name), month) for name, month in EXACT_QUARTERS[:3]], F.lit(12))


def clean_year(c: Column | str) -> Column:
    """First four digits of texts like ``2018R``; null without them."""
    return F.regexp_extract(_col(c).cast("string"), r"\d{4}", 0).try_cast("int")


def quarter_from_text(c: Column | str) -> Column:
    """Quarter number from ``Segundo trimestre del 2025``."""
    word = F.get(F.split(strip(c), r"\s+"), F.lit(0))
    return _first_match([(word == name, n) for name, n in ORDINAL_QUARTERS], F.lit(None).cast("int"))


def year_from_text(c: Column | str) -> Column:
    """The last word as a year; null when it is not a number."""
    return F.try_element_at(F.split(strip(c), r"\s+"), F.lit(-1)).try_cast("int")


def _date(year: Column, month: Column) -> Column:
    # make_date raises on a bad month, so bad input must not reach it.
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def month_start(year: Column | str, month: Column | str) -> Column:
    return _date(_col(year).cast("int"), _col(month).cast("int"))


def month_end(year: Column | str, month: Column | str) -> Column:
    return F.last_day(month_start(year, month))


def quarter_end(year: Column | str, quarter: Column | str) -> Column:
    """Last day of a calendar quarter."""
    return month_end(year, _col(quarter).cast("int") * 3)


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    """``2025Q2``; null when either part is null."""
    return F.concat(_col(year).cast("string"), F.lit("Q"), _col(quarter).cast("string"))


def excel_or_text_date(c: Column | str) -> Column:
    """Spreadsheet serial day number, or ISO text; anything else null."""
    text = strip(_col(c).cast("string"))
    serial = text.try_cast("double").cast("int")
    from_serial = F.date_add(F.lit("1899-12-30").cast("date"), serial)
    return F.when(text.rlike(r"^\d{1,7}(\.\d+)?$"), from_serial).otherwise(text.try_cast("date"))


def parse_date(c: Column | str, dayfirst: bool = False) -> Column:
    """Text date, ``dd/MM/yyyy`` when day first (else ``MM/dd/yyyy``), or ISO."""
    text = strip(_col(c).cast("string"))
    slashed = F.try_to_timestamp(text, F.lit("d/M/yyyy" if dayfirst else "M/d/yyyy")).cast("date")
    return F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), slashed).otherwise(text.try_cast("date"))
