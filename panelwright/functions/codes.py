"""File names, table codes and category codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.text import _col, strip

# Modules in the order they are looked for, then short forms.
MODULES = ("VIVT", "HOGT", "SDEMT", "COE1T", "COE2T")
SHORT_MODULES = (("COE1", "COE1T"), ("COE2", "COE2T"))
# Short table names and the module they stand for.
BASE_ALIASES = (("COE1", "COE1T"), ("COE2", "COE2T"), ("SDEM", "SDEMT"), ("HOG", "HOGT"), ("VIV", "VIVT"))
# Fixed patterns: year and quarter in a file name; base, quarter, year in a table code.
NAME_PERIOD = r"(?i)_(20\d{2})_trim(\d)\b"
TABLE_CODE = r"^([A-Z0-9]+?)(\d)(\d{2})$"
INTEGER = r"^-?\d+$"


def module_of(name: Column | str) -> Column:
    """Module of a file name: first tag contained, then the short forms."""
    upper = F.upper(_col(name))
    out = F.lit(None).cast("string")
    for tag, module in reversed([(m, m) for m in MODULES] + list(SHORT_MODULES)):
        out = F.when(upper.contains(tag), module).otherwise(out)
    return out


def yq_from_name(name: Column | str) -> tuple[Column, Column]:
    """(year, quarter) from ``..._2024_trim1.csv``; both null without it."""
    text = _col(name)
    return (
        F.regexp_extract(text, NAME_PERIOD, 1).try_cast("int"),
        F.regexp_extract(text, NAME_PERIOD, 2).try_cast("int"),
    )


def digit_key(c: Column | str, width: int) -> Column:
    """Digits only, zero-padded to ``width``; longer keys are kept whole, null stays null."""
    digits = F.regexp_replace(_col(c).cast("string"), r"\D", "")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def yq_from_per(c: Column | str) -> tuple[Column, Column]:
    """(year, quarter) from a period code: first digit quarter, next two the year."""
    code = _col(c).cast("string")
    digits = digit_key(code, 3)
    year = F.lit(2000) + F.substring(digits, 2, 2).try_cast("int")
    return year, F.substring(digits, 1, 1).try_cast("int")


def table_code(c: Column | str) -> Column:
    """``COE2T424`` -> struct(base, quarter, year, rank); other text -> (letters and digits, 0, 0)."""
    text = F.coalesce(F.upper(strip(c)), F.lit(""))
    # No match gives '' here, and null numbers below.
    stem = F.regexp_extract(text, TABLE_CODE, 1)
    full_names = F.create_map(*[F.lit(name) for pair in BASE_ALIASES for name in pair])
    base = F.coalesce(F.try_element_at(full_names, stem), F.nullif(stem, F.lit("")), F.regexp_replace(text, "[^A-Z0-9]", ""))
    quarter = F.coalesce(F.regexp_extract(text, TABLE_CODE, 2).try_cast("int"), F.lit(0))
    year = F.coalesce(F.regexp_extract(text, TABLE_CODE, 3).try_cast("int"), F.lit(0))
    return F.struct(
        base.alias("base"), quarter.alias("quarter"), year.alias("year"), ((year + 2000) * 10 + quarter).alias("rank")
    )


def plain_code(c: Column | str) -> Column:
    """The form two spellings of one code share: no leading zeros, or upper case."""
    text = strip(_col(c).cast("string"))
    number = F.regexp_replace(F.regexp_replace(text, r"^(-?)0+(?=\d)", "$1"), "^-0$", "0")
    return F.when(text.rlike(INTEGER), number).otherwise(F.upper(text))


def code_variants(c: Column | str) -> Column:
    """Spellings to try for a code, in order; blank or null gives an empty array."""
    text = strip(_col(c).cast("string"))
    plain = plain_code(c)
    two_digits = F.when(plain.rlike(r"^\d$"), F.concat(F.lit("0"), plain)).otherwise(plain)
    found = F.array_distinct(F.array(text, plain, two_digits))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))


# Fixed pattern: what a file name may not hold.
NOT_IN_NAMES = r"[^A-Za-z0-9_\-.]+"


def safe_name(c: Column | str) -> Column:
    """File-safe name: blanks and other runs become ``_``."""
    return F.regexp_replace(F.replace(strip(c), F.lit(" "), F.lit("_")), NOT_IN_NAMES, "_")
