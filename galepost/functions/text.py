"""Text columns: tolerant cleaning and parsing of landed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" (exact case) in landed files.
NULL_TOKENS = ("", "nan", "NaN", "null", "NULL", "None", "N/A")

# The characters that count as blank at either end of a field.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_DIGITS = r"[0-9](?:_?[0-9])*"
_NUMBER = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def column_name(header: str | None) -> str:
    """The column a header cell stands for: trimmed, in small letters, underscores for spaces."""
    return (header or "").strip().lower().replace(" ", "_")


def strip(value: Column) -> Column:
    """Remove blanks of any kind from both ends; Spark's plain trim knows only spaces."""
    return F.btrim(value, F.lit(BLANKS))


def clean_text(value: Column) -> Column:
    """Strip, then turn the null tokens into NULL."""
    stripped = strip(value)
    return F.when(~stripped.isin(*NULL_TOKENS), stripped)


def parse_number(value: Column) -> Column:
    """Text to double, NULL where the text is no number.

    The pattern keeps out texts that only the JVM parser takes, such as ``1.0d``.
    """
    text = strip(value)
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def parse_iso_date(value: Column) -> Column:
    """``yyyy-mm-dd`` or ``yyyymmdd`` to a date, NULL for anything else."""
    compact = F.concat_ws(
        "-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2)
    )
    return (
        F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value.try_cast("date"))
        .when(value.rlike(r"^[0-9]{8}$"), compact.try_cast("date"))
    )
