"""Text clean-up and lenient number parsing."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MAX = 2147483647
_INT_MIN = -2147483648


def _accent_pairs() -> tuple[str, str]:
    """Latin letters that Unicode decomposes into an ASCII letter plus marks."""
    source, target = [], []
    for first, last in ((0x00C0, 0x024F), (0x1E00, 0x1EFF)):
        for code in range(first, last + 1):
            base = unicodedata.normalize("NFD", chr(code))[0]
            if base.isascii() and base.isalpha():
                source.append(chr(code))
                target.append(base)
    return "".join(source) + "Łł", "".join(target) + "Ll"


_ACCENTED, _PLAIN = _accent_pairs()


def strip_accents(column: Column) -> Column:
    return F.translate(column, _ACCENTED, _PLAIN)


def strip_accents_text(text: str) -> str:
    return text.translate(str.maketrans(_ACCENTED, _PLAIN))


def clean_header(name: str) -> str:
    """Column name without accents or special characters, ``_`` for white space."""
    plain = re.sub(r"[^\w ]", "", strip_accents_text(name), flags=re.ASCII)
    return re.sub(r"\s", "_", plain).lower()


# -- lenient casts of raw text: bad or missing text gives the type's zero -------

_DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lenient_int(text: Column) -> Column:
    """Whole number; text with a point is truncated toward zero; bad or null -> 0."""
    text = text.cast("string")
    from_decimal = F.least(
        F.greatest(text.try_cast("double"), F.lit(float(_INT_MIN))), F.lit(float(_INT_MAX))
    ).cast("int")
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    return F.coalesce(F.when(F.contains(text, F.lit(".")), from_decimal).otherwise(whole), F.lit(0))


def lenient_double(text: Column) -> Column:
    """Decimal comma or point, cut (not rounded) after 15 decimals; bad or null -> 0.0."""
    text = F.translate(text.cast("string"), ",", ".")
    cut = F.regexp_replace(text, r"^([+-]?\d*\.\d{15})\d+$", "$1")
    return F.coalesce(F.when(text.rlike(_DECIMAL_TEXT), cut.try_cast("double")), F.lit(0.0))


def lenient_float(text: Column) -> Column:
    return F.coalesce(text.cast("string").try_cast("float"), F.lit(0.0).cast("float"))


def lenient_boolean(text: Column) -> Column:
    return F.coalesce(F.lower(text.cast("string")) == "true", F.lit(False))


def text_to_int(text: Column) -> Column:
    """Cast of raw text to int: a fraction is cut, anything malformed is null."""
    digits = F.regexp_extract(F.trim(text.cast("string")), r"^([+-]?\d+)(\.\d*)?$", 1)
    return digits.try_cast("int")


def comma_double(text: Column) -> Column:
    """Distance text with decimal comma; bad or null -> 0.0."""
    return F.coalesce(F.translate(text.cast("string"), ",", ".").try_cast("double"), F.lit(0.0))


def extract_number(text: Column) -> Column:
    """Number inside a measured text, e.g. ``81469kWh`` -> 81469.

    No digit at all gives 0.0; leftovers that are no number (``1-2``) give null.
    """
    kept = F.regexp_replace(text.cast("string"), r"[^-.0-9]+", "")
    number = F.when(kept == "", F.lit(0.0).cast("float")).otherwise(kept.try_cast("float"))
    return F.when(text.isNull(), F.lit(0.0).cast("float")).otherwise(number)
