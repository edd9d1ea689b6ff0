"""Prices as text and as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo import constants as C


def money_br(c: Column) -> Column:
    """``R$ 1.234,50`` as decimal; text that is no amount gives null."""
    bare = F.rtrim(F.regexp_replace(c, r"(?U)R\$\s*", ""), F.lit(".,"))
    return F.translate(bare, ",.", ".").try_cast("decimal(18,2)")


def money_naive(c: Column) -> Column:
    """Numeric prefix after removing ``R$ ``: thousands points read as decimals.

    Kept for compatibility with reports that cast the text as it stands. A text
    without a numeric prefix counts as zero, a null stays null.
    """
    bare = F.replace(c, F.lit("R$ "), F.lit(""))
    digits = F.regexp_extract(bare, r"^\s*([+-]?\d+(?:\.\d+)?)", 1)
    return F.when(c.isNotNull(), F.coalesce(digits.try_cast("double"), F.lit(0.0)))


def price_label(number_or_text: Column, is_text: Column) -> Column:
    """Numbers get the currency prefix, texts stay as they are."""
    return F.when(is_text, number_or_text).otherwise(F.concat(F.lit("R$ "), number_or_text))


def area_number(c: Column) -> Column:
    """Whole number of square metres, up to six digits."""
    return F.regexp_extract(c, C.AREA_WHOLE, 1).try_cast("int")


def count_number(c: Column) -> Column:
    """The number in ``2 Q`` or ``1 B``."""
    return F.regexp_extract(c, r"^(\d+) [QB]$", 1).try_cast("int")
