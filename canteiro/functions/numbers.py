"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.text import _col, strip, text_or_null

# Parsers below refer to their input once, or in every branch, so that generated code shares it.

_CURRENCY_OR_BLANK = r"R\$|[\s\x1c-\x1f\x85\xa0]+"
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def to_double(text: Column | str) -> Column:
    """Plain decimal text to double; anything else, NaN and infinities included, is NULL."""
    trimmed = strip(_col(text).cast("string"))
    return F.regexp_extract(trimmed, _NUMBER, 0).try_cast("double")


def to_long(text: Column | str) -> Column:
    """Decimal text cut to a whole number."""
    return to_double(text).try_cast("bigint")


def _swap(text: Column, old: str, new: str = "") -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _comma_is_last(text: Column) -> Column:
    """The last comma stands after the last dot."""
    return F.substring_index(text, ".", -1).contains(",")


def _comma_decimal(text: Column) -> Column:
    return _swap(_swap(text, "."), ",", ".")


def _last_separator_decimal(bare: Column, otherwise: Column) -> Column:
    """The last of dot and comma is decimal; ``otherwise`` is for texts without a comma."""
    return (
        F.when(~bare.contains(","), otherwise)
        .when(_comma_is_last(bare), _comma_decimal(bare))
        .otherwise(_swap(bare, ","))
    )


def money(text: Column | str) -> Column:
    """Money text in Brazilian or US notation.

    The last separator is the decimal one. A single dot before exactly three digits, and any
    repeated dot, separates thousands. Missing tokens hold no digits, so they give NULL.
    """
    bare = F.regexp_replace(_col(text).cast("string"), r"[^\d,.\-]", "")
    thousands = bare.rlike(r"\..*\.|\.[^.]{3}$")
    without_comma = F.when(thousands, _swap(bare, ".")).otherwise(bare)
    return to_double(_last_separator_decimal(bare, without_comma))


def amount(text: Column | str, style: str) -> Column:
    """Source-specific amount text.

    ``br_strict``       every dot separates thousands, the comma is decimal
    ``last_separator``  the last of dot and comma is decimal
    ``comma_decimal``   a comma is decimal; dots separate thousands only next to a comma
    ``dump``            as comma_decimal, but blank and unreadable text is 0.0
    """
    bare = F.regexp_replace(_col(text).cast("string"), _CURRENCY_OR_BLANK, "")
    if style == "br_strict":
        return to_double(_comma_decimal(bare))
    if style == "last_separator":
        return to_double(_last_separator_decimal(bare, bare))
    plain = to_double(F.when(bare.contains(","), _comma_decimal(bare)).otherwise(bare))
    if style == "comma_decimal":
        return plain
    if style == "dump":
        return F.coalesce(plain, F.lit(0.0))
    raise ValueError(f"unknown amount style: {style}")


def loose_number(text: Column | str) -> Column:
    """Any text holding one number in Brazilian notation; stray characters are dropped."""
    kept = text_or_null(_col(text).cast("string"), vocab.NULL_TEXTS_LEGACY, ignore_case=True)
    return to_double(F.regexp_replace(_comma_decimal(kept), r"[^0-9\-+.]+", ""))


def percent(text: Column | str) -> Column:
    """``40,00%`` to 40.0."""
    kept = text_or_null(_col(text).cast("string"), vocab.NULL_TEXTS_LEGACY_CELL)
    return to_double(_swap(F.regexp_replace(kept, "[% ]", ""), ",", "."))


def integer(text: Column | str) -> Column:
    """Digits and minus signs of a text as a whole number."""
    kept = text_or_null(_col(text).cast("string"), vocab.NULL_TEXTS_LEGACY, ignore_case=True)
    return F.regexp_replace(kept, r"[^0-9\-]+", "").try_cast("bigint")


def statistic(text: Column | str) -> Column:
    """Published statistic: comma decimal, ``...`` for not available."""
    return to_double(_swap(_col(text).cast("string"), ",", "."))


def exact_sum(value: Column | str) -> Column:
    """Sum of money with two decimals, free of float error and of row order."""
    return F.sum(_col(value).cast("decimal(38,2)")).cast("double")


def financial_percent(executed: Column | str, contracted: Column | str) -> Column:
    """Executed share of the contract in percent; NULL when either side is zero or unknown."""
    executed, contracted = _col(executed), _col(contracted)
    usable = (executed != 0) & (contracted != 0)
    return F.when(usable, F.bround(executed / F.nullif(contracted, F.lit(0.0)) * 100, 2))


def stopped_work_percent(given: Column | str, paid: Column | str, contracted: Column | str) -> Column:
    """Percent from the source, else paid over contracted, one decimal, at most 99."""
    paid, contracted = _col(paid), _col(contracted)
    share = F.bround(paid / F.nullif(contracted, F.lit(0.0)) * 100, 1)
    return F.coalesce(_col(given), F.when(share.isNotNull(), F.least(share, F.lit(99.0))))
