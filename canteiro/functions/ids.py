"""Identifiers: tax numbers and deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro.functions.text import _col

TAX_ID_LENGTH = 14


def _check_digit(number: Column, first: int, last: int) -> Column:
    """Mod-11 digit over the decimal places ``first``..``last`` counted from the right.

    Weights run 2..9 from the lowest place and start again at 2.
    """
    total = F.lit(0).cast("bigint")
    for place in range(first, last + 1):
        weight = 2 + (place - first) % 8
        digit = F.call_function("div", number, F.lit(10**place).cast("bigint")) % 10
        total = total + digit * weight
    remainder = total % 11
    return F.when(remainder < 2, F.lit(0).cast("bigint")).otherwise(11 - remainder)


def company_tax_id(text: Column | str) -> Column:
    """14-digit company tax number when both check digits hold, else NULL.

    Arithmetic on one long per row: no arrays, no per-digit strings. The check digits come first
    in the condition, where generated code shares the long between all its uses.
    """
    digits = F.regexp_replace(_col(text), r"\D", "")
    number = digits.try_cast("bigint")
    checked = _check_digit(number, 2, 13) * 10 + _check_digit(number, 1, 13)
    repeated = F.repeat(F.substring(digits, 1, 1), F.lit(TAX_ID_LENGTH))
    valid = (number % 100 == checked) & (F.length(digits) == TAX_ID_LENGTH) & (digits != repeated)
    return F.when(valid, digits)


def surrogate_key(*parts: Column | str) -> Column:
    """Stable key from the natural key; NULL as soon as one part is NULL."""
    columns = [_col(p).cast("string") for p in parts]
    complete = columns[0].isNotNull()
    for column in columns[1:]:
        complete = complete & column.isNotNull()
    return F.when(complete, F.sha2(F.concat_ws("|", *columns), 256))


def composite_id(*parts: Column | str, separator: str = "-") -> Column:
    """Parts joined by a separator; NULL when any part is NULL."""
    columns = []
    for part in parts:
        if columns:
            columns.append(F.lit(separator))
        columns.append(_col(part).cast("string"))
    return F.concat(*columns)
