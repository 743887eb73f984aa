"""Aggregates whose value does not depend on the order of the rows.

Money arrives as double. A sum of doubles changes with task order and with
every retried task. Here an amount is cut into integer limbs of 21 bits and
millionths, whose sums are exact, cannot overflow and stay cheap inside
generated code; the sums are put together as a decimal and leave as double. What has
no such form, NaN, infinity and amounts from 2^100 on, is summed as double beside it and
shows in the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# For amounts that are few already, such as gold rows.
MONEY = "decimal(24,6)"

_EXACT_BELOW = float(2**100)
_WORD = float(2**63)
_LIMB = 21


def _number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


#: Parts of an amount that count what is no finite number.
NOT_FINITE = ("nan", "plus", "minus")


def _limbs(value: Column) -> dict[str, Column]:
    """Millionths, limbs of 21 bits and words of 63 bits of amounts below 2^100; NULL for others."""
    exact = F.when(F.abs(value) < _EXACT_BELOW, value)
    words = F.when(F.abs(exact) < _WORD, F.lit(0)).otherwise((exact / _WORD).cast("bigint"))
    near = exact - words * _WORD
    units = F.floor(near)
    return {
        "millionths": F.rint((near - units) * 1_000_000.0).cast("bigint"),
        "limb0": units.bitwiseAND((1 << _LIMB) - 1),
        "limb1": F.shiftright(units, _LIMB).bitwiseAND((1 << _LIMB) - 1),
        "limb2": F.shiftright(units, 2 * _LIMB),
        "words": words,
    }


def amount_parts(column: Column | str) -> dict[str, Column]:
    """An amount as parts that may be added and taken away again: its limbs, and what is beyond
    them, counted by kind. Only amounts from 2^100 on stay doubles (``beyond``)."""
    value = _number(column)
    infinite = F.abs(value) == float("inf")
    beyond = (F.abs(value) >= _EXACT_BELOW) & ~F.isnan(value) & ~infinite
    kinds = (F.isnan(value), infinite & (value > 0), infinite & (value < 0))
    return {**_limbs(value), **{k: c.cast("int") for k, c in zip(NOT_FINITE, kinds)},
            "beyond": F.when(beyond, value), "beyond_n": beyond.cast("int")}


def put_together(sums: dict[str, Column], rest: Column) -> Column:
    """The amount of summed limbs, plus ``rest`` if it is not NULL."""
    whole = sums["millionths"].cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    for place, name in enumerate(("limb0", "limb1", "limb2", "words")):
        whole = whole + sums[name].cast("decimal(18,0)") * F.lit(Decimal(2 ** (_LIMB * place)))
    return F.when(rest.isNull(), whole.cast("double")).otherwise(
        rest + F.coalesce(whole.cast("double"), F.lit(0.0)))


def total(column: Column | str) -> Column:
    """Sum of the amounts; NULLs are left out, NaN and infinity are not."""
    value = _number(column)
    inside = F.abs(value) < _EXACT_BELOW
    return put_together({name: F.sum(part) for name, part in _limbs(value).items()},
                        F.sum(F.when(~inside, value)))


def mean(column: Column | str) -> Column:
    return total(column) / F.nullif(F.count(_number(column)), F.lit(0))


def not_finite(column: Column | str) -> Column:
    """How many amounts are NaN or infinite."""
    value = _number(column)
    return F.count_if(F.isnan(value) | (F.abs(value) == float("inf")))


def mean_hours(seconds: Column) -> Column:
    """Mean of whole seconds, in hours."""
    return F.sum(seconds) / F.lit(3600.0) / F.nullif(F.count(seconds), F.lit(0))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``part`` of ``whole`` in percent; an empty whole counts as one row."""
    share = part / F.greatest(whole, F.lit(1)) * 100.0
    return share if digits is None else F.round(share, digits)
