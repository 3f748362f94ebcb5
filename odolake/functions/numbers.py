"""Rounding, exact sums and unit conversion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Kilometres per mile and litres per US gallon.
KM_PER_MILE = 1.609344
LITRES_PER_GALLON = 3.785411784

_WHOLE = 2.0**53  # from here on doubles are whole numbers


def half_up(value: Column, digits: int = 6) -> Column:
    """Round a double half up with plain IEEE steps, so other engines can repeat it bit by bit."""
    unit = float(10**digits)
    scaled = value * F.lit(unit)
    # Beyond this a double has no digits left to round, and the scaled number does not fit a bigint.
    rounded = F.floor(scaled + F.lit(0.5)) / F.lit(unit)
    return F.when(F.abs(scaled) >= F.lit(_WHOLE), value).otherwise(rounded)


def micro(value: Column) -> Column:
    """A double as whole millionths; sums of these do not depend on row order."""
    scaled = value * F.lit(1e6) + F.lit(0.5)
    too_large = F.raise_error(F.lit("a value of 9e12 or more cannot be summed as whole millionths")).cast("bigint")
    return F.when(F.abs(scaled) >= F.lit(9e18), too_large).otherwise(F.floor(scaled))


def from_micro(value: Column) -> Column:
    return value.cast("double") / F.lit(1e6)


# A double is taken apart into whole numbers of 24 binary digits each. Summed one by one as bigints they have room for
# 2 ** 39 rows, and the sum of a column is exact, so it does not depend on order or partitioning.
_DIGITS = 24
_LIMBS = 9
_LOWEST = -120  # exponent of the last place kept, about 7.5e-37
_LARGEST = 2.0 ** (_LOWEST + _DIGITS * _LIMBS - 1)  # about 4e28


def _limb_sums(value: Column) -> list[Column]:
    """Sums of the limbs of a finite column, lowest first."""
    units = [_LOWEST + _DIGITS * i for i in range(_LIMBS)]
    # Multiplying by a power of two and rounding to a whole number keep all digits above the unit.
    whole = [F.rint(value * F.lit(2.0**-unit)) for unit in units] + [F.lit(0.0)]
    base = F.lit(2.0**_DIGITS)
    return [F.sum((low - high * base).cast("bigint")) for low, high in zip(whole, whole[1:])]


def exact_sum(value: Column) -> Column:
    """Sum of doubles, rounded once at the end: the same bits whatever the order and the partitioning.

    Digits below 2 ** -120 are rounded away, values of 2 ** 95 and more are an error. If a value is NaN or infinite the
    plain sum is returned, which then does not depend on the order either.
    """
    number = value.cast("double")
    odd = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    too_large = F.raise_error(F.lit("a value of 2 ** 95 or more cannot be summed exactly")).cast("double")
    finite = F.when(odd, None).when(F.abs(number) >= F.lit(_LARGEST), too_large).otherwise(number)
    total, carry = F.lit(0.0), F.lit(0).cast("bigint")
    half, base = F.lit(1 << (_DIGITS - 1)), F.lit(1 << _DIGITS)
    sums = _limb_sums(finite)
    for i, limb in enumerate(sums):
        limb = limb + carry
        if i + 1 < len(sums):
            carry = F.shiftright(limb + half, _DIGITS)
            limb = limb - carry * base
        total = total + limb.cast("double") * F.lit(2.0 ** (_LOWEST + _DIGITS * i))
    return F.when(F.bool_or(odd), F.sum(number)).otherwise(total)


def exact_mean(value: Column) -> Column:
    """Mean by ``exact_sum``: the same bits whatever the partitioning, so it can serve as a grouping key."""
    return exact_sum(value) / F.count(value)


def mpg_to_km_per_litre(mpg: Column) -> Column:
    return mpg * F.lit(KM_PER_MILE) / F.lit(LITRES_PER_GALLON)


def null_if_nan_text(value: Column, to_type: str) -> Column:
    """Text column where a missing value was stored as ``'nan'``, cast to its type; typed columns pass through."""
    return F.nullif(value.cast("string"), F.lit("nan")).try_cast(to_type)


def fixed_point(value: Column, digits: int = 6) -> Column:
    return F.format_string(f"%.{digits}f", value)
