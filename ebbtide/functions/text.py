"""Number formatting for reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# One suffix per power of a thousand.
SUFFIXES = ["", "K", "M", "B", "T"]


def human_format(number: Column) -> Column:
    """Three significant digits and a suffix: 1234 -> ``1.23K``, 999950 -> ``1M``.

    Ties go to the even digit. Beyond 10^15 the value stays in ``T``.
    """
    value = number.cast("double")
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 2)
    # below the last printed digit a quotient would only add noise, hence the two forms
    rounded = F.when(step >= 1, F.bround(value / step) * step).otherwise(
        F.bround(value * (1 / step)) / (1 / step)
    )
    power = F.least(
        F.greatest(F.floor(F.log10(F.abs(rounded)) / 3), F.lit(0)), F.lit(len(SUFFIXES) - 1)
    )
    digits = F.format_string("%.6f", rounded / F.pow(F.lit(1000.0), power))
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (power + 1).cast("int"))
    text = F.concat(F.regexp_replace(digits, r"\.?0+$", ""), suffix)
    return F.when(value == 0, F.lit("0")).when(value.isNotNull(), text)
