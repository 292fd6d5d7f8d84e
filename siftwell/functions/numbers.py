"""Rounding and number formats as the reference's runtime has them, so that written tables agree to the last digit."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers are taken in whole 2**-60ths, those below 2**-7 in whole 2**-70ths: no bit that decides a rounding is lost.
_UNITS = (1 << 60, 1 << 70)
_SMALL = 2.0**-7


def exact_round(c: Column, digits: int = 4) -> Column:
    """c to ``digits`` decimals by its binary value, exact ties to even: 2.675 is below its decimal form and becomes 2.67, where the
    built-in rounds that form up. From 8 on the built-in is used."""

    def of(size: int) -> Column:
        parts = (c * float(size)).cast("long").cast("decimal(19,0)") * F.lit(10**digits).cast("decimal(8,0)")
        unit = F.lit(str(size)).cast("decimal(22,0)")
        rest = F.pmod(parts, unit)
        whole = ((parts - rest) / unit).cast("decimal(27,0)")
        twice = rest * F.lit(2).cast("decimal(1,0)")
        up = (twice > unit) | ((twice == unit) & (F.pmod(whole, F.lit(2).cast("decimal(1,0)")) == 1))
        return (whole + F.when(up, 1).otherwise(0).cast("decimal(1,0)")).cast("double") / float(10**digits)

    return F.when(F.abs(c) < _SMALL, of(_UNITS[1])).when(F.abs(c) < 7.9, of(_UNITS[0])).otherwise(F.round(c, digits))


def exact_round_sql(x: str, digits: int = 4) -> str:
    """DuckDB's form of the same, for numbers from 0 to 8."""

    def of(size: int) -> str:
        parts = f"(CAST(({x}) * {size}.0::DOUBLE AS HUGEINT) * {10**digits})"
        whole, rest = f"({parts} // {size}::HUGEINT)", f"({parts} % {size}::HUGEINT)"
        up = f"(CASE WHEN 2 * {rest} > {size}::HUGEINT OR (2 * {rest} = {size}::HUGEINT AND {whole} % 2 = 1) THEN 1 ELSE 0 END)"
        return f"(CAST({whole} + {up} AS DOUBLE) / {10**digits})"

    return f"(CASE WHEN ({x}) < {_SMALL} THEN {of(_UNITS[1])} ELSE {of(_UNITS[0])} END)"


def scaled_round(c: Column, digits: int = 6) -> Column:
    """c to ``digits`` decimals as DuckDB's round has it: c times a power of ten is rounded, halves away from zero; where that product isn't
    finite, c stays. 1.0215705 times a million is below its half and becomes 1.02157, where the built-in rounds the decimal form up."""
    scale = 10.0**digits
    times = c * scale
    return F.when(F.abs(times) < float("inf"), F.signum(times) * F.round(F.abs(times)) / scale).otherwise(c)


def formatted(c: Column, spec: str, zero_is_blank: bool = False) -> Column:
    """c as text by a format such as ``.6g``, which no built-in writes. For the rows of a sink, in Arrow batches; null is empty."""

    def run(values: pd.Series) -> pd.Series:
        return pd.Series(["" if x is None or x != x or (zero_is_blank and not x) else format(x, spec) for x in values], dtype=object)

    return F.pandas_udf(run, "string")(c.cast("double"))
