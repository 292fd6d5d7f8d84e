"""Similarities of strings, sets and bit vectors."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def within_edits(a: Column, b: Column, most: int) -> Column:
    return F.levenshtein(a, b, most) >= 0


def dice(a: Column, b: Column) -> Column:
    """Sorensen-Dice of two sets (arrays without repeats); 0 if both are empty."""
    total = F.size(a) + F.size(b)
    return F.when(total > 0, 2.0 * F.size(F.array_intersect(a, b)) / total).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def overlap_coefficient(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def sequence_ratio(a: Column, b: Column) -> Column:
    """The matching-blocks ratio of Python's standard library, which is asymmetric; no built-in computes it."""
    run = F.pandas_udf(lambda x, y: pd.Series([None if p is None or q is None else SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype=float), "double")
    return run(a, b)


def lengths_near(a: Column, b: Column, share: float = 0.4) -> Column:
    """Relative difference of lengths of at most share: a cheap test before the ratio."""
    longest = F.greatest(F.length(a), F.length(b))
    return (longest > 0) & (F.abs(F.length(a) - F.length(b)) <= share * longest)


def deletion_keys(c: Column, most: int = 2, shortest: int = 6) -> Column:
    """The name and all its versions with up to two characters deleted; two names within that distance share one. A name
    shorter than ``shortest`` has itself alone."""
    once = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    keys = F.concat(F.array(c), once)
    if most > 1:
        twice = F.flatten(F.transform(once, lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))))
        keys = F.concat(keys, twice)
    return F.when(F.length(c) >= shortest, F.array_distinct(keys)).otherwise(F.array(c))


def tanimoto(a: Column, b: Column) -> Column:
    """Of bit vectors as arrays of 64-bit words; 0 if neither has a bit."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    any_ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(any_ > 0, both / any_).otherwise(0.0)


def formulas_fit(a: Column, b: Column) -> Column:
    """Unknown fits all; two known sets must meet."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.arrays_overlap(a, b)).otherwise(True)


def masses_fit(a: Column, b: Column, most: float = 0.5) -> Column:
    return F.coalesce(F.abs(a - b) <= most, F.lit(True))


def charges_fit(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(True))
