"""Scalar helpers: motif names, trimming, number formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: enzyme names and their motifs
ALIASES = {"HINDIII": "AAGCTT", "HIND3": "AAGCTT", "NCOI": "CCATGG", "DPN1": "GATC", "MBOI": "GATC"}


def resolve_motif(name: str) -> str:
    """The motif of an enzyme name, or the motif itself; upper case."""
    found = ALIASES.get(name.upper(), name.upper())
    if not re.fullmatch("[ACGT]+", found):
        raise ValueError(f"neither an enzyme nor a motif: {name!r}")
    return found


def right_trim(value: Column) -> Column:
    """Drop trailing spaces, tabs and line-end characters."""
    return F.regexp_replace(value, "[\\t\\n\\x0B\\f\\r ]+$", "")


def bin_floor(value: Column, size: int) -> Column:
    """The start of the bin of a non-negative position."""
    return F.floor(value / F.lit(size)).cast("bigint") * F.lit(size).cast("bigint")


def truncated_e5(value: Column) -> Column:
    """100,000 times a number, cut toward zero."""
    return (value * F.lit(100000.0)).cast("bigint")


def as_float32(value: float) -> Column:
    """An option that is kept in single precision."""
    return F.lit(value).cast("float").cast("double")


def _halves(x: Column) -> tuple[Column, Column]:
    """A double as the exact sum of two whose products with such halves are exact."""
    big = x * F.lit(134217729.0)  # 2 ** 27 + 1
    high = big - (big - x)
    return high, x - high


def fixed_15(value: Column) -> Column:
    """A number below 2**53 in size with 15 decimals, as C prints it: the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form instead.  The fraction
    times 10**15 is split into a double and its exact error, which decides
    where the double lies halfway between two integers.
    """
    size = F.abs(value)
    whole = F.floor(size)
    part = size - whole
    product = part * F.lit(1e15)
    (a, b), (c, d) = _halves(part), _halves(F.lit(1e15))
    error = ((a * c - product) + a * d + b * c) + b * d
    nearest = F.rint(product)
    rest = product - nearest
    units = (nearest + F.when((rest == 0.5) & (error > 0), 1).when((rest == -0.5) & (error < 0), -1).otherwise(0)).cast("bigint")
    carry = units >= 10**15
    sign = F.when((value < 0) | (value.cast("string") == "-0.0"), "-").otherwise("")
    return F.concat(sign, (whole + carry.cast("bigint")).cast("string"), F.lit("."), F.lpad(F.when(carry, 0).otherwise(units).cast("string"), 15, "0"))
