"""Put known defects into clean rows, to test cleaning jobs at full size.

Every choice depends only on a whole-number key column and a salt, so a rerun, a retried task
or another engine produces the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multiplicative hash modulo a prime below 2^31, so the product of two residues fits a bigint.
_PRIME = 2147483647
_STEP = 1103515245
_SALT_STEP = 69069069

_COPY = "__copy"


def bucket(key: Column, n: int, salt: int = 0) -> Column:
    """Evenly spread number from 0 to ``n - 1``; different salts give unrelated numbers."""
    factor = (_STEP + salt * _SALT_STEP) % _PRIME
    return (F.pmod(key.cast("bigint"), F.lit(_PRIME)) + 1) * factor % _PRIME % n


def _pick(choice: Column, options: Sequence[Column]) -> Column:
    # F.when opens the CASE, Column.when extends it; only the chosen option is computed.
    return reduce(lambda expr, i: expr.when(choice == i, options[i]), range(len(options)), F)


def vary_format(
    moment: Column, key: Column, formats: Sequence[str | None], salt: int = 0
) -> Column:
    """Timestamp or date written as text in one of ``formats``; a None entry gives NULL."""
    texts = [
        F.lit(None).cast("string") if fmt is None else F.date_format(moment, fmt)
        for fmt in formats
    ]
    return _pick(bucket(key, len(formats), salt), texts)


def blank_out(value: Column, key: Column, percent: int, salt: int = 0) -> Column:
    """NULL in ``percent`` of 100 rows."""
    return F.when(bucket(key, 100, salt) >= percent, value)


def pad_spaces(
    text: Column, key: Column, salt: int = 0, both: int = 20, leading: int = 8
) -> Column:
    """Two spaces on each side in ``both`` of 100 rows, one leading space in another ``leading``."""
    share = bucket(key, 100, salt)
    before = F.when(share < both, "  ").when(share < both + leading, " ").otherwise("")
    after = F.when(share < both, "  ").otherwise("")
    return F.concat(before, text, after)


def vary_case(
    text: Column, key: Column, salt: int = 0, upper: int = 15, lower: int = 10
) -> Column:
    """Upper case in ``upper`` of 100 rows, lower case in another ``lower``."""
    share = bucket(key, 100, salt)
    return F.when(share < upper, F.upper(text)).when(share < upper + lower, F.lower(text)).otherwise(text)


def vary_spelling(key: Column, spellings: Sequence[str | None], salt: int = 0) -> Column:
    """One of ``spellings``; a None entry gives NULL."""
    options = F.array(*[F.lit(s).cast("string") for s in spellings])
    return F.element_at(options, (bucket(key, len(spellings), salt) + 1).cast("int"))


def add_newer_copies(
    df: DataFrame, copies: Column, column: str, newer: Callable[[Column], Column]
) -> DataFrame:
    """Repeat each row ``copies`` more times, with another value in ``column`` of each copy.

    ``newer`` gets the number of the copy (from 1) and returns its value. Rows multiply where
    they are: the input is read once and nothing is shuffled.
    """
    numbered = df.withColumn(_COPY, F.explode(F.sequence(F.lit(0), copies.cast("int"))))
    value = F.when(F.col(_COPY) == 0, F.col(column)).otherwise(newer(F.col(_COPY)))
    return numbered.withColumn(column, value).drop(_COPY)


def poisson_thresholds(mean: float, steps: int = 1_000_000) -> list[int]:
    """How many of ``steps`` equal parts go to at most 0, 1, 2, ... events of a Poisson
    distribution: the inverse of its distribution function, cut where a part is less than one step."""
    upto, chance, total = [], math.exp(-mean), 0.0
    while round(total * steps) < steps and len(upto) < 64:
        total += chance
        upto.append(round(total * steps))
        chance *= mean / len(upto)
    return upto


def poisson_count(key: Column, mean: float, salt: int = 0, steps: int = 1_000_000) -> Column:
    """Number of events of a Poisson distribution, chosen by the hash of ``key``."""
    share = bucket(key, steps, salt)
    limits = [t for t in poisson_thresholds(mean, steps) if t < steps]
    return reduce(lambda total, t: total + (share >= t).cast("int"), limits, F.lit(0))


def add_copies_with_replacement(
    df: DataFrame, key: Column, mean: float, column: str, newer: Callable[[Column, Column], Column], salt: int = 0
) -> DataFrame:
    """Repeat rows as if copies were drawn with replacement, ``mean`` a row on average.

    Drawing a row of a large table over and over, each time among all, makes the number of copies
    of a row a Poisson number, and copies are drawn as well: a copy has copies of its own, by the
    same law. ``newer`` gets the numbers of the copy and of its copy (0: none) and returns the
    value of ``column``; the row itself stays as it is. Rows multiply where they are.
    """
    first, second = f"{_COPY}1", f"{_COPY}2"
    once = df.withColumn(first, F.explode(F.sequence(F.lit(0), poisson_count(key, mean, salt))))
    again = F.when(F.col(first) > 0, poisson_count(key * 64 + F.col(first), mean, salt + 1)).otherwise(0)
    twice = once.withColumn(second, F.explode(F.sequence(F.lit(0), again)))
    value = F.when(F.col(first) == 0, F.col(column)).otherwise(newer(F.col(first), F.col(second)))
    return twice.withColumn(column, value).drop(first, second)
