"""Deterministic user sampling.

A user is kept when a hash of its id falls below the rate's share of the
hash range. The
decision depends on the id only, so it is the same in every run, on every
partition layout, and in any SQL engine with ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits of md5, a 60-bit number that fits a bigint.
HASH_HEX_DIGITS = 15
HASH_RANGE = 1 << 60


def user_hash(user: Column, seed: str = "") -> Column:
    """Number in ``[0, HASH_RANGE)`` from the md5 of ``seed || user``."""
    text = F.concat(F.lit(seed), user.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def keep_user(user: Column, rate: float, seed: str = "") -> Column:
    """True for users in the sample. Rates outside (0, 1) keep everyone, as
    in the original job."""
    if not 0 < rate < 1:
        return F.lit(True)
    return user_hash(user, seed) < F.lit(int(rate * HASH_RANGE)).cast("bigint")
