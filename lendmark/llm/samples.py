"""Bounded samples that don't depend on how the rows are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARGIN = 4.0  # how many times the sample passes the first sieve


def smallest_hashes(rows: DataFrame, n: int, *key: str, seed: int = 0, total: int | None = None) -> DataFrame:
    """The ``n`` rows with the smallest hashes of ``key`` (all, if fewer).

    A share of the hash's full range thins the rows first, so only about ``MARGIN`` * ``n``
    of ``total`` rows are ordered; a sieve that lets fewer than ``n`` through is left out.
    """
    if total is None:
        total = rows.count()
    hashed = F.xxhash64(F.lit(seed), *key)
    sieve = (hashed.cast("double") + 2.0**63) <= MARGIN * n / max(total, 1) * 2.0**64
    if total > MARGIN * n and rows.filter(sieve).limit(n).count() == n:
        rows = rows.filter(sieve)
    return rows.orderBy(hashed, *key).limit(n)
