"""Column expressions shared by the operators.

All are built-in Spark expressions (whole-stage codegen, no Python per row).
Each has a DuckDB twin in ``keelson.plans.sql`` so results can be checked
against an independent engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A 32-bit md5 prefix divided by 2^32 gives a uniform draw in [0, 1).
HASH_PREFIX_HEX_DIGITS = 8
HASH_SCALE = 4294967296.0
# A null key is hashed as this text, so that it too has one side and one fold.
NULL_KEY = "<null>"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_unit(key: Column | str, seed: int | str, method: str = "md5") -> Column:
    """Deterministic uniform [0, 1) draw from the key and a seed.

    Depends only on the key and the seed — never on partitioning, task
    order or retries — so a split or fold assignment is stable when an
    executor is lost and the stage re-runs.

    ``md5`` (default) hashes ``'<seed>:<key>'`` and takes a 32-bit prefix;
    any SQL engine can reproduce it. ``xxhash64`` is cheaper per row (for
    very large tables where SQL parity is not needed): the top 53 bits of
    ``xxhash64(seed, key)``.
    """
    if method == "md5":
        digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(as_col(key).cast("string"), F.lit(NULL_KEY))))
        prefix = F.substring(digest, 1, HASH_PREFIX_HEX_DIGITS)
        return F.conv(prefix, 16, 10).cast("double") / F.lit(HASH_SCALE)
    if method == "xxhash64":
        h = F.xxhash64(F.lit(str(seed)), as_col(key))
        return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(2 ** 53))
    raise ValueError(f"unknown hash method {method!r}")


def hash_bucket(key: Column | str, seed: int | str, n: int, method: str = "md5") -> Column:
    """Integer bucket in ``[0, n)`` from the same uniform draw."""
    return F.floor(hash_unit(key, seed, method) * F.lit(float(n))).cast("int")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, null when the denominator is 0 (ANSI-safe)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def bin_index(x: Column, edges: Column) -> Column:
    """Right-open bin of ``x`` against sorted ``edges``; last edge included.

    Values left of the first edge land in bin 0, right of the last edge in
    the last bin (clipped), like a right-sided search-sorted minus one.
    """
    n_le = F.size(F.filter(edges, lambda e: e <= x))
    return F.greatest(F.lit(0), F.least(n_le - 1, F.size(edges) - 2))


def bin_of(x: Column, edges: list[float]) -> Column:
    """Same bin as ``bin_index`` for edges known on the driver: a chain of
    literal comparisons (whole-stage codegen) instead of a lambda over an
    array per row. A single edge defines no bin; like the clipped array
    form, every value then maps to 0."""
    n_bins = len(edges) - 1
    if n_bins < 1:
        return F.lit(0)
    expr = None
    for i in range(n_bins - 1):
        cond = x < F.lit(float(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(n_bins - 1)
    return last if expr is None else expr.otherwise(last)


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
