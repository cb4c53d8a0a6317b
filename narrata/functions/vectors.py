"""Column expressions on vectors and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """0 if either vector is null or zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm_a * norm_b), F.lit(0.0))


def whole_days(earlier: Column, later: Column) -> Column:
    """Days between two times, rounded down before the sign goes: the order of the arguments counts."""
    return F.abs(F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400_000_000)))


def temporal_proximity(earlier: Column, later: Column, decay_days: float = 7.0) -> Column:
    """exp(-days / decay); one half where a time is missing."""
    return F.coalesce(F.exp(-whole_days(earlier, later) / F.lit(decay_days)), F.lit(0.5))


def domain_similarity(a: Column, b: Column) -> Column:
    """1 equal, 0 different, one half where either is unknown."""
    known = F.nullif(a, F.lit("")).isNotNull() & F.nullif(b, F.lit("")).isNotNull()
    return F.when(known, F.when(a == b, 1.0).otherwise(0.0)).otherwise(0.5)
