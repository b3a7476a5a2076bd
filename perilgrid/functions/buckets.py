"""Equi-width value buckets as a Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value, type_name: str) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast(type_name)


def width_bucket(expr, min_value, max_value, num_buckets) -> Column:
    """Bucket number of ``expr`` among equal slices of [min_value, max_value).

    Below the range gives 0 and at or above it ``num_buckets + 1``. Bounds in reverse
    order number the buckets from the other end. Equal bounds only ever give the two
    outer buckets, NaN counts as 0 (before any reversal), a null argument gives null,
    and a bucket count below one raises.
    """
    value, first, last = (_col(v, "double") for v in (expr, min_value, max_value))
    buckets = _col(num_buckets, "bigint")
    any_nan = F.isnan(value) | F.isnan(first) | F.isnan(last)
    low, high = F.least(first, last), F.greatest(first, last)
    # try_divide / try_cast: infinite or equal bounds make the quotient undefined -> 0
    slot = F.try_divide(buckets.cast("double") * (value - low), high - low) + F.lit(1.0)
    rank = (
        F.when(any_nan, F.lit(0).cast("bigint"))
        .when(value < low, F.lit(0).cast("bigint"))
        .when(value >= high, buckets + 1)
        .otherwise(F.coalesce(slot.try_cast("bigint"), F.lit(0).cast("bigint")))
    )
    reversed_bounds = (first > last) & ~F.isnan(first) & ~F.isnan(last)
    missing = value.isNull() | first.isNull() | last.isNull() | buckets.isNull()
    message = F.concat(F.lit("the number of buckets must be at least 1, got "), buckets.cast("string"))
    return (
        F.when(missing, F.lit(None).cast("bigint"))
        .when(buckets <= 0, F.raise_error(message).cast("bigint"))
        .when(reversed_bounds, buckets - rank + 1)
        .otherwise(rank)
    )


def width_bucket_sql(value: str, first: str, last: str, buckets: str) -> str:
    """The same rule as SQL text, for the body of a registered function."""
    low, high = f"least({first}, {last})", f"greatest({first}, {last})"
    rank = f"""CASE
        WHEN isnan({value}) OR isnan({first}) OR isnan({last}) THEN 0L
        WHEN {value} < {low} THEN 0L
        WHEN {value} >= {high} THEN {buckets} + 1L
        ELSE coalesce(try_cast(
            try_divide(CAST({buckets} AS DOUBLE) * ({value} - {low}), {high} - {low}) + 1D AS BIGINT), 0L)
      END"""
    return f"""CASE
      WHEN {value} IS NULL OR {first} IS NULL OR {last} IS NULL OR {buckets} IS NULL THEN NULL
      WHEN {buckets} <= 0 THEN raise_error(
        concat('the number of buckets must be at least 1, got ', CAST({buckets} AS STRING)))
      WHEN {first} > {last} AND NOT isnan({first}) AND NOT isnan({last}) THEN {buckets} - ({rank}) + 1L
      ELSE {rank} END"""
