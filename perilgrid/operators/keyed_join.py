"""Equi-joins that stay balanced: broadcast behind a measured size, hot keys split otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilgrid.schema import FID
from perilgrid.session import new_dir

BROADCAST_BYTES = 64 << 20
LEFT_ROWS_PER_TASK = 2_000_000
RIGHT_ROWS_PER_TASK = 50_000

_FIXED_WIDTH = 8


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one in-memory row, from its schema and the lengths of its variable parts."""
    parts = [_width(f"`{field.name}`", field.dataType) for field in df.schema]
    return F.expr(" + ".join([f"{4 * _FIXED_WIDTH}L", *parts]))


def _width(value: str, data_type: T.DataType) -> str:
    fixed = _fixed_width(data_type)
    if fixed is not None:
        return str(fixed)
    if isinstance(data_type, T.StructType):
        fields = [_width(f"{value}.`{f.name}`", f.dataType) for f in data_type]
        return f"coalesce({' + '.join(fields)}, 0) + {2 * _FIXED_WIDTH}"
    if isinstance(data_type, T.ArrayType):
        element = _fixed_width(data_type.elementType)
        if element is not None:
            body = f"greatest(size({value}), 0) * {element}"
        else:
            body = f"aggregate({value}, 0L, (acc, e) -> acc + {_width('e', data_type.elementType)})"
        return f"coalesce({body}, 0) + {4 * _FIXED_WIDTH}"
    if isinstance(data_type, T.MapType):
        keys = _width(f"map_keys({value})", T.ArrayType(data_type.keyType))
        return f"{keys} + {_width(f'map_values({value})', T.ArrayType(data_type.valueType))}"
    return f"coalesce(octet_length({value}), 0) + {2 * _FIXED_WIDTH}"


def _fixed_width(data_type: T.DataType) -> int | None:
    if isinstance(data_type, T.StructType):
        parts = [_fixed_width(f.dataType) for f in data_type]
        return None if None in parts else sum(parts) + 2 * _FIXED_WIDTH
    if isinstance(data_type, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
        return None
    return _FIXED_WIDTH


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame | None:
    """All keys holding more rows than one task should take, with their number of ``_parts``.

    Counts are partially aggregated before the shuffle. There are at most as many hot keys as
    tasks' worth of rows; they are written to the shared folder and stay a DataFrame. None if no
    key is hot. Null keys match nothing and do not count.
    """
    spark = df.sparkSession
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > rows_per_task)
    path = new_dir(spark, "hot-keys")
    hot.select(*keys, F.ceil(F.col("_n") / rows_per_task).alias("_parts")).write.parquet(path)
    found = spark.read.parquet(path)
    return None if found.isEmpty() else found


def _parts(df: DataFrame, keys: list[str], hot: DataFrame, name: str) -> DataFrame:
    """Attach the number of parts of each row's key; keys that are not hot have one.

    The list is broadcast if it measures small; else adaptive execution splits this join.
    """
    size = hot.agg(F.sum(row_bytes(hot))).first()[0] or 0
    lookup = F.broadcast(hot) if size <= BROADCAST_BYTES else hot
    joined = df.join(lookup, keys, "left")
    return joined.withColumn(name, F.coalesce("_parts", F.lit(1).cast("bigint"))).drop("_parts")


def _own_part(df: DataFrame, parts: str) -> Column:
    """Deterministic part number of a row, spreading even exact copies over the map tasks."""
    columns = [FID] if FID in df.columns else [
        f.name for f in df.schema if not isinstance(f.dataType, T.MapType) and f.name != parts
    ]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in columns]) + F.spark_partition_id()
    return F.pmod(spread, F.col(parts))


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    condition: Column | None = None,
    how: str = "inner",
    left_rows: int = LEFT_ROWS_PER_TASK,
    right_rows: int = RIGHT_ROWS_PER_TASK,
) -> DataFrame:
    """Shuffle join that cuts hot keys into parts on both sides.

    A key hot on the left spreads its left rows over parts and repeats its right rows
    once per part, and the other way round, so every matching pair still meets in
    exactly one place. Semi joins split only the left side, as repeating left rows would
    repeat them in the output: use them where the right side has few rows for each key.
    """
    hot_left = hot_keys(left, keys, left_rows)
    hot_right = hot_keys(right, keys, right_rows) if how == "inner" else None
    on = list(keys)
    if hot_left is not None:
        on.append("_lpart")
        left = _parts(left, keys, hot_left, "_ln")
        left = left.withColumn("_lpart", _own_part(left, "_ln")).drop("_ln")
        right = _parts(right, keys, hot_left, "_ln")
        right = right.withColumn("_lpart", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_ln") - 1))).drop("_ln")
    if hot_right is not None:
        on.append("_rpart")
        right = _parts(right, keys, hot_right, "_rn")
        right = right.withColumn("_rpart", _own_part(right, "_rn")).drop("_rn")
        left = _parts(left, keys, hot_right, "_rn")
        left = left.withColumn("_rpart", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_rn") - 1))).drop("_rn")
    return _join(left, right, on, condition, how).drop("_lpart", "_rpart")


def _join(left: DataFrame, right: DataFrame, on: list[str], condition: Column | None, how: str) -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    matched = F.lit(True)
    for key in on:
        matched = matched & (F.col(f"`{key}`") == F.col(f"`_r_{key}`"))
    if condition is not None:
        matched = matched & condition
    return left.join(right, matched, how).drop(*[f"_r_{k}" for k in on])


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    condition: Column | None = None,
    how: str = "inner",
    right_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    **split_options,
) -> DataFrame:
    """Join a large left side: broadcast the right side if it measures small, else split hot keys.

    ``condition`` may name columns of both sides; apart from ``keys`` their names must differ.
    ``right_bytes`` is the measured size of the right side, if the caller has it already.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if right_bytes is None:
        right_bytes = right.agg(F.sum(row_bytes(right))).first()[0] or 0
    if right_bytes <= broadcast_bytes:
        return _join(left, F.broadcast(right), keys, condition, how)
    return split_join(left, right, keys, condition, how, **split_options)
