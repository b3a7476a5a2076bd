"""Feature tables stored as Parquet, one directory per table below a root path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilgrid.functions.curve import hilbert_key
from perilgrid.operators.keyed_join import BROADCAST_BYTES, row_bytes
from perilgrid.schema import FEATURE_TYPES, FID, FeatureType, geometry_fields
from perilgrid.session import drop_dir, new_dir, path_exists

BUCKET = "_bucket"
BUCKETS = 64
CODEC = "zstd"  # ids that are hashes in hexadecimal digits take half the bytes


def _feature_type(name: str) -> FeatureType:
    try:
        return FEATURE_TYPES[name]
    except KeyError:
        raise ValueError(f"unknown feature type {name!r}; known: {sorted(FEATURE_TYPES)}") from None


def table_path(root: str, name: str, table: str | None = None) -> str:
    return f"{root.rstrip('/')}/{table or _feature_type(name).table}"


def create_feature_table(spark: SparkSession, root: str, name: str, table: str | None = None) -> str:
    """Create an empty table with the declared schema; fails if it exists."""
    path = table_path(root, name, table)
    _feature_type(name).empty(spark).write.mode("error").parquet(path)
    return path


def read_feature_table(spark: SparkSession, root: str, name: str, table: str | None = None) -> DataFrame:
    """``__fid__`` and the declared attributes; the schema is given, so no file is opened to infer it."""
    schema = _feature_type(name).table_schema
    stored = spark.read.schema(schema).parquet(table_path(root, name, table))
    return stored.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])  # directory columns come last as read


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the stored columns in declared order; missing attributes become null.

    A frame without ``__fid__`` gets a 128-bit hash of its attribute values, so a task that
    runs again assigns the same ids.
    """
    feature_type = _feature_type(name)
    have = set(df.columns)
    if extra := have - set(feature_type.table_schema.fieldNames()):
        raise ValueError(f"columns not in feature type {name}: {sorted(extra)}")
    if FID in have:
        fid = F.col(FID)
    else:
        present = [F.col(f"`{f.name}`") for f in feature_type.schema if f.name in have]
        nulls = [c.isNull() for c in present]  # the hash itself skips nulls
        halves = [F.xxhash64(F.lit(salt), *present, *nulls) for salt in (0, 1)]
        fid = F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])
    columns = [fid.alias(FID)]
    for field in feature_type.schema:
        value = F.col(f"`{field.name}`") if field.name in have else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def write_feature_table(
    df: DataFrame,
    root: str,
    name: str,
    table: str | None = None,
    mode: str = "append",
    partition_by: list[str] | None = None,
    cluster_tile: float | None = None,
    files: int | None = None,
    cluster_curve: bool = False,
) -> str:
    """Append (by default) rows to a feature table and return its path.

    ``cluster_tile`` range-partitions and sorts the rows by square tiles of the default
    geometry, so that the min/max statistics of each row group cover a small area and box
    filters skip the rest. The feature id is the last range key: it splits a tile that
    holds a large share of the rows over several files. ``cluster_curve`` does the same along a
    Hilbert curve: each file and row group covers a compact area at any density, without a tile
    size to choose; rows without a place come first.
    ``partition_by`` lays out directories. The rows are rebalanced by its columns first:
    small values share a task, and adaptive execution splits the large ones, so neither
    many small files nor one task for a whole directory result.
    """
    feature_type = _feature_type(name)
    out = conform(df, name)
    path = table_path(root, name, table)
    if cluster_tile and cluster_curve:
        raise ValueError("cluster by tiles or along a curve, not both")
    if cluster_tile or cluster_curve:
        if feature_type.default_geometry is None:
            raise ValueError(f"feature type {name} has no geometry to cluster by")
        geom = f"`{feature_type.default_geometry}`"
        kind = geometry_fields(feature_type.schema)[feature_type.default_geometry]
        if cluster_curve:
            box = f"{geom}.bbox"
            middle = [f"{geom}.{c}" if kind == "Point" else f"({box}.{c}min + {box}.{c}max) / 2D" for c in "xy"]
            area = [hilbert_key(*middle)]
        else:
            x, y = (f"{geom}.x", f"{geom}.y") if kind == "Point" else (f"{geom}.bbox.xmin", f"{geom}.bbox.ymin")
            area = [F.floor(F.expr(y) / cluster_tile), F.floor(F.expr(x) / cluster_tile)]
        # keys are computed once for a row, not by each step that sorts by them
        keyed = {f"_key{i}": key for i, key in enumerate([*area, F.xxhash64(FID)])}
        order = [*(partition_by or []), *keyed]
        out = out.withColumns(keyed)
        out = out.repartitionByRange(files, *order) if files else out.repartitionByRange(*order)
        out = out.sortWithinPartitions(*order).drop(*keyed)
    elif partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def upsert_feature_table(
    df: DataFrame, root: str, name: str, table: str | None = None, buckets: int = BUCKETS
) -> str:
    """Write rows by feature id: a row replaces the stored one of the same id, others are added.

    The table lies in directories by a hash of the id. Only those that the new rows fall into are read and
    written again, and they are replaced when all tasks are done. A load that runs again, after a
    failure or by mistake, therefore leaves the same table. Of several new rows with one id the one with the
    smallest hash stays, so that a retry keeps the same one; rows with a null id are refused. Hashes of ids are
    shuffled to find copies and replaced rows; whole rows only where ids occur several times.

    A table belongs to one way of writing: one that was appended to cannot be upserted.
    """
    spark = df.sparkSession
    path = table_path(root, name, table)
    schema = _feature_type(name).table_schema
    columns = [F.col(f"`{f.name}`") for f in schema]
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        if stored.columns and BUCKET not in stored.columns:
            raise ValueError(f"{path} was not written by feature id")
    bucket = F.pmod(F.xxhash64(FID), F.lit(buckets)).cast("int").alias(BUCKET)
    one = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")
    known = F.when(F.col(FID).isNull(), F.raise_error(F.lit("a feature id is null"))).otherwise(F.col(FID))
    staged = new_dir(spark, "upsert")
    fresh = conform(df, name).withColumn(FID, known).select("*", bucket)
    fresh.write.option("compression", CODEC).parquet(staged)
    fresh = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(staged)
    sizes = dict(map(tuple, fresh.groupBy(BUCKET).agg(F.sum(row_bytes(fresh))).collect()))  # at most ``buckets``
    if not sizes:
        drop_dir(spark, staged)
        return path
    lists = [new_dir(spark, "upsert-ids") for _ in range(3)]
    merged = _without_copies(fresh, lists[0], one)
    if path_exists(spark, path):
        old = spark.read.schema(fresh.schema).parquet(path).where(F.col(BUCKET).isin(list(sizes)))
        merged = _not_replaced(old, fresh, lists[1:]).unionByName(merged)
    if sum(sizes.values()) <= BROADCAST_BYTES:  # few rows would make a small file for each task and directory
        merged = merged.hint("rebalance", BUCKET)
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
    writer.partitionBy(BUCKET).parquet(path)
    for folder in (staged, *lists):
        drop_dir(spark, folder)
    return path


def _hashed(df: DataFrame) -> DataFrame:
    """Rows with 128 bits of hash of their id, which stand for the id where whole rows need not be shuffled."""
    return df.withColumns({f"_h{salt}": F.xxhash64(F.lit(salt), FID) for salt in (0, 1)})


_HASHES = ["_h0", "_h1"]


def _listed(ids: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Hashes of ids, written and read back, with the size of their rows."""
    ids.select(*_HASHES).write.parquet(path)
    stored = ids.sparkSession.read.schema("_h0 bigint, _h1 bigint").parquet(path)
    return stored, stored.agg(F.sum(row_bytes(stored))).first()[0] or 0


def _sized(ids: DataFrame, size: int) -> DataFrame:
    return F.broadcast(ids) if size <= BROADCAST_BYTES else ids


def _without_copies(fresh: DataFrame, path: str, one: Column) -> DataFrame:
    """One row of each id. Ids that occur once are told by their hashes; the rows of the others alone are grouped."""
    columns = fresh.columns
    counts = _hashed(fresh.select(FID)).groupBy(*_HASHES).agg(F.count(F.lit(1)).alias("_n"))
    several, size = _listed(counts.where("_n > 1"), path)
    if not size:
        return fresh
    rows = _hashed(fresh)
    single = rows.join(_sized(several, size), _HASHES, "left_anti").select(*columns)
    copies = rows.join(_sized(several, size), _HASHES, "left_semi")
    grouped = copies.groupBy(F.col(FID).alias("_id")).agg(one, F.first(BUCKET).alias(BUCKET)).select("row.*", BUCKET)
    return single.unionByName(grouped)


def _not_replaced(old: DataFrame, fresh: DataFrame, paths: list[str]) -> DataFrame:
    """The stored rows whose id is not among the new ones, by the shorter list of hashes: of those that stay or go."""
    ids, new = _hashed(old.select(FID)).select(*_HASHES), _hashed(fresh.select(FID)).select(*_HASHES)
    stay, stay_size = _listed(ids.join(new, _HASHES, "left_anti"), paths[0])
    rows = _hashed(old)
    if stay_size > BROADCAST_BYTES:
        go, go_size = _listed(ids.join(new, _HASHES, "left_semi"), paths[1])
        if go_size <= BROADCAST_BYTES:
            return rows.join(F.broadcast(go), _HASHES, "left_anti").select(*old.columns)
    return rows.join(_sized(stay, stay_size), _HASHES, "left_semi").select(*old.columns)


def export_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    """Pipe-delimited text with a header; geometry columns are not exportable as text."""
    if nested := [f.name for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]:
        raise ValueError(f"drop or convert nested columns first: {nested}")
    df.write.mode(mode).option("sep", "|").option("header", True).csv(path)
    return path
