"""Ingest jobs: source files to typed feature rows, with an ``_ok`` flag per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilgrid.functions.geometry import point, wkt_point, wkt_polygon
from perilgrid.schema import FEATURE_TYPES, FID
from perilgrid.sources import geojson
from perilgrid.sources.delimited import field, read_fields
from perilgrid.session import drop_dir, new_dir, path_exists
from perilgrid.sources.feature_table import upsert_feature_table, write_feature_table

# Positions of the coordinate and shape fields in a site exposure line,
# and the two tables whose text files start with a header line.
LATITUDE_FIELD = 9
LONGITUDE_FIELD = 11
SHAPE_FIELD = 6
WITH_HEADER = ("siteexposure_event", "nzgrid_event")


def _key(key_columns: list[str]) -> Column:
    """Feature id from key columns: one as it is, several each with its length; null if any is."""
    texts = [F.col(f"`{c}`").cast("string") for c in key_columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


def _fid(key_columns: list[str] | None) -> Column:
    """Feature id from the named columns, or a hash of the whole line."""
    return _key(key_columns) if key_columns else F.sha2("line", 256)


def _typed(rows: DataFrame, schema: T.StructType, geometries: dict[str, Column], dropped: int) -> DataFrame:
    columns = []
    for index, f in enumerate(schema):
        if f.name in geometries:
            value = geometries[f.name]
        else:
            value = F.expr(field(index, f.dataType))
            if dropped:
                value = F.when(F.lit(index) < F.size("fields") - dropped, value)
        columns.append(value.cast(f.dataType).alias(f.name, metadata=f.metadata))
    return rows.select("line", "fields", *columns)


def ingest_text(
    spark: SparkSession,
    path: str | list[str],
    name: str,
    key_columns: list[str] | None = None,
    header: bool | None = None,
    sep: str = "|",
    legacy_drop_tail: bool = False,
) -> DataFrame:
    """Read a text table as feature rows: ``__fid__``, attributes, ``_ok`` (and ``geo_valid``).

    ``_ok`` is false for blank lines, for lines with more fields than the table has, whose
    geometry text does not parse, or with a null key column. Short lines load with nulls at the end. For site
    exposure an unparsable latitude or longitude becomes 0.0, coordinates out of range
    stay and are marked in ``geo_valid``, and a line that ends before the longitude is
    not ok. ``legacy_drop_tail`` leaves the last two fields of a site line unloaded.
    """
    feature_type = FEATURE_TYPES[name]
    schema = feature_type.schema
    header = name in WITH_HEADER if header is None else header
    rows = read_fields(spark, path, header, sep)
    n_fields = F.size("fields")
    is_site = name == "siteexposure_event"

    geometries: dict[str, Column] = {}
    if is_site:
        lat = F.coalesce(F.expr(field(LATITUDE_FIELD, T.DoubleType())), F.lit(0.0))
        lon = F.coalesce(F.expr(field(LONGITUDE_FIELD, T.DoubleType())), F.lit(0.0))
        geometries = {
            "geom": F.when(n_fields > LONGITUDE_FIELD, point(lon, lat)),
            "shapegeom": wkt_point(field(SHAPE_FIELD, T.StringType())),
        }
    else:
        for index, f in enumerate(schema):
            if f.metadata.get("geometry") == "Polygon":
                geometries[f.name] = wkt_polygon(field(index, T.StringType()))
            elif f.metadata.get("geometry") == "Point":
                geometries[f.name] = wkt_point(field(index, T.StringType()))
    text_fields = len(schema) - 2 if is_site else len(schema)
    typed = _typed(rows, schema, geometries, dropped=2 if legacy_drop_tail else 0)
    ok = (n_fields <= text_fields) & (F.trim("line") != "")
    for key in key_columns or []:
        ok = ok & F.col(f"`{key}`").isNotNull()
    for geometry in geometries:
        ok = ok & F.col(f"`{geometry}`").isNotNull()
    columns = [_fid(key_columns).alias(FID), *[F.col(f"`{f.name}`") for f in schema]]
    if is_site:
        in_range = (F.abs(F.col("geom.y")) <= 90) & (F.abs(F.col("geom.x")) <= 180)
        columns.append(F.coalesce(in_range, F.lit(False)).alias("geo_valid"))
    return typed.select(*columns, ok.alias("_ok"))


def ingest_geojson(
    spark: SparkSession,
    path: str | list[str],
    name: str = "wildfireevent",
    key_columns: list[str] | None = None,
    layout: str = "auto",
) -> DataFrame:
    """Read polygon features, of one or several parts: ``__fid__``, attributes, ``_ok``.

    Without ``key_columns`` the feature's own ``id`` is used, then a hash of its content.
    """
    feature_type = FEATURE_TYPES[name]
    geom = feature_type.default_geometry
    features = geojson.read_features(spark, path, feature_type, layout)
    attributes = []
    for f in feature_type.schema:
        value = geojson.feature_polygon() if f.name == geom else F.col(f"properties.`{f.name}`")
        attributes.append(value.cast(f.dataType).alias(f.name, metadata=f.metadata))
    content = F.sha2(F.to_json(F.struct("properties", "geometry")), 256)
    rows = features.select(
        F.coalesce("id", content).alias("_own_id"), (F.col("type") == "Feature").alias("_feature"), *attributes
    )
    fid = _key(key_columns) if key_columns else F.col("_own_id")
    ok = F.coalesce(F.col("_feature") & F.col(f"`{geom}`").isNotNull(), F.lit(False)) & fid.isNotNull()
    return rows.select(fid.alias(FID), *[F.col(f"`{f.name}`") for f in feature_type.schema], ok.alias("_ok"))


def quality_counts(ingested: DataFrame) -> DataFrame:
    """``written`` and ``failed`` rows of an ingest."""
    return ingested.agg(
        F.count_if(F.col("_ok")).alias("written"), F.count_if(~F.col("_ok")).alias("failed")
    )


def load(
    ingested: DataFrame,
    root: str,
    name: str,
    quarantine: str | None = None,
    mode: str = "append",
    cluster_tile: float | None = None,
    cluster_curve: bool = False,
) -> tuple[int, int]:
    """Write the good rows to the feature table and return ``(written, failed)``.

    The counts are observed during the write itself, so accounting costs no extra pass.
    Failed rows go to the ``quarantine`` path if one is given; only then, and only if there
    are any, is the source read again.

    ``mode="upsert"`` writes by feature id (:func:`upsert_feature_table`), so that a load can run again; the
    quarantine then holds the failures of the last load.
    """
    counts = Observation()
    observed = ingested.observe(
        counts, F.count_if(F.col("_ok")).alias("written"), F.count_if(~F.col("_ok")).alias("failed")
    )
    good = observed.where("_ok").drop("_ok", "geo_valid")
    if mode == "upsert":
        if cluster_tile or cluster_curve:
            raise ValueError("a table written by feature id is not laid out by area")
        upsert_feature_table(good, root, name)
        written, failed = counts.get["written"], counts.get["failed"]
    elif cluster_tile or cluster_curve:
        # a range shuffle samples its input first, which would run the observed stage twice
        good = ingested.where("_ok").drop("_ok", "geo_valid")
        write_feature_table(good, root, name, mode=mode, cluster_tile=cluster_tile, cluster_curve=cluster_curve)
        written, failed = quality_counts(ingested).first()
    else:
        write_feature_table(good, root, name, mode=mode)
        written, failed = counts.get["written"], counts.get["failed"]
    if quarantine and failed:
        ingested.where(~F.col("_ok")).write.mode("overwrite" if mode == "upsert" else mode).parquet(quarantine)
    return written, failed


def ingest_new_files(
    spark: SparkSession,
    source: str,
    root: str,
    name: str,
    state: str,
    files_per_batch: int = 1000,
    **options,
) -> DataFrame:
    """Load the files of a folder that were not loaded before; returns (file, written, failed) of all loads.

    A stream discovers the files and remembers them below ``state``, in batches of a bounded number; it ends
    when all that stand there now are loaded. Rows are written by feature id and the accounting of a batch
    replaces itself, so a run that was cut off can be started again: each record is there once. ``options``
    go to :func:`ingest_text`; a new file needs a new name, and one without content has no account.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(source)
        .select("path", F.col("_metadata.file_path").alias("file"))  # contents are not read here
    )
    accounts = f"{state.rstrip('/')}/accounting"
    counts = "file string, written bigint, failed bigint, batch bigint"

    def load_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        found = sorted(map(tuple, batch.collect()))
        paths = [p for p, _ in found]
        if not paths:
            return
        staged = new_dir(session, "new-files")
        rows = ingest_text(session, paths, name, **options)
        # local paths are written in two ways
        of = F.regexp_replace(F.input_file_name(), "^file:/+", "file:/")
        rows.withColumn("_file", of).write.parquet(staged)
        rows = session.read.schema(T.StructType([*rows.schema.fields, T.StructField("_file", T.StringType())])).parquet(staged)
        upsert_feature_table(rows.where("_ok").drop("_ok", "geo_valid", "_file"), root, name)
        by_file = rows.groupBy(F.col("_file").alias("file")).agg(
            F.count_if(F.col("_ok")).alias("written"), F.count_if(~F.col("_ok")).alias("failed")
        )
        empty = session.createDataFrame([(name,) for _, name in found], "file string")
        by_file = empty.join(by_file, "file", "left").fillna(0)
        by_file.coalesce(1).write.mode("overwrite").parquet(f"{accounts}/batch={number}")
        drop_dir(session, staged)

    query = (
        files.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", f"{state.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, accounts):
        return spark.createDataFrame([], counts).drop("batch")
    return spark.read.schema(counts).parquet(accounts).drop("batch")
