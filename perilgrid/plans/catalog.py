"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilgrid.functions import geometry as g
from perilgrid.functions.sql import create_feature_view, register
from perilgrid.operators import hexbin
from perilgrid.operators.polygon_join import polygon_join
from perilgrid.operators.spatial_join import spatial_join
from perilgrid.plans import inputs, reports
from perilgrid.plans.oracles import BUCKETS, FIRE_BOX, HISTOGRAM_PORTFOLIO, LIMIT_BUCKETS, LOOKUP_SITE, PORTFOLIO
from perilgrid.schema import FEATURE_TYPES, FID
from perilgrid.session import new_dir
from perilgrid.sources import ingest
from perilgrid.sources.catalog_tables import create_bucketed_table
from perilgrid.sources.delimited import write_delimited
from perilgrid.sources.feature_table import export_csv, read_feature_table, write_feature_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_SITE = reports.SITE_KEYS


def _site_columns() -> list:
    return [
        FID, "portfolio_id", "peril_id", "account_id", "site_id", "nz_grid_id", "site_lat", "site_long",
        F.col("geom.x").alias("geom_x"), F.col("geom.y").alias("geom_y"),
        "cov1val", "cov2val", "cov3val", "cov4val", "s_udf_met1",
    ]


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


DIGITS = 4  # the test data's precision; double sums are compared rounded to it


# --- scans ---------------------------------------------------------------------------------


@query
def scan_feature_table(spark, sf_dir):
    root = new_dir(spark, "scan")
    write_feature_table(inputs.sites(spark, sf_dir, heavy=True), root, "siteexposure_event")
    return read_feature_table(spark, root, "siteexposure_event").select(*_site_columns())


@query
def scan_bbox_projection(spark, sf_dir):
    return reports.box_scan(inputs.sites(spark, sf_dir))


@query
def scan_bbox_count(spark, sf_dir):
    return reports.box_scan(inputs.sites(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"))


@query
def scan_bbox_saved(spark, sf_dir):
    path = new_dir(spark, "bbox")
    reports.box_scan(inputs.sites(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@query
def scan_bbox_clustered(spark, sf_dir):
    """The box scan of a stored table whose files each cover a compact area."""
    root = new_dir(spark, "clustered")
    write_feature_table(inputs.sites(spark, sf_dir), root, "siteexposure_event", cluster_curve=True)
    return reports.box_scan(read_feature_table(spark, root, "siteexposure_event"))


@query
def scan_attr_filter(spark, sf_dir):
    return reports.portfolio_scan(inputs.sites(spark, sf_dir), PORTFOLIO).select(*_site_columns())


def _footprint_edges(footprints: DataFrame) -> DataFrame:
    """Every ring segment with its place in the polygon."""
    rings = footprints.select("OBJECTID", "FIRE_NAME", "ACRES", F.posexplode("geometry.rings").alias("ring", "_points"))
    ends = F.posexplode(F.expr("slice(_points, 1, size(_points) - 1)")).alias("seq", "_from")
    return rings.select("*", ends).selectExpr(
        "OBJECTID", "FIRE_NAME", "ACRES", "ring", "seq", "_from.x AS x0", "_from.y AS y0",
        "_points[seq + 1].x AS x1", "_points[seq + 1].y AS y1",
    )


@query
def scan_footprints(spark, sf_dir):
    return _footprint_edges(inputs.footprints(spark, sf_dir))


@query
def footprint_head(spark, sf_dir):
    return reports.footprint_head(inputs.footprints(spark, sf_dir), below=100, n=10)


@query
def count_sites(spark, sf_dir):
    return inputs.sites(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query
def count_losses(spark, sf_dir):
    return inputs.losses(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query
def bbox_lookup(spark, sf_dir):
    return reports.box_lookup(inputs.sites(spark, sf_dir), n=5)


@query
def bbox_lookup_all(spark, sf_dir):
    return reports.box_lookup(inputs.sites(spark, sf_dir))


@query
def bbox_lookup_sql(spark, sf_dir):
    register(spark)
    create_feature_view(inputs.sites(spark, sf_dir), "siteexposure_event")
    return spark.sql(
        "SELECT site_id FROM siteexposure_event WHERE st_intersects(st_makeBBOX(-91.0, 31.0, -96.0, 29.0), geom)"
    )


@query
def point_accessors(spark, sf_dir):
    geom = F.col("geom")
    return inputs.sites(spark, sf_dir).select(
        FID, g.st_x(geom).alias("x"), g.st_y(geom).alias("y"), g.st_isempty(geom).alias("is_empty")
    )


@query
def wkt_parse(spark, sf_dir):
    """Both spacings of the point text occur."""
    spaced = F.col("portfolio_id") % 2 == 0
    text = F.when(spaced, g.wkt_from_point("geom", gap=" ")).otherwise(g.wkt_from_point("geom"))
    parsed = inputs.sites(spark, sf_dir).select(FID, text.alias("shape")).select(FID, g.wkt_point("shape").alias("p"))
    return parsed.select(FID, "p.x", "p.y")


# --- grid ----------------------------------------------------------------------------------


@query
def grid_count(spark, sf_dir):
    return reports.grid_count(inputs.sites(spark, sf_dir, heavy=True), inputs.grid(spark, sf_dir))


@query
def grid_count_sql(spark, sf_dir):
    register(spark)
    create_feature_view(inputs.sites(spark, sf_dir), "siteexposure_event")
    create_feature_view(inputs.grid(spark, sf_dir), "nzgrid_event")
    return spark.sql(
        """SELECT count(*) AS n FROM nzgrid_event AS cell
           JOIN siteexposure_event AS site ON cell.nz_grid_id = try_cast(site.nz_grid_id AS BIGINT)
           WHERE st_intersects(cell.SHAPE, site.geom)"""
    )


@query
def grid_enrich(spark, sf_dir):
    return reports.grid_enrich(inputs.sites(spark, sf_dir, heavy=True), inputs.grid(spark, sf_dir))


@query
def grid_enrich_saved(spark, sf_dir):
    root = new_dir(spark, "grid")
    found = reports.grid_match(inputs.sites(spark, sf_dir, heavy=True), inputs.grid(spark, sf_dir))
    # a site lies in one cell, so its id is that of the derived row too
    rows = found.select(FID, "portfolio_id", "site_id", "g_country_id", "geo_unit_id")
    write_feature_table(rows, root, "txmsiteexposureevent")
    return read_feature_table(spark, root, "txmsiteexposureevent")


# --- footprints ----------------------------------------------------------------------------


@query
def fire_exposure(spark, sf_dir):
    return reports.exposure_in_footprints(
        inputs.sites(spark, sf_dir, heavy=True), inputs.footprints(spark, sf_dir), digits=DIGITS
    )


@query
def fire_contains(spark, sf_dir):
    return reports.contained_pairs(inputs.sites(spark, sf_dir, heavy=True), inputs.footprints(spark, sf_dir))


@query
def fire_contains_head(spark, sf_dir):
    # the first pairs belong to the first sites that are in any footprint; only those are paired
    sites, fires = inputs.sites(spark, sf_dir, heavy=True), inputs.footprints(spark, sf_dir)
    first = reports.first_sites(sites, fires, 10)
    return reports.contained_pairs(first, fires).orderBy(FID, "OBJECTID").limit(10)


@query
def fire_semi_join(spark, sf_dir):
    return reports.sites_in_footprints(inputs.sites(spark, sf_dir, heavy=True), inputs.footprints(spark, sf_dir))


@query
def fire_exposure_shuffled(spark, sf_dir):
    """The join that neither broadcasts tiles nor trusts keys to be small."""
    counted = spatial_join(
        inputs.sites(spark, sf_dir, heavy=True).select("portfolio_id", "s_udf_met1", FID, "geom"),
        inputs.footprints(spark, sf_dir).select("geometry"),
        broadcast_bytes=0,
        left_rows=20_000,
        right_rows=50,
        weight="n_fires",
    )
    return reports.counted_exposure(counted, "n_fires", DIGITS)


@query
def fire_semi_join_repeated(spark, sf_dir):
    sites = inputs.sites(spark, sf_dir, heavy=True)
    twice = sites.unionByName(sites.where("CAST(site_id AS BIGINT) % 3 = 0"))
    return reports.sites_in_footprints(twice, inputs.footprints(spark, sf_dir))


@query
def fire_lookup_site(spark, sf_dir):
    return reports.footprints_at_site(inputs.sites(spark, sf_dir), inputs.footprints(spark, sf_dir), LOOKUP_SITE)


@query
def fire_exposure_multipart(spark, sf_dir):
    """Footprints of several parts, some over each other: a site counts once for a footprint."""
    sites = inputs.sites(spark, sf_dir, heavy=True).select("portfolio_id", "s_udf_met1", FID, "geom")
    counted = spatial_join(sites, inputs.multi_footprints(spark, sf_dir).select("geometry"), weight="n_fires")
    total = F.round(F.sum(F.col("s_udf_met1") * F.col("n_fires")), DIGITS).alias("sum_s_udf_met1")
    return counted.groupBy("portfolio_id").agg(total, F.sum("n_fires").alias("n_pairs"))


@query
def fire_contains_multipart(spark, sf_dir):
    """The same pairs, strictly inside, through the join that shuffles tiles and splits hot ones."""
    sites = inputs.sites(spark, sf_dir, heavy=True).select(FID, "geom")
    fires = inputs.multi_footprints(spark, sf_dir).select("OBJECTID", "geometry")
    return spatial_join(sites, fires, "contains", broadcast_bytes=0, left_rows=20_000, right_rows=50).drop("geom")


@query
def fire_exposure_sql(spark, sf_dir):
    """The exposure report in plain SQL: cells of points and polygons make it an equi-join."""
    register(spark)
    create_feature_view(inputs.sites(spark, sf_dir, heavy=True), "siteexposure_event")
    create_feature_view(inputs.footprints(spark, sf_dir), "wildfireevent")
    return spark.sql(
        """WITH places AS (
             SELECT portfolio_id, s_udf_met1, geom, c.* FROM siteexposure_event, LATERAL st_point_cells(geom, -3, 3) c
           ), fires AS (
             SELECT geometry, c.* FROM wildfireevent, LATERAL st_cells(geometry, -3, 3) c
           )
           SELECT portfolio_id, round(sum(s_udf_met1), 4) AS sum_s_udf_met1,
                  round(sum(s_udf_met1), 4) / count(s_udf_met1) AS avg_s_udf_met1
           FROM places JOIN fires USING (level, cx, cy)
           WHERE st_intersects(geom, geometry) GROUP BY portfolio_id"""
    )


@query
def footprints_in_box(spark, sf_dir):
    register(spark)
    create_feature_view(inputs.multi_footprints(spark, sf_dir), "fires")
    corners = ", ".join(f"{v}D" for v in FIRE_BOX)
    return spark.sql(f"SELECT OBJECTID FROM fires WHERE st_intersects(st_makeBBOX({corners}), geometry)")


@query
def footprint_overlaps(spark, sf_dir):
    fires = inputs.multi_footprints(spark, sf_dir)
    left, right = (fires.select(F.col("OBJECTID").alias(c), "geometry") for c in "ab")
    return polygon_join(left, right).where("a < b")


# --- losses --------------------------------------------------------------------------------


@query
def loss_by_portfolio(spark, sf_dir):
    return reports.loss_by_portfolio(inputs.sites(spark, sf_dir), inputs.losses(spark, sf_dir), digits=DIGITS)


@query
def loss_by_portfolio_bbox(spark, sf_dir):
    return reports.loss_by_portfolio(
        inputs.sites(spark, sf_dir), inputs.losses(spark, sf_dir), box=reports.GULF_BOX, digits=DIGITS
    )


@query
def loss_by_portfolio_exact(spark, sf_dir):
    """Sums that are equal in every bit over any partitioning, without rounding to digits."""
    return reports.loss_by_portfolio(inputs.sites(spark, sf_dir), inputs.losses(spark, sf_dir), exact=True)


@query
def loss_by_portfolio_bucketed(spark, sf_dir):
    """Sites and losses kept by site id in the catalog: neither side is shuffled for the join."""
    label = uuid.uuid4().hex
    sites = create_bucketed_table(inputs.sites(spark, sf_dir), "siteexposure_event", f"sites_{label}", ["site_id"], 16)
    losses = create_bucketed_table(inputs.losses(spark, sf_dir), "sitelossanalyzevent", f"losses_{label}", ["site_id"], 16)
    return reports.loss_by_portfolio(sites, losses, digits=DIGITS)


@query
def loss_by_site_bbox(spark, sf_dir):
    return reports.loss_by_site(inputs.sites(spark, sf_dir), inputs.losses(spark, sf_dir), digits=DIGITS)


@query
def loss_by_site_bucket(spark, sf_dir):
    return reports.loss_by_site_bucket(inputs.sites(spark, sf_dir), inputs.losses(spark, sf_dir), digits=DIGITS)


# --- coverage ------------------------------------------------------------------------------


@query
def site_cov_max(spark, sf_dir):
    return reports.coverage_max(inputs.sites(spark, sf_dir))


@query
def cov_bucket(spark, sf_dir):
    return reports.coverage_bucket(inputs.sites(spark, sf_dir), *BUCKETS)


@query
def cov_bucket_sql(spark, sf_dir):
    register(spark)
    reports.coverage_max(inputs.sites(spark, sf_dir)).createOrReplaceTempView("site_coverage")
    first, last, n = BUCKETS
    bucket = f"WIDTH_BUCKET_1(c.max_10, {first}D, {last}D, {n})"
    return spark.sql(f"SELECT c.*, {bucket} AS BIN FROM site_coverage AS c")


@query
def cov_histogram(spark, sf_dir):
    return reports.coverage_histogram(inputs.sites(spark, sf_dir), *BUCKETS, portfolio_id=HISTOGRAM_PORTFOLIO, n=100)


@query
def cov_histogram_alias(spark, sf_dir):
    """Policies by limit: the bucket is named once in the select list and grouped by that name."""
    register(spark)
    inputs.policies(spark, sf_dir).createOrReplaceTempView("policies")
    low, high, n = LIMIT_BUCKETS
    return spark.sql(
        f"""SELECT portfolio_id, WIDTH_BUCKET_1(policy_bl_grosslimit, {low}D, {high}D, {n}) AS limit_class,
                   count(DISTINCT account_id) AS accounts, round(sum(policy_bl_grosslimit), {DIGITS}) AS total_limit
            FROM policies WHERE policy_bl_grosslimit IS NOT NULL GROUP BY portfolio_id, limit_class"""
    )


# --- hexagons ------------------------------------------------------------------------------


def _portfolio_sites(spark, sf_dir) -> DataFrame:
    return reports.portfolio_scan(inputs.sites(spark, sf_dir, heavy=True), PORTFOLIO).select(*_SITE, "geom")


def _hex(spark, sf_dir, last) -> DataFrame:
    return hexbin.hex_steps(_portfolio_sites(spark, sf_dir), inputs.zooms(spark, sf_dir), last)


@query
def count_site_zoom(spark, sf_dir):
    return reports.site_zoom_count(inputs.sites(spark, sf_dir), inputs.zooms(spark, sf_dir), PORTFOLIO)


@query
def hex_site_zoom(spark, sf_dir):
    return hexbin.site_zoom(_portfolio_sites(spark, sf_dir), inputs.zooms(spark, sf_dir)).select(*_SITE, "x", "y", "lod")


@query
def hex_radius(spark, sf_dir):
    zoomed = hexbin.site_zoom(_portfolio_sites(spark, sf_dir), inputs.zooms(spark, sf_dir))
    return hexbin.with_origin(zoomed).select(*_SITE, "lod", "zoom_id", "hex_radius", "origin_x", "origin_y")


@query
def hex_offsets(spark, sf_dir):
    return _hex(spark, sf_dir, hexbin.offsets).select(*_SITE, "lod", "dx", "dy", "h", "v")


@query
def hex_quads(spark, sf_dir):
    return _hex(spark, sf_dir, hexbin.quads).select(*_SITE, "lod", "quad_row", "quad_col", "mod2_row")


@query
def hex_centers(spark, sf_dir):
    return _hex(spark, sf_dir, hexbin.centers).select(*_SITE, "lod", "center_x", "center_y")


@query
def hex_residuals(spark, sf_dir):
    return _hex(spark, sf_dir, hexbin.residuals).select(*_SITE, "lod", "q2x", "q2y", "abs_q2x", "abs_q2y")


@query
def hex_azimuth(spark, sf_dir):
    return _hex(spark, sf_dir, hexbin.azimuth).select(
        *_SITE,
        "lod",
        "quad_row",
        "quad_col",
        F.col("mod2_row").cast("double").alias("mod2_row"),
        "is_inside",
        F.round("azimuth", 6).alias("azimuth"),
    )


@query
def hex_bin(spark, sf_dir):
    return hexbin.hex_bin(_portfolio_sites(spark, sf_dir), inputs.zooms(spark, sf_dir))


@query
def hex_bin_saved(spark, sf_dir):
    root = new_dir(spark, "hex")
    chosen = reports.portfolio_scan(inputs.sites(spark, sf_dir, heavy=True), PORTFOLIO).select(FID, *_SITE, "geom")
    binned = hexbin.hex_steps(chosen, inputs.zooms(spark, sf_dir))
    rows = binned.select(F.concat_ws("/", FID, "lod").alias(FID), *_SITE, "lod", "arow", "acol")
    write_feature_table(rows, root, "txmsitehexbinevent", partition_by=["lod"])
    return read_feature_table(spark, root, "txmsitehexbinevent")


@query
def hex_bin_all(spark, sf_dir):
    """Every portfolio, every row."""
    return hexbin.hex_bin(inputs.sites(spark, sf_dir, heavy=True), inputs.zooms(spark, sf_dir))


@query
def hex_bin_mercator(spark, sf_dir):
    """Bins of projected places, in metres like the radius; every fourth site lies beyond the projection's edge."""
    sites = inputs.sites(spark, sf_dir, heavy=True)
    beyond = F.expr("named_struct('x', geom.x, 'y', CASE WHEN CAST(site_id AS BIGINT) % 4 = 0 THEN geom.y + 55D ELSE geom.y END)")
    return hexbin.hex_bin(sites.withColumn("geom", beyond), inputs.zooms(spark, sf_dir), project="webmercator")


@query
def hex_bin_counts(spark, sf_dir):
    return reports.hex_bin_counts(inputs.sites(spark, sf_dir, heavy=True), inputs.zooms(spark, sf_dir))


# --- ingest round trips --------------------------------------------------------------------


def _as_text(df: DataFrame, name: str, **texts) -> DataFrame:
    """The text fields of a feature type in order; attributes without a value are null."""
    have = set(df.columns)
    columns = []
    for f in FEATURE_TYPES[name].schema:
        if f.name in texts:
            value = texts[f.name]
        elif f.name in ("geom", "shapegeom"):
            continue
        else:
            value = F.col(f"`{f.name}`").cast("string") if f.name in have else F.lit(None).cast("string")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _through_text(spark, rows: DataFrame, name: str, keys: list[str] | None, null_token: str = "", **texts) -> DataFrame:
    """Write rows as a text file, run the ingest job, and read the feature table it loads."""
    root = new_dir(spark, name)
    source = f"{root}/source"
    write_delimited(_as_text(rows, name, **texts), source, name in ingest.WITH_HEADER, null_token=null_token)
    ingest.load(ingest.ingest_text(spark, source, name, keys), root, name, quarantine=f"{root}/quarantine")
    return read_feature_table(spark, root, name)


@query
def ingest_site_exposure(spark, sf_dir):
    loaded = _through_text(
        spark,
        inputs.sites(spark, sf_dir, heavy=True),
        "siteexposure_event",
        ["sitenum"],
        null_token="NULL",
        sitenum=F.col(FID),
        shape=g.wkt_from_point("geom"),
    )
    shape = [F.col("shapegeom.x").alias("shape_x"), F.col("shapegeom.y").alias("shape_y")]
    return loaded.select(*_site_columns(), *shape)


@query
def ingest_nzgrid(spark, sf_dir):
    loaded = _through_text(
        spark, inputs.grid(spark, sf_dir), "nzgrid_event", ["nz_grid_id"], SHAPE=g.wkt_from_polygon("SHAPE")
    )
    box = F.col("SHAPE.bbox")
    return loaded.select(
        "OBJECTID", "nz_grid_id", "g_country_id", "geo_unit_id", "minx", "miny", "maxx", "maxy",
        *[box[n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
        F.posexplode(F.flatten("SHAPE.rings")).alias("seq", "_p"),
    ).select("*", "_p.x", "_p.y").drop("_p")


@query
def ingest_hex_zoom(spark, sf_dir):
    return _through_text(spark, inputs.zooms(spark, sf_dir), "hexzoomevent", ["zoom_id"]).drop(FID)


@query
def ingest_policy_exposure(spark, sf_dir):
    loaded = _through_text(spark, inputs.policies(spark, sf_dir), "policyexposureevent", ["policy_id"])
    return loaded.drop(FID).withColumn("premium", F.col("premium").cast("double"))


@query
def ingest_portfolio_account(spark, sf_dir):
    return _through_text(spark, inputs.accounts(spark, sf_dir), "portfolioaccountevent", ["account_id"]).drop(FID)


@query
def ingest_site_loss(spark, sf_dir):
    return _through_text(spark, inputs.losses(spark, sf_dir), "sitelossanalyzevent", None).drop(FID)


def _feature_lines(footprints: DataFrame, *others: str) -> DataFrame:
    """One GeoJSON feature per row."""
    scalars = [f.name for f in FEATURE_TYPES["wildfireevent"].schema if f.name in footprints.columns and f.name != "geometry"]
    coordinates = F.transform(
        F.col("geometry.rings"), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    )
    shape = F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(*[F.col(f"`{c}`") for c in scalars]).alias("properties"), shape.alias("geometry")
    )
    return footprints.select(*others, F.to_json(feature).alias("value"))


@query
def ingest_wildfire_geojson(spark, sf_dir):
    root = new_dir(spark, "geojson")
    _feature_lines(inputs.footprints(spark, sf_dir)).write.text(f"{root}/source")
    rows = ingest.ingest_geojson(spark, f"{root}/source", key_columns=["OBJECTID"])
    ingest.load(rows, root, "wildfireevent", quarantine=f"{root}/quarantine")
    return _footprint_edges(read_feature_table(spark, root, "wildfireevent"))


@query
def ingest_geojson_collection(spark, sf_dir):
    """Collections in the common layout, members and brackets on lines of their own; some features are cut off."""
    root = new_dir(spark, "collections")
    lines = _feature_lines(inputs.footprints(spark, sf_dir), "OBJECTID")
    whole = F.when(F.col("OBJECTID") % 9 == 4, F.substring("value", 1, 60)).otherwise(F.col("value"))
    grouped = lines.groupBy(F.floor(F.col("OBJECTID") / 50)).agg(F.array_join(F.collect_list(whole), ",\n").alias("value"))
    head = '{\n"type": "FeatureCollection",\n"name": "fires",\n"crs": { "type": "name", "properties": { "name": "CRS84" } },\n"features": [\n'
    grouped.select(F.concat(F.lit(head), "value", F.lit("\n]\n}"))).write.text(f"{root}/source")
    rows = ingest.ingest_geojson(spark, f"{root}/source", key_columns=["OBJECTID"])
    ingest.load(rows, root, "wildfireevent", quarantine=f"{root}/quarantine")
    return _footprint_edges(read_feature_table(spark, root, "wildfireevent"))


def _multi_feature(footprints: DataFrame) -> DataFrame:
    """One indented GeoJSON feature of several parts per row."""
    parts = F.transform(F.expr(g.part_rings("geometry")), lambda p: F.transform(p, lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))
    properties = F.struct("OBJECTID", "FIRE_NAME", "ACRES")
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), shape.alias("geometry"))
    return footprints.select("OBJECTID", F.to_json(feature, {"pretty": "true"}).alias("value"))


@query
def ingest_geojson_indented(spark, sf_dir):
    """Collections as most tools write them: indented over many lines, features of several parts."""
    root = new_dir(spark, "indented")
    features = _multi_feature(inputs.multi_footprints(spark, sf_dir))
    grouped = features.groupBy(F.floor(F.col("OBJECTID") / 500)).agg(F.array_join(F.collect_list("value"), ",\n").alias("value"))
    head = '{\n  "type": "FeatureCollection",\n  "crs": { "type": "name", "properties": { "name": "CRS84" } },\n  "features": [\n'
    grouped.select(F.concat(F.lit(head), "value", F.lit("\n  ]\n}"))).write.text(f"{root}/source")
    rows = ingest.ingest_geojson(spark, f"{root}/source", key_columns=["OBJECTID"])
    ingest.load(rows, root, "wildfireevent", quarantine=f"{root}/quarantine")
    loaded = read_feature_table(spark, root, "wildfireevent")
    rings = loaded.select("OBJECTID", "FIRE_NAME", "ACRES", F.expr(f"posexplode({g.part_rings('geometry')}) AS (part, _rings)"))
    rings = rings.select("OBJECTID", "FIRE_NAME", "ACRES", "part", F.posexplode("_rings").alias("ring", "_points"))
    ends = F.posexplode(F.expr("slice(_points, 1, size(_points) - 1)")).alias("seq", "_from")
    return rings.select("*", ends).selectExpr(
        "OBJECTID", "FIRE_NAME", "ACRES", "part", "ring", "seq", "_from.x AS x0", "_from.y AS y0",
        "_points[seq + 1].x AS x1", "_points[seq + 1].y AS y1",
    )


@query
def ingest_text_counts(spark, sf_dir):
    """Blank lines, lines with a stray control character and lines with too many fields fail."""
    key = F.col("p_partkey").cast("string")
    kind = F.col("p_partkey") % 7
    stray, long = F.concat(key, F.lit("\u00010|5")), F.concat(key, F.lit("|5|6"))
    value = F.when(kind == 0, F.lit("")).when(kind == 1, stray).when(kind == 2, long).otherwise(F.concat(key, F.lit("|5")))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    source = new_dir(spark, "lines")
    parts.select(value.alias("value")).write.text(source)
    return ingest.quality_counts(ingest.ingest_text(spark, source, "hexzoomevent", ["zoom_id"]))


@query
def ingest_quality_counts(spark, sf_dir):
    """Lines whose shape text is cut off fail; the others are written."""
    rows = inputs.sites(spark, sf_dir, heavy=True)
    whole = g.wkt_from_point("geom")
    broken = F.col("site_id").endswith("7")
    text = _as_text(
        rows, "siteexposure_event", shape=F.when(broken, F.substring(whole, 1, 8)).otherwise(whole), sitenum=F.col(FID)
    )
    source = new_dir(spark, "quality")
    write_delimited(text, source, header=True)
    return ingest.quality_counts(ingest.ingest_text(spark, source, "siteexposure_event", ["sitenum"]))


@query
def export_csv_round_trip(spark, sf_dir):
    path = new_dir(spark, "export")
    export_csv(inputs.sites(spark, sf_dir).select(*_SITE, "s_udf_met1"), path)
    schema = "portfolio_id BIGINT, account_id STRING, site_id STRING, s_udf_met1 DOUBLE"
    return spark.read.schema(schema).option("sep", "|").option("header", True).csv(path)


@query
def ingest_twice(spark, sf_dir):
    """Losses loaded twice by feature id, the second time with more of them: each is there once."""
    root = new_dir(spark, "twice")
    rows = inputs.losses(spark, sf_dir)
    for part, chosen in (("half", F.col("analysis_id") < 4), ("whole", F.lit(True))):
        source = f"{root}/{part}"
        write_delimited(_as_text(rows.where(chosen), "sitelossanalyzevent"), source, False)
        ingest.load(ingest.ingest_text(spark, source, "sitelossanalyzevent"), root, "sitelossanalyzevent", mode="upsert")
    return read_feature_table(spark, root, "sitelossanalyzevent").groupBy("portfolio_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("gross_loss"), DIGITS).alias("sum_gross_loss")
    )


@query
def ingest_incremental(spark, sf_dir):
    """Policies that arrive in two drops of files, with a restart in between and one after them."""
    root = new_dir(spark, "drops")
    rows = inputs.policies(spark, sf_dir)
    for drop in range(2):
        chosen = rows.where(F.col("policy_id") % 2 == drop)
        write_delimited(_as_text(chosen, "policyexposureevent"), f"{root}/source/{drop}", False)
        for _ in range(2):
            ingest.ingest_new_files(
                spark, f"{root}/source/*", root, "policyexposureevent", f"{root}/state", header=False, key_columns=["policy_id"]
            )
    loaded = read_feature_table(spark, root, "policyexposureevent")
    return loaded.select("policy_id", "portfolio_id", "account_id", F.col("premium").cast("double").alias("premium"))


QUERIES["export_csv"] = QUERIES.pop("export_csv_round_trip")
