"""Named reports over feature tables. Every function takes and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.functions.buckets import width_bucket
from perilgrid.functions.geometry import Box, edges, st_intersects
from perilgrid.operators import hexbin
from perilgrid.operators.keyed_join import row_bytes, sized_join
from perilgrid.operators.rollup import exact_loss_rollup, loss_rollup, sum_and_avg
from perilgrid.operators.segments import COLUMNS, layout, matches
from perilgrid.operators.spatial_join import spatial_join
from perilgrid.schema import FID

# The search boxes and the default histogram range.
GULF_BOX = Box(-94.0, 31.0, -96.0, 29.0)
WIDE_GULF_BOX = Box(-91.0, 31.0, -96.0, 29.0)
HISTOGRAM_RANGE = (150.0, 3990682000.0, 99)

FEW_POINTS = 100  # rows of a site that are compared with footprints one by one

SITE_KEYS = ["portfolio_id", "account_id", "site_id"]


def box_scan(sites: DataFrame, box: Box = GULF_BOX) -> DataFrame:
    """Sites in a box (edges included), four columns."""
    return sites.where(box.intersects(F.col("geom"))).select(*SITE_KEYS, "s_udf_met1")


def box_lookup(sites: DataFrame, box: Box = WIDE_GULF_BOX, n: int | None = None) -> DataFrame:
    """Site ids in a box; with ``n`` the first few in id order."""
    found = sites.where(box.intersects(F.col("geom"))).select("site_id")
    return found if n is None else found.orderBy("site_id").limit(n)


def portfolio_scan(sites: DataFrame, portfolio_id: int) -> DataFrame:
    return sites.where(F.col("portfolio_id") == portfolio_id)


def footprint_head(footprints: DataFrame, below: int, n: int) -> DataFrame:
    return footprints.where(F.col("OBJECTID") < below).select("OBJECTID", "ACRES").orderBy("OBJECTID").limit(n)


def grid_match(sites: DataFrame, grid: DataFrame, **join_options) -> DataFrame:
    """Sites joined to the grid cell they name, where the point also lies in that cell.

    Site keys are text and grid keys are numbers; a key that is not a number matches nothing.
    """
    keyed = sites.select("portfolio_id", "site_id", FID, "geom", F.expr("try_cast(nz_grid_id AS BIGINT)").alias("_cell"))
    # segments are laid out once per cell, not once per candidate site
    cells = grid.selectExpr("nz_grid_id AS _cell", "g_country_id", "geo_unit_id", "SHAPE.bbox", f"{edges('SHAPE')} AS _all")
    cells = cells.selectExpr("_cell", "g_country_id", "geo_unit_id", *layout("bbox", "_all"))
    facts = cells.agg(F.sum(row_bytes(cells)).alias("bytes"), F.count("_edges").alias("arrays")).first()
    inside = matches("geom.x", "geom.y", "intersects", arrays=facts["arrays"] > 0)
    matched = sized_join(keyed, cells, ["_cell"], inside, right_bytes=facts["bytes"] or 0, **join_options)
    return matched.drop("_cell", *COLUMNS)


def grid_enrich(sites: DataFrame, grid: DataFrame) -> DataFrame:
    return grid_match(sites, grid).select("portfolio_id", "site_id", "g_country_id", "geo_unit_id")


def grid_count(sites: DataFrame, grid: DataFrame) -> DataFrame:
    return grid_match(sites, grid).agg(F.count(F.lit(1)).alias("n"))


def exposure_in_footprints(sites: DataFrame, footprints: DataFrame, digits: int | None = None) -> DataFrame:
    """Exposure by portfolio over (site, footprint) pairs; overlapping footprints count twice."""
    counted = spatial_join(
        sites.select("portfolio_id", "s_udf_met1", FID, "geom"), footprints.select("geometry"), weight="n_fires"
    )
    return counted_exposure(counted, "n_fires", digits)


def counted_exposure(counted: DataFrame, weight: str, digits: int | None = None) -> DataFrame:
    """Exposure by portfolio over sites that count ``weight`` times."""
    value, times = F.col("s_udf_met1"), F.col(weight)
    return counted.groupBy("portfolio_id").agg(
        *sum_and_avg(F.sum(value * times), F.sum(F.when(value.isNotNull(), times)), "s_udf_met1", digits)
    )


def footprints_at_site(sites: DataFrame, footprints: DataFrame, site_id: str) -> DataFrame:
    """One row with the portfolio id per footprint touching the site."""
    site = sites.where(F.col("site_id") == site_id).select("portfolio_id", FID, "geom")
    extent = site.agg(
        F.count("geom.x").alias("n"), *[F.expr(f"{fn}(geom.{axis}) AS {axis}{fn}") for fn in ("min", "max") for axis in "xy"]
    ).first()
    near = footprints.select("geometry").where(
        "false"
        if extent["xmin"] is None
        else f"geometry.bbox.xmin <= {extent['xmax']!r}D AND geometry.bbox.xmax >= {extent['xmin']!r}D "
        f"AND geometry.bbox.ymin <= {extent['ymax']!r}D AND geometry.bbox.ymax >= {extent['ymin']!r}D"
    )
    if extent["n"] <= FEW_POINTS:
        # a handful of points is tested against the few footprints around them, without tiles
        hit = st_intersects("geom", "geometry")
        return near.join(F.broadcast(site.where("geom.x IS NOT NULL")), hit).select("portfolio_id")
    return spatial_join(site, near).select("portfolio_id")


def contained_pairs(sites: DataFrame, footprints: DataFrame, portfolio_id: int | None = None) -> DataFrame:
    """(site, footprint) pairs with the site strictly inside."""
    if portfolio_id is not None:
        sites = portfolio_scan(sites, portfolio_id)
    pairs = spatial_join(
        sites.select(FID, *SITE_KEYS, "geom"), footprints.select("OBJECTID", "geometry"), predicate="contains"
    )
    return pairs.drop("geom")


def first_sites(sites: DataFrame, footprints: DataFrame, n: int) -> DataFrame:
    """The sites up to the ``n``-th in id order that is strictly inside a footprint: the first ``n`` pairs are theirs."""
    inside = spatial_join(sites.select(FID, "geom"), footprints.select("geometry"), "contains", "left_semi")
    ids = [r[0] for r in inside.select(FID).orderBy(FID).limit(n).collect()]
    if len(ids) < n:
        return sites
    upto = F.col(FID).isNull()  # nulls sort first
    return sites.where(upto if ids[-1] is None else upto | (F.col(FID) <= ids[-1]))


def sites_in_footprints(sites: DataFrame, footprints: DataFrame, portfolio_id: int | None = None) -> DataFrame:
    """Each site strictly inside at least one footprint, once, where the portfolio is known."""
    if portfolio_id is not None:
        sites = portfolio_scan(sites, portfolio_id)
    known = sites.where(F.col("portfolio_id").isNotNull()).select(FID, *SITE_KEYS, "s_udf_met1", "geom")
    return spatial_join(known, footprints, predicate="contains", how="left_semi").drop("geom")


def coverage_max(sites: DataFrame) -> DataFrame:
    """Largest total coverage per portfolio and site; null if any part is null."""
    total = F.col("cov1val") + F.col("cov2val") + F.col("cov3val") + F.col("cov4val")
    return sites.groupBy("portfolio_id", "site_id").agg(F.max(total).alias("max_10"))


def coverage_bucket(sites: DataFrame, first: float, last: float, buckets: int) -> DataFrame:
    return coverage_max(sites).withColumn("BIN", width_bucket(F.col("max_10"), first, last, buckets))


def coverage_histogram(
    sites: DataFrame,
    first: float = HISTOGRAM_RANGE[0],
    last: float = HISTOGRAM_RANGE[1],
    buckets: int = HISTOGRAM_RANGE[2],
    portfolio_id: int | None = None,
    n: int | None = None,
) -> DataFrame:
    """Minimum, maximum and number of site coverages per bucket, in bucket order."""
    binned = coverage_bucket(sites, first, last, buckets)
    if portfolio_id is not None:
        binned = binned.where(F.col("portfolio_id") == portfolio_id)  # moves below the aggregate
    bins = (
        binned.groupBy("BIN")
        .agg(F.min("max_10").alias("MIN_VAL"), F.max("max_10").alias("MAX_VAL"), F.count(F.lit(1)).alias("FREQUENCY"))
        .select("MIN_VAL", "MAX_VAL", "BIN", "FREQUENCY")
        .orderBy("BIN")
    )
    return bins if n is None else bins.limit(n)


def loss_by_portfolio(
    sites: DataFrame, losses: DataFrame, box: Box | None = None, digits: int | None = None, exact: bool = False
) -> DataFrame:
    """Exposure and loss by portfolio; with a box only sites strictly inside it.

    ``exact`` sums are the same in every bit whatever the order of the rows.
    """
    if box is not None:
        sites = sites.where(box.contains(F.col("geom")))
    if exact:
        return exact_loss_rollup(sites, losses, "portfolio_id")
    return loss_rollup(sites, losses, "portfolio_id", digits=digits)


def loss_by_site(
    sites: DataFrame, losses: DataFrame, box: Box = GULF_BOX, digits: int | None = None
) -> DataFrame:
    return loss_rollup(sites.where(box.intersects(F.col("geom"))), losses, "site_id", digits=digits)


def loss_by_site_bucket(
    sites: DataFrame,
    losses: DataFrame,
    box: Box = GULF_BOX,
    first: float = HISTOGRAM_RANGE[0],
    last: float = HISTOGRAM_RANGE[1],
    buckets: int = HISTOGRAM_RANGE[2],
    digits: int | None = None,
) -> DataFrame:
    """Loss by site with the site id itself put into a bucket; a non-numeric id gets null."""
    value = F.col("site_id").try_cast("double")
    return loss_by_site(sites, losses, box, digits).withColumn("bin", width_bucket(value, first, last, buckets))


def site_zoom_count(sites: DataFrame, zooms: DataFrame, portfolio_id: int) -> DataFrame:
    """Rows of the site x zoom product, from the counts of its two sides."""
    chosen = portfolio_scan(sites, portfolio_id).where(F.col("geom.x").isNotNull())
    return chosen.agg((F.count(F.lit(1)) * F.lit(zooms.count())).alias("n"))


def hex_bin_counts(sites: DataFrame, zooms: DataFrame) -> DataFrame:
    """Sites per hexagon and zoom level over all portfolios."""
    binned = hexbin.hex_bin(sites, zooms)
    return binned.groupBy("lod", "arow", "acol").agg(F.count(F.lit(1)).alias("n_sites"))
