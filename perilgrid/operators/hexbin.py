"""Hexagon binning of points at every zoom level.

Each step adds columns to the previous one; Catalyst folds the chain into one plan.
All arithmetic is in doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilgrid.functions.geometry import st_isempty
from perilgrid.operators.keyed_join import BROADCAST_BYTES, row_bytes

# Grid origin, as used by the published hex tables.
ORIGIN_X = 20037507.0671618
ORIGIN_Y = 19971868.8804086

# Sphere of the web map projection, and the latitude at which its square ends.
EARTH_RADIUS = 6378137.0
MERCATOR_LATITUDE = 85.05112877980659

LEVELS_PER_GROUP = 64  # zoom rows carried along as one packed row


def _d(value: float) -> Column:
    return F.lit(float(value))


def site_zoom(points: DataFrame, zooms: DataFrame, geom: str = "geom") -> DataFrame:
    """Every non-empty point at every zoom level: adds ``x, y, lod, zoom_id, hex_radius``.

    The zoom table is a short lookup. It is packed into rows of about 64 levels, measured, and
    broadcast: points are not shuffled, and every point meets every level because that product
    is the result. A table too large to broadcast is refused.
    """
    usable = points.where(~st_isempty(F.col(geom))).withColumns(
        {"x": F.col(f"{geom}.x"), "y": F.col(f"{geom}.y")}
    )
    entry = F.struct(
        F.col("zoom_id").cast("bigint").alias("zoom_id"), F.col("zoom_value").cast("double").alias("zoom_value")
    )
    # packed rows of about LEVELS_PER_GROUP levels; with one of them each point meets one row
    groups = F.expr(f"CAST(ceil(count(*) / {LEVELS_PER_GROUP}) AS BIGINT)")
    numbered = zooms.select(entry.alias("z")).crossJoin(zooms.agg(groups.alias("_n")))
    packed = numbered.groupBy(F.pmod(F.xxhash64("z"), F.col("_n")).alias("_group")).agg(
        F.collect_list("z").alias("_levels")
    )
    size = packed.agg(F.sum(row_bytes(packed))).first()[0] or 0
    if size > BROADCAST_BYTES:
        raise ValueError(f"the zoom table measures {size} bytes; a lookup of at most {BROADCAST_BYTES} is expected")
    usable = usable.crossJoin(F.broadcast(packed.select("_levels")))
    levels = F.col("_levels")
    expanded = usable.withColumn("_zoom", F.explode(levels))
    return expanded.withColumns(
        {
            "lod": F.col("_zoom.zoom_id"),
            "zoom_id": F.col("_zoom.zoom_id"),
            "hex_radius": F.col("_zoom.zoom_value"),
        }
    ).drop("_zoom", "_levels")


def with_origin(df: DataFrame, origin_x: float = ORIGIN_X, origin_y: float = ORIGIN_Y) -> DataFrame:
    return df.withColumns({"origin_x": _d(origin_x), "origin_y": _d(origin_y)})


def offsets(df: DataFrame) -> DataFrame:
    """Distance from the origin, half width ``h`` and quarter height ``v`` of the hexagon."""
    return df.withColumns(
        {
            "dx": F.col("x") - F.col("origin_x"),
            "dy": F.col("y") - F.col("origin_y"),
            "h": F.col("hex_radius") * F.cos(_d(30.0) * F.pi() / _d(180.0)),
            "v": F.col("hex_radius") / _d(2.0),
        }
    )


def quads(df: DataFrame) -> DataFrame:
    """Row and column of the enclosing quad; ``mod2_row`` keeps the sign of odd rows."""
    row = F.floor(F.col("dy") / (_d(3.0) * F.col("v"))).cast("bigint")
    return df.withColumns(
        {
            "quad_row": row,
            "quad_col": F.floor(F.col("dx") / (_d(2.0) * F.col("h"))).cast("bigint"),
            "mod2_row": row % F.lit(2).cast("bigint"),
        }
    )


def centers(df: DataFrame) -> DataFrame:
    """Centre of the quad; odd rows are shifted right by half a hexagon."""
    shift = F.when(F.col("mod2_row") != 0, F.col("h")).otherwise(_d(0.0))
    return df.withColumns(
        {
            "center_x": F.col("quad_col") * (_d(2.0) * F.col("h")) + shift + F.col("origin_x"),
            "center_y": F.col("quad_row") * (_d(3.0) * F.col("v")) + F.col("origin_y"),
        }
    )


def residuals(df: DataFrame) -> DataFrame:
    q2x, q2y = F.col("x") - F.col("center_x"), F.col("y") - F.col("center_y")
    return df.withColumns({"q2x": q2x, "q2y": q2y, "abs_q2x": F.abs(q2x), "abs_q2y": F.abs(q2y)})


def azimuth(df: DataFrame) -> DataFrame:
    """Whether the quad's own hexagon holds the point, and the bearing from its centre."""
    too_far = (F.col("abs_q2x") > F.col("hex_radius")) | (F.col("abs_q2y") > F.col("hex_radius"))
    within = (F.col("abs_q2x") / F.col("h") + F.col("abs_q2y") / F.col("v")) <= _d(2.0)
    bearing = F.atan2(F.col("q2x"), F.col("q2y"))  # x first: clockwise from north
    turned = F.when(bearing < _d(0.0), bearing + _d(2.0) * F.pi()).otherwise(bearing)
    return df.withColumns(
        {
            "is_inside": F.when(too_far, F.lit(False)).otherwise(within),
            "azimuth": turned * _d(180.0) / F.pi(),
        }
    )


# Neighbour of the quad per bearing sector, first match wins:
# (bearing above, row step, column step in odd rows, column step in even rows)
SECTORS = (
    (300.0, 1, 0, -1),
    (240.0, 0, -1, -1),
    (180.0, -1, -1, 0),
    (120.0, -1, 1, 0),
    (60.0, 0, 1, 1),
    (0.0, 1, 1, 0),
)
NORTH = (1, 0, 0)  # bearing exactly zero


def assign(df: DataFrame) -> DataFrame:
    """Final hexagon (``arow``, ``acol``): the quad itself or its neighbour by sector."""

    def step(pick) -> Column:
        chain = F.when(F.col("is_inside"), F.lit(0))
        for above, row, odd, even in SECTORS:
            chain = chain.when(F.col("azimuth") > _d(above), pick(row, odd, even))
        return chain.otherwise(pick(*NORTH)).cast("bigint")

    def column_step(_row: int, odd: int, even: int) -> Column:
        if odd == even:
            return F.lit(odd)
        return F.when(F.col("mod2_row") != 0, F.lit(odd)).otherwise(F.lit(even))

    return df.withColumns(
        {
            "arow": F.col("quad_row") + step(lambda row, odd, even: F.lit(row)),
            "acol": F.col("quad_col") + step(column_step),
        }
    )


STEPS = (offsets, quads, centers, residuals, azimuth, assign)


def web_mercator(geom: str) -> Column:
    """Point in degrees as a point in metres of the web map projection.

    Latitudes beyond the projection's square are clipped to its edge. Empty points stay empty.
    """
    lat = F.greatest(_d(-MERCATOR_LATITUDE), F.least(_d(MERCATOR_LATITUDE), F.col(geom)["y"]))
    x = F.col(geom)["x"] * F.pi() / _d(180.0) * _d(EARTH_RADIUS)
    y = F.ln(F.tan(F.pi() / _d(4.0) + lat * F.pi() / _d(360.0))) * _d(EARTH_RADIUS)
    both = F.col(geom)["y"].isNotNull()  # greatest and least pass over a null
    return F.when(F.col(geom).isNotNull(), F.struct(F.when(both, x).alias("x"), F.when(both, y).alias("y")))


def hex_steps(
    points: DataFrame, zooms: DataFrame, last=assign, origin_x=ORIGIN_X, origin_y=ORIGIN_Y, project: str | None = None
) -> DataFrame:
    """Run the chain up to and including ``last``.

    The default takes coordinates as they are; ``project="webmercator"`` turns degrees into metres first, the
    unit of the radius and of the origin.
    """
    if project not in (None, "webmercator"):
        raise ValueError(f"unknown projection {project!r}")
    if project:
        points = points.withColumn("geom", web_mercator("geom"))
    df = with_origin(site_zoom(points, zooms), origin_x, origin_y)
    for step in STEPS[: STEPS.index(last) + 1]:
        df = step(df)
    return df


def hex_bin(
    points: DataFrame,
    zooms: DataFrame,
    origin_x: float = ORIGIN_X,
    origin_y: float = ORIGIN_Y,
    limit: int | None = None,
    project: str | None = None,
) -> DataFrame:
    """``portfolio_id, account_id, site_id, lod, arow, acol`` for every point and zoom level."""
    columns = ["portfolio_id", "account_id", "site_id"]
    binned = hex_steps(points.select(*columns, "geom"), zooms, assign, origin_x, origin_y, project)
    result = binned.select(*columns, "lod", "arow", "acol")
    return result if limit is None else result.limit(limit)
