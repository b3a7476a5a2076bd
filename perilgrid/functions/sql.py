"""SQL names for the geometry and bucket functions, without Python in the row path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perilgrid.functions.buckets import width_bucket_sql
from perilgrid.functions.geometry import INSIDE, OUTSIDE, SLACK, let, part_edges, parts_overlap, position
from perilgrid.schema import geometry_fields

FINER = 3  # cells of a polygon are 2^-3 of the power of two that is as wide as it is

# One SQL type for points and polygons, so that a function takes either in either order.
# A point is its own envelope and has no parts; `empty` is null for a null geometry.
PARTS = "ARRAY<ARRAY<STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>>>"
GEOMETRY = f"STRUCT<empty: BOOLEAN, xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE, parts: {PARTS}>"


def _point(geom: Column) -> Column:
    nothing = F.lit(None).cast(PARTS)
    return F.struct(
        F.when(geom.isNotNull(), geom["x"].isNull()).alias("empty"),
        geom["x"].alias("xmin"),
        geom["y"].alias("ymin"),
        geom["x"].alias("xmax"),
        geom["y"].alias("ymax"),
        nothing.alias("parts"),
    )


def _polygon(name: str) -> Column:
    """Exactly of the type that the functions take: else each call would copy the segments to cast them."""
    geom = F.col(name)
    return F.struct(
        F.when(geom.isNotNull(), F.size(geom["rings"]) == 0).alias("empty"),
        *[geom["bbox"][n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
        F.expr(f"CAST(CASE WHEN {name} IS NOT NULL THEN {part_edges(name)} END AS {PARTS})").alias("parts"),
    )


def create_feature_view(df: DataFrame, name: str) -> None:
    """Temp view whose geometry columns the registered functions accept.

    The conversion is a projection that Catalyst simplifies away: a constant box test on
    such a view still reaches the scan as comparisons of ``geom.x`` and ``geom.y``.
    """
    kinds = geometry_fields(df.schema)
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        kind = kinds.get(field.name)
        if kind == "Point":
            column = _point(column)
        elif kind == "Polygon":
            column = _polygon(f"`{field.name}`")
        columns.append(column.alias(field.name))
    df.select(*columns).createOrReplaceTempView(name)


def _function(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


def register(spark: SparkSession) -> None:
    """Create the temporary SQL functions of the engine in this session.

    ``st_x, st_y, st_isempty, st_makeBBOX, st_contains, st_intersects, bbox`` work on the
    views of :func:`create_feature_view`. ``WIDTH_BUCKET_1`` is the bucket function under
    a name of its own, since Spark has a built-in ``width_bucket`` with other edge cases and does
    not let a SQL function replace it. A join ``ON st_intersects(..)`` is a nested loop; the table functions
    ``st_point_cells`` and ``st_cells``, used with LATERAL, make it an equi-join in plain SQL: every point and
    polygon whose level lies between ``lo`` and ``hi`` meet in one cell. See also
    :func:`create_spatial_join_view`.
    """
    g = f"g {GEOMETRY}"
    ab = f"a {GEOMETRY}, b {GEOMETRY}"
    overlap = "a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin"
    in_a, in_b = position("b.xmin", "b.ymin", "es"), position("a.xmin", "a.ymin", "es")
    # a rectangle holds a polygon if it holds its envelope; other outlines are not compared that way
    is_box = "size(a.parts) = 1 AND size(a.parts[0]) = 4 AND forall(a.parts[0], e -> e.x0 = e.x1 OR e.y0 = e.y1)"
    holds = "a.xmin <= b.xmin AND a.xmax >= b.xmax AND a.ymin <= b.ymin AND a.ymax >= b.ymax AND NOT b.empty"
    unsupported = "raise_error('only a box can be tested for containing a polygon')"

    def edge(x0: str, y0: str, x1: str, y1: str) -> str:
        return f"named_struct('x0', {x0}, 'y0', {y0}, 'x1', {x1}, 'y1', {y1})"

    left, bottom, right, top = "least(x1, x2)", "least(y1, y2)", "greatest(x1, x2)", "greatest(y1, y2)"
    box_edges = ", ".join(
        (
            edge(left, bottom, right, bottom),
            edge(right, bottom, right, top),
            edge(right, top, left, top),
            edge(left, top, left, bottom),
        )
    )
    corners = "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE"

    _function(spark, "st_x", g, "DOUBLE", "CASE WHEN g.parts IS NULL THEN g.xmin END")
    _function(spark, "st_y", g, "DOUBLE", "CASE WHEN g.parts IS NULL THEN g.ymin END")
    _function(spark, "st_isempty", g, "BOOLEAN", "g.empty")
    _function(
        spark,
        "st_makeBBOX",
        corners,
        GEOMETRY,
        f"named_struct('empty', false, 'xmin', {left}, 'ymin', {bottom}, 'xmax', {right}, 'ymax', {top}, "
        f"'parts', array(array({box_edges})))",
    )
    _function(
        spark,
        "st_intersects",
        ab,
        "BOOLEAN",
        f"{overlap} AND CASE WHEN a.parts IS NULL AND b.parts IS NULL THEN true "
        f"WHEN b.parts IS NULL THEN exists(a.parts, es -> {in_a} <> {OUTSIDE}) "
        f"WHEN a.parts IS NULL THEN exists(b.parts, es -> {in_b} <> {OUTSIDE}) "
        f"ELSE {parts_overlap('a.parts', 'b.parts')} END",
    )
    _function(
        spark,
        "st_contains",
        ab,
        "BOOLEAN",
        f"{overlap} AND CASE WHEN a.parts IS NULL THEN b.parts IS NULL "
        f"WHEN b.parts IS NULL THEN exists(a.parts, es -> {in_a} = {INSIDE}) "
        f"WHEN {is_box} THEN {holds} ELSE {unsupported} END",
    )
    _function(
        spark,
        "bbox",
        f"g {GEOMETRY}, {corners}",
        "BOOLEAN",
        f"g.xmin <= {right} AND g.xmax >= {left} AND g.ymin <= {top} AND g.ymax >= {bottom}",
    )
    # Cells of 2^level degrees. A polygon has a level a few steps below its extent, so its envelope lies in a
    # bounded number of cells, of which it gets those that it may touch; a point has one cell of every level asked for.
    table = "TABLE(level INT, cx BIGINT, cy BIGINT)"
    spans = ", ".join(f"'{c}{fn}', floor(g.{c}{fn} / pow(2D, v))" for c in "xy" for fn in ("min", "max"))
    extent = "greatest(g.xmax - g.xmin, g.ymax - g.ymin)"
    level = f"greatest(lo, CASE WHEN {extent} > 0 THEN cast(ceil(log2({extent})) AS int) ELSE lo END)"
    checked = f"CASE WHEN {level} > hi THEN raise_error('a polygon is wider than the cells of the highest level') ELSE greatest(lo, {level} - {FINER}) END"
    # a cell that no segment comes near lies on one side of each part's outline, and its corner tells on which
    west, south = "(x * w)", "(y * w)"
    comes_near = (
        f"least(e.x0, e.x1) - {SLACK} <= {west} + w AND greatest(e.x0, e.x1) + {SLACK} >= {west} "
        f"AND least(e.y0, e.y1) - {SLACK} <= {south} + w AND greatest(e.y0, e.y1) + {SLACK} >= {south} "
        f"AND abs((e.x1 - e.x0) * ({south} + w / 2D - e.y0) - (e.y1 - e.y0) * ({west} + w / 2D - e.x0)) "
        f"<= (abs(e.x1 - e.x0) + abs(e.y1 - e.y0)) * (w / 2D + {SLACK})"
    )
    met = f"g.parts IS NULL OR exists(g.parts, es -> exists(es, e -> {comes_near}) OR {position(west, south, 'es')} <> {OUTSIDE})"
    cells = (
        f"flatten(transform(sequence(s.xmin, s.xmax), x -> transform(filter(sequence(s.ymin, s.ymax), y -> {met}), "
        "y -> named_struct('level', v, 'cx', x, 'cy', y))))"
    )
    # the polygon is taken whole: with its fields taken one by one Spark's column pruning loses the cells
    cells = let("q", "g", let("v", checked, let("w", "pow(2D, v)", let("s", f"named_struct({spans})", cells))).replace("g.", "q."))
    at = "named_struct('level', l, 'cx', floor(g.xmin / pow(2D, l)), 'cy', floor(g.ymin / pow(2D, l)))"
    _function(
        spark,
        "st_point_cells",
        f"{g}, lo INT, hi INT",
        table,
        f"SELECT c.level, c.cx, c.cy FROM (SELECT inline(CASE WHEN g.xmin IS NOT NULL THEN transform(sequence(lo, hi), l -> {at}) END) AS (level, cx, cy)) c",
    )
    _function(
        spark,
        "st_cells",
        f"{g}, lo INT, hi INT",
        table,
        f"SELECT c.level, c.cx, c.cy FROM (SELECT inline(CASE WHEN g.xmin IS NOT NULL THEN {cells} END) AS (level, cx, cy)) c",
    )
    _function(
        spark,
        "WIDTH_BUCKET_1",
        "value DOUBLE, first DOUBLE, last DOUBLE, buckets BIGINT",
        "BIGINT",
        width_bucket_sql("value", "first", "last", "buckets"),
    )


def create_spatial_join_view(
    spark: SparkSession,
    name: str,
    points: str,
    polygons: str,
    predicate: str = "intersects",
    how: str = "inner",
    **options,
) -> None:
    """Temp view of the tile join of two tables or views, named as SQL sees them.

    A join ``ON st_intersects(..)`` written in SQL is a nested loop; a view made here is an
    equi-join on tiles, for inputs of any size. The sides are plain feature tables (not those of
    :func:`create_feature_view`); ``options`` go to :func:`spatial_join`. The tiles are cut when the
    view is created, so create it anew after the polygons change.
    """
    from perilgrid.operators.spatial_join import spatial_join

    joined = spatial_join(spark.table(points), spark.table(polygons), predicate, how, **options)
    joined.createOrReplaceTempView(name)


__all__ = ["GEOMETRY", "create_feature_view", "create_spatial_join_view", "register"]
