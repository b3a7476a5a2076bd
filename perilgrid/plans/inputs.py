"""Feature tables derived from the star-schema test tables.

The column expressions are written once, in SQL both Spark and DuckDB read, so that the
oracle sees the same inputs. Constants are doubles throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from perilgrid.functions.geometry import multi_polygon, polygon, rectangle_rings
from perilgrid.schema import FEATURE_TYPES, FID

# --- expressions shared with the oracle --------------------------------------------------

_LON = (
    "CAST(-100 AS DOUBLE) + CAST((l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 10000 AS DOUBLE)"
    " / CAST(1000 AS DOUBLE)"
)
_LAT = (
    "CAST(27 AS DOUBLE) + CAST((l_orderkey * 104729 + l_suppkey * 17 + l_linenumber) % 8000 AS DOUBLE)"
    " / CAST(1000 AS DOUBLE)"
)
_SITE_ID = "CAST(l_orderkey * 10 + l_linenumber AS STRING)"
# lines numbered 7 name the neighbouring cell on purpose: the spatial test must reject them
# cells are 1/side degrees wide, 10 * side of them in a row from the south-west corner of the area
_GRID_ID = (
    "CAST(CAST(floor((lat - CAST(27 AS DOUBLE)) * side) AS BIGINT) * (10 * side)"
    " + CAST(floor((lon + CAST(100 AS DOUBLE)) * side) AS BIGINT)"
    " + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS STRING)"
)
SITE_COLUMNS = {
    FID: "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT))",
    "portfolio_id": "51320 + l_suppkey % 10",
    "peril_id": "CAST(3 AS BIGINT)",
    "account_id": "CAST(l_suppkey AS STRING)",
    "site_id": _SITE_ID,
    "nz_grid_id": _GRID_ID,
    "site_lat": "lat",
    "site_long": "lon",
    "cov1val": "l_extendedprice",
    "cov2val": "l_quantity * 100",
    "cov3val": "l_extendedprice * l_discount",
    "cov4val": "l_extendedprice * l_tax",
    "s_udf_met1": "l_extendedprice",
}


def _filled(feature: str, row: str, given: dict[str, str]) -> dict[str, str]:
    """Every attribute of a feature type: the given ones, the others made from the row number.

    Made numbers are null on some rows; made texts are not, as a text file cannot tell an empty
    string from a missing one.
    """
    columns = {}
    for k, field in enumerate(FEATURE_TYPES[feature].schema, 2):
        kind = field.dataType.simpleString()
        made = {
            "bigint": f"CASE WHEN ({row} + {k}) % 11 <> 0 THEN ({row} * {k}) % 977 END",
            "double": f"CASE WHEN ({row} + {k}) % 13 <> 0 THEN CAST(({row} * {k}) % 1009 AS DOUBLE) / CAST(8 AS DOUBLE) END",
            "string": f"concat('{field.name} ', CAST({row} % {50 + k} AS STRING))",
        }
        columns[field.name] = given.get(field.name) or made[kind]
    return columns


# lines 4 to 7 name another site or none, so the left join has misses and sites with several losses
LOSS_COLUMNS = _filled(
    "sitelossanalyzevent",
    "l_orderkey",
    {
        "portfolio_id": "51320 + l_suppkey % 10",
        "analysis_id": "CAST(l_linenumber AS BIGINT)",
        "site_id": "CAST(l_orderkey * 10 + l_linenumber + CASE WHEN l_linenumber > 3 THEN 5 ELSE 0 END AS STRING)",
        "account_id": "CAST(l_suppkey AS STRING)",
        "gross_loss": "l_extendedprice * CAST(0.01 AS DOUBLE)",
        "damage_loss": "l_extendedprice * CAST(0.012 AS DOUBLE)",
        "net_loss": "l_extendedprice * CAST(0.008 AS DOUBLE)",
    },
)
_CELL_X = "CAST(p_partkey % (10 * side){} AS DOUBLE) / CAST(side AS DOUBLE) + CAST(-100 AS DOUBLE)"
_CELL_Y = "CAST(CAST(floor(p_partkey / CAST(10 * side AS DOUBLE)) AS BIGINT){} AS DOUBLE) / CAST(side AS DOUBLE) + CAST(27 AS DOUBLE)"
GRID_COLUMNS = {
    "OBJECTID": "p_partkey",
    "nz_grid_id": "p_partkey",
    "g_country_id": "CAST(840 AS BIGINT)",
    "geo_unit_id": "1000 + p_partkey",
    "minx": _CELL_X.format(""),
    "maxx": _CELL_X.format(" + 1"),
    "miny": _CELL_Y.format(""),
    "maxy": _CELL_Y.format(" + 1"),
}
# the largest side at which the rows of ``part`` tile the whole 10 x 8 degree area; the rest of
# them continues to the north
GRID_SIDE = "CAST(greatest(1, floor(sqrt(count(*) / CAST(80 AS DOUBLE)))) AS BIGINT)"
ZOOM_COLUMNS = {
    "zoom_id": "p_partkey",
    "zoom_value": "CAST(floor(CAST(1565430 AS DOUBLE) / power(CAST(2 AS DOUBLE), CAST(p_partkey AS DOUBLE))) AS BIGINT)",
}
ZOOM_FILTER = "p_partkey < 20"  # the hexagon table has exactly 20 zoom levels
FOOTPRINT_COLUMNS = {
    "OBJECTID": "s_suppkey",
    "FIRE_NAME": "s_name",
    "ACRES": "s_acctbal",
    "cx": "CAST(-100 AS DOUBLE) + CAST((s_suppkey * 137) % 1000 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "cy": "CAST(27 AS DOUBLE) + CAST((s_suppkey * 211) % 800 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "r": "CAST(20 + 15 * (s_suppkey % 5) AS DOUBLE) / CAST(100 AS DOUBLE)",
}
POLICY_COLUMNS = _filled(
    "policyexposureevent",
    "o_orderkey",
    {
        "portfolio_id": "51320 + o_custkey % 10",
        "policy_id": "o_orderkey",
        "account_id": "o_custkey",
        "premium": "CAST(o_totalprice AS STRING)",
        "policy_bl_grosslimit": "o_totalprice",
    },
)
ACCOUNT_COLUMNS = _filled(
    "portfolioaccountevent",
    "c_custkey",
    {
        "account_id": "c_custkey",
        "account_name": "c_name",
        "division": "c_mktsegment",
        "a_udf_met1": "c_acctbal",
    },
)

# outer ring and hole of a footprint as multiples of its radius, closed
STAR = (
    (1.0, 0.0), (0.4, 0.4), (0.0, 1.0), (-0.4, 0.4), (-1.0, 0.0),
    (-0.4, -0.4), (0.0, -1.0), (0.4, -0.4), (1.0, 0.0),
)
HOLE = ((0.2, 0.2), (-0.2, 0.2), (-0.2, -0.2), (0.2, -0.2), (0.2, 0.2))
HOLE_EVERY = 7  # footprints whose id is a multiple of this have the hole


def _moved(ring, scale: float, dx: float, dy: float):
    return tuple((scale * x + dx, scale * y + dy) for x, y in ring)


# parts of a footprint of several: the star with its hole, a smaller one over its corner with a hole of its own,
# a star apart from both; ids leave 0, 1 or 2 when divided by 3 and have that many parts more than one
PARTS = (
    (STAR, HOLE),
    (_moved(STAR, 0.75, 0.5, 0.25), _moved(HOLE, 0.75, 0.5, 0.25)),
    (_moved(STAR, 0.5, 2.5, 0.0),),
)


def _projection(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


# --- Spark side ----------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Hand the rows of a scan to every core when its files have fewer splits than that.

    Meant for plain scans ahead of CPU-heavy work. A table with enough splits, as any large
    one has, stays as it is and is not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def _side(spark: SparkSession, sf_dir: str) -> Column:
    """A scalar subquery: plans that need no cell prune it unread."""
    return _table(spark, sf_dir, "part").selectExpr(f"{GRID_SIDE} AS side").scalar().alias("side")


def sites(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Site exposure; ``heavy`` asks for enough partitions to keep every core busy."""
    lines = _table(spark, sf_dir, "lineitem")
    located = (spread(lines) if heavy else lines).selectExpr("*", f"{_LON} AS lon", f"{_LAT} AS lat")
    located = located.select("*", _side(spark, sf_dir))
    return located.selectExpr(*_projection(SITE_COLUMNS), "named_struct('x', lon, 'y', lat) AS geom")


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(*_projection(LOSS_COLUMNS))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select("p_partkey", _side(spark, sf_dir))
    cells = rows.selectExpr(*_projection(GRID_COLUMNS))
    return cells.withColumn("SHAPE", polygon(rectangle_rings("minx", "miny", "maxx", "maxy")))


def zooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").where(ZOOM_FILTER).selectExpr(*_projection(ZOOM_COLUMNS))


def _ring_literal(offsets) -> str:
    return f"array({', '.join(f"named_struct('x', {dx!r}D, 'y', {dy!r}D)" for dx, dy in offsets)})"


_PLACED = "transform({}, ring -> transform(ring, o -> named_struct('x', cx + r * o.x, 'y', cy + r * o.y)))"


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = _table(spark, sf_dir, "supplier").selectExpr(*_projection(FOOTPRINT_COLUMNS))
    offsets = (
        f"CASE WHEN OBJECTID % {HOLE_EVERY} = 0 THEN array({_ring_literal(STAR)}, {_ring_literal(HOLE)}) "
        f"ELSE array({_ring_literal(STAR)}) END"
    )
    return shaped.withColumn("geometry", polygon(_PLACED.format(offsets))).drop("cx", "cy", "r")


def multi_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints of one to three parts, some of which overlap, with holes."""
    shaped = _table(spark, sf_dir, "supplier").selectExpr(*_projection(FOOTPRINT_COLUMNS))
    parts = [_PLACED.format(f"array({', '.join(map(_ring_literal, rings))})") for rings in PARTS]
    chosen = f"slice(array({', '.join(parts)}), 1, CAST(OBJECTID % {len(PARTS)} + 1 AS INT))"
    return shaped.withColumn("geometry", multi_polygon(chosen)).drop("cx", "cy", "r")


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*_projection(POLICY_COLUMNS))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*_projection(ACCOUNT_COLUMNS))


# --- oracle side ---------------------------------------------------------------------------


def _select(columns: dict[str, str], table: str, where: str | None = None, extra: str = "") -> str:
    sql = f"SELECT {', '.join(_projection(columns))}{extra} FROM {table}"
    return f"{sql} WHERE {where}" if where else sql


def _edge_rows(rings) -> list[str]:
    rows = []
    for ring, offsets in enumerate(rings):
        for seq, ((x0, y0), (x1, y1)) in enumerate(zip(offsets, offsets[1:])):
            rows.append(f"{ring}, {seq}, {x0!r}, {y0!r}, {x1!r}, {y1!r}")
    return rows


def _edges_of(rows: str, columns: str, where: str) -> str:
    return f"""
        SELECT OBJECTID, {columns}ring, seq, cx + r * dx0 AS x0, cy + r * dy0 AS y0, cx + r * dx1 AS x1, cy + r * dy1 AS y1
        FROM footprints CROSS JOIN (
          SELECT {columns}ring, seq, CAST(dx0 AS DOUBLE) AS dx0, CAST(dy0 AS DOUBLE) AS dy0,
                 CAST(dx1 AS DOUBLE) AS dx1, CAST(dy1 AS DOUBLE) AS dy1
          FROM (VALUES {rows}) v({columns}ring, seq, dx0, dy0, dx1, dy1)) o
        WHERE {where}"""


_MULTI_ROWS = ", ".join(f"({part}, {row})" for part, rings in enumerate(PARTS) for row in _edge_rows(rings))


def _located(edges: str, boxes: str, part: str = "") -> str:
    """Every (site, footprint) pair inside the envelope, with its crossing count and boundary flag."""
    same = " AND e.part = b.part" if part else ""
    return f"""
        SELECT s.{FID}, e.OBJECTID{part},
          sum(CASE WHEN (y0 > geom_y) <> (y1 > geom_y)
                    AND geom_x < (x1 - x0) * (geom_y - y0) / (y1 - y0) + x0 THEN 1 ELSE 0 END) % 2 = 1 AS inside,
          max(CASE WHEN (x1 - x0) * (geom_y - y0) - (y1 - y0) * (geom_x - x0) = 0
                    AND geom_x BETWEEN least(x0, x1) AND greatest(x0, x1)
                    AND geom_y BETWEEN least(y0, y1) AND greatest(y0, y1) THEN 1 ELSE 0 END) = 1 AS on_edge
        FROM sites s JOIN {boxes} b ON geom_x BETWEEN xmin AND xmax AND geom_y BETWEEN ymin AND ymax
        JOIN {edges} e ON e.OBJECTID = b.OBJECTID{same}
        GROUP BY s.{FID}, e.OBJECTID{part}"""


_BOX = "SELECT OBJECTID{0}, min(x0) AS xmin, max(x0) AS xmax, min(y0) AS ymin, max(y0) AS ymax FROM {1} GROUP BY OBJECTID{0}"

ORACLE_VIEWS = {
    "sites": _select(
        SITE_COLUMNS,
        f"(SELECT *, {_LON} AS lon, {_LAT} AS lat FROM lineitem CROSS JOIN side) t",
        extra=", lon AS geom_x, lat AS geom_y",
    ),
    "side": f"SELECT {GRID_SIDE} AS side FROM part",
    "losses": _select(LOSS_COLUMNS, "lineitem"),
    "grid": _select(GRID_COLUMNS, "part CROSS JOIN side"),
    "zooms": _select(ZOOM_COLUMNS, "part", ZOOM_FILTER),
    "footprints": _select(FOOTPRINT_COLUMNS, "supplier"),
    "policies": _select(POLICY_COLUMNS, "orders"),
    "accounts": _select(ACCOUNT_COLUMNS, "customer"),
    "edges": _edges_of(
        ", ".join(f"({row})" for row in _edge_rows((STAR, HOLE))), "", f"ring = 0 OR OBJECTID % {HOLE_EVERY} = 0"
    ),
    "boxes": _BOX.format("", "edges"),
    "located": _located("edges", "boxes"),
    "multi_edges": _edges_of(_MULTI_ROWS, "part, ", f"part <= OBJECTID % {len(PARTS)}"),
    "multi_boxes": _BOX.format(", part", "multi_edges"),
    "multi_located": _located("multi_edges", "multi_boxes", ", e.part"),
}
_DEPENDS = {
    "sites": ["side"],
    "grid": ["side"],
    "edges": ["footprints"],
    "boxes": ["edges"],
    "located": ["sites", "boxes"],
    "multi_edges": ["footprints"],
    "multi_boxes": ["multi_edges"],
    "multi_located": ["sites", "multi_boxes"],
}


def with_views(query: str, *views: str) -> str:
    """Prefix a query with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _DEPENDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    ctes = ", ".join(f"{v} AS ({ORACLE_VIEWS[v]})" for v in ordered)
    return f"WITH {ctes} {query}"
