"""Oracle SQL for DuckDB, one text per registered query."""

from __future__ import annotations

from perilgrid.plans.inputs import with_views as w
from perilgrid.schema import FID

PORTFOLIO = 51325
HISTOGRAM_PORTFOLIO = 51326
LOOKUP_SITE = "1025"
BUCKETS = (0.0, 130000.0, 99)
LIMIT_BUCKETS = (1000.0, 401000.0, 8)

GULF = "geom_x BETWEEN -96 AND -94 AND geom_y BETWEEN 29 AND 31"
GULF_INTERIOR = "geom_x > -96 AND geom_x < -94 AND geom_y > 29 AND geom_y < 31"
WIDE_GULF = "geom_x BETWEEN -96 AND -91 AND geom_y BETWEEN 29 AND 31"


def _bucket(value: str, first: float, last: float, n: int) -> str:
    """Ascending bounds only: all the reports use them so."""
    return (
        f"CASE WHEN {value} < {first}::DOUBLE THEN 0 WHEN {value} >= {last}::DOUBLE THEN {n + 1} "
        f"ELSE CAST(floor({n}::DOUBLE * ({value} - {first}::DOUBLE) / ({last}::DOUBLE - {first}::DOUBLE) + 1::DOUBLE) AS BIGINT) END::BIGINT"
    )


_MAX = "SELECT portfolio_id, site_id, max(cov1val + cov2val + cov3val + cov4val) AS max_10 FROM sites GROUP BY 1, 2"
_BINNED = f'SELECT *, {_bucket("max_10", *BUCKETS)} AS "BIN" FROM ({_MAX}) m'
_BINS = 'SELECT min(max_10) AS "MIN_VAL", max(max_10) AS "MAX_VAL", "BIN", count(*) AS "FREQUENCY" FROM ({}) b {} GROUP BY "BIN" ORDER BY "BIN" {}'


def _nearest(value: str) -> str:
    """Nearest double to the exact sum: integers of 2**-60, halves of which are exact doubles (the sum is above 2**8)."""
    total = f"sum(CAST({value} * {2.0**60!r}::DOUBLE AS HUGEINT))"
    high = f"({total} >> 60)"
    rest = f"({total} - ({total} >> 60) * {1 << 60}::HUGEINT)"
    low = f"({rest} >> 10) * 2 + CASE WHEN {rest} & 1023 = 0 THEN 0 ELSE 1 END"
    return f"CAST({high} AS DOUBLE) + CAST({low} AS DOUBLE) / {2.0**51!r}::DOUBLE"


_LOSS_EXACT = f"""SELECT portfolio_id, v AS sum_s_udf_met1, v / n AS avg_s_udf_met1, sum_gross_loss FROM (
  SELECT s.portfolio_id, {_nearest('s.s_udf_met1')} AS v, count(s.s_udf_met1) AS n,
    {_nearest('l.gross_loss')} AS sum_gross_loss
  FROM sites s LEFT JOIN losses l ON s.site_id = l.site_id GROUP BY s.portfolio_id)"""


def _loss(by: str, where: str = "", extra: str = "") -> str:
    return f"""SELECT s.{by}, round(sum(s.s_udf_met1), 4) AS sum_s_udf_met1,
      round(sum(s.s_udf_met1), 4) / count(s.s_udf_met1) AS avg_s_udf_met1,
      round(sum(l.gross_loss), 4) AS sum_gross_loss{extra}
      FROM sites s LEFT JOIN losses l ON s.site_id = l.site_id {where} GROUP BY s.{by}"""


_SITE = "portfolio_id, account_id, site_id"


# Hexagons: each column as an expression of its own over a site (x, y) and a level's radius r.
_ORIGIN_X, _ORIGIN_Y = "CAST(20037507.0671618 AS DOUBLE)", "CAST(19971868.8804086 AS DOUBLE)"


def _n(value: int) -> str:
    return f"CAST({value} AS DOUBLE)"


_H = f"(r * cos({_n(30)} * pi() / {_n(180)}))"
_V = f"(r / {_n(2)})"
_ROW = f"CAST(floor((y - {_ORIGIN_Y}) / ({_n(3)} * {_V})) AS BIGINT)"
_COL = f"CAST(floor((x - {_ORIGIN_X}) / ({_n(2)} * {_H})) AS BIGINT)"
_CENTER_X = f"({_COL} * ({_n(2)} * {_H}) + CASE WHEN {_ROW} % 2 <> 0 THEN {_H} ELSE {_n(0)} END + {_ORIGIN_X})"
_CENTER_Y = f"({_ROW} * ({_n(3)} * {_V}) + {_ORIGIN_Y})"
_OFF_X, _OFF_Y = f"(x - {_CENTER_X})", f"(y - {_CENTER_Y})"
_HELD = f"(abs({_OFF_X}) <= r AND abs({_OFF_Y}) <= r AND abs({_OFF_X}) / {_H} + abs({_OFF_Y}) / {_V} <= {_n(2)})"
_ANGLE = f"atan2({_OFF_X}, {_OFF_Y})"
_BEARING = f"((CASE WHEN {_ANGLE} < 0 THEN {_ANGLE} + {_n(2)} * pi() ELSE {_ANGLE} END) * {_n(180)} / pi())"
# Neighbour by bearing: above, up to, row step, column step in odd and in even rows.
_SECTORS = "(-1, 0, 1, 0, 0), (0, 60, 1, 1, 0), (60, 120, 0, 1, 1), (120, 180, -1, 1, 0), (180, 240, -1, -1, 0), (240, 300, 0, -1, -1), (300, 360, 1, 0, -1)"
_CELL = f"""{_ROW} + CASE WHEN {_HELD} THEN 0 ELSE up END AS arow,
  {_COL} + CASE WHEN {_HELD} THEN 0 WHEN {_ROW} % 2 <> 0 THEN odd ELSE even END AS acol"""
_SITE_LEVELS = f"""(SELECT {_SITE}, geom_x AS x, geom_y AS y, zoom_id AS lod, zoom_id, CAST(zoom_value AS DOUBLE) AS r
  FROM sites CROSS JOIN zooms {{}}) p"""


def _hex(columns: str, everywhere: bool = False) -> str:
    where = "" if everywhere else f"WHERE portfolio_id = {PORTFOLIO}"
    return w(f"SELECT {columns} FROM {_SITE_LEVELS.format(where)}", "sites", "zooms")


def _hex_cells(columns: str, everywhere: bool = False) -> str:
    sectors = f"(VALUES {_SECTORS}) s(above, upto, up, odd, even)"
    return f"{_hex(columns, everywhere)} JOIN {sectors} ON {_BEARING} > above AND {_BEARING} <= upto"


_HEX_BIN = _hex_cells(f"{_SITE}, lod, {_CELL}")
_HEX_ALL = _hex_cells(f"{_SITE}, lod, {_CELL}", everywhere=True)
_NORTH = f"CASE WHEN CAST(site_id AS BIGINT) % 4 = 0 THEN geom_y + {_n(55)} ELSE geom_y END"
_CLIPPED = f"greatest(-85.05112877980659::DOUBLE, least(85.05112877980659::DOUBLE, {_NORTH}))"
_HEX_MERCATOR = _HEX_ALL.replace(
    "geom_x AS x, geom_y AS y",
    f"geom_x * pi() / {_n(180)} * {_n(6378137)} AS x, ln(tan(pi() / {_n(4)} + {_CLIPPED} * pi() / {_n(360)})) * {_n(6378137)} AS y",
)
_CORNERS = "(0, minx, miny), (1, maxx, miny), (2, maxx, maxy), (3, minx, maxy), (4, minx, miny)"
_EDGES = """SELECT f.OBJECTID, FIRE_NAME, ACRES, ring, seq, x0, y0, x1, y1
           FROM footprints f JOIN edges e ON e.OBJECTID = f.OBJECTID"""
_GRID_JOIN = """FROM sites JOIN grid ON CAST(sites.nz_grid_id AS BIGINT) = grid.nz_grid_id
  AND geom_x BETWEEN minx AND maxx AND geom_y BETWEEN miny AND maxy"""
_GRID_ENRICH = w(f"SELECT portfolio_id, site_id, g_country_id, geo_unit_id {_GRID_JOIN}", "sites", "grid")
_SITE_ROWS = f"""SELECT {FID}, portfolio_id, peril_id, account_id, site_id, nz_grid_id, site_lat, site_long, geom_x, geom_y,
  cov1val, cov2val, cov3val, cov4val, s_udf_met1 FROM sites"""
_EXPOSURE = f"""SELECT portfolio_id, round(sum(s_udf_met1), 4) AS sum_s_udf_met1,
  round(sum(s_udf_met1), 4) / count(s_udf_met1) AS avg_s_udf_met1
  FROM located JOIN sites USING ({FID}) WHERE inside OR on_edge GROUP BY portfolio_id"""
_CONTAINED = f"""SELECT {FID}, {_SITE}, OBJECTID FROM located JOIN sites USING ({FID}) WHERE inside AND NOT on_edge"""



def _side(s: str, t: str, k: int) -> str:
    """On which side of segment ``s`` an end of ``t`` lies."""
    return f"(({s}.x1 - {s}.x0) * ({t}.y{k} - {s}.y0) - ({s}.y1 - {s}.y0) * ({t}.x{k} - {s}.x0))"


def _on(s: str, t: str, k: int) -> str:
    x, y = f"{t}.x{k}", f"{t}.y{k}"
    return f"({_side(s, t, k)} = 0 AND {x} BETWEEN least({s}.x0, {s}.x1) AND greatest({s}.x0, {s}.x1) AND {y} BETWEEN least({s}.y0, {s}.y1) AND greatest({s}.y0, {s}.y1))"


_CROSS = " AND ".join(f"({_side(s, t, 0)} > 0) <> ({_side(s, t, 1)} > 0)" for s, t in (("s", "t"), ("t", "s")))
_TOUCH = " OR ".join(_on(s, t, k) for s, t in (("s", "t"), ("t", "s")) for k in (0, 1))
_ODD = """sum(CASE WHEN (t.y0 > s.y0) <> (t.y1 > s.y0) AND s.x0 < (t.x1 - t.x0) * (s.y0 - t.y0) / (t.y1 - t.y0) + t.x0
  THEN 1 ELSE 0 END) % 2 = 1"""


def _overlaps(a: str, b: str, where: str) -> str:
    """Pairs (a, b) of outlines, given as segments with ids, that meet or of which one holds a vertex of the other."""

    def held(a: str, b: str, swapped: bool) -> str:
        ids = "t.id AS a, s.id AS b" if swapped else "s.id AS a, t.id AS b"
        return f"SELECT {ids} FROM {a} s JOIN {b} t ON {where} GROUP BY s.id, t.id, s.part, t.part, s.ring, s.seq, s.x0, s.y0 HAVING {_ODD}"

    return f"""SELECT DISTINCT a, b FROM (
      SELECT s.id AS a, t.id AS b FROM {a} s JOIN {b} t ON {where} WHERE ({_CROSS}) OR {_TOUCH}
      UNION ALL {held(a, b, False)} UNION ALL {held(b, a, True)})"""


_MULTI = "(SELECT OBJECTID AS id, part, ring, seq, x0, y0, x1, y1 FROM multi_edges)"
FIRE_BOX = (-97.25, 28.5, -94.5, 31.25)
_BOX_SIDES = """(SELECT 0 AS id, 0 AS part, 0 AS ring, seq, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0,
  CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1
  FROM (VALUES (0, {0}, {1}, {2}, {1}), (1, {2}, {1}, {2}, {3}), (2, {2}, {3}, {0}, {3}), (3, {0}, {3}, {0}, {1})) v(seq, x0, y0, x1, y1))""".format(*FIRE_BOX)
_MULTI_EXPOSURE = f"""SELECT portfolio_id, round(sum(s_udf_met1), 4) AS sum_s_udf_met1, count(*) AS n_pairs
  FROM (SELECT DISTINCT {FID}, OBJECTID FROM multi_located WHERE inside OR on_edge) JOIN sites USING ({FID}) GROUP BY portfolio_id"""

ORACLES: dict[str, str] = {
    # scans
    "scan_feature_table": w(_SITE_ROWS, "sites"),
    "scan_bbox_projection": w(f"SELECT {_SITE}, s_udf_met1 FROM sites WHERE {GULF}", "sites"),
    "scan_bbox_saved": w(f"SELECT {_SITE}, s_udf_met1 FROM sites WHERE {GULF}", "sites"),
    "scan_bbox_count": w(f"SELECT count(*) AS n FROM sites WHERE {GULF}", "sites"),
    "scan_bbox_clustered": w(f"SELECT {_SITE}, s_udf_met1 FROM sites WHERE {GULF}", "sites"),
    "scan_attr_filter": w(f"{_SITE_ROWS} WHERE portfolio_id = {PORTFOLIO}", "sites"),
    "scan_footprints": w(_EDGES, "footprints", "edges"),
    "footprint_head": w("SELECT OBJECTID, ACRES FROM footprints WHERE OBJECTID < 100 ORDER BY OBJECTID LIMIT 10", "footprints"),
    "count_sites": w("SELECT count(*) AS n FROM sites", "sites"),
    "count_losses": w("SELECT count(*) AS n FROM losses", "losses"),
    "bbox_lookup": w(f"SELECT site_id FROM sites WHERE {WIDE_GULF} ORDER BY site_id LIMIT 5", "sites"),
    "bbox_lookup_all": w(f"SELECT site_id FROM sites WHERE {WIDE_GULF}", "sites"),
    "bbox_lookup_sql": w(f"SELECT site_id FROM sites WHERE {WIDE_GULF}", "sites"),
    "point_accessors": w(f"SELECT {FID}, geom_x AS x, geom_y AS y, false AS is_empty FROM sites", "sites"),
    "wkt_parse": w(f"SELECT {FID}, geom_x AS x, geom_y AS y FROM sites", "sites"),
    # grid
    "grid_count": w(f"SELECT count(*) AS n {_GRID_JOIN}", "sites", "grid"),
    "grid_count_sql": w(f"SELECT count(*) AS n {_GRID_JOIN}", "sites", "grid"),
    "grid_enrich": _GRID_ENRICH,
    "grid_enrich_saved": w(f"SELECT {FID}, portfolio_id, site_id, g_country_id, geo_unit_id {_GRID_JOIN}", "sites", "grid"),
    # footprints
    "fire_exposure": w(_EXPOSURE, "located"),
    "fire_contains": w(_CONTAINED, "located"),
    "fire_contains_head": w(f"{_CONTAINED} ORDER BY {FID}, OBJECTID LIMIT 10", "located"),
    "fire_semi_join": w(
        f"""SELECT {FID}, {_SITE}, s_udf_met1 FROM sites
            WHERE portfolio_id IS NOT NULL AND {FID} IN (SELECT {FID} FROM located WHERE inside AND NOT on_edge)""",
        "located",
    ),
    "fire_exposure_shuffled": w(_EXPOSURE, "located"),
    # every third site stands there twice
    "fire_semi_join_repeated": w(
        f"""SELECT {FID}, {_SITE}, s_udf_met1
            FROM (SELECT * FROM sites UNION ALL SELECT * FROM sites WHERE CAST(site_id AS BIGINT) % 3 = 0)
            WHERE {FID} IN (SELECT {FID} FROM located WHERE inside AND NOT on_edge)""",
        "located",
    ),
    "fire_lookup_site": w(
        f"SELECT portfolio_id FROM located JOIN sites USING ({FID}) WHERE site_id = '{LOOKUP_SITE}' AND (inside OR on_edge)",
        "located",
    ),
    "fire_exposure_sql": w(_EXPOSURE, "located"),
    "fire_exposure_multipart": w(_MULTI_EXPOSURE, "multi_located"),
    "fire_contains_multipart": w(
        f"SELECT DISTINCT {FID}, OBJECTID FROM multi_located WHERE inside AND NOT on_edge", "multi_located"
    ),
    "footprints_in_box": w(f"SELECT b AS \"OBJECTID\" FROM ({_overlaps(_BOX_SIDES, _MULTI, 'true')})", "multi_edges"),
    "footprint_overlaps": w(_overlaps(_MULTI, _MULTI, "s.id <> t.id") + " WHERE a < b", "multi_edges"),
    # losses
    "loss_by_portfolio": w(_loss("portfolio_id"), "sites", "losses"),
    "loss_by_portfolio_exact": w(_LOSS_EXACT, "sites", "losses"),
    "loss_by_portfolio_bucketed": w(_loss("portfolio_id"), "sites", "losses"),
    "loss_by_portfolio_bbox": w(_loss("portfolio_id", f"WHERE {GULF_INTERIOR}"), "sites", "losses"),
    "loss_by_site_bbox": w(_loss("site_id", f"WHERE {GULF}"), "sites", "losses"),
    "loss_by_site_bucket": w(
        _loss("site_id", f"WHERE {GULF}", f", {_bucket('CAST(s.site_id AS DOUBLE)', 150.0, 3990682000.0, 99)} AS bin"),
        "sites",
        "losses",
    ),
    # coverage
    "site_cov_max": w(_MAX, "sites"),
    "cov_bucket": w(_BINNED, "sites"),
    "cov_bucket_sql": w(_BINNED, "sites"),
    "cov_histogram": w(_BINS.format(_BINNED, f"WHERE portfolio_id = {HISTOGRAM_PORTFOLIO}", "LIMIT 100"), "sites"),
    "cov_histogram_alias": w(
        f"""SELECT portfolio_id, {_bucket("policy_bl_grosslimit", *LIMIT_BUCKETS)} AS limit_class,
            count(DISTINCT account_id) AS accounts, round(sum(policy_bl_grosslimit), 4) AS total_limit
            FROM policies WHERE policy_bl_grosslimit IS NOT NULL GROUP BY ALL""",
        "policies",
    ),
    # hexagons
    "count_site_zoom": w(f"SELECT count(*) AS n FROM sites, zooms WHERE portfolio_id = {PORTFOLIO}", "sites", "zooms"),
    "hex_site_zoom": _hex(f"{_SITE}, x, y, lod"),
    "hex_radius": _hex(f"{_SITE}, lod, zoom_id, r AS hex_radius, {_ORIGIN_X} AS origin_x, {_ORIGIN_Y} AS origin_y"),
    "hex_offsets": _hex(f"{_SITE}, lod, x - {_ORIGIN_X} AS dx, y - {_ORIGIN_Y} AS dy, {_H} AS h, {_V} AS v"),
    "hex_quads": _hex(f"{_SITE}, lod, {_ROW} AS quad_row, {_COL} AS quad_col, {_ROW} % 2 AS mod2_row"),
    "hex_centers": _hex(f"{_SITE}, lod, {_CENTER_X} AS center_x, {_CENTER_Y} AS center_y"),
    "hex_residuals": _hex(
        f"{_SITE}, lod, {_OFF_X} AS q2x, {_OFF_Y} AS q2y, abs({_OFF_X}) AS abs_q2x, abs({_OFF_Y}) AS abs_q2y"
    ),
    "hex_azimuth": _hex(
        f"{_SITE}, lod, {_ROW} AS quad_row, {_COL} AS quad_col, CAST({_ROW} % 2 AS DOUBLE) AS mod2_row, "
        f"{_HELD} AS is_inside, round({_BEARING}, 6) AS azimuth"
    ),
    "hex_bin": _HEX_BIN,
    "hex_bin_all": _HEX_ALL,
    "hex_bin_mercator": _HEX_MERCATOR,
    "hex_bin_saved": _hex_cells(f"fid || '/' || CAST(lod AS VARCHAR) AS {FID}, {_SITE}, lod, {_CELL}").replace(
        f"(SELECT {_SITE}, geom_x", f"(SELECT {FID} AS fid, {_SITE}, geom_x"
    ),
    "hex_bin_counts": f"SELECT lod, arow, acol, count(*) AS n_sites FROM ({_HEX_ALL}) GROUP BY 1, 2, 3",
    # ingest round trips
    "ingest_site_exposure": w(
        f"""SELECT {FID}, portfolio_id, peril_id, account_id, site_id, nz_grid_id, site_lat, site_long,
            geom_x, geom_y, geom_x AS shape_x, geom_y AS shape_y, cov1val, cov2val, cov3val, cov4val, s_udf_met1 FROM sites""",
        "sites",
    ),
    "ingest_nzgrid": w(
        f"""SELECT OBJECTID, nz_grid_id, g_country_id, geo_unit_id, minx, miny, maxx, maxy,
            minx AS xmin, miny AS ymin, maxx AS xmax, maxy AS ymax, c.seq, c.x, c.y
            FROM grid, LATERAL (VALUES {_CORNERS}) c(seq, x, y)""",
        "grid",
    ),
    "ingest_hex_zoom": w("SELECT zoom_id, zoom_value FROM zooms", "zooms"),
    "ingest_policy_exposure": w("SELECT * REPLACE (CAST(premium AS DOUBLE) AS premium) FROM policies", "policies"),
    "ingest_portfolio_account": w("SELECT * FROM accounts", "accounts"),
    "ingest_site_loss": w("SELECT * FROM losses", "losses"),
    "ingest_geojson_collection": w(f"{_EDGES} WHERE f.OBJECTID % 9 <> 4", "footprints", "edges"),
    "ingest_geojson_indented": w(
        "SELECT f.OBJECTID, FIRE_NAME, ACRES, part, ring, seq, x0, y0, x1, y1 FROM footprints f JOIN multi_edges e ON e.OBJECTID = f.OBJECTID",
        "multi_edges",
    ),
    "ingest_twice": w(
        "SELECT portfolio_id, count(*) AS n, round(sum(gross_loss), 4) AS sum_gross_loss FROM losses GROUP BY portfolio_id", "losses"
    ),
    "ingest_incremental": w(
        "SELECT policy_id, portfolio_id, account_id, CAST(premium AS DOUBLE) AS premium FROM policies", "policies"
    ),
    "ingest_text_counts": "SELECT count(*) FILTER (p_partkey % 7 > 2) AS written, count(*) FILTER (p_partkey % 7 <= 2) AS failed FROM part",
    "ingest_wildfire_geojson": w(_EDGES, "footprints", "edges"),
    "ingest_quality_counts": "SELECT count(*) FILTER (l_linenumber <> 7) AS written, count(*) FILTER (l_linenumber = 7) AS failed FROM lineitem",
    "export_csv": w(f"SELECT {_SITE}, s_udf_met1 FROM sites", "sites"),
}
