"""Point, polygon and box expressions over plain Spark structs.

Points are ``struct<x,y>`` (longitude first); polygons are
``struct<rings: array<array<struct<x,y>>>, bbox: struct<xmin,ymin,xmax,ymax>, parts: array<int>>``,
where ``parts`` is null for one part and else the number of rings of each of several parts. A part is its
rings by the even-odd rule; a polygon of several parts is what at least one of them covers.
Everything here is a built-in column expression: no Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OUTSIDE, INSIDE = 0, 1  # codes of `position`; bit 1 (value 2) is set on the boundary


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def st_x(geom: Column) -> Column:
    return geom["x"]


def st_y(geom: Column) -> Column:
    return geom["y"]


def st_isempty(geom: Column, kind: str = "Point") -> Column:
    """True for EMPTY geometries, null for null ones."""
    empty = geom["x"].isNull() if kind == "Point" else F.size(geom["rings"]) == 0
    return F.when(geom.isNotNull(), empty)


def let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it inside ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_ONE_PART = "CAST(NULL AS ARRAY<INT>)"


def polygon(rings: str) -> Column:
    """Attach the envelope to an array of rings; null rings give a null polygon."""
    return F.expr(let("_rings", rings, with_envelope("_rings")))


def multi_polygon(parts: str) -> Column:
    """Polygon of several parts, each an array of rings; null parts give a null polygon."""
    sizes = "CASE WHEN size(_parts) > 1 THEN transform(_parts, p -> size(p)) END"
    return F.expr(let("_parts", parts, let("_rings", "flatten(_parts)", with_envelope("_rings", sizes))))


def part_rings(poly: str) -> str:
    """The rings of each part of a polygon: an array of arrays of rings."""
    before = f"aggregate(slice({poly}.parts, 1, i), 0, (a, b) -> a + b)"
    several = f"transform({poly}.parts, (n, i) -> slice({poly}.rings, 1 + {before}, n))"
    return f"CASE WHEN {poly}.parts IS NULL THEN array({poly}.rings) ELSE {several} END"


def with_envelope(rings: str, parts: str = _ONE_PART) -> str:
    ends = ", ".join(
        f"'{axis}{fn}', array_{fn}(transform(_all, p -> p.{axis}))" for fn in ("min", "max") for axis in "xy"
    )
    box = let("_all", f"flatten({rings})", f"named_struct({ends})")
    return f"CASE WHEN {rings} IS NOT NULL THEN named_struct('rings', {rings}, 'bbox', {box}, 'parts', {parts}) END"


def rectangle_rings(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """One closed ring, counter-clockwise from the lower left, as SQL."""
    corners = ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))
    return f"array(array({', '.join(f"named_struct('x', {x}, 'y', {y})" for x, y in corners)}))"


# The tests below are SQL text: one definition serves DataFrame code (through `expr`) and the
# registered SQL functions, and a long expression reaches the JVM in a single call.


def edges(poly: str) -> str:
    """All ring segments of a polygon as ``array<struct<x0,y0,x1,y1>>``."""
    return ring_edges(f"{poly}.rings")


def part_edges(poly: str) -> str:
    """The ring segments of each part of a polygon."""
    return f"transform({part_rings(poly)}, rings -> {ring_edges('rings')})"


def ring_edges(rings: str) -> str:
    n = "greatest(size(ring) - 1, 0)"
    return (
        f"flatten(transform({rings}, ring -> zip_with(slice(ring, 1, {n}), slice(ring, 2, {n}), "
        "(a, b) -> named_struct('x0', a.x, 'y0', a.y, 'x1', b.x, 'y1', b.y))))"
    )


def crosses(x: str, y: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """The ray from (x, y) towards +x crosses the segment; its upper end does not count."""
    return (
        f"CASE WHEN ({y0} > {y}) <> ({y1} > {y}) "
        f"THEN {x} < ({x1} - {x0}) * ({y} - {y0}) / ({y1} - {y0}) + {x0} ELSE false END"
    )


def touches(x: str, y: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """(x, y) lies on the segment."""
    return (
        f"(({x1} - {x0}) * ({y} - {y0}) - ({y1} - {y0}) * ({x} - {x0}) = 0D "
        f"AND ({x} - {x0}) * ({x} - {x1}) <= 0D AND ({y} - {y0}) * ({y} - {y1}) <= 0D)"
    )


def position(x: str, y: str, segments: str, start: str = "0") -> str:
    """Locate (x, y) against ring segments: 0 outside, 1 inside, 2 or 3 on the boundary.

    Even-odd rule over all rings, so holes count as outside. Bit 0 toggles on every
    segment crossed by the ray towards +x; bit 1 is set when a segment holds the point.
    ``start`` carries the crossings of segments left out because every ray crosses them.
    """
    ends = ("e.x0", "e.y0", "e.x1", "e.y1")
    return (
        f"aggregate({segments}, {start}, (acc, e) -> CASE "
        f"WHEN {y} < least(e.y0, e.y1) OR {y} > greatest(e.y0, e.y1) THEN acc "
        f"ELSE (acc ^ CASE WHEN {crosses(x, y, *ends)} THEN 1 ELSE 0 END) "
        f"| CASE WHEN {touches(x, y, *ends)} THEN 2 ELSE 0 END END)"
    )


# what a computed crossing of a segment ``e`` may be off by, and more
SLACK = "(abs(e.x0) + abs(e.x1) + abs(e.y0) + abs(e.y1)) * 1e-12D"


def in_envelope(x: str, y: str, box: str) -> str:
    return f"{x} BETWEEN {box}.xmin AND {box}.xmax AND {y} BETWEEN {box}.ymin AND {box}.ymax"


def st_intersects(geom: str, poly: str) -> Column:
    """Point column in the interior or on the boundary of the polygon column; null for nulls."""
    return _unless_null(geom, poly, _located(geom, poly, f"<> {OUTSIDE}"))


def st_contains(poly: str, geom: str) -> Column:
    """Point column strictly inside the polygon column; boundary and holes do not count."""
    return _unless_null(geom, poly, _located(geom, poly, f"= {INSIDE}"))


def _located(geom: str, poly: str, wanted: str) -> str:
    x, y = f"{geom}.x", f"{geom}.y"
    several = f"exists({part_edges(poly)}, es -> {position(x, y, 'es')} {wanted})"
    return f"CASE WHEN {poly}.parts IS NULL THEN {position(x, y, edges(poly))} {wanted} ELSE {several} END"


def segments_meet(a: str, b: str) -> str:
    """Two segments ``struct<x0,y0,x1,y1>`` cross or touch."""

    def side(s: str, x: str, y: str) -> str:
        return f"({s}.x1 - {s}.x0) * ({y} - {s}.y0) - ({s}.y1 - {s}.y0) * ({x} - {s}.x0)"

    def apart(s: str, t: str) -> str:
        """The ends of ``t`` lie on different sides of the line through ``s``."""
        return f"(({side(s, f'{t}.x0', f'{t}.y0')}) > 0D) <> (({side(s, f'{t}.x1', f'{t}.y1')}) > 0D)"

    def on(s: str, x: str, y: str) -> str:
        return touches(x, y, f"{s}.x0", f"{s}.y0", f"{s}.x1", f"{s}.y1")

    ends = [on(s, f"{t}.x{k}", f"{t}.y{k}") for s, t in ((a, b), (b, a)) for k in (0, 1)]
    return f"(({apart(a, b)}) AND ({apart(b, a)}) OR {' OR '.join(ends)})"


def parts_overlap(a: str, b: str, a_box: str | None = None, b_box: str | None = None) -> str:
    """Two polygons, given as the segments of their parts, share at least one point.

    Their outlines meet, or one of them has a part that begins inside the other. Segments outside of the
    other's envelope are not compared; envelopes that are at hand need not be found from the segments.
    """

    def near(parts: str, other: str, at_hand: str | None) -> str:
        x, y = f"flatten({other})", f"flatten({parts})"
        box = [f"array_{fn}(transform({x}, e -> {fn2}(e.{c}0, e.{c}1)))" for c in "xy" for fn, fn2 in (("min", "least"), ("max", "greatest"))]
        keep = (
            "greatest(e.x0, e.x1) >= _b.xmin AND least(e.x0, e.x1) <= _b.xmax "
            "AND greatest(e.y0, e.y1) >= _b.ymin AND least(e.y0, e.y1) <= _b.ymax"
        )
        if at_hand:
            return f"filter({y}, e -> {keep.replace('_b.', f'{at_hand}.')})"
        names = ("xmin", "xmax", "ymin", "ymax")
        return let("_b", f"named_struct({', '.join(f"'{n}', {v}" for n, v in zip(names, box))})", f"filter({y}, e -> {keep})")

    def begins(parts: str, other: str, at_hand: str | None) -> str:
        first = f"{in_envelope('p[0].x0', 'p[0].y0', at_hand)} AND " if at_hand else ""
        return f"exists({parts}, p -> {first}exists({other}, es -> {position('p[0].x0', 'p[0].y0', 'es')} <> {OUTSIDE}))"

    apart = "least(s.x0, s.x1) > greatest(t.x0, t.x1) OR greatest(s.x0, s.x1) < least(t.x0, t.x1)"
    apart += f" OR {apart}".replace("x0", "y0").replace("x1", "y1")
    crossing = f"exists(_na, s -> exists(_nb, t -> CASE WHEN {apart} THEN false ELSE {segments_meet('s', 't')} END))"
    meet = let("_na", near(a, b, b_box), let("_nb", near(b, a, a_box), crossing))
    return f"({begins(a, b, b_box)} OR {begins(b, a, a_box)} OR {meet})"


def _unless_null(geom: str, poly: str, exact: str) -> Column:
    near = in_envelope(f"{geom}.x", f"{geom}.y", f"{poly}.bbox")
    return F.expr(f"CASE WHEN {geom} IS NOT NULL AND {poly} IS NOT NULL THEN coalesce({near}, false) AND {exact} END")


@dataclass(frozen=True)
class Box:
    """Constant rectangle; corners may come in any order.

    Both tests are plain comparisons of ``geom.x`` / ``geom.y`` with literals, which
    reach the Parquet reader as nested predicates and skip row groups.
    """

    x1: float
    y1: float
    x2: float
    y2: float

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return (
            float(min(self.x1, self.x2)),
            float(min(self.y1, self.y2)),
            float(max(self.x1, self.x2)),
            float(max(self.y1, self.y2)),
        )

    def intersects(self, geom: Column) -> Column:
        xmin, ymin, xmax, ymax = self.bounds
        return geom["x"].between(xmin, xmax) & geom["y"].between(ymin, ymax)

    def contains(self, geom: Column) -> Column:
        xmin, ymin, xmax, ymax = self.bounds
        return (geom["x"] > xmin) & (geom["x"] < xmax) & (geom["y"] > ymin) & (geom["y"] < ymax)


_RINGS = "array<array<struct<x: double, y: double>>>"


def wkt_point(text: str) -> Column:
    """``POINT (x y)`` / ``POINT(x y)`` / ``POINT EMPTY``; anything else is null."""
    body = rf"regexp_extract({text}, r'(?i)^\s*POINT\s*\(([^()]*)\)\s*$', 1)"
    ordinate = "try_cast(get(_pair, {}) AS DOUBLE)"
    parsed = let(
        "_xy",
        f"named_struct('x', {ordinate.format(0)}, 'y', {ordinate.format(1)})",
        rf"""CASE WHEN size(_pair) = 2 AND _xy.x IS NOT NULL AND _xy.y IS NOT NULL THEN _xy
                 WHEN {text} RLIKE r'(?i)^\s*POINT\s+EMPTY\s*$'
                 THEN named_struct('x', CAST(NULL AS DOUBLE), 'y', CAST(NULL AS DOUBLE)) END""",
    )
    return F.expr(let("_pair", rf"split(trim({body}), r'\s+')", parsed))


def wkt_polygon(text: str) -> Column:
    """``POLYGON ((x y, ...), (...))``; unclosed, short or unparsable rings give null."""
    body = rf"regexp_extract({text}, r'(?is)^\s*POLYGON\s*\(\s*\((.+)\)\s*\)\s*$', 1)"
    ordinate = "try_cast(get(_ends, {}) AS DOUBLE)"
    vertex = let("_ends", r"split(trim(pair), r'\s+')", f"named_struct('x', {ordinate.format(0)}, 'y', {ordinate.format(1)})")
    rings = rf"transform(split(_body, r'\)\s*,\s*\('), ring -> transform(split(ring, ','), pair -> {vertex}))"
    parsed = let("_read", rings, f"CASE WHEN {valid_rings('_read')} THEN _read END")
    either = rf"""CASE WHEN _body <> '' THEN {parsed}
                     WHEN {text} RLIKE r'(?i)^\s*POLYGON\s+EMPTY\s*$' THEN CAST(array() AS {_RINGS}) END"""
    return polygon(let("_body", body, either))


def valid_rings(rings: str) -> str:
    """Every ring has at least four vertices, no missing coordinate, and is closed."""
    return (
        f"coalesce(size({rings}) > 0 AND forall({rings}, r -> size(r) >= 4 "
        "AND forall(r, p -> p IS NOT NULL AND p.x IS NOT NULL AND p.y IS NOT NULL) "
        "AND get(r, 0) <=> get(r, size(r) - 1)), false)"
    )


def wkt_from_point(geom: str, gap: str = "") -> Column:
    return F.expr(f"concat('POINT{gap}(', {geom}.x, ' ', {geom}.y, ')')")


def wkt_from_polygon(poly: str) -> Column:
    pairs = "array_join(transform(r, p -> concat(p.x, ' ', p.y)), ', ')"
    return F.expr(f"concat('POLYGON (', array_join(transform({poly}.rings, r -> concat('(', {pairs}, ')')), ', '), ')')")
