"""Places along a Hilbert curve as a column expression."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 4  # bits of each coordinate that one lookup takes
WORLD = (-180.0, -90.0, 180.0, 90.0)
BITS = 20  # cells of about 40 m over the world


@functools.cache
def _steps(width: int) -> str:
    """SQL array by turn (swapped 1, mirrored 2), x and y of `width` bits: number along the curve and the turn inside."""
    rows = []
    for turn in range(4):
        for xy in range(1 << 2 * width):
            now, number = turn, 0
            for b in range(width - 1, -1, -1):
                at = [xy >> width + b & 1, xy >> b & 1]
                if now & 1:
                    at.reverse()
                px, py = (v ^ now >> 1 for v in at)
                number = number * 4 + (px * 3 ^ py)
                if not py:
                    # the curve inside is swapped, and mirrored as well where px is set
                    now ^= 1 | px << 1
            rows.append(now << 2 * width | number)
    return f"array({', '.join(map(str, rows))})"


def hilbert_key(x: str, y: str, bits: int = BITS, extent: tuple[float, float, float, float] = WORLD) -> Column:
    """Number of a point's cell along the curve over 2**bits x 2**bits cells of the extent.

    Neighbours on the curve are neighbours on the map, so a range of keys covers a compact area, where rows of
    tiles cover a strip. Points outside of the extent count to the cell at its border; null or NaN gives null.
    """
    if not 1 <= bits <= 31:
        raise ValueError("bits must lie between 1 and 31")
    xmin, ymin, xmax, ymax = map(float, extent)
    cells = 1 << bits

    def cell(value: str, low: float, high: float) -> str:
        part = f"(({value}) - {low!r}D) / {high - low!r}D * {cells}D"
        return f"CAST(floor(least(greatest({part}, 0D), {cells - 1}D)) AS BIGINT)"

    # A step takes a few bits of both coordinates and looks up the number of their cell along the curve and how
    # the curve inside it is turned. Lookups in constant arrays compile, where a loop over the bits would not.
    place = [cell(x, xmin, xmax), cell(y, ymin, ymax)]
    turn, key, low = "0", "0L", bits
    while low:
        width = low % STEP or STEP
        low -= width
        at = " * {0} + ".join(f"(CAST(shiftright({c}, {low}) AS INT) & {(1 << width) - 1})" for c in place).format(1 << width)
        found = f"element_at({_steps(width)}, ({turn}) * {1 << 2 * width} + {at} + 1)"
        key = f"({key} * {1 << 2 * width}L + ({found} & {(1 << 2 * width) - 1}))"
        turn = f"shiftright({found}, {2 * width})"
    known = " AND ".join(f"{value} IS NOT NULL AND NOT isnan({value})" for value in (x, y))
    # added, not put into a branch, where Spark would compute repeated parts again and again
    return F.expr(f"{key} + CASE WHEN {known} THEN 0L END")
