"""Sums of doubles that do not depend on the order of the rows, from built-in aggregates.

A double is split into signed integer limbs of 24 bits on a fixed grid of powers of two, which loses nothing.
Each limb is summed as an integer, so partial sums can be merged in any order; the total is rounded to a double
once, to the nearest one. Sums in progress are a struct of limbs that can be grouped and weighted again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilgrid.functions.geometry import let

LIMB_BITS = 24
# Limbs by exponent: from 2**(24 * LOW) up to 2**(24 * HIGH), about 4e-28 (with all its bits) to 2e43.
LOW, HIGH = -6, 6

_MASK = (1 << LIMB_BITS) - 1
_RANGE = "a value has bits outside of the limbs of the exact sum; widen low and high"


def _scale(limb: int) -> str:
    return f"{2.0 ** (LIMB_BITS * limb)!r}D"


def limb_sums(value: str, low: int = LOW, high: int = HIGH) -> Column:
    """Aggregate: struct<limbs: array<bigint>, odd: double, n: bigint> of a SQL expression.

    ``limbs`` has one sum for each limb, lowest first, and a last one for what is carried out of them;
    ``odd`` is the sum of NaN and infinities, null without any; ``n`` counts the values. A value outside
    of the limbs is an error, and so is a sum of more than 2**39 rows (an overflow), never a wrong result.
    """
    x = f"CAST({value} AS DOUBLE)"
    finite = f"abs({x}) < double('Infinity')"
    fits = f"(abs({x}) < {_scale(high)} AND {x} % {_scale(low)} = 0D)"
    sums = []
    for limb in range(low, high):
        chunk = f"CAST(({x} % {_scale(limb + 1)} - {x} % {_scale(limb)}) / {_scale(limb)} AS BIGINT)"
        if limb == low:
            chunk = f"CASE WHEN {fits} THEN {chunk} ELSE CAST(raise_error('{_RANGE}') AS BIGINT) END"
        sums.append(f"coalesce(sum(CASE WHEN {finite} THEN {chunk} END), 0L)")
    limbs = f"array({', '.join(sums)}, 0L)"
    odd = f"sum(CASE WHEN NOT ({finite}) THEN {x} END)"
    return F.expr(f"named_struct('limbs', {limbs}, 'odd', {odd}, 'n', count({x}))")


def _carried(limbs: str) -> str:
    """SQL: the same total with every limb but the last between 0 and 2**24 - 1."""
    start = f"named_struct('out', slice({limbs}, 1, 0), 'carry', 0L)"
    step = f"""named_struct('out', concat(_acc.out, array((_limb + _acc.carry) & {_MASK}L)),
        'carry', shiftright(_limb + _acc.carry, {LIMB_BITS}))"""
    end = f"concat(_acc.out, array(_acc.carry + element_at({limbs}, -1)))"
    return f"aggregate(slice({limbs}, 1, size({limbs}) - 1), {start}, (_acc, _limb) -> {step}, _acc -> {end})"


def carried(sums: str, low: int = LOW, high: int = HIGH) -> Column:
    """A column of sums with limbs brought to their range, so that they can be weighted and summed again."""
    # limb by limb and not in a loop over the array, so that it compiles
    out, carry = [], "0L"
    for i in range(high - low):
        limb = f"({sums}.limbs[{i}] + {carry})"
        out.append(f"{limb} & {_MASK}L")
        carry = f"shiftright({limb}, {LIMB_BITS})"
    limbs = f"array({', '.join(out)}, {sums}.limbs[{high - low}] + {carry})"
    return F.expr(f"named_struct('limbs', {limbs}, 'odd', {sums}.odd, 'n', {sums}.n)")


def merged_sums(sums: str, weight: str = "1L", low: int = LOW, high: int = HIGH) -> Column:
    """Aggregate: the sums of a column of carried limbs, each counted ``weight`` times; null ones are skipped."""
    limbs = ", ".join(f"coalesce(sum({sums}.limbs[{i}] * {weight}), 0L)" for i in range(high - low + 1))
    odd = f"sum(CASE WHEN {weight} > 0 THEN {sums}.odd END)"
    return F.expr(f"named_struct('limbs', array({limbs}), 'odd', {odd}, 'n', coalesce(sum({sums}.n * {weight}), 0L))")


def _rounded(limbs: str, low: int, high: int) -> str:
    """SQL: nearest double of non-negative carried limbs.

    The four highest limbs from the first one in use make two exact doubles; what lies below only
    matters for ties and goes into the last bit of the lower one, so one addition rounds once.
    """
    n = high - low
    top = f"element_at({limbs}, -1)"
    digits = f"concat(slice({limbs}, 1, {n}), array({top} & {_MASK}L, shiftright({top}, {LIMB_BITS}) & {_MASK}L, shiftright({top}, {2 * LIMB_BITS})))"
    first = "array_max(transform(_d, (v, i) -> CASE WHEN v > 0 THEN i ELSE -1 END))"

    def two(at: str) -> str:
        return f"(coalesce(get(_d, {at}), 0L) * {_MASK + 1}L + coalesce(get(_d, {at} - 1), 0L))"

    rest = "CASE WHEN _t > 3 AND exists(slice(_d, 1, greatest(_t - 3, 0)), v -> v > 0) THEN 1L ELSE 0L END"
    # scales of limbs _t - 1 and _t - 3, of which the first in use may lie at the lower end
    scales = f"array({', '.join(_scale(limb) for limb in range(low - 3, high + 3))})"
    upper = f"CAST({two('_t')} AS DOUBLE) * get(_p, _t + 2)"
    lower = f"CAST({two('_t - 2')} | {rest} AS DOUBLE) * get(_p, _t)"
    body = let("_t", first, f"CASE WHEN _t < 0 THEN 0D ELSE {let('_p', scales, f'{upper} + {lower}')} END")
    return let("_d", digits, body)


def rounded_sum(sums: str, low: int = LOW, high: int = HIGH) -> Column:
    """The double nearest to a sum of limbs; null if there was no value, NaN or infinite if there was such a one."""
    body = let(
        "_c",
        _carried("_s.limbs"),
        f"""CASE WHEN _s.n = 0 THEN CAST(NULL AS DOUBLE) WHEN _s.odd IS NOT NULL THEN _s.odd
            WHEN element_at(_c, -1) < 0
            THEN - {let('_m', 'transform(_s.limbs, v -> -v)', let('_c2', _carried('_m'), _rounded('_c2', low, high)))}
            ELSE {_rounded('_c', low, high)} END""",
    )
    return F.expr(let("_s", sums, body))
