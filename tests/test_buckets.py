import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perilgrid.functions.buckets import width_bucket
from perilgrid.functions.sql import register

NAN = float("nan")
INF = float("inf")
CASES = [
    # value, first, last, buckets, expected
    (5.0, 0.0, 10.0, 10, 6),
    (0.0, 0.0, 10.0, 10, 1),
    (9.999, 0.0, 10.0, 10, 10),
    (-0.1, 0.0, 10.0, 10, 0),
    (10.0, 0.0, 10.0, 10, 11),
    (5.0, 10.0, 0.0, 10, 5),
    (10.0, 10.0, 0.0, 10, 0),  # reversed: value equal to the first bound
    (0.0, 10.0, 0.0, 10, 10),  # reversed: value equal to the last bound
    (11.0, 10.0, 0.0, 10, 0),
    (-1.0, 10.0, 0.0, 10, 11),
    (1.0, 2.0, 2.0, 4, 0),  # equal bounds
    (2.0, 2.0, 2.0, 4, 5),
    (NAN, 0.0, 10.0, 10, 0),
    (NAN, 10.0, 0.0, 10, 11),
    (5.0, NAN, 10.0, 10, 0),
    (INF, 0.0, 10.0, 10, 11),
    (-INF, 0.0, 10.0, 10, 0),
    (5.0, 0.0, INF, 10, 1),
    (102000001941.0, 150.0, 3990682000.0, 99, 100),
    (None, 0.0, 10.0, 10, None),
    (5.0, None, 10.0, 10, None),
    (5.0, 0.0, 10.0, None, None),
]


def expected(value, first, last, n):
    """The rule in plain Python, for finite arguments."""
    low, high = min(first, last), max(first, last)
    if value < low:
        rank = 0
    elif value >= high:
        rank = n + 1
    else:
        rank = math.floor(n * (value - low) / (high - low) + 1)
    return n - rank + 1 if first > last else rank


@pytest.fixture(scope="module")
def columns(spark):
    register(spark)

    def run(rows):
        df = spark.createDataFrame(rows, "v double, a double, b double, n bigint")
        out = df.select(
            width_bucket(F.col("v"), F.col("a"), F.col("b"), F.col("n")), F.expr("WIDTH_BUCKET_1(v, a, b, n)")
        ).collect()
        return [tuple(r) for r in out]

    return run


def test_table(columns):
    assert columns([c[:4] for c in CASES]) == [(c[4], c[4]) for c in CASES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.floats(-1e6, 1e6), st.floats(-1e6, 1e6), st.floats(-1e6, 1e6), st.integers(1, 1000)
        ),
        min_size=20,
        max_size=40,
    )
)
def test_matches_rule(columns, rows):
    assert columns(rows) == [(expected(*r), expected(*r)) for r in rows]


@pytest.mark.parametrize("n", [0, -3])
def test_bucket_count_must_be_positive(columns, n):
    with pytest.raises(Exception, match=f"at least 1, got {n}"):
        columns([(1.0, 0.0, 2.0, n)])
