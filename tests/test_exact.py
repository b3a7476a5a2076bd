import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from perilgrid.functions.exact import carried, limb_sums, merged_sums, rounded_sum
from perilgrid.operators.rollup import exact_loss_rollup


def bits(value):
    return None if value is None else struct.pack(">d", value)


def exact(df, *keys):
    return df.groupBy(*keys).agg(limb_sums("v").alias("s")).select(*keys, rounded_sum("s").alias("total"))


def values_of(seed, n):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.uniform(-1e6, 1e6),
        lambda: rng.choice([1, -1]) * 10 ** rng.uniform(-20, 30),
        lambda: round(rng.uniform(0, 1000), 2),
        lambda: rng.choice([2.0**53, -(2.0**53), 1.0, 2.0**-60, -1.0, 0.5, 0.0, -0.0]),
    ]
    kind = kinds[seed % len(kinds)]
    return [kind() for _ in range(n)]


def test_nearest_double(spark):
    """Many groups of all kinds of values against correctly rounded sums."""
    groups = {seed: values_of(seed, 1 + seed % 40) for seed in range(400)}
    groups[1000] = [1e16, 1.0, -1e16]
    groups[1001] = [2.0**53, 1.0, 2.0**-70]  # just above a tie
    groups[1002] = [2.0**53, 1.0]  # a tie, to even
    groups[1003] = [-(2.0**53), -1.0, -(2.0**-70)]
    groups[1004] = [0.1] * 10
    groups[1005] = [1.5e43, 1.5e43, 1.5e43, -1e-20]
    groups[1006] = [3.0, -3.0]
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.total for r in exact(df, "k").collect()}
    for k, vs in groups.items():
        want = math.fsum(vs)
        assert bits(got[k] + 0.0) == bits(want + 0.0), (k, got[k], want)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_any_partitioning(spark, parts):
    values = values_of(1, 5000)
    random.Random(parts).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    assert bits(exact(df).first().total) == bits(math.fsum(values))


def test_weighted_sums_of_sums(spark):
    groups = {k: (values_of(k, 20), 1 + k * 1000) for k in range(12)}
    df = spark.createDataFrame([(k, v, w) for k, (vs, w) in groups.items() for v in vs], "k long, v double, w long")
    inner = df.groupBy("k", "w").agg(limb_sums("v").alias("s")).withColumn("s", carried("s"))
    got = inner.agg(merged_sums("s", "w").alias("s")).select(rounded_sum("s").alias("total"), F.col("s.n")).first()
    assert bits(got.total) == bits(math.fsum(v for vs, w in groups.values() for v in vs for _ in range(w)))
    assert got.n == sum(20 * w for _, w in groups.values())


def test_null_nan_infinite_empty(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, None), (1, None), (2, 1.0), (2, None), (3, inf), (3, 1.0), (4, inf), (4, -inf), (5, nan), (5, 2.0)]
    got = {r.k: r.total for r in exact(spark.createDataFrame(rows, "k long, v double"), "k").collect()}
    assert got[1] is None and got[2] == 1.0 and got[3] == inf and math.isnan(got[4]) and math.isnan(got[5])
    none = spark.createDataFrame([], "v double")
    assert exact(none).first().total is None


@pytest.mark.parametrize("value", [1e44, 1e-40])
def test_out_of_range_is_an_error(spark, value):
    with pytest.raises(Exception, match="widen low and high"):
        exact(spark.createDataFrame([(value,)], "v double")).collect()
    wide = spark.createDataFrame([(value,), (value,)], "v double").agg(limb_sums("v", -9, 9).alias("s"))
    assert wide.select(rounded_sum("s", -9, 9).alias("t")).first().t == 2 * value


def test_rollup_by_any_partitioning(spark):
    """Sums of the joined rows, sites without losses and repeated ones included, equal in every bit."""
    rng = random.Random(3)
    sites = [(rng.choice(["1", "2", "3", "4", None]), rng.randrange(3), rng.choice([rng.uniform(-1e9, 1e9), None])) for _ in range(60)]
    losses = [(rng.choice(["1", "2", "3", "9", None]), rng.uniform(0, 1e-3)) for _ in range(80)]
    want = {}
    for site, portfolio, value in sites:
        met = [x for s, x in losses if s == site and site is not None]
        sums = want.setdefault(portfolio, ([], []))
        sums[0].extend([value] * max(1, len(met)) if value is not None else [])
        sums[1].extend(met)
    for parts in (1, 7):
        left = spark.createDataFrame(sites, "site_id string, portfolio_id long, s_udf_met1 double").repartition(parts)
        right = spark.createDataFrame(losses, "site_id string, gross_loss double").repartition(parts)
        got = {r.portfolio_id: r for r in exact_loss_rollup(left, right, "portfolio_id").collect()}
        assert set(got) == set(want)
        for portfolio, (values, met) in want.items():
            row = got[portfolio]
            assert bits(row.sum_s_udf_met1) == bits(math.fsum(values))
            assert bits(row.avg_s_udf_met1) == bits(math.fsum(values) / len(values))
            assert bits(row.sum_gross_loss) == bits(math.fsum(met))
