"""Radix quantiles and Gram sums against plain versions."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import profile


def bits(x):
    key = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -key if x < 0 else key


def test_sortable_bits_are_those_of_the_double(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(20_000)]
    values += [math.ldexp(m, e) for e in range(-1074, 1024) for m in (1.0, 1.0 - 2**-53, 1.0 + 2**-52)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    key = profile.sortable(F.col("v"))
    for r in df.select("v", key.alias("k"), profile.from_sortable(key).alias("back")).collect():
        assert r.k == bits(r.v) and r.back == r.v
    nan = spark.range(1).select(profile.sortable(F.lit(float("nan"))).alias("k")).first().k
    assert nan > bits(math.inf)


@pytest.mark.parametrize("values", [
    [5.0], [1e-300, 1e300, -1e300, -1e-300, 0.0, 1.0], [math.inf, -math.inf, 1.0, 2.0, 3.0], [1.0, 1.0, 1.0, 2.0], [-math.inf, -5.0, 7.25, math.inf, math.inf],
    [float(x) for x in range(-50, 51)],
])
def test_quantiles_of_far_values(spark, values):
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = profile.exact_quantiles(spark.createDataFrame([(v,) for v in values] + [(None,)], "x double"), ["x"], probs).first().quantiles
    ordered = sorted(values)
    for p, g in zip(probs, got):
        at = p * (len(values) - 1)
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        want = low if low == high else low + (high - low) * (at - math.floor(at))
        assert g == pytest.approx(want, rel=1e-15, nan_ok=True)


def test_quantiles_of_a_million_neighbours(spark):
    """All values share their first 44 bits, so nothing is decided before the last rounds; no task orders them."""
    n = 1_000_000
    df = spark.range(n).select((1.0 + F.col("id") * 2.0**-50).alias("x"), F.when(F.col("id") < 3, float("nan")).otherwise(F.col("id") % 7).alias("y"), F.lit(None).cast("double").alias("z"))
    found = profile.exact_quantiles(df, ["x", "y", "z"], (0.0, 0.25, 0.5, 1.0))
    got = {r["column"]: r.quantiles for r in found.collect()}
    assert got["x"] == [1.0, 1.0 + 249999.75 * 2.0**-50, 1.0 + 499999.5 * 2.0**-50, 1.0 + (n - 1) * 2.0**-50]
    assert got["y"][:3] == [0.0, 1.0, 3.0] and math.isnan(got["y"][3]) and "z" not in got
    assert profile.exact_quantiles(df.limit(0), ["x"]).count() == 0


def test_correlations_with_nulls_and_constants(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1, (500, 4))
    x[:, 2] = -x[:, 0] * 2 + x[:, 1] / 3
    x[:, 3] = 7.1
    gone = rng.random((500, 4)) < [0.0, 0.2, 0.3, 0.1]
    rows = [(i % 2 and "b" or None, *[None if gone[i, k] else float(x[i, k]) for k in range(4)]) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double").withColumn("e", F.lit(None).cast("double"))
    names = ["a", "b", "c", "d", "e"]
    got = {(r.g, r.a, r.b): r["corr"] for r in profile.corr_matrix(df, names, by=["g"]).collect()}
    assert len(got) == 50
    for g in (None, "b"):
        mine = np.array([(r[0] == g) for r in rows])
        for i in range(5):
            for j in range(5):
                value = got[g, names[i], names[j]]
                if max(i, j) >= 3:
                    assert value is None
                    continue
                both = mine & ~gone[:, i] & ~gone[:, j]
                assert value == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], rel=1e-9)
    plan = profile.corr_matrix(df, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate [_present")  # pairs are formed above the aggregate of the rows


def test_quantile_rounds_hash_and_compile(spark):
    """Rounds neither sort all rows for an array among their sums nor make keys inside lambdas, which are not compiled."""
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    plan = profile.exact_quantiles(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert not any("log2" in line.lower() and "lambda" in line for line in plan.splitlines())


def test_quantiles_beside_infinity_and_nan(spark):
    """Neither zero nor infinity shares its slice with NaN."""
    values = [-math.inf, -0.0, 0.0, math.inf, math.inf, math.nan, math.nan, math.nan]
    probs = [k / 7 for k in range(8)]
    got = profile.exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], probs).first().quantiles
    assert got[:5] == [-math.inf, 0.0, 0.0, math.inf, math.inf] and all(map(math.isnan, got[5:]))
