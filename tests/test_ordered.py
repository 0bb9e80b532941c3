"""Numbers and rows before, over slices, against the plain window forms."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.operators import ordered, regression, schema, series


def days(spark, n, step=1):
    return spark.range(n).select(F.date_add(F.lit("1000-01-01").cast("date"), (F.col("id") * step).cast("int")).alias("d"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("v"))


def test_one_long_series_is_cut(spark, monkeypatch):
    """A series of a million dates: as many slices as it needs, none much above its share, and the values of the window form."""
    n = 1_000_000
    long = days(spark, n)
    got = ordered.with_previous(long, {"before": "v", "day": "d"}, "d")
    assert got.filter("before is null").count() == 1
    again = got.join(long.select(F.date_add("d", 1).alias("d"), F.col("v").alias("w")), "d")
    assert again.count() == n - 1
    assert again.filter("before <> w or date_diff(d, day) <> 1").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_slice" in plan and "SinglePartition" not in plan.split("Subquery")[0].split("BroadcastExchange")[0].split("Window")[1]


@pytest.mark.parametrize("rows_a_slice", [1, 3, 50, 8192])
@pytest.mark.parametrize("kind", ["date", "timestamp", "long", "double"])
def test_row_before_equals_the_window_form(spark, monkeypatch, rows_a_slice, kind):
    monkeypatch.setattr(ordered, "ROWS", rows_a_slice)
    rng = random.Random(rows_a_slice)
    make = {
        "date": lambda k: date(2000, 1, 1) + timedelta(days=k), "timestamp": lambda k: datetime(2000, 1, 1) + timedelta(minutes=k),
        "long": lambda k: k, "double": lambda k: k / 7,
    }[kind]
    rows = []
    for name, n in (("a", 200), ("b", 3), ("c", 1), (None, 40)):
        rows += [(name, make(k), rng.choice([None, float(k)]), "x") for k in rng.sample(range(-500, 5000), n)] + [(name, None, 7.0, "x")]
    df = spark.createDataFrame(rows, f"g string, at {kind}, v double, _carriage string")
    got = ordered.with_previous(df, {"before": "v", "then": "at"}, "at", ["g"])
    w = W.partitionBy("g").orderBy("at")
    want = df.withColumn("before", F.lag("v").over(w)).withColumn("then", F.lag("at").over(w))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ordered.with_previous(df.limit(0), {"before": "v"}, "at", ["g"]).count() == 0


def test_names_are_numbered_by_path(spark):
    rng = random.Random(1)
    paths = [f"s3://drop/{rng.randrange(10**9):09}/f.csv" for _ in range(4000)]
    rows = [(p, rng.choice(["hot", "hot", "cold", None])) for p in paths]
    df = spark.createDataFrame(rows, "path string, stem string").withColumn("tag", F.lit("t"))
    want, seen = {}, {}
    for p, stem in sorted(rows):
        seen[stem] = seen.get(stem, 0) + 1
        want[p] = f"{stem or ''}__t{f'__{seen[stem]}' if seen[stem] > 1 else ''}.csv"
    named = schema.unique_names(df, "path", "stem", "tag")
    assert {r.path: r.name for r in named.collect()} == want
    slices = ordered.sliced(df, "path").groupBy("_slice").count().agg(F.count("*"), F.max("count")).first()
    assert slices[0] == ordered.STEP**2 and slices[1] < 200


def test_durbin_watson_of_a_cut_series(spark, monkeypatch):
    rows = days(spark, 3000).select("d", "v", (F.col("v") * 2 + F.pmod(F.xxhash64("d"), F.lit(7)) + 1).alias("y"))
    models = regression.ols(rows, ["y"], "v", log=False)
    whole = regression.ols_diagnostics(rows, models, ["y"], "v", "d", log=False).first()
    monkeypatch.setattr(ordered, "ROWS", 10)
    cut = regression.ols_diagnostics(rows, models, ["y"], "v", "d", log=False).first()
    assert cut.durbin_watson == pytest.approx(whole.durbin_watson, rel=1e-12)
    resid = [r.resid for r in regression.residuals(rows, models, ["y"], "v", "d", log=False).orderBy("d").collect()]
    plain = sum((a - b) ** 2 for a, b in zip(resid[1:], resid)) / sum(r * r for r in resid)
    assert cut.durbin_watson == pytest.approx(plain, rel=1e-9)


def test_gaps_and_index_of_null_groups(spark):
    rows = [("a", date(2020, 1, 1), 2.0), ("a", date(2020, 1, 4), 3.0), (None, date(2020, 1, 2), 4.0), (None, date(2020, 1, 9), 2.0), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, d date, v double")
    gaps = {(r.g, r.d): r.gap_days for r in series.gap_days(df, "d", ["g"]).collect()}
    assert gaps == {("a", None): None, ("a", date(2020, 1, 1)): None, ("a", date(2020, 1, 4)): 3, (None, date(2020, 1, 2)): None, (None, date(2020, 1, 9)): 7}
    index = {(r.g, r.d): r.v_idx for r in series.base100(df, ["v"], "d", ["g"]).collect()}
    assert index == {("a", None): 50.0, ("a", date(2020, 1, 1)): 100.0, ("a", date(2020, 1, 4)): 150.0, (None, date(2020, 1, 2)): 100.0, (None, date(2020, 1, 9)): 50.0}
    growth = series.yoy(df.withColumn("d", F.add_months("d", 0)), ["v"], "d", ["g"], months=0)
    assert growth.count() == 4


def test_latest_year_of_null_groups(spark):
    from panelwright.operators import filters

    df = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2), (None, 2019, 3), (None, 2018, 4), ("b", None, 5)], "g string, anio int, v int")
    assert sorted(r.v for r in filters.latest_year(df, by=["g"]).collect()) == [2, 3]
