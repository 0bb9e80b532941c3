"""Profiles of a whole table: counts, exact quantiles, modes, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column, exact or by sketch."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in cols]).unpivot([], list(cols), "column", "n_distinct")


def shape(df: DataFrame) -> DataFrame:
    """Column names and types, with the row and column counts."""
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema.fields)
    ])
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.inline(fields))


def column_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for every non-null value; repeated values collapse map-side."""
    return _count_values(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))


def _count_values(df: DataFrame) -> DataFrame:
    return (
        df.unpivot([], df.columns, "column", "value")
        .filter("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


INFINITY = 0x7FF0 << 48


def _near(size: Column) -> Column:
    # The logarithm may be off by one where rounding has passed a power of two.
    return F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))


def _bits(value: Column, size: Column, near: Column, ratio: Column) -> Column:
    def whole(exponent: Column, part: Column) -> Column:
        return (exponent + 1023) * F.lit(1 << 52) + ((part - 1) * float(1 << 52)).cast("long")

    normal = F.when(ratio < 1, whole(near - 1, ratio * 2)).when(ratio >= 2, whole(near + 1, ratio / 2)).otherwise(whole(near, ratio))
    small = (size * float(1 << 537) * float(1 << 537)).cast("long")
    bits = (
        F.when(F.isnan(value), F.lit(0x7FF8 << 48)).when(size == float("inf"), F.lit(INFINITY)).when(size == 0, F.lit(0))
        .when(size < 2.0**-1022, small).otherwise(normal)
    )
    return F.when(value < 0, -bits).otherwise(bits).cast("long")


def sortable(value: Column) -> Column:
    """A double as a long of the same order: its bits, negated below zero; NaN comes last, both zeros are 0.

    Built from exact steps only: scaling by powers of two and whole numbers below 2^53.
    """
    size = F.abs(value)
    near = _near(size)
    return _bits(value, size, near, size / F.pow(F.lit(2.0), near.cast("double")))


def _with_key(df: DataFrame) -> DataFrame:
    """Adds ``key``, the sortable ``value``; the steps are columns of their own, so that each is computed once and compiled."""
    steps = df.withColumn("_size", F.abs("value")).withColumn("_near", _near(F.col("_size")))
    steps = steps.withColumn("_ratio", F.col("_size") / F.pow(F.lit(2.0), F.col("_near").cast("double")))
    return steps.withColumn("key", _bits(F.col("value"), F.col("_size"), F.col("_near"), F.col("_ratio")))


def from_sortable(key: Column) -> Column:
    """The double of a sortable long."""
    bits = F.abs(key)
    exponent, part = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    normal = (part / float(1 << 52) + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
    size = (
        F.when(bits > F.lit(INFINITY), float("nan")).when(bits == F.lit(INFINITY), float("inf"))
        .when(exponent == 0, part / float(1 << 537) / float(1 << 537)).otherwise(normal)
    )
    return F.when(key < 0, -size).otherwise(size)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact interpolated quantiles of each column as an array in the order of ``probs``: (column, quantiles).

    Radix selection: values become longs of the same order, and their leading 16 bits are
    counted; the slices that hold a wanted rank are known from running sums, and only the
    values in them are counted by their next 16 bits, until all 64 are used. Each round is
    one scan whose tasks send on at most a row a slice: values themselves are never
    shuffled or ordered, however many fall into one slice. Nulls are left out, NaN is above
    infinity; a column without values has no row.
    """
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value").filter("value is not null")
    position = [F.lit(p) * (F.col("total") - 1) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in position])))
    slices = _with_key(long).groupBy("column", F.shiftright("key", 48).alias("slice")).agg(F.count(F.lit(1)).alias("m"))
    whole = F.sum("m").over(W.partitionBy("column"))
    slices = slices.withColumns({"part": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "total": whole})
    for shift in (48, 32, 16, 0):
        if shift < 48:
            # At most two slices a wanted quantile and column are kept: small enough to broadcast.
            # Their ends as doubles hold just their values; the end of infinity's own slice would let NaN in.
            least = F.shiftleft("part", shift + 16)
            most = least + F.lit((1 << shift + 16) - 1)
            most = F.when(least <= F.lit(INFINITY), F.least(most, F.lit(INFINITY))).otherwise(most)
            ends = kept.select(F.col("column").alias("_column"), "part", "before", "total", from_sortable(least).alias("lo"), from_sortable(most).alias("hi"))
            within = (F.col("column") == F.col("_column")) & (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
            inside = _with_key(long.join(F.broadcast(ends), within))
            # Aggregates of plain numbers are hashed; an array among them would have all rows sorted.
            slices = inside.groupBy("column", "part", F.shiftright("key", shift).alias("slice")).agg(
                F.count(F.lit(1)).alias("m"), F.max("before").alias("before"), F.max("total").alias("total")
            )
        # At most 65,536 slices of a part reach this window.
        start = F.col("before") + F.sum("m").over(W.partitionBy("column", "part").orderBy("slice")) - F.col("m")
        placed = slices.withColumn("start", start)
        within_slice = F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("m")))
        kept = (
            placed.select("column", F.col("slice").alias("part"), F.col("start").alias("before"), "total", within_slice.alias("ranks"))
            .filter(F.size("ranks") > 0)
        )
    found = kept.select("column", "total", from_sortable(F.col("part")).alias("value"), F.explode("ranks").alias("rank"))
    by_rank = found.groupBy("column", "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    quantiles = []
    for p in position:
        low, high = F.col("at")[F.floor(p)], F.col("at")[F.ceil(p)]
        quantiles.append(F.when(low == high, low).otherwise(low + (high - low) * (p - F.floor(p))))
    return by_rank.select("column", F.array(*quantiles).alias("quantiles"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of each column."""
    stats = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in cols
    ])
    one_row = df.agg(stats.alias("s")).select(F.inline("s"))
    cut = exact_quantiles(df, cols).select(
        "column", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    )
    return one_row.join(cut, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def modes(counts: DataFrame, n_modes: int = 3) -> DataFrame:
    """The most frequent values of each column, smallest first, at most ``n_modes``."""
    # row_number <= n is limited in each map task before rows are shuffled.
    w = W.partitionBy("column").orderBy(F.desc("n"), "value")
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n_modes)
    return (
        top.withColumn("most", F.max("n").over(W.partitionBy("column")))
        .filter("n = most")
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("modes"))
    )


def center_stats(df: DataFrame, cols: Sequence[str], n_modes: int = 3) -> DataFrame:
    """count, mean, median, quartiles and first modes of each column."""
    counts = column_counts(df, cols)
    # One row a column from the table itself, so that a column of nulls has one too.
    stats = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(F.col(c).cast("double")).alias("mean")) for c in cols
    ])
    basic = df.agg(stats.alias("s")).select(F.inline("s"))
    cut = exact_quantiles(df, cols).select(
        "column", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))]
    )
    return basic.join(cut, "column", "left").join(modes(counts, n_modes), "column", "left")


def temporal_profile(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last day, observations, and median days between observations.

    Observations are counted per day first, so each series has at most one row per
    calendar day; repeats on a day count as gaps of zero.
    """
    daily = df.filter(F.col(date).isNotNull()).groupBy(*by, F.col(date).cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    w = W.partitionBy(*by).orderBy("_day")
    gaps = daily.withColumn("_gap", F.date_diff(F.col("_day"), F.lag("_day").over(w)))
    weighted = F.array(
        F.struct(F.col("_n").alias("obs"), F.col("_gap").alias("gap"), F.when(F.col("_gap").isNotNull(), 1).otherwise(0).cast("long").alias("weight")),
        F.struct(F.lit(0).cast("long").alias("obs"), F.lit(0).alias("gap"), (F.col("_n") - 1).alias("weight")),
    )
    # filter() keeps the day rows themselves (obs > 0) and the repeats.
    rows = gaps.select(*by, "_day", F.inline(weighted)).filter("obs > 0 or weight > 0")
    return rows.groupBy(*by).agg(
        F.min("_day").alias("first"),
        F.max("_day").alias("last"),
        F.sum("obs").alias("n_obs"),
        F.floor(F.percentile("gap", F.lit(0.5), F.col("weight"))).cast("int").alias("median_gap_days"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns in one pass, as (a, b, corr).

    Pairs with a null are skipped; a constant column gives null. A row meets the aggregate
    once: sums and cross products of all columns, apart for each pattern of nulls, so that
    rows with a null count for the pairs they have. Pairs are only formed from the few rows
    that leave it. Values are shifted by their column's mean, which keeps the sums small.
    """
    cols = list(cols)
    value = [F.col(f"`{c}`").cast("double") for c in cols]
    means = df.agg(F.struct(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(value)]).alias("m")).scalar()
    shifted = [F.coalesce(v - means[f"m{i}"], F.lit(0.0)).alias(f"_x{i}") for i, v in enumerate(value)]
    present = F.concat(*[F.when(v.isNull(), "0").otherwise("1") for v in value]).alias("_present")
    rows = df.select(*by, present, *shifted, *[v.alias(f"_v{i}") for i, v in enumerate(value)])
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    sums = rows.groupBy(*by, "_present").agg(
        F.count(F.lit(1)).alias("_n"),
        *[f(f"_{c}{i}").alias(f"_{out}{i}") for i in range(len(cols)) for f, c, out in ((F.sum, "x", "s"), (F.min, "v", "lo"), (F.max, "v", "hi"))],
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_p{i}_{j}") for i, j in pairs],
    )

    def pair(i: int, j: int) -> Column:
        both = (F.substring("_present", i + 1, 1) == "1") & (F.substring("_present", j + 1, 1) == "1")
        fields = {
            "n": "_n", "sx": f"_s{i}", "sy": f"_s{j}", "xx": f"_p{i}_{i}", "yy": f"_p{j}_{j}", "xy": f"_p{i}_{j}",
            "xl": f"_lo{i}", "xh": f"_hi{i}", "yl": f"_lo{j}", "yh": f"_hi{j}",
        }
        return F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), *[F.when(both, F.col(c)).alias(name) for name, c in fields.items()])

    each = sums.select(*by, F.inline(F.array(*[pair(i, j) for i, j in pairs])))
    total = each.groupBy(*by, "a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "xx", "yy", "xy")], *[f(c).alias(c) for f, c in ((F.min, "xl"), (F.max, "xh"), (F.min, "yl"), (F.max, "yh"))]
    )
    left = lambda p, s, t: F.col(p) - F.col(s) * F.col(t) / F.nullif(F.col("n"), F.lit(0))
    vx, vy = left("xx", "sx", "sx"), left("yy", "sy", "sy")
    varies = (F.col("xl") < F.col("xh")) & (F.col("yl") < F.col("yh")) & (vx > 0) & (vy > 0)
    corr = F.when(F.col("a") == F.col("b"), F.when(varies, 1.0)).otherwise(F.when(varies, left("xy", "sx", "sy") / F.nullif(F.sqrt(vx) * F.sqrt(vy), F.lit(0.0))))
    named = total.select(*by, "a", "b", corr.alias("corr"))
    other_way = named.filter("a <> b").select(*by, F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return named.unionByName(other_way)


def magnitude_ratio(df: DataFrame, a: str, b: str) -> DataFrame:
    """Means of two columns and the ratio of the means."""
    means = df.agg(F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"))
    return means.withColumn("ratio", F.try_divide("mean_a", "mean_b"))
