"""Order over large groups without one task for it: slices of the sort key, numbers, and the row before.

Rows are ordered inside slices only. What crosses slices is small: a count a slice for
numbers, one row a slice for the row before. No result depends on where slices end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.operators.joins import null_safe_join

#: Bounds are searched in two steps of so many; there are the square of it slices, and so many sampled keys for each.
STEP, PER_SLICE = 16, 32
#: Rows of the longest series that one slice should hold.
ROWS = 8192


def sliced(df: DataFrame, key: str, out: str = "_slice") -> DataFrame:
    """``df`` with the slice of its key: the number of bounds at or below it, 0 for null.

    Bounds are every so-manieth of a bounded sample, the keys of least hash. Equal keys
    share a slice.
    """
    slices = STEP * STEP
    sample = df.select(F.col(key).alias("_k")).filter("_k is not null").orderBy(F.xxhash64("_k"), "_k").limit(slices * PER_SLICE)
    ordered = sample.agg(F.sort_array(F.collect_list("_k")).alias("_s"))
    bound = lambda i: F.get("_s", (i * F.size("_s") / slices).cast("int"))
    bounds = ordered.select(F.transform(F.sequence(F.lit(1), F.lit(slices - 1)), bound).alias("_b"))
    some = F.transform(F.sequence(F.lit(1), F.lit(STEP - 1)), lambda i: F.get("_b", i * STEP - 1))
    both = bounds.select(F.struct("_b", some.alias("_c"))).scalar()
    placed = df.withColumn("_bounds", both)
    placed = placed.withColumn("_coarse", F.size(F.filter("_bounds._c", lambda b: b <= F.col(key))) * STEP)
    fine = F.size(F.filter(F.slice("_bounds._b", F.col("_coarse") + 1, F.lit(STEP - 1)), lambda b: b <= F.col(key)))
    return placed.withColumn(out, F.col("_coarse") + fine).drop("_bounds", "_coarse")


def number_in_group(df: DataFrame, keys: Sequence[str], by: str, out: str = "n") -> DataFrame:
    """1, 2, 3, ... within each group, in the order of ``by`` (unique in its group); rows of null keys are a group.

    Slice sizes are summed and rows numbered inside their slice, so no task orders a whole
    frequent group.
    """
    keys = list(keys)
    placed = sliced(df, by)
    sizes = placed.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_m"))
    # As many rows of a group reach this window as there are slices.
    before = F.sum("_m").over(W.partitionBy(*keys).orderBy("_slice")) - F.col("_m")
    starts = sizes.select(*keys, "_slice", before.alias("_before"))
    inside = F.row_number().over(W.partitionBy(*keys, "_slice").orderBy(by))
    numbered = null_safe_join(placed.withColumn("_k", inside), starts, [*keys, "_slice"])
    return numbered.withColumn(out, (F.col("_before") + F.col("_k")).cast("long")).drop("_slice", "_k", "_before")


def _as_number(df: DataFrame, order: str) -> Column:
    kind = dict(df.dtypes)[order]
    if kind == "date":
        return F.unix_date(order).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    return F.col(order).cast("double")


def with_previous(df: DataFrame, values: dict[str, str], order: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with columns of the row before it in its series (null for the first): a segmented scan.

    ``values``: new name -> column; ``order`` is a date, a timestamp or a number, nulls
    first, and a series has one row for each. The span of ``order`` is cut into as many
    equal slices as the longest series needs, one if all are short. The last row of a
    slice is carried into the next one of its series, a row each, and ``lag`` runs inside
    slices only: a long series is spread over all tasks.
    """
    by, names, at = list(by), list(values), _as_number(df, order)
    span = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    plan = span.agg(F.min("lo").alias("lo"), ((F.max("hi") - F.min("lo")) / F.ceil(F.max("n") / ROWS)).alias("width"))
    plan = plan.select(F.struct("lo", "width")).scalar()
    # A null or zero width puts all rows into one slice.
    placed = df.withColumn("_slice", F.coalesce(F.floor(F.try_divide(at - plan["lo"], plan["width"])), F.lit(0)).cast("long"))
    copied = {f"_v{i}": F.col(c) for i, c in enumerate(values.values())}
    # Structs compare with nulls first, so that rows without a date have a last one too.
    last = F.max_by(F.struct(order, *[c.alias(n) for n, c in copied.items()]), F.struct(order))
    tails = placed.groupBy(*by, "_slice").agg(last.alias("_last"))
    onward = F.lead("_slice").over(W.partitionBy(*by).orderBy("_slice"))
    carried = tails.withColumn("_slice", onward).filter("_slice is not null").select(*by, "_slice", F.lit(True).alias("_carried"), "_last.*")
    rows = placed.withColumns({**copied, "_carried": F.lit(False)}).unionByName(carried, allowMissingColumns=True)
    w = W.partitionBy(*by, "_slice").orderBy(F.desc("_carried"), order)
    lagged = rows.select("*", *[F.lag(f"_v{i}").over(w).alias(name) for i, name in enumerate(names)])
    return lagged.filter("not _carried").select(*df.columns, *names)
