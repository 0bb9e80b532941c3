"""Lookups and joins, with a size check before anything is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions.codes import digit_key

# A side goes to every executor only when it has at most this many rows and bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Copies of the lookup side in a salted join.
SALTS = 32


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed once if the session names a checkpoint folder.

    For small inputs that a size check and the query itself would both compute.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    return df.checkpoint() if folder else df


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a side, reading at most ``max_rows + 1`` of its rows."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns],
    )
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def row_salt(df: DataFrame, salts: int) -> Column:
    """A salt from the row and its partition.

    A retried task repeats it, and copies of one row that lie in different partitions
    get different salts.
    """
    plain = [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(salts)).cast("int")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls count as equal; the left side's keys stay."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in on else F.col(f"`{c}`") for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[f"`{c}`"].eqNullSafe(renamed[f"`_r_{c}`"]) for c in on])
    return left.join(renamed, same, how).drop(*[f"_r_{c}" for c in on])


def join_lookup(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact to a lookup that has one row per key.

    A lookup measured as small is broadcast, so the fact is not shuffled. A larger one is
    joined by sort and merge: where one key holds much of the fact, Spark splits that
    part of the fact by measured size and repeats the lookup's rows for it only. Both
    routes give the same rows.
    """
    on, lookup = list(on), settled(lookup)
    return fact.join(F.broadcast(lookup) if fits_broadcast(lookup) else lookup.hint("merge"), on, how)


def join_salted(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """The same join for sessions in which Spark may not split keys itself: the lookup is copied once per salt."""
    on = list(on)
    salted = fact.withColumn("_salt", row_salt(fact, salts))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first under a stated order.

    Spark limits each map task to its own first row per key before the shuffle,
    so a very frequent key moves one row per task only.
    """
    w = W.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")


def one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Pass rows through, failing the job if a key occurs twice."""
    keys, values = list(keys), list(values)
    message = F.concat(
        F.lit(f"more than one row for ({', '.join(keys)}): "),
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]),
    )
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(v).alias(v) for v in values]
    )
    # The check sits inside the values so that pruning cannot remove it.
    return counted.select(
        *keys,
        *[F.when(F.col("_n") == 1, F.col(v)).otherwise(F.raise_error(message)).alias(v) for v in values],
    )


def label_state(df: DataFrame, catalog: DataFrame, code: str = "ent", out: str = "ent_nombre") -> DataFrame:
    """State name by two-digit code; no match or null code gives null."""
    names = keep_first(
        catalog.select(digit_key("CVE_ENT", 2).alias("_ent"), F.col("NOM_ENT").alias(out))
        .filter("_ent is not null"),
        ["_ent"],
        [out],
    )
    return join_lookup(df.withColumn("_ent", digit_key(code, 2)), names, ["_ent"]).drop("_ent")


def label_municipality(
    df: DataFrame,
    catalog: DataFrame,
    ent: str = "ent",
    mun: str = "mun",
    out: str = "mun_nombre",
    drop_codes: bool = False,
) -> DataFrame:
    """Municipality name by (state, municipality) code, optionally dropping the codes."""
    names = keep_first(
        catalog.select(
            digit_key("CVE_ENT", 2).alias("_ent"),
            digit_key("CVE_MUN", 3).alias("_mun"),
            F.col("NOM_MUN").alias(out),
        ).filter("_ent is not null and _mun is not null"),
        ["_ent", "_mun"],
        [out],
    )
    keyed = df.withColumn("_ent", digit_key(ent, 2)).withColumn("_mun", digit_key(mun, 3))
    named = join_lookup(keyed, names, ["_ent", "_mun"]).drop("_ent", "_mun")
    return named.drop(ent, mun) if drop_codes else named


def join_many_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join that fails when the right side repeats a key."""
    on = list(on)
    values = [c for c in right.columns if c not in on]
    return join_lookup(left, one_per_key(right, on, values), on, "inner")


def join_on_date(*frames: DataFrame, date: str = "fecha") -> DataFrame:
    """Inner join of several series on date; each must have one row per date."""
    checked = [one_per_key(f, [date], [c for c in f.columns if c != date]) for f in frames]
    return reduce(lambda a, b: a.join(b, date), checked)


def with_total(df: DataFrame, total: DataFrame, on: Sequence[str], value: str, out: str = "share_pct") -> DataFrame:
    """Left join of totals and the percentage of them; no total or zero gives null, a repeated total fails."""
    totals = one_per_key(total.select(*on, F.col(value).alias("_total")), on, ["_total"])
    share = F.try_divide(F.lit(100.0) * F.col(value), F.col("_total"))
    return df.join(totals, list(on), "left").withColumn(out, share).drop("_total")


def attach_row_meta(df: DataFrame, meta: DataFrame, keys: Sequence[str] = ("source", "row_idx")) -> DataFrame:
    """Bring the label columns of a grid row back to each of its cells."""
    return df.join(meta, list(keys), "left")
