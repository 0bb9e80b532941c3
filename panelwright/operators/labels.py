"""Category labels from code dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions.codes import code_variants, plain_code, table_code
from panelwright.functions.text import strip
from panelwright.operators.joins import BROADCAST_BYTES, null_safe_join, settled

# Variables with at most this many codes and bytes are looked up in a map; others are joined.
MAP_CODES = 256
MAP_BYTES = 1024 * 1024


def dictionary_variables(rows: DataFrame) -> DataFrame:
    """(base, variable) of every dictionary row, with and without categories; names fold case."""
    code = table_code(F.when(strip("tabla") != "", F.col("tabla")).otherwise("BASE"))
    return rows.select(code["base"].alias("base"), F.upper(strip("variable")).alias("variable")).distinct()


def merge_dictionary(rows: DataFrame) -> DataFrame:
    """One label per (base, variable, code spelling).

    ``rows``: tabla, variable, categorias, and optionally file_ord and row_ord. The
    newest quarter wins, then the later file, row and category. Blank codes or labels
    are dropped. Every code enters under all its spellings.
    """
    code = table_code(F.when(strip("tabla") != "", F.col("tabla")).otherwise("BASE"))
    order = [F.col(c) if c in rows.columns else F.lit(0).alias(c) for c in ("file_ord", "row_ord")]
    exploded = rows.select(
        code.alias("_t"), F.upper(strip("variable")).alias("variable"), *order,
        F.posexplode("categorias").alias("cat_ord", "_c"),
    )
    spelled = exploded.select(
        F.col("_t.base").alias("base"), "variable", F.col("_t.rank").alias("rank"), "file_ord", "row_ord", "cat_ord",
        strip("_c.categoria").alias("label"),
        F.explode(code_variants("_c.valor")).alias("code"),
    ).filter("label != ''")
    newest = F.struct("rank", "file_ord", "row_ord", "cat_ord")
    return spelled.groupBy("base", "variable", "code").agg(
        F.max_by("label", newest).alias("label"), F.max("rank").alias("rank")
    )


def _variable_columns(df: DataFrame, dictionary: DataFrame, base: str) -> tuple[DataFrame, dict[str, str], dict[str, tuple]]:
    """Dictionary rows that concern this table, its columns by upper name, and code counts.

    The collected counts have at most one row per column of the table.
    """
    columns: dict[str, str] = {}
    for c in df.columns:
        columns.setdefault(c.upper(), c)
    mine = settled(dictionary.filter((F.col("base") == base) & F.col("variable").isin(list(columns))))
    sizes = mine.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("code") + F.octet_length("label")).alias("size")
    )
    return mine, columns, {r["variable"]: (r["n"], r["size"]) for r in sizes.collect()}


def _hit(mapping: Column, code: Column | str) -> Column:
    # A merged dictionary stores "1" and "01" together, so two looks cover all spellings.
    text = strip(F.col(code).cast("string") if isinstance(code, str) else code)
    return F.coalesce(F.try_element_at(mapping, text), F.try_element_at(mapping, plain_code(code)))


def apply_labels(
    df: DataFrame, dictionary: DataFrame, base: str, suffix: str = "_label", map_codes: int = MAP_CODES
) -> DataFrame:
    """Add ``<col>_label`` for every column the merged dictionary knows.

    Short code lists travel as maps in one scalar subquery and cost no shuffle and no
    join. All longer lists together cost one join and one shuffle of the table.
    """
    mine, columns, sizes = _variable_columns(df, dictionary, base)
    # Maps travel together, so their sum is bounded too; the smallest lists go first.
    short, total = [], 0
    for v, (n, size) in sorted(sizes.items(), key=lambda s: (s[1][1] or 0, s[0])):
        total += size or 0
        if n <= map_codes and (size or 0) <= MAP_BYTES and total <= BROADCAST_BYTES:
            short.append(v)
    short.sort()
    long = sorted(set(sizes) - set(short))
    out = df
    if short:
        entries = [
            F.map_from_entries(F.collect_list(F.when(F.col("variable") == v, F.struct("code", "label")))).alias(v)
            for v in short
        ]
        maps = mine.filter(F.col("variable").isin(short)).agg(F.struct(*entries).alias("maps")).scalar()
        out = out.withColumns({f"{columns[v]}{suffix}": _hit(maps.getField(v), columns[v]) for v in short})
    return _join_labels(out, mine, {v: columns[v] for v in long}, suffix) if long else out


def _join_labels(df: DataFrame, mine: DataFrame, columns: dict[str, str], suffix: str) -> DataFrame:
    """Labels of many columns by one join: the fact is shuffled once for any number of them.

    The distinct combinations of codes are taken apart into (variable, code), looked up
    together and put together again; the fact joins the labelled combinations. Null codes
    join like others.
    """
    codes = {f"_label_code{i}": F.col(f"`{c}`").cast("string") for i, c in enumerate(columns.values())}
    keyed = df.withColumns(codes)
    looks = F.array(*[
        F.struct(F.lit(v).alias("variable"), code.alias("code"), F.lit(order).alias("_order"))
        for name, v in zip(codes, columns) for order, code in enumerate((strip(F.col(name)), plain_code(name)))
    ])
    tall = keyed.select(*codes).distinct().select(*codes, F.inline(looks))
    found = tall.join(mine.select("variable", "code", "label"), ["variable", "code"], "left")
    # The exact spelling goes before the plain one.
    labels = [
        F.min_by("label", F.when((F.col("variable") == v) & F.col("label").isNotNull(), F.col("_order"))).alias(f"{c}{suffix}")
        for v, c in columns.items()
    ]
    kept = [c for c in df.columns if c not in {f"{c}{suffix}" for c in columns.values()}]
    return null_safe_join(keyed.select(*[f"`{c}`" for c in kept], *codes), found.groupBy(*codes).agg(*labels), list(codes), "left").drop(*codes)


def missing_variables(variables: DataFrame, dictionary: DataFrame, df: DataFrame, base: str) -> DataFrame:
    """Dictionary variables with no column in the table, or with no usable category."""
    mine = variables.filter(F.col("base") == base).select("variable")
    usable = dictionary.filter(F.col("base") == base).select("variable")
    present = F.upper(F.col("variable")).isin([c.upper() for c in df.columns])
    absent = mine.filter(~present).withColumn("reason", F.lit("not in table"))
    empty = mine.filter(present).join(usable, "variable", "left_anti").withColumn("reason", F.lit("no categories"))
    return absent.unionByName(empty)


def label_quality(df: DataFrame, dictionary: DataFrame, base: str, n: int = 10) -> DataFrame:
    """Columns whose labels are all null, with the first ``n`` unmapped codes and known codes.

    Looks at the whole table: codes are counted per column first, so what is shuffled
    is one row per distinct code and task.
    """
    mine, columns, sizes = _variable_columns(df, dictionary, base)
    names = sorted(sizes)
    w = W.partitionBy("variable").orderBy("code")

    def first_n(codes: DataFrame, out: str) -> DataFrame:
        ranked = codes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
        return ranked.groupBy("variable").agg(F.array_sort(F.collect_list("code")).alias(out))

    known = first_n(mine.select("variable", "code"), "known_codes")
    if not names:
        return known.select("variable", F.array().cast("array<string>").alias("unmapped_codes"), "known_codes").limit(0)
    used = (
        df.select(*[F.col(columns[v]).cast("string").alias(v) for v in names])
        .unpivot([], names, "variable", "code")
        .filter("code is not null")
        .groupBy("variable", "code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tried = used.withColumn("_try", F.explode_outer(code_variants("code")))
    lookup = mine.select("variable", F.col("code").alias("_try"), "label")
    hits = tried.join(lookup, ["variable", "_try"], "left").groupBy("variable", "code").agg(
        F.count("label").alias("hits")
    )
    labelled = hits.filter("hits > 0").select("variable").distinct()
    unmapped = first_n(hits.filter("hits = 0"), "unmapped_codes")
    return (
        known.join(labelled, "variable", "left_anti")
        .join(unmapped, "variable", "left")
        .select("variable", F.coalesce("unmapped_codes", F.array().cast("array<string>")).alias("unmapped_codes"), "known_codes")
    )
