"""Column expressions over whole tables."""

from pyspark.sql import functions as F

from panelwright.functions import codes, periods, text
from panelwright.functions.text import BOM
from panelwright.operators import regression, reshape
from suite.inputs import NATION, TIDY_SQL, pick, pick_sql, table, tidy

# Period texts by order key, with the month each rule gives them.
PERIODS = ("T1", "1er trimestre", " t2 ", "2do Trim", "T3", "4to", "6 Meses", "9 meses", "Anual", "Año 2018", "12 Meses", "otro", None, "2º", "4º")
STRICT = (3, 3, 6, 6, 9, 12, 6, 9, 12, 12, None, None, None, 6, 12)
TOTALS = (0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0)
EXACT = (3, 12, 12, 12, 9, 12, 6, 12, 12, 12, 12, 12, 12, 12, 12)
LOOSE = (3, 12, 12, 12, 9, 12, 12, 12, 12, 12, 12, 12, 12, 12, 12)


def _case(values, key="o_orderkey"):
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else v}" for i, v in enumerate(values))
    return f"CAST(CASE {key} % {len(values)} {arms} END AS INTEGER)"


def _period_counts(rule):
    def run(spark, sf):
        rows = table(spark, sf, "orders", pick(F.col("o_orderkey"), *PERIODS).alias("periodo"))
        return rows.groupBy("periodo", rule("periodo").alias("month"), periods.is_cumulative("periodo").alias("total")).agg(
            F.count(F.lit(1)).alias("n")
        )
    return run


def _period_sql(months):
    return (
        f"SELECT {pick_sql('o_orderkey', *PERIODS)} AS periodo, {_case(months)} AS month, "
        f"{_case(TOTALS)} = 1 AS total, count(*) AS n FROM orders GROUP BY 1, 2, 3"
    )


def _year_counts(spark, sf):
    rows = table(spark, sf, "documents", periods.clean_year("text").alias("anio"))
    years = rows.groupBy("anio").agg(F.count(F.lit(1)).alias("n"))
    marked = table(spark, sf, "orders", F.concat(F.year("o_orderdate").cast("string"), pick(F.col("o_orderkey"), "R", "p", "")).alias("t"))
    return years.unionByName(marked.groupBy(periods.clean_year("t").alias("anio")).agg(F.count(F.lit(1)).alias("n")))


def _quarter_text(spark, sf):
    ordinal = F.get(F.array(*[F.lit(w) for w in ("Primer", "Segundo", "Tercer", "Cuarto")]), F.quarter("o_orderdate") - 1)
    said = F.concat(F.lit(" "), ordinal, pick(F.col("o_orderkey"), " trimestre  del ", " trimestre del\t"), F.year("o_orderdate").cast("string"))
    rows = table(spark, sf, "orders", F.when(F.col("o_orderstatus") == "P", "sin dato").otherwise(said).alias("t"))
    return rows.groupBy(periods.year_from_text("t").alias("anio"), periods.quarter_from_text("t").alias("trimestre")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _dates(spark, sf):
    y, q, m = F.year("o_orderdate"), F.quarter("o_orderdate"), F.month("o_orderdate")
    bad = F.when(F.col("o_orderstatus") == "P", m + 12).otherwise(m)
    return table(
        spark, sf, "orders",
        periods.quarter_end(y, q).alias("quarter_end"), periods.quarter_label(y, q).alias("quarter_label"),
        periods.month_end(y, m).alias("month_end"), periods.month_start(y, bad).alias("month_start"),
    ).groupBy("quarter_end", "quarter_label", "month_end", "month_start").agg(F.count(F.lit(1)).alias("n"))


def _digit_keys(spark, sf):
    raw = F.concat(pick(F.col("c_custkey"), "", "k-", " ", "."), F.col("c_custkey").cast("string"))
    return table(spark, sf, "customer", "c_custkey", codes.digit_key(raw, 2).alias("key2"), codes.digit_key(raw, 3).alias("key3"))


def _code_variants(spark, sf):
    k = F.col("o_orderkey")
    code = F.concat(pick(k, "", " 0", "-", "a", "Z"), F.pmod(k, F.lit(500)).cast("string"), pick(k, "", " "))
    code = F.when(F.pmod(k, F.lit(11)) == 0, "  ").otherwise(code)
    return table(spark, sf, "orders", F.array_join(codes.code_variants(code), "|").alias("variants")).groupBy("variants").agg(
        F.count(F.lit(1)).alias("n")
    )


CODE_VARIANTS_SQL = """WITH raw AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE trim(
    list_extract(['', '0', '-', 'a', 'Z'], CAST(o_orderkey % 5 AS INTEGER) + 1) || (o_orderkey % 500)) END AS t FROM orders),
parts AS (SELECT t, CASE WHEN regexp_full_match(t, '-?[0-9]+') THEN CAST(TRY_CAST(t AS BIGINT) AS VARCHAR) ELSE upper(t) END AS p FROM raw),
three AS (SELECT t, p, CASE WHEN length(p) = 1 AND p BETWEEN '0' AND '9' THEN '0' || p ELSE p END AS d FROM parts)
SELECT CASE WHEN t = '' THEN '' ELSE t || CASE WHEN p <> t THEN '|' || p ELSE '' END
  || CASE WHEN d <> p AND d <> t THEN '|' || d ELSE '' END END AS variants, count(*) AS n FROM three GROUP BY 1"""


def _names(spark, sf):
    """File names built from orders: module, period, and codes read back."""
    k = F.col("o_orderkey")
    name = F.concat(
        pick(k, "SDEMT", "coe1", "Coe2t", "hogt", "vivt_COE1T", "other", "COE2"), F.lit("__x_"),
        F.year("o_orderdate").cast("string"), F.lit("_TRIM"), F.quarter("o_orderdate").cast("string"),
        pick(k, ".csv", "__2.csv", ".CSV"),
    )
    rows = table(spark, sf, "orders", name.alias("name"), F.concat(pick(k, "", " ", "p"), F.quarter("o_orderdate").cast("string"),
                                                                  F.date_format(F.col("o_orderdate").cast("date"), "yy")).alias("per"))
    year, quarter = codes.yq_from_name("name")
    per_year, per_quarter = codes.yq_from_per("per")
    return rows.groupBy(
        codes.module_of("name").alias("module"), year.alias("anio"), quarter.alias("trimestre"),
        per_year.alias("per_anio"), per_quarter.alias("per_trimestre"),
    ).agg(F.count(F.lit(1)).alias("n"))


NAMES_SQL = """SELECT CASE o_orderkey % 7 WHEN 0 THEN 'SDEMT' WHEN 1 THEN 'COE1T' WHEN 2 THEN 'COE2T' WHEN 3 THEN 'HOGT'
    WHEN 4 THEN 'VIVT' WHEN 6 THEN 'COE2T' END AS module,
  CASE WHEN o_orderkey % 3 <> 1 AND year(o_orderdate) >= 2000 THEN CAST(year(o_orderdate) AS INTEGER) END AS anio,
  CASE WHEN o_orderkey % 3 <> 1 AND year(o_orderdate) >= 2000 THEN CAST(quarter(o_orderdate) AS INTEGER) END AS trimestre,
  CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS per_anio, CAST(quarter(o_orderdate) AS INTEGER) AS per_trimestre,
  count(*) AS n FROM orders GROUP BY ALL"""


def _table_codes(spark, sf):
    k = F.col("o_orderkey")
    code = F.concat(pick(k, "coe1", "COE2T", " sdem", "Hog", "VIV", "ABC"), F.quarter("o_orderdate").cast("string"),
                    F.date_format(F.col("o_orderdate").cast("date"), "yy"), pick(k, "", " ", "-x"))
    t = codes.table_code(code)
    return table(spark, sf, "orders", t.alias("t")).groupBy(
        F.col("t.base").alias("base"), F.col("t.quarter").alias("quarter"), F.col("t.year").alias("year"), F.col("t.rank").alias("rank")
    ).agg(F.count(F.lit(1)).alias("n"))


TABLE_CODES_SQL = """WITH c AS (SELECT CAST(o_orderkey % 6 AS INTEGER) AS i, o_orderkey % 3 = 2 AS bad,
    CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(year(o_orderdate) % 100 AS INTEGER) AS y FROM orders)
SELECT CASE WHEN bad THEN list_extract(['COE1','COE2T','SDEM','HOG','VIV','ABC'], i + 1) || q || lpad(CAST(y AS VARCHAR), 2, '0') || 'X'
    ELSE list_extract(['COE1T','COE2T','SDEMT','HOGT','VIVT','ABC'], i + 1) END AS base,
  CASE WHEN bad THEN 0 ELSE q END AS quarter, CASE WHEN bad THEN 0 ELSE y END AS year,
  CASE WHEN bad THEN 20000 ELSE (2000 + y) * 10 + q END AS rank, count(*) AS n FROM c GROUP BY ALL"""


def _digest(expression):
    """A text expression over every document, whole texts, as a digest per document."""
    return lambda spark, sf: table(spark, sf, "documents", "doc_id", F.md5(expression("text")).alias("digest"))


def _mojibake(spark, sf):
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf, "documents", "doc_id", F.md5(text.fix_mojibake(broken)).alias("repaired"), F.md5(text.fix_mojibake("text")).alias("untouched"))


def _numbers(spark, sf):
    raw = F.concat(pick(F.col("l_orderkey") + F.col("l_linenumber"), "", " ", "x", "-"), F.col("l_quantity").cast("string"), pick(F.col("l_orderkey"), "", "\t", " %"))
    rows = table(spark, sf, "lineitem", "l_returnflag", text.to_double(raw).alias("v"))
    filled = reshape.zero_fill(rows, "v")
    return filled.groupBy("l_returnflag").agg(
        F.round(F.sum("v"), 2).alias("total"), F.count_if("v_missing").alias("missing"), F.count(F.lit(1)).alias("n")
    )


NUMBERS_SQL = """SELECT l_returnflag, round(sum(CASE WHEN bad THEN 0 WHEN neg THEN -l_quantity ELSE l_quantity END), 2) AS total,
  count_if(bad) AS missing, count(*) AS n FROM (SELECT l_returnflag, l_quantity, (l_orderkey + l_linenumber) % 4 = 3 AS neg,
  (l_orderkey + l_linenumber) % 4 = 2 OR l_orderkey % 3 = 2 AS bad FROM lineitem) GROUP BY 1"""


def _logs(spark, sf):
    rows = regression.log_measures(table(spark, sf, "lineitem", "l_returnflag", "l_discount", "l_extendedprice"), ["l_discount", "l_extendedprice"])
    return rows.groupBy("l_returnflag").agg(
        F.round(F.avg("l_discount"), 8).alias("avg_ln_discount"), F.count("l_discount").alias("n_discount"),
        F.round(F.avg("l_extendedprice"), 8).alias("avg_ln_price"),
    )


def _metric_like(spark, sf):
    rows = table(spark, sf, "documents", "lang", text.metric_like("text", "Ción").alias("a"), text.metric_like("text", "elle").alias("b"))
    return rows.groupBy("lang").agg(F.count_if("a").alias("n_cion"), F.count_if("b").alias("n_elle"))


def _date_texts(spark, sf):
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    serial = F.date_diff(day, F.lit("1899-12-30").cast("date")).cast("string")
    either = F.when(F.pmod(k, F.lit(3)) == 0, serial).when(F.pmod(k, F.lit(3)) == 1, day.cast("string")).otherwise("s/f")
    slashed = F.when(F.pmod(k, F.lit(2)) == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return table(
        spark, sf, "orders", day.alias("day"), periods.excel_or_text_date(either).alias("serial_or_iso"), periods.parse_date(slashed, dayfirst=True).alias("dayfirst")
    ).groupBy("day", "serial_or_iso", "dayfirst").agg(F.count(F.lit(1)).alias("n"))


def _units(spark, sf):
    rows = tidy(spark, sf)
    return rows.groupBy("metric", text.unit_class("metric").alias("unit"), text.is_national("estado").alias("nacional")).agg(F.count(F.lit(1)).alias("n"))


def _formats(spark, sf):
    rows = table(spark, sf, "lineitem", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount").groupBy(F.year("l_shipdate").alias("anio"))
    sums = rows.agg(F.sum("l_extendedprice").alias("p"), F.sum("l_quantity").alias("q"), (F.avg("l_discount") * 100).alias("d"))
    return sums.select("anio", text.fmt_money("p").alias("money"), text.fmt_count("q").alias("count_text"), text.fmt_pct("d").alias("pct"))


def _headers(spark, sf):
    raw = F.concat(pick(F.col("p_partkey"), BOM, "", "  "), F.upper("p_name"), pick(F.col("p_partkey"), " \t ", "  x", ""))
    return table(spark, sf, "part", text.norm_header(raw).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "period_month": (_period_counts(periods.period_month), _period_sql(STRICT)),
    "period_month_exact": (_period_counts(periods.period_month_exact), _period_sql(EXACT)),
    "period_month_loose": (_period_counts(periods.period_month_loose), _period_sql(LOOSE)),
    "clean_year": (
        _year_counts,
        r"""SELECT TRY_CAST(NULLIF(regexp_extract(text, '\d{4}'), '') AS INTEGER) AS anio, count(*) AS n FROM documents GROUP BY 1
        UNION ALL SELECT CAST(year(o_orderdate) AS INTEGER), count(*) FROM orders GROUP BY 1""",
    ),
    "quarter_from_text": (
        _quarter_text,
        """SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS anio,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(quarter(o_orderdate) AS INTEGER) END AS trimestre, count(*) AS n FROM orders GROUP BY 1, 2""",
    ),
    "quarter_and_month_dates": (
        _dates,
        """SELECT last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS quarter_end,
        year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter_label, last_day(o_orderdate) AS month_end,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_start, count(*) AS n
        FROM orders GROUP BY ALL""",
    ),
    "digit_key": (
        _digit_keys,
        """SELECT c_custkey, CASE WHEN c_custkey < 10 THEN '0' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS key2,
        CASE WHEN c_custkey < 10 THEN '00' || c_custkey WHEN c_custkey < 100 THEN '0' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS key3
        FROM customer""",
    ),
    "code_variants": (_code_variants, CODE_VARIANTS_SQL),
    "names_and_period_codes": (_names, NAMES_SQL),
    "table_code": (_table_codes, TABLE_CODES_SQL),
    "slugify": (
        _digest(text.slugify),
        r"""SELECT doc_id, md5(lower(trim(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]+', '_', 'g'), '_'))) AS digest FROM documents""",
    ),
    "safe_name": (
        _digest(codes.safe_name),
        r"""SELECT doc_id, md5(regexp_replace(replace(trim(text, E' \t\n\r\x0b\x0c'), ' ', '_'), '[^A-Za-z0-9_\-.]+', '_', 'g')) AS digest FROM documents""",
    ),
    "squeeze": (
        _digest(text.squeeze),
        r"""SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\n\r\f\x0b]+', ' ', 'g'))) AS digest FROM documents""",
    ),
    "fix_mojibake": (_mojibake, "SELECT doc_id, md5(text) AS repaired, md5(text) AS untouched FROM documents"),
    "to_double_and_zero_fill": (_numbers, NUMBERS_SQL),
    "log_measures": (
        _logs,
        """SELECT l_returnflag, round(avg(CASE WHEN l_discount > 0 THEN ln(l_discount) END), 8) AS avg_ln_discount,
        count_if(l_discount > 0) AS n_discount, round(avg(ln(l_extendedprice)), 8) AS avg_ln_price FROM lineitem GROUP BY 1""",
    ),
    "metric_like": (
        _metric_like,
        """SELECT lang, count_if(contains(lower(strip_accents(text)), 'cion')) AS n_cion,
        count_if(contains(lower(strip_accents(text)), 'elle')) AS n_elle FROM documents GROUP BY 1""",
    ),
    "date_texts": (
        _date_texts,
        """SELECT CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS serial_or_iso,
        CAST(o_orderdate AS DATE) AS dayfirst, count(*) AS n FROM orders GROUP BY ALL""",
    ),
    "unit_class_and_national": (
        _units,
        f"""WITH {TIDY_SQL} SELECT metric, CASE WHEN lower(metric) LIKE '%millones de pesos%' THEN 'money'
        WHEN lower(metric) LIKE '%unidades%' THEN 'count' WHEN lower(metric) LIKE '%ndice%' THEN 'index' ELSE 'other' END AS unit,
        estado = '{NATION}' AS nacional, count(*) AS n FROM tidy GROUP BY ALL""",
    ),
    "display_formats": (
        _formats,
        """SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, '$' || format('{:,.0f}', sum(l_extendedprice)) AS money,
        format('{:,.0f}', sum(l_quantity)) AS count_text, format('{:.1f}%', avg(l_discount) * 100) AS pct FROM lineitem GROUP BY 1""",
    ),
    "norm_header": (
        _headers,
        """SELECT p_name || CASE WHEN p_partkey % 3 = 1 THEN ' x' ELSE '' END AS "column", count(*) AS n FROM part GROUP BY 1""",
    ),
}
