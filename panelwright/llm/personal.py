"""Personal data by candidate gradient boosting, in DataFrame functions: spans proposed, boosted trees, calibrated thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import written

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("email", "ip", "card", "phone")
#: The base patterns: leftmost and longest as a plain search finds them, but without trying the rest of a run again. A run
#: of name characters is looked at once, from its beginning or from the end of the last match; possessive counts keep nothing to go back to.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of more spans, with high recall: spelled-out addresses, bracketed dots, other separators, numbers without a plus.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?@ ?| ?[\[(] ?(?:at|AT|@) ?[\])] ?| at (?=[A-Za-z0-9-]++ dot ))[A-Za-z0-9-]++(?:(?:\.| ?[\[(] ?(?:dot|DOT|\.) ?[\])] ?| dot )[A-Za-z0-9-]++){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ ./-]{0,2}+[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])",
}
#: What a text must hold before a kind's patterns are tried.
HOLDS = {"email": r"@|[ \[(](?:at|AT)[ \])]", "ip": r"[0-9][.\[(]", "card": "[0-9][0-9 ./-]{12}", "phone": "[0-9][) .-]|\\+[0-9]"}
#: Words before a span that speak for its kind, and words that speak against any.
HINTS = {"email": "mail|contact|write|reply", "ip": "ip|host|server|addr|login|from", "card": "card|visa|master|amex|credit|debit|payment", "phone": "tel|phone|call|fax|mobile|cell|whatsapp|dial"}
AGAINST = "version|v\\.?$|order|invoice|isbn|issn|doi|ref|page|section|chapter|serial|total|price|[$€£#=]$"
#: Code points of context, rounds and depth of the trees, and the precision on held-out documents that a threshold must keep.
BEFORE, ROUNDS, DEPTH, PRECISION = 24, 20, 4, 0.98
#: Features of a candidate with the number of their values: the model is fitted on a row for each combination at most.
FEATURES = {"kind": 4, "n_digits": 21, "groups": 8, "separators": 16, "first": 11, "valid": 2, "before": 5, "after": 5, "hint": 2, "against": 2}


def _proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, base boolean, kind, i, gap, match, left, right): matches with the code points since the last one, and their context.

    The pieces between matches give the places; a document without a match has one row of
    nulls. Written once, as texts are long and matches few.
    """
    text = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    generators = [(base, k, kind, pattern) for base, found in ((True, BASE), (False, MORE)) for k, (kind, pattern) in enumerate(found.items())]
    edge = lambda piece: F.struct(F.length(piece).alias("n"), F.right(piece, F.lit(BEFORE)).alias("l"), F.left(piece, F.lit(2)).alias("r"))
    parts = []
    for n, (_, _, kind, pattern) in enumerate(generators):
        holds = F.col("_t").rlike(HOLDS[kind])
        parts.append(F.when(holds, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).alias(f"_m{n}"))
        parts.append(F.when(holds, F.transform(F.split("_t", pattern, -1), edge)).alias(f"_p{n}"))
    cut = text.select("_row", "_id", *parts)
    def matches(n: int, base: bool, k: int) -> Column:
        piece = lambda i: F.get(f"_p{n}", i)
        one = lambda m, i: F.struct(
            F.lit(base).alias("base"), F.lit(k).alias("kind"), i.alias("i"), piece(i)["n"].alias("gap"), m.alias("match"),
            piece(i)["l"].alias("left"), piece(i + 1)["r"].alias("right"),
        )
        return F.coalesce(F.transform(f"_m{n}", one), F.array())

    arrays = [matches(n, base, k) for n, (base, k, _, _) in enumerate(generators)]
    return written(cut.select("_row", "_id", F.inline_outer(F.concat(*arrays))))


def luhn(digits: Column) -> Column:
    """Whether the last digit of a number is its check digit."""
    turned = F.reverse(digits)
    values = F.transform(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), lambda i: F.substring(turned, i, F.lit(1)).try_cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.coalesce(F.aggregate(values, F.lit(0), lambda s, v: s + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0, F.lit(False))


def _small_parts(match: Column) -> Column:
    parts = F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))
    return F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255) & (F.size(parts) == 4)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _accepted(match: Column, kind: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    digits = _digits(match)
    n = F.length(digits)
    return (
        F.when(kind == 0, True).when(kind == 1, F.coalesce(_small_parts(match), F.lit(False)))
        .when(kind == 2, n.between(14, 19) & luhn(F.when(n.between(14, 19), digits).otherwise(F.lit("")))).otherwise(n.between(10, 15))
    )


def _placed(proposed: DataFrame) -> DataFrame:
    """Accepted base spans and all others, with start and end in code points."""
    w = W.partitionBy("_row", "base", "kind").orderBy("i")
    ends = F.sum((F.col("gap") + F.length("match")).cast("long")).over(w)
    some = proposed.filter("match is not null").withColumn("end", ends).withColumn("start", F.col("end") - F.length("match"))
    return some.filter(~F.col("base") | _accepted(F.col("match"), F.col("kind"))).drop("gap", "i")


def _overlaps(spans: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Marks whether a span overlaps a base span of the same keys: rows in order of place, one look back and, in turned order, one ahead."""
    before = W.partitionBy(*keys).orderBy("start", "end", "base").rowsBetween(W.unboundedPreceding, W.currentRow)
    behind = W.partitionBy(*keys).orderBy(F.desc("start"), F.desc("end"), F.desc("base")).rowsBetween(W.unboundedPreceding, W.currentRow)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(behind)
    return spans.withColumn(out, F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False)))


def _char(c: Column) -> Column:
    return (
        F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike("[$€£#=]"), 4).otherwise(3)
    )


def _plain_form(match: Column, kind: Column) -> Column:
    """A candidate as the base pattern would have it: spelled or bracketed signs as signs."""
    at = F.regexp_replace(match, r" ?[\[(] ?(?:at|AT|@) ?[\])] ?| at | ?@ ?", "@")
    dots = lambda c: F.regexp_replace(c, r" ?[\[(] ?(?:dot|DOT|\.) ?[\])] ?| dot ", ".")
    return F.when(kind == 0, dots(at)).when(kind == 1, dots(match)).otherwise(match)


def _described(spans: DataFrame) -> DataFrame:
    """Adds the features of a candidate: its format and its context, but not which pattern proposed it."""
    formed = spans.withColumn("_form", _plain_form(F.col("match"), F.col("kind")))
    form, left, name = F.col("_form"), F.lower("left"), F.col("kind") == 0
    digits = _digits(form)
    has = lambda c, bit: F.when(form.contains(c), bit).otherwise(0)
    number = lambda c: F.when(name, 0).otherwise(c)  # noqa: E731  of an address only its end and its context count
    valid = (
        F.when(name, form.rlike(r"(?i)^[a-z0-9].*[.][a-z]{2,6}$")).when(F.col("kind") == 1, _small_parts(form))
        .when(F.col("kind") == 2, luhn(digits)).otherwise(F.length(digits).between(9, 15))
    )
    hint = reduce(lambda c, k: c.when(F.col("kind") == k, left.rlike(HINTS[KINDS[k]])), range(1, 4), F.when(name, left.rlike(HINTS["email"])))
    return formed.withColumns({
        "n_digits": number(F.least(F.length(digits), F.lit(20))), "groups": number(F.least(F.size(F.regexp_extract_all(form, F.lit("[0-9]+"), F.lit(0))), F.lit(7))),
        "separators": number(has(" ", 1) + has("-", 2) + has(".", 4) + has("(", 8)), "first": number(F.coalesce(F.left(digits, F.lit(1)).try_cast("int"), F.lit(10))),
        "valid": F.coalesce(valid, F.lit(False)).cast("int"), "before": _char(F.right("left", F.lit(1))), "after": _char(F.left("right", F.lit(1))),
        "hint": hint.cast("int"), "against": left.rlike(AGAINST).cast("int"),
    }).drop("_form")


def chosen_features(candidates: DataFrame) -> DataFrame:
    """Feature combinations whose candidates are redacted: (features, p, threshold).

    ``candidates``: the features, ``label`` (1 if a base span of the kind overlaps), and
    ``held_out``. They are counted by combination first, so the trees learn from all of
    them on a table that does not grow. The threshold of a kind lies half-way between the
    least score at and above which the held-out candidates keep the precision and the next
    score below it, and at one half at least. Without candidates of both labels nothing is
    chosen.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    names = list(FEATURES)
    counted = written(candidates.groupBy(*names, "label", "held_out").agg(F.count(F.lit(1)).cast("double").alias("_n")))
    rows = VectorAssembler(inputCols=names, outputCol="_x").transform(counted)
    fitted = rows.filter("not held_out").coalesce(1)
    if fitted.select("label").distinct().count() < 2:
        return counted.limit(0).select(*names)
    trees = GBTClassifier(featuresCol="_x", labelCol="label", weightCol="_n", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.2, seed=42)
    scored = trees.fit(fitted.withColumn("label", F.col("label").cast("double"))).transform(rows)
    scored = scored.select(*names, "label", "held_out", "_n", F.round(vector_to_array("probability")[1], 6).alias("p"))
    tested = scored.filter("held_out").groupBy("kind", "p").agg(F.sum(F.col("_n") * F.col("label")).alias("_hits"), F.sum("_n").alias("_all"))
    w = W.partitionBy("kind").orderBy(F.desc("p"))
    kept = tested.withColumns({"_share": F.sum("_hits").over(w) / F.sum("_all").over(w), "_below": F.coalesce(F.lead("p").over(w), F.lit(0.0))})
    threshold = kept.filter(F.col("_share") >= PRECISION).groupBy("kind").agg(F.greatest(F.min((F.col("p") + F.col("_below")) / 2), F.lit(0.5)).alias("threshold"))
    return scored.select(*names, "p").distinct().join(threshold, "kind").filter("p >= threshold").select(*names)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array of (start, kind, end, base)) of whole texts, by place and kind; places in code points, end exclusive.

    Base spans are those of the fixed patterns. Candidates of the wider generators learn
    from them: one that overlaps a base span of its kind is an example for, any other one
    against, and what the trees see is format and context only. Those whose score reaches
    the calibrated threshold are added, unless a base span overlaps them. Null and empty
    texts have no span; every row gives a row, repeated rows and null ids included; other
    columns are left out, an empty table gives an empty one.
    """
    proposed = _proposed(docs, id_col, text_col)
    placed = _placed(proposed)
    labelled = _overlaps(_overlaps(placed, ["_row", "kind"], "label"), ["_row"], "_taken").withColumn("label", F.col("label").cast("int"))
    spans = written(_described(labelled).drop("match", "left", "right"))
    held_out = F.crc32(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    more = spans.filter("not base")
    added = more.filter("not _taken").join(chosen_features(more.withColumn("held_out", held_out)), list(FEATURES), "left_semi")
    span = F.struct("start", "kind", "end", "base").alias("_span")
    found = spans.filter("base").select("_row", span).unionByName(added.select("_row", span))
    lists = found.groupBy("_row").agg(F.sort_array(F.collect_list("_span")).alias("spans"))
    every = proposed.select("_row", "_id").distinct()
    named = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.get(F.array(*map(F.lit, KINDS)), s["kind"]).alias("kind"), s["end"].alias("end"), s["base"].alias("base")))
    return every.join(lists, "_row", "left").select(F.col("_id").alias(id_col), F.coalesce(named, F.array()).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with each span replaced by its kind in brackets; overlapping spans are replaced as one, by the kind of the first.

    By id, which must be unique here; rows with a null id are left out.
    """
    found = personal_data(docs.filter(F.col(id_col).isNotNull()), id_col, text_col).select(id_col, "spans")
    start = F.lit(0).cast("long")
    part = lambda t, a, b: F.substring(t, (a + 1).cast("int"), (b - a).cast("int"))

    def step(done: Column, s: Column) -> Column:
        text = F.when(s["start"] >= done["at"], F.array_append(F.array_append(done["out"], part(F.col("_t"), done["at"], s["start"])), F.concat(F.lit("["), s["kind"], F.lit("]")))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), text.alias("out"))

    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    walked = texts.join(found, id_col).withColumn("_w", F.aggregate("spans", F.struct(start.alias("at"), F.array().cast("array<string>").alias("out")), step))
    rest = part(F.col("_t"), F.col("_w.at"), F.length("_t").cast("long"))
    return walked.select(id_col, F.concat(F.array_join("_w.out", ""), rest).alias(text_col))


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), added)
