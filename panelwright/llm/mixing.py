"""Mixing by soft membership: domain posteriors, and document rates by projected-gradient least squares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_column, importable, settled, unused, whole_text

#: Bounds of the labelled rows the classifier is fitted on: documents per domain, and the bytes of each.
SAMPLE, SAMPLE_BYTES = 1000, 16_384
#: Byte pairs: the features of a text, a weight for each and domain.
PAIRS = 1 << 16
STEPS = 200
#: Rounds of the projected gradient, and the residual, as a share of all tokens, at which it ends.
ROUNDS, CLOSE = 40, 1e-6


def training_rows(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, text bytes, domain): up to ``sample`` labelled documents a domain, in the order of a hash of the id.

    Rows with a null id or domain are left out, of several domains of a document the first
    by name counts, and documents above ``SAMPLE_BYTES`` are not fitted on. The chosen ids
    are bounded, so they are sent to the texts.
    """
    known = labelled.filter(F.col(id_col).isNotNull() & F.col("domain").isNotNull()).groupBy(id_col).agg(F.min("domain").alias("_domain"))
    short = docs.filter(F.octet_length(text_col) <= SAMPLE_BYTES).select(id_col, text_col)
    order = W.partitionBy("_domain").orderBy(F.xxhash64(id_col), id_col)
    chosen = known.join(short.select(id_col).distinct(), id_col, "left_semi").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample)
    return short.join(F.broadcast(chosen), id_col).dropDuplicates([id_col]).select(id_col, whole_text(text_col), "_domain")


def pair_codes(text: bytes):
    import numpy as np

    data = np.frombuffer(text, np.uint8).astype(np.int32)
    return data[:-1] << 8 | data[1:]


def fit_softmax(texts: list[bytes], classes: list[int], n_classes: int, steps: int = STEPS):
    """(weights by class and byte pair, biases): softmax regression on standardised shares of byte pairs, by Adam."""
    import numpy as np

    weights, bias = np.zeros((n_classes, PAIRS)), np.zeros(n_classes)
    if not texts:
        return weights, bias
    codes = [pair_codes(t) for t in texts]
    docs = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    used, column = np.unique(np.concatenate(codes), return_inverse=True)
    x = np.zeros((len(texts), len(used)), np.float32)
    np.add.at(x, (docs, column), 1)
    df = (x > 0).sum(0) >= 3
    x, used = x[:, df], used[df]
    x /= np.array([max(1, len(c)) for c in codes], np.float32)[:, None]
    mean, scale = x.mean(0), x.std(0) + 1e-4
    x = (x - mean) / scale
    y = np.eye(n_classes, dtype=np.float32)[classes]
    w, m, v = (np.zeros((n_classes, len(used) + 1), np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        z = x @ w[:, :-1].T + w[:, -1]
        p = np.exp(z - z.max(1, keepdims=True))
        p = p / p.sum(1, keepdims=True) - y
        g = np.hstack([p.T @ x / len(x) + 1e-2 * w[:, :-1], p.mean(0)[:, None]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights[:, used] = w[:, :-1] / scale
    return weights, w[:, -1] - (w[:, :-1] * (mean / scale)).sum(1)


def fit(rows: DataFrame, domains: list[str], id_col: str = "doc_id"):
    """Fit on the bounded training rows, in one task; a weight for each byte pair and domain at most comes to the driver."""
    import numpy as np

    importable(rows.sparkSession)
    names = list(domains)

    def run(batches):
        import pyarrow as pa

        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)) if r[2] in names]
        got.sort(key=lambda r: (r[0], r[1]))
        weights, bias = fit_softmax([t for _, t, _ in got], [names.index(d) for *_, d in got], len(names))
        k, at = np.nonzero(weights)
        rows = [np.append(k, np.arange(len(names))), np.append(at, np.full(len(names), -1)), np.append(weights[k, at], bias)]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.float64())], ["k", "i", "w"])

    found = rows.coalesce(1).mapInArrow(run, "k int, i int, w double").toPandas()
    weights, bias = np.zeros((len(names), PAIRS), np.float32), np.zeros(len(names))
    kept = found.i >= 0
    weights[found.k[kept], found.i[kept]] = found.w[kept]
    bias[found.k[~kept]] = found.w[~kept]
    return weights, bias


def posteriors(docs: DataFrame, model, text_col: str = "text", column: str = "mix") -> DataFrame:
    """``docs`` with a struct (tokens long, posterior array<double>): words at white space, and the share of each domain.

    Whole texts. A null, empty or one-byte text has the posterior of an empty text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import numpy as np

        weights, bias = sent.value

        def one(text: bytes) -> dict:
            codes = pair_codes(text)
            z = weights[:, codes].mean(1, dtype=np.float64) + bias if len(codes) else bias
            p = np.exp(z - z.max())
            return {"tokens": len(text.split()), "posterior": (p / p.sum()).tolist()}

        return lambda texts: [one(t) for t in texts.to_pylist()]

    return docs.withColumn(column, arrow_column(docs, whole_text(text_col), "struct<tokens:long,posterior:array<double>>", make))


def rate(steps: list[list[float]], least: float, posterior: str = "mix.posterior") -> Column:
    """A document's rate after these gradient steps: from 1, each step adds its part and projects onto ``least`` or more."""
    start = F.lit(1.0)
    if not steps:
        return F.greatest(start, F.lit(float(least)))
    history = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    dot = lambda step: reduce(lambda a, b: a + b, [F.col(posterior)[k] * step[k] for k in range(len(steps[0]))])
    return F.aggregate(history, start, lambda r, step: F.greatest(F.lit(float(least)), r - dot(step)))


def fit_rates(scored: DataFrame, targets: list[float], total: float | None = None, least: float = 0.0, column: str = "mix") -> list[list[float]]:
    """Gradient steps whose rates make the expected tokens of each domain ``target * total`` as nearly as can be.

    Least squares over the rates of all documents: the residual of a domain is the sum of
    rate * tokens * posterior less its target. Every round is one aggregate of a row for
    each domain; the gradient of a document is its posterior times a vector that is common
    to all, so rates are never stored: they follow from the few vectors so far. The
    residual is measured in the metric in which the problem without bounds is perfectly
    conditioned, so a unit step is right and few rounds are needed.
    """
    import numpy as np

    n = len(targets)
    p, tokens = F.col(f"{column}.posterior"), F.col(f"{column}.tokens")
    moments = scored.agg(*[F.sum(tokens * p[j] * p[k]).alias(f"m{j}_{k}") for j in range(n) for k in range(j, n)], F.sum(tokens).alias("all")).first()
    if not moments["all"]:
        return []
    gram = np.array([[moments[f"m{min(j, k)}_{max(j, k)}"] for k in range(n)] for j in range(n)], float)
    inverse = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    have = gram.sum(0)  # posteriors sum to 1
    share = np.array(targets, float) / sum(targets)
    # Without a total: the least one at which no domain has to shrink, where each document stays; else that of the corpus.
    total = total or (float((have / np.maximum(share, 1e-12)).max()) if least >= 1 else float(moments["all"]))
    steps, best, since = [], None, 0
    for _ in range(ROUNDS):
        r = rate(steps, least, f"{column}.posterior")
        got = scored.agg(*[F.sum(r * tokens * p[k]).alias(f"s{k}") for k in range(n)]).first()
        residual = np.array([got[k] for k in range(n)], float) - share * total
        size = float(np.abs(residual).max()) / total
        since = 0 if best is None or size < 0.98 * best[0] else since + 1
        if best is None or size < best[0]:
            best = (size, list(steps))
        if size < CLOSE or since >= 4:
            break
        steps.append((inverse @ residual).tolist())
    return best[1]


def _fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str, text_col: str, least: float):
    domains = sorted(targets)
    model = fit(training_rows(docs, labelled, id_col, text_col), domains, id_col)
    kept = settled(posteriors(docs.select(id_col, text_col), model, text_col).select(id_col, "mix"))  # a few numbers a document
    return model, kept, fit_rates(kept, [targets[d] for d in domains], least=least)


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """(id, mix struct (tokens, posterior), rate) of each row; see ``mix``."""
    _, kept, steps = _fitted(docs, labelled, targets, id_col, text_col, least)
    return kept.withColumn("rate", rate(steps, least))


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: float = 0.0,
    rate_col: str = "rate",
) -> DataFrame:
    """``docs`` with its rate; a column of that name is replaced.

    ``labelled`` (id, domain) fits the classifier, ``targets`` give each domain's share of
    the tokens. Every row has a rate, repeated rows the same one; null ids are fitted like
    others, and without labels or tokens all rates are 1. Texts are scored again for the
    result rather than joined, so they are not shuffled.
    """
    model, _, steps = _fitted(docs, labelled, targets, id_col, text_col, least)
    column = unused(docs, "mix")
    return posteriors(docs, model, text_col, column).withColumn(rate_col, rate(steps, least, f"{column}.posterior")).drop(column)


def repeated(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: float = 0.0
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its rate says, the whole part, and once more if a hash of the id falls below the rest."""
    column = unused(docs, "rate")
    mixed = mix(docs, labelled, targets, id_col, text_col, least, column)
    uniform = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor(column) + (uniform < F.col(column) - F.floor(column)).cast("long")).cast("int")
    copy = unused(mixed, "copy")
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).drop(copy, column)


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else good or poor by quality."""
    domain = F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = rates(docs, quality_domains(table(spark, sf_dir, "labels")), {"good": 0.85, "poor": 0.1, "toxic": 0.05})
    names = sorted(("good", "poor", "toxic"))
    return mixed.select("doc_id", F.col("mix.tokens").alias("n_tokens"), "rate", *[F.col("mix.posterior")[k].alias(f"p_{d}") for k, d in enumerate(names)])
