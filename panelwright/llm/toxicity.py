"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learnt from document labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_column, importable, unused, whole_text

#: Words, and the ends of sentences. A sentence ends at a stop, an exclamation or question mark or a line end.
PARTS = r"\w+|[.!?\n]+"
#: Hashed features, a weight each: what the model broadcasts never grows beyond this.
FEATURES = 1 << 18
#: Prefixes that share a weight between the forms of a word.
PREFIXES = (3, 4, 5, 6)
#: Bounds of the labelled rows the model is fitted on: documents per label, and their bytes per label and doubling of length.
SAMPLE, SAMPLE_BYTES = 1500, 1 << 22
EPOCHS = 150
#: A feature gets a weight if so many fitted documents have it; rarer ones would be learnt by heart.
LEAST_DOCS, L2 = 4, 1e-5
#: A sentence's score that counts as none when a document is scored, so that many clean sentences don't add up.
FLOOR = 0.02


def features(word: str) -> list[int]:
    """Hashed features of a word: the word itself and its prefixes."""
    from zlib import crc32

    found = [crc32(b"=" + word.encode()) % FEATURES]
    return found + [crc32(b"^" + word[:n].encode()) % FEATURES for n in PREFIXES if len(word) >= n]


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, text bytes, toxic): up to ``sample`` labelled documents per label, in the order of a hash of the id.

    Only ids outside fold 0. Rows with a null id or label are left out, and of several labels
    of a document the highest counts. Documents of every length take part: for each label
    and each doubling of length they are taken until they hold ``SAMPLE_BYTES``, the one
    that crosses that included. The chosen ids are bounded, so they are sent to the texts.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & (fold(id_col) != 0))
    known = known.groupBy(id_col).agg(F.max("toxic").alias("_toxic"))
    sizes = docs.filter(F.col(text_col).isNotNull()).groupBy(id_col).agg(F.max(F.octet_length(text_col)).cast("long").alias("_size"))
    sized = known.join(sizes, id_col).withColumn("_class", F.length(F.bin("_size")))
    by_class = W.partitionBy("_toxic", "_class").orderBy(F.xxhash64(id_col), id_col)
    first = sized.withColumn("_n", F.row_number().over(by_class)).filter(F.col("_n") <= sample)
    before = F.sum("_size").over(by_class.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_size")
    fitting = first.withColumn("_before", before).filter(F.col("_before") < SAMPLE_BYTES)
    order = W.partitionBy("_toxic").orderBy(F.xxhash64(id_col), id_col)
    chosen = fitting.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample).select(id_col, "_toxic")
    texts = docs.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    return texts.join(F.broadcast(chosen), id_col).dropDuplicates([id_col]).select(F.col(id_col), whole_text(text_col), F.col("_toxic").cast("int"))


def fit_noisy_or(texts: list[str], toxic: list[int], epochs: int = EPOCHS):
    """(weights, bias, leak) under p = 1 - (1 - leak) prod(1 - s), by Adam on the document likelihood.

    1 - s is (1 - sigmoid(z)) / (1 - sigmoid(bias)), so a sentence without any
    weighted word scores exactly 0, and what is left to chance is one leak a document,
    whatever its number of sentences.
    """
    import re
    from array import array

    import numpy as np

    cut, known = re.compile(PARTS).findall, {}
    index, words, sentences, docs = array("i"), array("i"), 0, array("i")
    for n, text in enumerate(texts):
        for sentence in re.split(r"[.!?\n]+", text.lower()):
            if got := cut(sentence):
                for word in got:
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = features(word)
                    index.extend(ids)
                    words.extend([sentences] * len(ids))
                sentences += 1
                docs.append(n)
    index, words, docs, y = np.array(index, np.int32), np.array(words, np.int32), np.array(docs, np.int32), np.array(toxic, np.int64)
    weights, bias, leak = np.zeros(FEATURES), -6.0, -6.0
    if not len(index) or not 0 < y.sum() < len(y):
        return weights, bias, leak if not len(y) or not y.all() else 0.0
    pairs = np.unique(index.astype(np.int64) * len(y) + docs[words]) // len(y)
    used, df = np.unique(pairs, return_counts=True)
    used = used[df >= LEAST_DOCS]
    kept = np.isin(index, used)
    index, words = index[kept], words[kept]
    column = np.searchsorted(used, index).astype(np.int32)
    w, m, v = np.zeros(len(used) + 2), np.zeros(len(used) + 2), np.zeros(len(used) + 2)
    w[-2:] = bias, leak
    for t in range(1, epochs + 1):
        z = np.clip(np.bincount(words, w[column], sentences) + w[-2], -30, 30)
        s, floor, known_leak = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-w[-2])), 1 / (1 + np.exp(-w[-1]))
        miss = np.bincount(docs, np.logaddexp(0, z) - np.logaddexp(0, w[-2]), len(y)) + np.logaddexp(0, w[-1])
        p = np.maximum(-np.expm1(-miss), 1e-12)
        each = np.where(y == 1, -np.exp(-miss) / p, 1.0)
        pull = each[docs] * s
        ends = [pull.sum() - each[docs].sum() * floor, each.sum() * known_leak]
        g = np.append(np.bincount(column, pull[words], len(used)), ends) / len(y) + L2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        np.maximum(w[:-2], 0, out=w[:-2])  # words only add to a sentence's score, so a long sentence doesn't hide one
    weights[used] = w[:-2]
    return weights, float(w[-2]), float(w[-1])


def fit(rows: DataFrame, id_col: str = "doc_id", epochs: int = EPOCHS):
    """Fit on the bounded training rows, in one task; the model's few non-zero weights come to the driver."""
    importable(rows.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        got.sort(key=lambda r: (r[0], r[1]))
        weights, bias, leak = fit_noisy_or([t.decode() for _, t, _ in got], [int(y > 0) for *_, y in got], epochs)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2]), pa.int32()), pa.array(np.append(weights[at], [bias, leak]))], ["i", "w"])

    found = rows.coalesce(1).mapInArrow(run, "i int, w double").toPandas()
    import numpy as np

    weights = np.zeros(FEATURES, np.float32)
    kept = found[found.i >= 0]
    weights[kept.i.to_numpy()] = kept.w.to_numpy()
    ends = dict(zip(found.i, found.w))
    return weights, float(ends.get(-1, -6.0)), float(ends.get(-2, -6.0))


def score(docs: DataFrame, model, text_col: str = "text", at_least: float = 0.5, column: str = "toxicity") -> DataFrame:
    """``docs`` with a struct (score, offending): the noisy-or of all sentences of a whole text, and those that offend.

    ``offending`` holds (start, length, score) in code points for each sentence whose own
    score is ``at_least`` or more. A null, empty or wordless text has no sentence and
    scores 0. Rows and other columns stay as they are; a column of the new one's name is
    replaced.
    """
    weights, bias, leak = model
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        import math
        import re

        import numpy as np

        weights, parts = sent.value, re.compile(PARTS)
        floor = max(-math.log1p(-FLOOR), float(np.logaddexp(0, bias)))
        cut, end = parts.findall, re.compile(r"[.!?\n]")

        class Weight(dict):
            def __missing__(self, word: str) -> float:
                value = math.inf if end.match(word) else float(sum(weights[i] for i in features(word)))
                if len(self) >= 400_000:
                    self.clear()
                if len(word) <= 48:
                    self[word] = value
                return value

        weight = Weight().__getitem__

        def one(text: str):
            text = text.lower() if len(text.lower()) == len(text) else "".join(c.lower()[:1] for c in text)
            tokens = cut(text)
            sums = np.fromiter(map(weight, tokens), float, len(tokens))
            stop = np.isinf(sums)
            word = np.flatnonzero(~stop)
            if not len(word):
                return 0.0, []
            sums[stop] = 0
            sentence = np.cumsum(stop)[word]
            starts = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
            z = np.clip(np.add.reduceat(sums[word], starts) + bias, -30, 30)
            miss = np.maximum(np.logaddexp(0, z) - floor, 0).sum() + np.logaddexp(0, leak)
            p, s = float(-np.expm1(-miss)), 1 / (1 + np.exp(-z))
            hits = []
            if (s >= at_least).any():
                places = [m.span() for m in parts.finditer(text)]
                last = np.append(starts[1:], len(word)) - 1
                for n in np.flatnonzero(s >= at_least):
                    a, b = places[word[starts[n]]][0], places[word[last[n]]][1]
                    hits.append({"start": a, "length": b - a, "score": float(s[n])})
            return p, hits

        return lambda texts: [{"score": p, "offending": hits} for p, hits in (one(t.decode()) for t in texts.to_pylist())]

    kind = "struct<score:double,offending:array<struct<start:int,length:int,score:double>>>"
    return docs.withColumn(column, arrow_column(docs, whole_text(text_col), kind, make))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score, by a model fitted on their labels, is below ``at_least``."""
    column = unused(docs, "toxicity")
    scored = score(docs, fit(training_rows(docs, labels, id_col, text_col), id_col), text_col, column=column)
    return scored.filter(F.col(f"{column}.score") < at_least).drop(column)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs, table(spark, sf_dir, "labels")))
    scored = score(docs, model).select("doc_id", "toxicity.*")
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"), "offending",
    )
