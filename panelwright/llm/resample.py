"""Importance resampling towards a target corpus: hashed word runs, bit-sliced weights, Gumbel keys."""

from __future__ import annotations

from math import floor, log
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_map, settled, unused, whole_text

#: Buckets of features, words of the longest run, words a document must have to be drawn, percent drawn, scale of gains and keys.
BUCKETS, RUN, LEAST_WORDS, PERCENT, SCALE = 10_000, 3, 20, 5, 1000
#: Bytes of a text worked on at once, and documents whose planes are made together.
CHUNK, TOGETHER = 1 << 20, 64
#: Bytes of words stay, A-Z in lower case; all others end a word.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def checksums(text: bytes):
    """CRC-32 of all runs of one to three words of a text, joined by blanks: pairs (number of words, list) a chunk.

    The checksum of a run goes on from that of the run without its last word, so each
    costs that word's bytes only; the last two runs are carried into the next chunk.
    """
    plain, at = text.translate(WORD_BYTES), 0
    tails: list[int] = []  # of the runs of one and two words that end with the last word
    while at < len(plain):
        end = plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        words = plain[at:end].split()
        at = end
        if not words:
            continue
        spaced = [b" " + w for w in words]
        runs = [list(map(crc32, words))]
        for k in range(RUN - 1):  # runs[k] ends with the last words of the chunk, one run a word
            left = tails[k : k + 1] + runs[k][:-1]
            runs.append(list(map(crc32, spaced[len(words) - len(left) :], left)))
        tails = [r[-1] for r in runs[: RUN - 1] if r]
        yield len(words), [c for r in runs for c in r]


def bucket_counts(text: bytes, buckets: int = BUCKETS):
    """(number of words, number of features, features in each bucket) of a text."""
    import numpy as np

    n_words, counts = 0, np.zeros(buckets, np.int64)
    for n, sums in checksums(text):
        n_words += n
        counts += np.bincount(np.array(sums, np.uint32) % buckets, minlength=buckets)
    return n_words, int(counts.sum()), counts


def _tally(buckets: int):
    def make():
        import numpy as np

        totals = np.zeros(buckets, np.int64)

        def step(texts):
            nonlocal totals
            for t in texts.to_pylist():
                totals += bucket_counts(t, buckets)[2]
            return [[], []]

        def end():
            at = np.flatnonzero(totals)
            return [at, totals[at]]

        step.end = end
        return step

    return make


def bucket_totals(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task sends on one row a bucket at most."""
    return arrow_map(df, [whole_text(text_col)], "bucket int, n long", _tally(buckets)).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket: the scaled log ratio of its smoothed shares in the target and in the documents, rounded down."""
    s = bucket_totals(docs, text_col, buckets).withColumnRenamed("n", "s")
    t = bucket_totals(target, text_col, buckets).withColumnRenamed("n", "t")
    both = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0)
    rows = both.select("bucket", "s", "t").collect()  # one a bucket: bounded by the parameter, whatever the input
    all_s, all_t = sum(r.s for r in rows), sum(r.t for r in rows)
    found = {r.bucket: floor(SCALE * log(float(r.t + 1) * float(all_s + buckets) / (float(r.s + 1) * float(all_t + buckets)))) for r in rows}
    return [found[b] for b in range(buckets)]


def packed_planes(values, width: int):
    """Bit planes of rows of whole numbers in two's complement of ``width`` bits, each as 64-bit words: plane, row, word."""
    import numpy as np

    wide = np.zeros((values.shape[0], -(-values.shape[1] // 64) * 64), np.int64)
    wide[:, : values.shape[1]] = values
    return [np.packbits((wide >> k & 1).astype(np.uint8), axis=1).view(np.uint64) for k in range(width)]


def bit_sliced_sums(counts, gain_planes):
    """Exact sums of counts times gains: AND of every count plane with every gain plane, popcounts, powers of two.

    ``gain_planes`` are those of one row; the last is the sign, which counts negatively.
    """
    import numpy as np

    sums = np.zeros(len(counts), np.int64)
    planes = packed_planes(counts, int(counts.max(initial=0)).bit_length())
    for p, rows in enumerate(planes):
        for g, (gain,) in enumerate(gain_planes):
            found = np.bitwise_count(rows & gain).sum(axis=1, dtype=np.int64) << (p + g)
            sums += -found if g == len(gain_planes) - 1 else found
    return sums


def _weigher(sent, buckets: int):
    def make():
        import numpy as np

        values = np.array(sent.value, np.int64)
        planes = packed_planes(values[None], int(np.abs(values).max(initial=0)).bit_length() + 1)

        def step(ids, texts):
            words, features, weights = [], [], []
            texts = texts.to_pylist()
            for a in range(0, len(texts), TOGETHER):
                part = [bucket_counts(t, buckets) for t in texts[a : a + TOGETHER]]
                words += [w for w, *_ in part]
                features += [f for _, f, _ in part]
                weights.append(bit_sliced_sums(np.stack([c for *_, c in part]), planes))
            return [ids, words, features, np.concatenate(weights) if weights else []]

        return step

    return make


def weights(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight long): the sum of gains over a text's features, 0 for none."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    kind = dict(docs.dtypes)[id_col]
    return arrow_map(docs, [F.col(id_col), whole_text(text_col)], f"`{id_col}` {kind}, n_words long, n_features long, weight long", _weigher(sent, len(gain)))


def keyed(weighted: DataFrame, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Adds ``score``: the weight and a Gumbel key from a hash of the id, so the highest scores are a draw without replacement."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return weighted.withColumn("score", F.col("weight") + F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / float(1 << 32)))))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank): a share of the documents drawn towards the target's distribution.

    Of the N documents of ``least_words`` words or more, the ``percent * N / 100`` of
    highest score have ranks 1, 2, 3, ..., equal scores by smaller id, null ids first; all
    others have none. Null and empty texts have no features and weight 0, as have all
    texts if both tables are empty. Every row gives a row: repeated rows are drawn each on
    their own, though with equal scores. Other columns are left out.
    """
    scored = settled(keyed(weights(docs, gains(docs, target, text_col), id_col, text_col), id_col, seed))
    drawn = scored.agg(F.floor(F.count_if(F.col("n_words") >= least_words) * percent / 100)).first()[0]
    late, place = unused(scored, "_late"), unused(scored, "_place")
    order = [F.col(late), F.desc("score"), F.col(id_col)]
    # Sorted ranges behind a checkpoint, so that sizes and places are those of the same ranges.
    spread = scored.withColumn(late, F.col("n_words") < least_words).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settled(spread.withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(place, 33)  # the number of the range; what is below is the place in it
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_n")).alias("_before"))  # a row a range
    rank = F.col("_before") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.join(F.broadcast(starts), part == F.col("_part"))
    return ranked.select(*scored.columns, F.when(rank <= drawn, rank).alias("rank"))


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
