"""Document fingerprints from improbable features: rare byte windows in chained Bloom filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_map, importable, whole_text

#: Bytes of a window, windows of a run, and runs a window must win to be a feature.
WINDOW, RUN, WINS = 32, 32, 8
#: Bytes of a short window; texts with fewer features than ``ZONE`` have their short windows in filters of their own, and
#: two texts are compared by these if one of them has fewer than ``FEW`` and both have them.
SHORT, FEW, ZONE = 4, 16, 32
#: Entropy steps, bits of a filter, bits per feature, features of a filter.
STEPS, BITS, HASHES, FILL = 1000, 2048, 5, 160
#: Share of the way from the overlap expected by chance to the highest possible one that counts as no likeness.
CUTOFF = 0.15
#: Bytes worked on at once.
CHUNK = 1 << 20


def entropy_steps(data):
    """The Shannon entropy of every window, in steps of 0 to 1000; whole-number sums, so equal windows agree.

    Moving on by a byte changes the counts of two byte values: that of the leaving byte,
    one more than its equals among the other bytes of the window, and that of the entering one.
    """
    import numpy as np

    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    c = np.arange(1, WINDOW + 1)
    total = np.append(0, np.round(c * np.log2(c) * (1 << 20))).astype(np.int64)
    gain = np.append(0, np.diff(total))
    first = total[np.bincount(data[:WINDOW], minlength=256)].sum()
    change = gain[1 + before[WINDOW:].astype(np.intp)] - gain[1 + after[: n - 1].astype(np.intp)]
    sums = first + np.append(0, np.cumsum(change))
    top = total[WINDOW]
    return ((top - sums) * STEPS + top // 2) // top


def chunks(ends, span: int):
    """(a, b, to the end of its text) of slices of the joined texts that overlap by ``span`` bytes."""
    import numpy as np

    total = int(ends[-1]) if len(ends) else 0
    for a in range(0, total, CHUNK):
        b = min(a + CHUNK + span, total)
        k = np.searchsorted(ends, [a, b - 1], side="right")
        inside = ends[k[0] : k[1] + 1]
        sizes = np.diff(np.append(a, np.minimum(inside, b)))
        yield a, b, np.repeat(inside, sizes) - np.arange(a, b)


def rarity(docs: DataFrame, text_col: str = "text") -> list[int]:
    """The rank of each entropy step, the rarest first, by its windows in all texts of the table."""
    importable(docs.sparkSession)

    def make():
        import numpy as np
        import pyarrow as pa

        def step(texts):
            raw = texts.to_pylist()
            data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(t) for t in raw])
            count = np.zeros(STEPS + 1, np.int64)
            for a, b, left in chunks(ends, WINDOW - 1):
                steps = entropy_steps(data[a:b])[:CHUNK]
                count += np.bincount(steps[left[: len(steps)] >= WINDOW], minlength=STEPS + 1)
            at = np.flatnonzero(count)
            return [pa.array(at, pa.int32()), pa.array(count[at], pa.int64())]

        return step

    found = arrow_map(docs, [whole_text(text_col)], "step int, n long", make).groupBy("step").agg(F.sum("n").alias("n"))
    count = [0] * (STEPS + 1)
    for r in found.collect():  # a row for each entropy step at most
        count[r.step] = r.n
    order = sorted(range(STEPS + 1), key=lambda s: (count[s], s))
    rank = [0] * (STEPS + 1)
    for place, s in enumerate(order):
        rank[s] = place
    return rank


def _filters(owner, h, n: int) -> list[tuple]:
    """(filters as rows of 32 64-bit words, features in each) of each of ``n`` texts, from hashes in order of their owners."""
    import numpy as np

    count = np.bincount(owner, minlength=n)
    base, first = np.append(0, np.cumsum(-(-count // FILL))), np.append(0, np.cumsum(count))
    at = base[owner] + (np.arange(len(owner)) - first[owner]) // FILL
    bits = np.zeros(int(base[-1]) * BITS, np.uint8)
    for j in range(HASHES):
        bits[at * BITS + (h >> np.uint64(11 * j) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    words = np.packbits(bits).view(np.uint64).reshape(-1, BITS // 64)
    held = np.bincount(at, minlength=int(base[-1]))
    return [(words[a:b], held[a:b]) for a, b in zip(base, base[1:])]


def short_features(text: bytes):
    """Hashes of the distinct short windows of a text, in ascending order of the windows as numbers; of a shorter text, of the whole."""
    import numpy as np

    if len(text) < SHORT:
        windows = np.array([int.from_bytes(text, "little") | len(text) << 32], np.uint64)
    else:
        data = np.frombuffer(text, np.uint8).astype(np.uint32)
        n = len(data) - SHORT + 1
        windows = np.unique(data[:n] | data[1 : n + 1] << 8 | data[2 : n + 2] << 16 | data[3 : n + 3] << 24).astype(np.uint64)
    h = windows ^ np.uint64(0x9E3779B97F4A7C15)
    for _ in range(2):
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def digests(texts: list[bytes], rank) -> list[tuple]:
    """(chain, short chain) of whole texts; a chain is (filters, features in each), filters as rows of 32 64-bit words.

    In every run of windows the leftmost of lowest rank wins; a window that wins ``WINS``
    runs is a feature. Features go in text order into a filter until it holds ``FILL``, then
    into the next. In a text of fewer than ``ZONE`` features, being short or uniform, each
    distinct window of 4 bytes, or the whole of a shorter text, is a feature of the short
    chain; other texts and empty ones have an empty short chain.
    """
    import numpy as np

    sizes = np.array([len(t) for t in texts], np.int64)
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes)
    wins = np.zeros(len(data), np.uint8)
    for a, b, left in chunks(ends, WINDOW + RUN - 2):
        steps = entropy_steps(data[a:b])
        n = len(steps)
        if n < RUN:
            continue
        key = (rank[steps] << 21 | np.arange(n)).astype(np.int32)
        width = 1
        while width < RUN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        runs = np.flatnonzero(left[: min(len(key), CHUNK)] >= WINDOW + RUN - 1)
        wins[a : a + n] += np.bincount(key[runs] & (1 << 21) - 1, minlength=n).astype(np.uint8)
    place = np.flatnonzero(wins >= WINS)
    h = np.full(len(place), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(0, len(place), CHUNK // WINDOW):
        part = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[place[j : j + CHUNK // WINDOW]]
        for word in np.ascontiguousarray(part).view(np.uint64).T:
            mixed = (h[j : j + len(part)] ^ word) * np.uint64(0xFF51AFD7ED558CCD)
            h[j : j + len(part)] = mixed ^ mixed >> np.uint64(32)
    owner = np.searchsorted(ends, place, side="right")
    bare = np.flatnonzero((np.bincount(owner, minlength=len(texts)) < ZONE) & (sizes > 0))
    small = [short_features(texts[i]) for i in bare]
    short = np.concatenate(small) if small else np.zeros(0, np.uint64)
    return list(zip(_filters(owner, h, len(texts)), _filters(np.repeat(bare, [len(s) for s in small]).astype(np.int64), short, len(texts))))


def text_form(digest) -> str:
    """A digest as text: for each chain the features of its last filter, a colon, and its filters in base 64; a semicolon between."""
    from base64 import b64encode

    return ";".join(f"{held[-1] if len(held) else 0}:{b64encode(words.tobytes()).decode()}" for words, held in digest)


def chain_likeness(one, other) -> float:
    """0 to 1: the mean, over the chain with fewer filters, of each filter's best normalised bit overlap; 0 if one is empty.

    What two filters of their numbers of bits share by chance counts as none, so a window
    that a text repeats counts once.
    """
    import numpy as np

    f, g = sorted((one[0], other[0]), key=len)
    if not len(f):
        return 0.0
    total = 0.0
    g_bits, block = np.bitwise_count(g).sum(1, dtype=np.int64), max(1, 4096 // max(1, len(g)))
    for a in range(0, len(f), block):
        part = f[a : a + block]
        common = np.bitwise_count(part[:, None] & g[None]).sum(2, dtype=np.int64)
        f_bits = np.bitwise_count(part).sum(1, dtype=np.int64)[:, None]
        most, chance = np.minimum(f_bits, g_bits), f_bits * g_bits / BITS
        least = chance + CUTOFF * np.maximum(most - chance, 0)
        total += np.clip((common - least) / np.maximum(most - least, 1e-9), 0, 1).max(1).sum()
    return float(total / len(f))


def likeness(one, other) -> float:
    """0 to 1, of chains of the same kind on both sides: the short ones if a text has few features and both have them.

    Both digests empty: 1; one of them: 0.
    """
    empty = [not len(d[0][0]) and not len(d[1][0]) for d in (one, other)]
    if any(empty):
        return float(all(empty))
    few = min(int(d[0][1].sum()) for d in (one, other)) < FEW
    kind = 1 if few and len(one[1][0]) and len(other[1][0]) else 0
    return chain_likeness(one[kind], other[kind])


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt into id ranges, each followed by the first row of the next one: (_b, _tail, _o, id, _text), sorted.

    The ranges are set by the least ids of quantile ranges, one for each; those rows alone
    go to two ranges, so a text is shuffled once.
    """
    spark = docs.sparkSession
    placed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_o"), F.col(id_col), whole_text(text_col))
    n = min(4096, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(placed.approxQuantile("_o", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []

    def below(bounds):
        return F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("_o"))) if bounds else F.lit(0)

    least = placed.groupBy(below(cuts).alias("_b")).agg(F.min("_o").alias("_o"))
    heads = sorted(r[0] for r in least.select("_o").collect())  # a row for each range
    bucket = below(heads)
    head = F.array_contains(F.array(*[F.lit(h) for h in heads]), F.col("_o")) if heads else F.lit(False)
    to = F.when(head, F.array(bucket, F.when(bucket > 1, bucket - 1).otherwise(F.lit(len(heads))))).otherwise(F.array(bucket))
    dealt = placed.select("*", F.posexplode(to).alias("_tail", "_b"))
    return dealt.repartition(max(1, len(heads)), "_b").sortWithinPartitions("_b", "_tail", "_o", "_text").select("_b", "_tail", id_col, "_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / 2) code points replaced by as many from the
    start of the next document by id (after the last, the first), or all of them. Whole
    texts; a null text counts as empty. Null ids come first, rows that share an id follow
    their text. The rarity of entropies is counted over the whole table, so fingerprints
    compare within a table. Every row gives a row; other columns are left out.
    """
    rank = rarity(docs, text_col)
    ordered = in_order(docs, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]

    def make():
        from hashlib import sha256

        import numpy as np

        ranks, pending = np.array(rank, np.int64), None

        def step(buckets, tails, ids, texts):
            nonlocal pending
            # Each row with its text and digest; the last one waits for the next call.
            rows = [[b, t, i, x, None] for b, t, i, x in zip(*(c.to_pylist() for c in (buckets, tails, ids, texts)))]
            for row, digest in zip(rows, digests([r[3] for r in rows], ranks)):
                row[4] = digest
            pairs = []
            for row in rows:
                if pending is not None and pending[0] == row[0]:
                    pairs.append((pending, row))
                pending = None if row[1] else row
            edited = []
            for (_, _, _, x, _), (_, _, _, y, _) in pairs:
                x, y = x.decode(), y.decode()
                edited.append((len(x), (x[: len(x) - len(x) // 2] + y[: len(x) // 2]).encode()))
            out = [[] for _ in range(7)]
            for ((_, _, i, _, own), (*_, other)), (n, text), new in zip(pairs, edited, digests([t for _, t in edited], ranks)):
                row = (i, n, sha256(text).hexdigest(), text_form(own), text_form(new), likeness(own, new), likeness(own, other))
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return step

    schema = (
        f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return arrow_map(ordered, ["_b", "_tail", id_col, "_text"], schema, make, rows=64)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
