"""Phrase collocations by best-first branch and bound: a frontier of prefixes grows until each language's best are settled."""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_map, unused, whole_text, written

#: Words of the longest phrase, occurrences of a candidate, percent of them at which a longer one covers it, rows a language, scale of scores.
LONGEST, LEAST, COVER, TOP, SCALE = 4, 30, 80, 2000, 1_000_000
#: The first round's bound is the score of the pair of this rank, as a multiple of the rows wanted; it grows by the factor, and after so many rounds all is open.
AHEAD, FACTOR, ROUNDS = 2, 8, 2
#: Bits of a set of phrases that tasks look up: its size never grows, more phrases only let more of the others through.
SET_BITS = 1 << 25
#: Bytes of text whose phrases are counted together.
BLOCK = 1 << 22
#: A-Z in lower case, a tab as a blank, ends of pieces as line ends.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


class _Numbers(dict):
    """Numbers of words in the order they are met; the empty word is -2 and the end of a piece -1."""

    def __init__(self):
        self.update({b"": -2, b"\n": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n


class _Runs:
    """Runs of words of a block of one language: numbers of the runs at each place, and their words."""

    def __init__(self, language: bytes, texts: list[bytes], skip: int = 0):
        import numpy as np

        numbers = _Numbers()
        words = b" \n ".join(texts).replace(b"\n", b" \n ").split(b" ")
        at = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        self.places = at[at != -2]
        self.skip = skip  # so many words at the beginning were counted with what precedes them
        self.words = list(numbers)[2:]
        self.spaced = [b" " + w for w in self.words]
        self.sums = list(map(crc32, self.words, repeat(crc32(language + b"\t"))))

    def level(self, left, usable, k: int):
        """Runs of ``k`` words made of a run of ``k - 1`` at ``left`` and the next word, where ``usable``.

        Gives numbers by place (-1 for none), and of each run the number of its first part,
        its last word and one of its places.
        """
        import numpy as np

        here = np.flatnonzero(usable[: max(0, len(self.places) - k + 1)])
        size = max(1, len(self.words))
        keys, inverse = np.unique(left[here] * size + self.places[here + k - 1], return_inverse=True)
        numbers, place = np.full(len(self.places), -1, np.int64), np.zeros(len(keys), np.int64)
        numbers[here], place[inverse] = inverse, here
        return numbers, keys // size, keys % size, place

    def sums_of(self, part, last, sums: list[int]) -> list[int]:
        """Checksums of runs, from those of their first parts."""
        return list(map(crc32, map(self.spaced.__getitem__, last.tolist()), map(sums.__getitem__, part.tolist())))

    def names_at(self, places, k: int) -> list[bytes]:
        """The runs of ``k`` words at some places."""
        columns = [map(self.words.__getitem__, self.places[places].tolist())]
        columns += [map(self.spaced.__getitem__, self.places[places + j].tolist()) for j in range(1, k)]
        return list(map(b"".join, zip(*columns)))

    def emitted(self, numbers, place, k: int, chosen=None):
        """(names, occurrences not counted before) of the runs of a level, or of the chosen ones of them."""
        import numpy as np

        fresh = numbers[max(0, self.skip - k + 1) :]
        counts = np.bincount(fresh[fresh >= 0], minlength=len(place))
        some = np.flatnonzero(counts > 0 if chosen is None else (counts > 0) & chosen)
        return self.names_at(place[some], k), counts[some]


def _is_in(bits, sums):
    """Whether each checksum is in a set, with one False more, so that place -1 is in none."""
    import numpy as np

    at = np.array(sums, np.uint32).astype(np.int64) & (len(bits) * 8 - 1)
    return np.append((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool), False)


def _next(flags):
    """The flag of the place after each one."""
    import numpy as np

    return np.append(flags[1:], False)


def _count_words(runs: _Runs, sets: dict) -> list:
    import numpy as np

    counts = np.bincount(runs.places[runs.skip :][runs.places[runs.skip :] >= 0], minlength=len(runs.words))
    some = np.flatnonzero(counts)
    return [([runs.words[i] for i in some.tolist()], counts[some])]


def _count_pairs(runs: _Runs, sets: dict) -> list:
    import numpy as np

    often = _is_in(sets["words"], runs.sums)[runs.places]
    here = np.flatnonzero((often & _next(often))[: len(runs.places) - 1])
    here, size = here[here >= runs.skip - 1], max(1, len(runs.words))
    keys, counts = np.unique(runs.places[here] * size + runs.places[here + 1], return_counts=True)
    first, second = map(runs.words.__getitem__, (keys // size).tolist()), map(runs.spaced.__getitem__, (keys % size).tolist())
    return [(list(map(bytes.__add__, first, second)), counts)]


def _frequent_pairs(runs: _Runs, sets: dict):
    """Numbers of frequent pairs by place (-1 for none), and the checksums of all pairs."""
    import numpy as np

    often = _is_in(sets["words"], runs.sums)[runs.places]
    pairs, part, last, _ = runs.level(runs.places, often & _next(often), 2)
    sums = runs.sums_of(part, last, runs.sums)
    return np.where(_is_in(sets["pairs"], sums)[pairs], pairs, -1), sums


def _count_longer(runs: _Runs, sets: dict) -> list:
    """Runs of three words that grow from an open pair or may cover a contender, and runs of four from an open pair at their first or second word."""
    pairs, sums = _frequent_pairs(runs, sets)
    opened, contends = _is_in(sets["open"], sums)[pairs], _is_in(sets["contenders"], sums)[pairs]
    both = (pairs >= 0) & _next(pairs >= 0)
    grown = opened | _next(contends)
    triples, _, _, place = runs.level(pairs, both & (grown | _next(opened)), 3)
    fours, _, _, place4 = runs.level(triples, (triples >= 0) & _next(both) & (opened | _next(opened)), 4)
    return [runs.emitted(triples, place, 3, grown[place]), runs.emitted(fours, place4, 4)]


def _count_wanted(runs: _Runs, sets: dict) -> list:
    pairs, sums = _frequent_pairs(runs, sets)
    heads = _is_in(sets["heads"], sums)[pairs]
    triples, part, last, place = runs.level(pairs, heads & _next(pairs >= 0), 3)
    return [runs.emitted(triples, place, 3, _is_in(sets["wanted"], runs.sums_of(part, last, sums))[:-1])]


def _counter(count, sets: dict):
    def make():
        import numpy as np
        import pyarrow as pa

        held: dict[bytes, list[bytes]] = {}
        size, bits = 0, {name: np.frombuffer(sent.value, np.uint8) for name, sent in sets.items()}

        def rows(language: bytes, texts: list[bytes], skip: int = 0) -> list:
            found = [x for x in count(_Runs(language, texts, skip), bits) if len(x[0])]
            return [(pa.repeat(pa.scalar(language.decode()), len(names)), pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts)) for names, counts in found]

        def flush() -> list:
            nonlocal size
            found = [r for language, texts in held.items() for r in rows(language, texts)]
            held.clear()
            size = 0
            return found

        def long(language: bytes, text: bytes) -> list:
            """A text above the block's size in slices that end at a blank; the last words of a slice lead the next one."""
            found, a, lead = [], 0, []
            while a < len(text):
                b = text.find(b" ", a + BLOCK)
                b = len(text) if b < 0 else b
                part = b" ".join([*lead, text[a:b]])
                found += rows(language, [part], len(lead))
                lead, a = [w for w in part.replace(b"\n", b" \n ").split(b" ") if w][-(LONGEST - 1) :], b
            return found

        def joined(found: list) -> list:
            return [pa.concat_arrays(c) for c in zip(*found)] or [[], [], []]

        def step(languages, texts):
            nonlocal size
            found = []
            for language, text in zip(languages.to_pylist(), texts.to_pylist()):
                text = text.translate(LETTERS)
                if len(text) > BLOCK:
                    found += long(language, text)
                    continue
                held.setdefault(language, []).append(text)
                size += len(text)
                if size >= BLOCK:
                    found += flush()
            return joined(found)

        step.end = lambda: joined(flush())
        return step

    return make


def _counted(docs: DataFrame, count, sets: dict[str, bytes], least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases that a counter gives, n being ``least`` or more; a task sends on a row a phrase and block at most."""
    context = docs.sparkSession.sparkContext
    sent = {name: context.broadcast(bits) for name, bits in sets.items()}
    found = arrow_map(docs, ["_lang", "_text"], "lang string, phrase string, n long", _counter(count, sent))
    return written(found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _set(phrases: DataFrame) -> bytes:
    """A set of phrases as one bit for each checksum modulo ``SET_BITS``; at most those bits reach the driver."""
    at = F.crc32(F.concat_ws("\t", "lang", "phrase").cast("binary")) % SET_BITS
    width = min(SET_BITS, 32768)
    rows = phrases.select(at.alias("_at")).groupBy(F.floor(F.col("_at") / width).alias("part")).agg(F.bitmap_construct_agg(F.col("_at") % width).alias("bits"))
    found = bytearray(SET_BITS // 8)
    for r in rows.collect():
        found[r.part * width // 8 : (r.part + 1) * width // 8] = r.bits[: width // 8]
    return bytes(found)


def _score(a: str | Column, total: Column) -> Column:
    """2 * SCALE * a / total, rounded down, in whole numbers wider than 64 bits."""
    wide = F.lit(2 * SCALE).cast("decimal(10,0)") * F.col(a).cast("decimal(19,0)")
    return F.call_function("div", wide, total.cast("decimal(19,0)"))


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, sure) of phrases: the lowest-scoring cut, ties to the shortest first part.

    ``counts`` (lang, phrase, n) has all first parts. Where a rest is missing, its count is
    taken as ``a``, the least it can be: the score is then a bound, and ``sure`` is false.
    """
    words = F.split("phrase", " ")
    joined = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cut = F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("_k")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), cut)
    cuts = cuts.withColumns({"_left": joined(F.lit(1), F.col("_k")), "_right": joined(F.col("_k") + 1, F.size(words))})
    left = counts.select("lang", F.col("phrase").alias("_left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_right"), F.col("n").alias("_r"))
    both = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"], "left")
    valued = both.withColumn("r", F.coalesce("_r", "a")).withColumn("_s", _score("a", F.col("l") + F.col("r")))
    best = valued.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("_s", "_k", "l", "r")).alias("_best"), F.bool_and(F.col("_r").isNotNull()).alias("sure")
    )
    return best.select("lang", "phrase", "a", "_best.l", "_best.r", F.col("_best._s").alias("score"), "sure")


def covered(candidates: DataFrame, longer: DataFrame, cover: int = COVER) -> DataFrame:
    """``candidates`` that no phrase of one word more holds in ``cover`` percent of their occurrences.

    Longer ones need no look: a phrase that holds a candidate so often is no more frequent
    than the one between them, which holds it too.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(words, 1, F.size(words) - 1), " "), F.array_join(F.slice(words, F.lit(2), F.size(words)), " "))
    most = longer.select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("_most"))
    wide = lambda c, k: F.col(c).cast("decimal(19,0)") * k
    kept = F.col("_most").isNull() | (wide("_most", 100) < wide("a", cover))
    return candidates.join(most, ["lang", "phrase"], "left").filter(kept).drop("_most")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, least: int = LEAST, cover: int = COVER
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of each language.

    A phrase's score cannot pass that of its first part cut after the first word with the
    rest as frequent as the part itself: 2 * f(part) / (f(first word) + f(part)). All
    pairs of frequent words are counted, then those whose bound reaches the language's
    current mark are grown in one pass for the whole frontier; one more pass counts the
    rests of the longer ones. A language is settled when ``top`` surviving phrases reach
    its mark: whatever was not grown scores less. For the others the mark is lowered, so
    the best parts grow first, and phrases that tie with the last one have been met.

    Null and empty texts have no phrase, a null language is ``und``, a language without
    candidates has no row, repeated rows count again, other columns are left out; an empty
    table gives an empty one.
    """
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).cast("binary").alias("_lang"), whole_text(text_col))
    all_words = _counted(docs, _count_words, {}, 1)
    total = all_words.groupBy("lang").agg(F.sum("n").alias("n_words"))
    words = all_words.filter(F.col("n") >= least)
    sets = {"words": _set(words)}
    pairs = _counted(docs, _count_pairs, sets, least)
    sets["pairs"] = _set(pairs)
    first_word = words.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("_f"))
    bounded = scored(pairs, words).withColumn("_first", F.substring_index("phrase", " ", 1)).join(first_word, ["lang", "_first"])
    bounded = written(bounded.select("lang", "phrase", "a", "l", "r", "score", _score("a", F.col("_f") + F.col("a")).alias("bound")))
    ranked = bounded.withColumn("_n", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), "phrase")))
    waiting, done, reach = pairs.select("lang").distinct(), None, AHEAD * top
    for last in [*[False] * ROUNDS, True]:
        marks = ranked.filter(F.col("_n") == (0 if last else reach)).select("lang", "score")
        marks = waiting.join(marks, "lang", "left").select("lang", F.coalesce("score", F.lit(0)).alias("mark"))
        marks = written(marks)
        frontier = bounded.join(marks, "lang")
        sets |= {"open": _set(frontier.filter("bound >= mark")), "contenders": _set(frontier.filter("score >= mark"))}
        longer = _counted(docs, _count_longer, sets, least)
        three, four = longer.filter(F.size(F.split("phrase", " ")) == 3), longer.filter(F.size(F.split("phrase", " ")) == 4)
        known = words.unionByName(pairs).unionByName(three)
        unsure = scored(four, known).join(marks, "lang").filter("not sure and score >= mark")
        rests = written(unsure.select("lang", F.substring_index("phrase", " ", -3).alias("phrase")).distinct())
        if not rests.isEmpty():
            found = _counted(docs, _count_wanted, sets | {"wanted": _set(rests), "heads": _set(rests.select("lang", F.substring_index("phrase", " ", 2).alias("phrase")))}, least)
            known = known.unionByName(found.join(rests, ["lang", "phrase"], "left_semi"))
        reaching = scored(longer, known).unionByName(bounded.select("lang", "phrase", "a", "l", "r", "score", F.lit(True).alias("sure")))
        reaching = reaching.join(marks, "lang").filter("score >= mark")
        kept = covered(reaching.drop("sure"), longer, cover)
        kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
        kept = written(kept)
        full = kept.groupBy("lang").agg(F.max("rank").alias("_rows"))
        settled = marks.join(full, "lang", "left").filter((F.col("mark") == 0) | (F.coalesce("_rows", F.lit(0)) >= top)).select("lang")
        ready = kept.join(settled, "lang", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        waiting = written(waiting.join(settled, "lang", "left_anti"))
        reach *= FACTOR
        if waiting.isEmpty():
            break
    long = lambda c: F.col(c).cast("long").alias(c)
    return done.join(total, "lang").select("lang", long("rank"), "phrase", long("a"), long("l"), long("r"), F.col("n_words").alias("n"), long("score"))


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), runs AS (
    SELECT lang, w[i : i + k - 1] AS g FROM starts, range(1, 5) AS t(k) WHERE i + k - 1 <= len(w)
), grams AS (
    SELECT lang, g, count(*) AS n FROM runs GROUP BY ALL
), totals AS (
    SELECT lang, sum(n)::BIGINT AS n FROM grams WHERE len(g) = 1 GROUP BY lang
), candidates AS (
    SELECT lang, g, n AS a FROM grams WHERE len(g) > 1 AND n >= 30
), cuts AS (
    SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates
), valued AS (
    SELECT c.lang, c.g, c.a, c.k, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n + y.n) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : c.k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.k + 1 : len(c.g)]
), best AS (
    SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), held AS (
    SELECT lang, inner_g, max(a) AS most FROM (
        SELECT lang, a, g[i : i + k - 1] AS inner_g FROM candidates, range(1, 4) AS s(i), range(2, 4) AS t(k) WHERE i + k - 1 <= len(g) AND k < len(g)
    ) GROUP BY ALL
), kept AS (
    SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.inner_g = b.g
    WHERE h.most IS NULL OR 100::HUGEINT * h.most < 80::HUGEINT * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
