"""Near-duplicates by SimHash: pigeonhole blocks, a join on blocks, Hamming checks, components."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_map, settled, whole_text, written
from panelwright.llm.components import components

BITS = 64
#: Members of a block that are compared pair by pair; a larger block is linked through shared neighbours.
PAIRWISE = 64


def _signer(words: int, seed: int):
    def make():
        import numpy as np
        import xxhash

        digest = xxhash.xxh64_intdigest

        def sign(text: bytes) -> int:
            tokens = text.lower().split()  # ASCII letters and ASCII white space only, as these are bytes
            if not tokens:
                return 0
            join, n = b" ".join, max(1, len(tokens) - words + 1)
            hashes = np.fromiter((digest(join(tokens[i : i + words]), seed) for i in range(n)), np.uint64, n)
            # 255 rows of 64 one-byte counters are summed eight counters at a time.
            bits = np.zeros((-(-n // 255) * 255, BITS), np.uint8)
            bits[:n] = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
            sums = bits.view(np.uint64).reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64)
            ones = sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])

        return lambda ids, texts: [ids, [sign(t) for t in texts.to_pylist()]]

    return make


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(id, fingerprint long): a bit is 1 if it is 1 in over half of the shingles' XXH64.

    Whole texts; A-Z is lower-cased, words end at ASCII white space. A text of fewer words
    is one shingle; a null, empty or blank text has fingerprint 0. Every row gives a row,
    repeated rows and null ids included; other columns are left out.
    """
    kind = dict(docs.dtypes)[id_col]
    return arrow_map(docs, [F.col(id_col), whole_text(text_col)], f"`{id_col}` {kind}, fingerprint long", _signer(words, seed))


def signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def block_masks(max_distance: int) -> list[int]:
    """Masks of block sets: of ``max_distance + 3`` blocks, any three.

    Fingerprints that differ in at most ``max_distance`` bits differ in as many blocks at
    most, so they agree on three whole blocks at least.
    """
    n = max_distance + 3
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, 3)]
    return [signed(m) for m in masks]


def _close(a: str, b: str, d: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= d


def links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints at most ``max_distance`` (an even number) bits apart.

    Distinct fingerprints are dealt out by their block sets; members of a block are joined
    and their distance verified. In a block of more than ``PAIRWISE`` members, where pairs
    would grow with the square, each member meets its neighbours instead: it emits itself
    with up to half that many of the block's free bits flipped, and all members that share
    such a value are linked to the least of them. Two members within the distance share a
    value half-way, and members that share one are within the distance, so the components
    are exactly those of all pairs; the rows grow with the members only.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even")
    masks = block_masks(max_distance)
    distinct = prints.select("fingerprint").filter("fingerprint is not null").distinct()
    dealt = distinct.select(
        "fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("set", "block")
    )
    size = dealt.groupBy("set", "block").agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("u"), F.max("fingerprint").alias("v"))
    size = settled(size.filter("n > 1"))
    twos = size.filter("n = 2").filter(_close("u", "v", max_distance)).select("u", "v")

    def members(of: DataFrame) -> DataFrame:
        return dealt.join(of.select("set", "block"), ["set", "block"])

    some = members(size.filter(f"n between 3 and {PAIRWISE}"))
    pairs = (
        some.withColumnRenamed("fingerprint", "u").join(some.withColumnRenamed("fingerprint", "v"), ["set", "block"])
        .filter((F.col("u") < F.col("v")) & _close("u", "v", max_distance)).select("u", "v")
    )
    mask = F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("set") + 1)
    many = members(size.filter(f"n > {PAIRWISE}")).withColumn("near", F.col("fingerprint"))
    for _ in range(max_distance // 2):
        flips = F.filter(F.array(*[F.lit(signed(1 << i)) for i in range(BITS)]), lambda bit: bit.bitwiseAND(mask) == 0)
        many = many.withColumn("near", F.explode(F.concat(F.array("near"), F.transform(flips, lambda bit: F.col("near").bitwiseXOR(bit)))))
    hub = many.groupBy("set", "block", "near").agg(F.min("fingerprint").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("set", "block", "near", "v")
    stars = many.join(hub, ["set", "block", "near"]).filter("fingerprint <> v").select(F.col("fingerprint").alias("u"), "v")
    return twos.unionByName(pairs).unionByName(stars).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, max_distance: int = 2
) -> DataFrame:
    """(id, fingerprint long, component_id): the least id reachable over links, its own included.

    Equal fingerprints are one class, so copies are never paired; classes are linked and
    the class of a document is joined on. Rows with a null id keep their row and join
    their class, but never name it: a component of null ids only has a null id.
    """
    prints = settled(fingerprints(docs, id_col, text_col, words, seed))
    classes = prints.groupBy("fingerprint").agg(F.min(id_col).alias("_least"))
    roots = components(links(prints, max_distance))
    rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select("fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    labels = rooted.join(named, "_root").select("fingerprint", "component_id")
    return prints.join(labels, "fingerprint").select(id_col, "fingerprint", "component_id")


def keep_least(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component of ``found`` (id, component_id): that of the least id.

    Where several rows have that id, one of them stays. Rows with a null id stay, as
    nothing names them. The ids that go, and those that are repeated, are written as tables
    first: Spark then knows their size and leaves the rows where they are if it is small.
    """
    losers = found.filter(F.col(id_col) != F.col("component_id")).select(id_col)
    again = written(found.filter(F.col(id_col) == F.col("component_id")).groupBy(id_col).count().filter("count > 1").select(id_col))
    gone = written(losers.union(again).distinct())
    single = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    return single.unionByName(docs.join(again, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id."""
    return keep_least(docs, settled(near_duplicates(docs, id_col, text_col, **options)), id_col)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
