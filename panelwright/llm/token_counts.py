"""Exact token counts by heap-and-linked-list byte-pair merging, without emitting identifiers."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import vocabulary
from panelwright.llm.common import arrow_map, whole_text

#: How byte-level vocabularies cut a text before merging (fixed by the vocabulary's library).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Counts of so many short pieces are remembered by a worker; then it starts anew. Results do not depend on it.
REMEMBERED, SHORT = 400_000, 48


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Initial symbols minus merges: the lowest-rank adjacent pair, leftmost first, until none is left.

    A heap holds candidate pairs by rank and place, and two arrays link each symbol to its
    neighbours; a candidate whose symbols have changed since is passed over.
    """
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(p)) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, i, (a, b) = heappop(heap)
        j = right[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        merges += 1
        symbols[i], symbols[j] = a + b, ""
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get(p := (a + b, symbols[k]))) is not None:
                heappush(heap, (r, i, p))
        if (h := left[i]) >= 0 and (r := ranks.get(p := (symbols[h], a + b))) is not None:
            heappush(heap, (r, h, p))
    return n - merges


def _counter(path: str):
    def make():
        import regex

        spec = vocabulary.read(path)
        letters = vocabulary.byte_letters()
        ranks = {tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
        cut = regex.compile(PIECES).findall
        special = sorted(map(regex.escape, vocabulary.specials(spec)), key=len, reverse=True)
        apart = regex.compile("|".join(special)).split if special else lambda text: [text]

        class Counts(dict):
            def __missing__(self, piece: str) -> int:
                n = merged_count([letters[b] for b in piece.encode()], ranks)
                if len(piece) <= SHORT:
                    if len(self) >= REMEMBERED:
                        self.clear()
                    self[piece] = n
                return n

        count = Counts().__getitem__

        def tokens(text: str) -> int:
            parts = apart(text)
            return len(parts) - 1 + sum(sum(map(count, cut(part))) for part in parts)

        def step(ids, texts):
            texts = texts.to_pylist()
            return [ids, [len(t) for t in texts], [tokens(t.decode()) for t in texts]]

        return step

    return make


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 1024
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of whole texts under a byte-level vocabulary file.

    Special strings inside a text are one token each; nothing is added at the ends. A null
    text counts as empty: 0 bytes, 0 tokens. Every row gives a row, repeated rows and null
    ids included; other columns are left out. ``path`` must be readable on the executors.
    """
    path = path or vocabulary.default_path("byte_bpe_50k.json")
    kind = dict(docs.dtypes)[id_col]
    counted = arrow_map(docs, [F.col(id_col), whole_text(text_col)], f"`{id_col}` {kind}, n_bytes long, n_tokens long", _counter(path))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    return token_counts(table(spark, sf_dir, "documents"))
