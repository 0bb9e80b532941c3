"""Byte-pair encoding of many words at once by numpy merge rounds, and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import vocabulary
from panelwright.llm.common import arrow_map, whole_text

#: How the vocabulary's library cuts a normalised text into words (fixed).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Ids of so many short words are remembered by a worker; then it starts anew. Results do not depend on it.
REMEMBERED, SHORT = 300_000, 48


class Merges:
    """The merge table as sorted pair keys, searched by bisection."""

    def __init__(self, spec: dict):
        import numpy as np

        model = spec["model"]
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        ids = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in model["merges"]]
        first, second, made = np.array(ids, np.int64).T
        keys = first << 32 | second
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order, made[order]
        # Merging every occurrence of a word's lowest pair at once gives what one at a time gives
        # if no product takes part in an earlier merge than the one that makes it.
        last = np.full(max(self.vocab.values()) + 1, -1)
        np.maximum.at(last, made, np.arange(len(made)))
        self.ordered = bool((np.maximum(last[first], last[second]) < np.arange(len(made))).all())

    def apply(self, symbols, word):
        """Merge rounds over one flat array; ``word`` has the number of each symbol's word."""
        import numpy as np

        none = len(self.keys)
        done_symbols, done_words = [], []
        while len(symbols):
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), none - 1)
            hit = (self.keys[at] == keys) & (word[:-1] == word[1:])
            rank = np.append(np.where(hit, self.rank[at], none), none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(word)))
            # Words without a pair leave; the others go into the next round.
            if not (going := least < none).all():
                stays = np.repeat(going, size)
                done_symbols.append(symbols[~stays])
                done_words.append(word[~stays])
                symbols, word, rank = symbols[stays], word[stays], rank[stays]
                at = np.append(at, 0)[stays]
                least, size = least[going], size[going]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            best = rank == np.repeat(least, size)
            if self.ordered:
                # In a run such as a a a a, every second place starts a merge, from the left.
                place = np.flatnonzero(best)
                fresh = np.append(True, np.diff(place) > 1)
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - run) % 2 == 0]
            else:
                place = np.flatnonzero(best)
                place = place[np.append(True, word[place][1:] != word[place][:-1])]
            symbols[place] = self.made[at[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate([*done_symbols, symbols]), np.concatenate([*done_words, word])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def encode(self, words: list[str]) -> list:
        """The ids of each word, as int32 arrays."""
        import numpy as np

        letters = vocabulary.byte_letters()
        plain = np.array([self.vocab[c] for c in letters], np.int64)
        final = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw])
        codes = np.frombuffer(b"".join(raw), np.uint8)
        symbols = plain[codes]
        ends = np.cumsum(size) - 1
        symbols[ends] = final[codes[ends]]
        symbols, word = self.apply(symbols, np.repeat(np.arange(len(raw)), size))
        cuts = np.searchsorted(word, np.arange(1, len(raw)))
        return np.split(symbols.astype(np.int32), cuts)


def _encoder(path: str):
    def make():
        import unicodedata

        import numpy as np
        import pyarrow as pa
        import regex

        spec = vocabulary.read(path)
        merges, special = Merges(spec), vocabulary.specials(spec)
        cut, blank = regex.compile(WORDS).findall, regex.compile(r"\s+")
        apart = regex.compile("(" + "|".join(sorted(map(regex.escape, special), key=len, reverse=True)) + ")").split
        known: dict[str, bytes] = {}
        one = {s: np.array([i], np.int32).tobytes() for s, i in special.items()}

        def lower(text: str) -> str:
            # Letter by letter, so that a final sigma is no exception.
            return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))

        def words(text: str) -> list[str]:
            return cut(lower(blank.sub(" ", unicodedata.normalize("NFC", text))))

        def step(ids, texts):
            nonlocal known
            cuts = [[part if i % 2 else words(part) for i, part in enumerate(apart(t.decode()))] for t in texts.to_pylist()]
            seen = {w for parts in cuts for i, part in enumerate(parts) if i % 2 == 0 for w in part}
            if len(known) > REMEMBERED:
                known = {}
            fresh = [w for w in seen if w not in known]
            here = dict(zip(fresh, (a.tobytes() for a in merges.encode(fresh)))) if fresh else {}
            known |= {w: b for w, b in here.items() if len(w) <= SHORT}
            find = lambda w: known.get(w) or here[w]
            flat = [b"".join(one[part] if i % 2 else b"".join(map(find, part)) for i, part in enumerate(parts)) for parts in cuts]
            offsets = np.cumsum([0, *(len(b) // 4 for b in flat)]).astype(np.int32)
            return [ids, pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(flat), np.int32))]

        return step

    return make


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>): the ids of each whole text, none added at its ends, nothing cut or padded.

    Special strings inside a text are one id each. A null or empty text gives an empty
    array. Every row gives a row, repeated rows and null ids included; other columns are
    left out. ``path`` must be readable on the executors.
    """
    path = path or vocabulary.default_path("word_bpe_49k.json")
    kind = dict(docs.dtypes)[id_col]
    return arrow_map(docs, [F.col(id_col), whole_text(text_col)], f"`{id_col}` {kind}, ids array<int>", _encoder(path))


def _decoder(path: str):
    def make():
        spec = vocabulary.read(path)
        names = {i: s for s, i in (spec["model"]["vocab"] | vocabulary.specials(spec)).items()}

        def step(keys, ids):
            values, cuts = ids.values.to_numpy(), ids.offsets.to_numpy()
            rows = [values[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
            return [keys, ids, [" ".join([names[i] for i in row if i in names]) for row in rows]]

        return step

    return make


def _digester():
    from hashlib import sha256

    def step(keys, ids, texts):
        values, cuts = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        rows = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        texts = [t.encode() for t in (texts if isinstance(texts, list) else texts.to_pylist())]
        return [keys, [len(r) // 4 for r in rows], [sha256(r).hexdigest() for r in rows], [sha256(t).hexdigest() for t in texts]]

    return step


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def decode(encoded: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """(id, ids, text): the tokens of each row's ids, special ones too, joined by one blank.

    The vocabulary names no decoder, so its library gives the tokens as they are, word-end
    marks included. Null ids give an empty text; an id outside the vocabulary gives nothing.
    """
    path = path or vocabulary.default_path("word_bpe_49k.json")
    kind = dict(encoded.dtypes)[id_col]
    return arrow_map(encoded, [F.col(id_col), F.col("ids")], f"`{id_col}` {kind}, ids array<int>, text string", _decoder(path))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): texts encoded and decoded again in one pass.

    The digest of the ids takes them as little-endian 32-bit integers. Encoding and
    decoding follow each other in the same Python worker, so neither ids nor decoded texts
    travel between processes.
    """
    path = path or vocabulary.default_path("word_bpe_49k.json")

    def make():
        steps = [_encoder(path)(), _decoder(path)(), _digester()]

        def step(*columns):
            for one in steps:
                columns = one(*columns)
            return columns

        return step

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(docs, [F.col(id_col), whole_text(text_col)], f"`{id_col}` {kind}, {DIGESTS}", make)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    return round_trip(table(spark, sf_dir, "documents"))
