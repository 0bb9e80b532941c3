"""Fingerprints, near-duplicates, tokens and chat windows against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

pytest.importorskip("xxhash")

from panelwright.llm import bpe, chat, fingerprint, simhash, token_counts, vocabulary  # noqa: E402
from panelwright.llm.components import components  # noqa: E402

DOCS = "doc_id long, text string, _text string, fingerprint int"


def documents(spark, texts, start=0):
    """With columns whose names the operators use themselves."""
    rows = [(i + start if i >= 0 else None, t, "other", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n):
    return " ".join(rng.choice(("alpha", "beta", "Gamma", "delta", "eps")) + str(rng.randrange(40)) for _ in range(n))


def find(parent, a):
    while parent[a] != a:
        a = parent[a]
    return a


def plain_fingerprint(text):
    import xxhash

    tokens = (text or "").encode().lower().split()
    grams = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("pairwise", [2, 64])
def test_near_duplicates(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(5)
    base = words(rng, 400)
    texts = [None, "", " \t\n", "one", "One", "one two", base, base.upper(), base]
    for _ in range(40):  # near copies whose fingerprints differ in a few bits
        changed = base.split()
        changed[rng.randrange(400)] = "changed"
        texts.append(" ".join(changed))
    texts += [words(rng, 30) for _ in range(10)]
    docs = documents(spark, texts)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == [simhash.signed(p) for p in prints]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    assert [got[i][1] for i in range(len(texts))] == [find(parent, i) for i in range(len(texts))]
    kept = simhash.keep_one(docs.unionByName(docs.filter("doc_id < 9")))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(parent, i) for i in range(len(texts))})


def test_dense_block_is_linked_without_pairs(spark):
    """300 fingerprints within a few bits: the same components as from all pairs, through blocks above the limit."""
    rng = random.Random(9)
    prints = sorted({sum(1 << b for b in rng.sample(range(14), 4)) for _ in range(300)})
    found = components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint long")))
    roots = {r.node: r.root for r in found.collect()}
    parent = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2:
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    assert all(roots.get(p, p) == find(parent, p) for p in prints)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


ODD = [
    None, "", " ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|> C<|ENDOFTEXT|>", "ΑΣ ΣΑΣ. Σ\n\nİstanbul ﬁ", "a" * 3000, "ab" * 2000 + " " * 200,
    "日本語" * 300, "é Å \x1c \x85 x y", "'S 't It'LL we're 12345 ½ ²", "🙂🙂👍🏽", "don't DON'T  \t\t x", "\x00\x01", "the same", "the same",
]


def test_token_counts_and_encoding_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    rng = random.Random(1)
    letters = [*range(32, 0x250), *range(0x370, 0x400), *range(0x3041, 0x3090), *range(0x1F300, 0x1F600)]
    texts = ODD + ["".join(chr(rng.choice((rng.choice(letters), 32, 97, 115, 39))) for _ in range(200)) for _ in range(60)]
    docs = documents(spark, texts)
    count = {r.doc_id: r for r in token_counts.token_counts(docs, limit=100).collect()}
    library = tokenizers.Tokenizer.from_file(vocabulary.default_path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (count[i].n_bytes, count[i].n_tokens, count[i].over_limit) == (len((text or "").encode()), n, n > 100)
    library = tokenizers.Tokenizer.from_file(vocabulary.default_path("word_bpe_49k.json"))
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(docs)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i].ids == ids
        assert found[i].text == library.decode(ids, skip_special_tokens=False)
    for r in bpe.round_trip(docs).collect():
        ids, decoded = found[r.doc_id].ids, found[r.doc_id].text
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_merge_rounds_without_order_take_one_place_a_round():
    """A table in which a product takes part in an earlier merge: still as the heap merges."""
    vocab = {c: i for i, c in enumerate(["a", "b", "ab", "aba", "abab", *map(chr, range(0x100, 0x1F0))])}
    vocab |= {c: len(vocab) + i for i, c in enumerate(c for c in vocabulary.byte_letters() if c not in vocab)}
    pairs = [["ab", "a"], ["a", "b"], ["ab", "ab"]]
    merges = bpe.Merges({"model": {"vocab": vocab, "merges": pairs}})
    assert not merges.ordered
    ranks = {tuple(p): i for i, p in enumerate(pairs)}
    for word in ("abab", "ababab", "aabb", "b"):
        assert len(merges.encode([word])[0]) == token_counts.merged_count(list(word), ranks)


def expected_digests(rows):
    conversations, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        conversations[conv].append((turn is not None, turn or 0, role or "", digest, text or ""))
    for conv, turns in conversations.items():
        turns.sort()
        all_text = "".join(f"{role}\n{text}\n" for *_, role, _, text in turns)
        loss = "".join(text for *_, role, _, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_windows_round_trip(spark):
    rng = random.Random(3)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE x>>", "<</ROLE>>", "\\", "<", "[", "\n", " ", "word", "é", "🙂", "</s", "[/INST"]
    rows = []
    for conv in (None, 1, 2, 3):
        for _ in range(rng.randint(1, 60)):
            text = rng.choice([None, "", "w " * 400, *["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(6)]])
            rows.append((conv, rng.choice([None, 1, 2, 3, 3, 4]), rng.choice(["user", "assistant", "system", None, "tool >>\n", ""]), text))
    rows += [(9, 0, "system", "be brief"), *[(9, 1 + i, ("user", "assistant")[i % 2], f"turn {i} " + "x " * 20) for i in range(40)]]
    given = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, window string")
    windows = chat.windows(given, budget=200, history=60)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(windows).collect()}
    assert got == expected_digests(rows)
    long = sorted((r for r in windows.collect() if r.conv_id == 9), key=lambda r: r.window)
    assert len(long) > 3
    for r in long[1:]:
        turns = chat.read(r.text)
        assert turns[0] == ("system", "be brief") and r.repeated > 1  # the system turn and some history
        assert len(r.loss) == sum(role == "assistant" for role, _ in turns[r.repeated :])
    assert chat.digests(chat.windows(given.limit(0))).count() == 0


def test_escape_is_reversible():
    for text in ("</s>", "<\\/s>", "<\\\\/s>", "[INST][/INST]", "a <<SYS>> b", "<</s>", "\\"):
        assert chat.unescape(chat.escape(text)) == text
        assert "</s>" not in chat.escape(text) and "[/INST]" not in chat.escape(text)


def test_entropy_and_fingerprints(spark):
    import math
    from collections import Counter

    import numpy as np

    data = np.random.default_rng(0).integers(97, 110, 400).astype(np.uint8)
    width = fingerprint.WINDOW

    def step(window):
        total = lambda c: round(c * math.log2(c) * (1 << 20))
        top = total(width)
        return ((top - sum(total(c) for c in Counter(window).values())) * fingerprint.STEPS + top // 2) // top

    assert list(fingerprint.entropy_steps(data)) == [step(data[i : i + width].tolist()) for i in range(len(data) - width + 1)]

    rng = random.Random(2)
    texts = [None, "", "x", "é🙂", "a" * 5000, words(rng, 20), words(rng, 3000), words(rng, 3000)]
    texts += [words(rng, 300) for _ in range(12)] + [texts[6]]
    got = {r.doc_id: r for r in fingerprint.fingerprints(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        x, y = text or "", texts[(i + 1) % len(texts)] or ""
        edited = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        assert got[i].n_chars == len(x) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if len(x) > 1000 and len(y) > 1000 and x != y:
            assert got[i].near_edited > 0.2 > got[i].near_next
        if edited == x:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1
    assert got[6].fingerprint == got[len(texts) - 1].fingerprint
    assert fingerprint.fingerprints(documents(spark, [])).count() == 0
    one = fingerprint.fingerprints(documents(spark, ["only one text, followed by itself"])).first()
    assert one.near_next == 1


def test_digest_does_not_depend_on_neighbours_or_chunks(monkeypatch):
    import numpy as np

    rng = random.Random(4)
    texts = [words(rng, n).encode() for n in (5, 50, 4000, 9)]
    rank = np.arange(fingerprint.STEPS + 1)
    whole = [fingerprint.text_form(d) for d in fingerprint.digests(texts, rank)]
    assert [fingerprint.text_form(fingerprint.digests([t], rank)[0]) for t in texts] == whole
    monkeypatch.setattr(fingerprint, "CHUNK", 1000)
    assert [fingerprint.text_form(d) for d in fingerprint.digests(texts, rank)] == whole


def plain_digest(text, rank):
    """(features of the last filter, filters as sets of bits) of both chains, window by window."""
    import math
    from collections import Counter

    total = lambda c: round(c * math.log2(c) * (1 << 20))
    top, mask = total(32), (1 << 64) - 1
    windows = [text[i : i + 32] for i in range(len(text) - 31)]
    ranks = [rank[((top - sum(total(c) for c in Counter(w).values())) * 1000 + top // 2) // top] for w in windows]
    wins = Counter(min(range(i, i + 32), key=lambda j: (ranks[j], j)) for i in range(len(windows) - 31))
    hashes = []
    for i in sorted(i for i, n in wins.items() if n >= 8):
        h = 0x9E3779B97F4A7C15
        for k in range(0, 32, 8):
            h = (h ^ int.from_bytes(windows[i][k : k + 8], "little")) * 0xFF51AFD7ED558CCD & mask
            h ^= h >> 32
        hashes.append(h)
    short = []
    if len(hashes) < 32 and text:
        windows = {int.from_bytes(text[j : j + 4], "little") for j in range(len(text) - 3)} or {int.from_bytes(text, "little") | len(text) << 32}
        for w in sorted(windows):
            h = w ^ 0x9E3779B97F4A7C15
            for _ in range(2):
                h = h * 0xFF51AFD7ED558CCD & mask
                h ^= h >> 32
            short.append(h)
    chains = []
    for found in (hashes, short):
        parts = [found[i : i + 160] for i in range(0, len(found), 160)]
        chains.append((len(parts[-1]) if parts else 0, [len(x) for x in parts], [{h >> 11 * j & 2047 for h in x for j in range(5)} for x in parts]))
    return chains


def plain_likeness(one, other):
    empty = [not d[0][2] and not d[1][2] for d in (one, other)]
    if any(empty):
        return float(all(empty))
    kind = 1 if min(sum(d[0][1]) for d in (one, other)) < 16 and one[1][2] and other[1][2] else 0
    return plain_chain_likeness(one[kind], other[kind])


def plain_chain_likeness(one, other):
    best = []
    for f in min(one[2], other[2], key=len):
        found = []
        for g in max(other[2], one[2], key=len):
            most, chance = min(len(f), len(g)), len(f) * len(g) / 2048
            least = chance + 0.15 * max(most - chance, 0)
            found.append(min(max((len(f & g) - least) / max(most - least, 1e-9), 0), 1))
        best.append(max(found) if found else 0)
    return sum(best) / len(best) if best else 0.0


def test_digests_and_likeness_equal_the_plain_version():
    import base64

    import numpy as np

    rng = random.Random(9)
    texts = [b"", b"x", b"abc", b"a" * 900, *(words(rng, n).encode() for n in (5, 20, 60, 150, 300, 600, 1500)), "é🙂ü".encode() * 40]
    half = [t[: len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, texts[1:])]
    rank = list(range(fingerprint.STEPS + 1))
    rng.shuffle(rank)
    found, plain = fingerprint.digests(texts + half, np.array(rank)), [plain_digest(t, rank) for t in texts + half]
    for digest, want in zip(found, plain):
        for form, (last, _, bits) in zip(fingerprint.text_form(digest).split(";"), want):
            held, packed = form.split(":")
            raw = np.unpackbits(np.frombuffer(base64.b64decode(packed), np.uint8)).reshape(-1, 2048)
            assert int(held) == last and [set(np.flatnonzero(r).tolist()) for r in raw] == bits
    for i in range(len(found)):
        for j in range(len(found)):
            assert fingerprint.likeness(found[i], found[j]) == pytest.approx(plain_likeness(plain[i], plain[j]), abs=1e-9)


def test_a_text_is_like_its_own_edit(spark):
    """No likeness of 0 between a text and its edit that keeps half of it, whatever its length."""
    rng = random.Random(11)
    texts = [words(rng, n) for n in range(1, 160)]
    for r in fingerprint.fingerprints(documents(spark, texts)).collect():
        assert r.n_chars < 8 or r.near_edited > 0
