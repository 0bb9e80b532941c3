"""Phrase mining, personal data and resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pytest

pytest.importorskip("panelwright.llm.queries")

from panelwright.llm import personal, phrases, resample  # noqa: E402

SF = "/root/testdata/sf0.001"


def documents(spark, rows, **more):
    """(doc_id, text, lang) rows with columns whose names operators use inside."""
    names = {"_text": "x", "fingerprint": "y", "bucket": 1, "weight": 2, "_slice": 3, "rank": 4, **more}
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{n}` {'int' if isinstance(v, int) else 'string'}" for n, v in names.items())
    return spark.createDataFrame([(*r, *names.values()) for r in rows], schema)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_draw(docs, target, percent=5, least=20):
    """By the contract, a document at a time."""
    sums = []
    for texts in (target, [t for _, t in docs]):
        n = [0] * 10000
        for t in texts:
            for b in plain_features(t)[1]:
                n[b] += 1
        sums.append(n)
    t, s = sums
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(sum(s) + 10000) / (float(s[b] + 1) * float(sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        n_words, found = plain_features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    long = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(long[: len(long) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resampling_equals_the_plain_version(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("Wort", "mot", "ñandú", "x9", "İ", "the") for b in range(30)]
    texts = [None, "", " .. ", "one", "One-two", "A b C", "a" * 5000, "tail " * 3000] + [
        rng.choice(" -\n.").join(rng.choices(vocabulary[: rng.choice([5, 180])], k=rng.randint(1, 60))) for _ in range(150)
    ]
    rows = [*enumerate(texts), (9, texts[9]), (None, texts[20]), (None, texts[20])]
    target = [*texts[10:30], None, "wort1 wort2 " * 50]
    docs = documents(spark, [(i, t, "x") for i, t in rows])
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    monkeypatch.setattr(resample, "CHUNK", 64)
    got = resample.resample(docs, goal, percent=40)
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == plain_draw(rows, target, 40)
    none = resample.resample(docs.limit(0), goal)
    assert none.count() == 0
    empty = resample.resample(docs.filter("doc_id in (0, 1)"), goal.limit(0)).collect()
    assert [(r.weight, r.rank) for r in empty] == [(0, None)] * 2


def test_bit_sliced_sums():
    import numpy as np

    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (5, 130)) * rng.integers(0, 40, (5, 130))
    gain = rng.integers(-9000, 9000, (1, 130))
    planes = resample.packed_planes(gain, int(abs(gain).max()).bit_length() + 1)
    assert resample.bit_sliced_sums(counts, planes).tolist() == (counts @ gain[0]).tolist()
    assert resample.bit_sliced_sums(np.zeros((2, 130), int), planes).tolist() == [0, 0]


def test_resampling_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = resample.query(spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_draw([(r.doc_id, r.text) for r in docs], target)


def plain_phrases(rows, top, least=30, cover=80):
    """By the contract, over all phrases."""
    counts, total = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            total[lang] = total.get(lang, 0) + len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    held, best = {}, {}
    for (lang, g), a in counts.items():
        if len(g) > 1 and a >= least:
            cuts = [(2_000_000 * a // (counts[lang, g[:k]] + counts[lang, g[k:]]), k) for k in range(1, len(g))]
            best[lang, g] = (*min(cuts), a)
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    held[lang, g[i : i + k]] = max(held.get((lang, g[i : i + k]), 0), a)
    out = []
    for lang in total:
        kept = [(-s, -a, " ".join(g).encode(), g, k) for (x, g), (s, k, a) in best.items() if x == lang and 100 * held.get((x, g), 0) < cover * a]
        for rank, (s, a, name, g, k) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, name.decode(), -a, counts[lang, g[:k]], counts[lang, g[k:]], total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("top, least, block, bits", [(2000, 3, 1 << 23, 1 << 25), (7, 3, 200, 1 << 16), (25, 2, 64, 256), (1, 4, 999, 1 << 16)])
def test_phrases_equal_the_plain_version(spark, monkeypatch, top, least, block, bits):
    """Also with few rows wanted, so that languages need several rounds, tiny blocks, so that texts are cut, and sets that collide."""
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "SET_BITS", bits)
    rng = random.Random(top)
    stock = ["New York City", "in spite of", "as well as the", "ad hoc", "Ünder\tÄll odds", "to be or", "x\x00y \x1cz"]
    rows = [(None, None), ("", ""), ("en", " .,; \n"), ("en", "ad hoc " * 40), ("de", "a"), ("en", "A a a a a a"), ("fr", "ça va. " * 30)]
    for i in range(120):
        words = [rng.choice(stock) if rng.random() < 0.4 else f"w{min(int(rng.expovariate(0.3)), 40)}" for _ in range(rng.randint(1, 60))]
        rows.append((rng.choice(["en", "en", "de", None, ""]), "".join(w + rng.choice([" ", " ", " ", "  ", ", ", ".", "\n", "\u00a0 "]) for w in words)))
    docs = documents(spark, [(i, t, lang) for i, (lang, t) in enumerate(rows)], phrase="x", n=3, mark=1)
    got = phrases.collocations(docs, top=top, least=least)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, top, least)


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(documents(spark, []).limit(0)).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    each = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in each) % 10 == 0


def plain_spans(text):
    """By the contract."""
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return [f"{list(BASE)[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_base_spans_equal_the_plain_version(spark):
    rng = random.Random(12)
    parts = ["a@b.c", "x.y_z%+-@h-o.co.uk", "@", "..", "1.2.3.4", "255.0256.1.1", "300.1.1.1.1", "1.2.3.4.5", "4785380592391139", "4785 3805-9239 1139", "+1 (743) 555-3824", "+12-", "+491701234567 ", "7" * 30,
             "é", "\U0001f600", " ", "-", "+", "(", "_", "a", "0", "\n", "tel ", "a@b.c_x@d.e", "x@y@z.w.v", "00049", "5555-5555-5555-4444"]
    texts = [None, "", "a" * 9_000, "a." * 4_000 + "@", "a@b" + ".c" * 60_000, "1" * 9_000, "1." * 9_000, "+1" + "(" * 9_000, *parts] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(400)]
    rows = [*enumerate(texts), (9, texts[20]), (None, texts[30]), (None, texts[30])]
    docs = documents(spark, [(i, t, "x") for i, t in rows], base=1, kind=2, spans="x", start=1)
    got = personal.personal_data(docs)
    listed = [(r.doc_id, [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base]) for r in got.collect()]
    assert sorted(listed, key=repr) == sorted([(i, plain_spans(t)) for i, t in rows], key=repr)
    assert personal.personal_data(docs.limit(0)).count() == 0


def test_trees_add_what_looks_alike(spark):
    """Numbers without a plus, bracketed dots and spelled addresses are found by what plain ones look like; other numbers are left alone."""
    rng = random.Random(4)
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    texts = []
    for i in range(600):
        phone, mail = f"+1 ({number(3)}) 555-{number(4)}", f"jo.{number(2)}@mail{number(1)}.example.com"
        host = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        texts.append(rng.choice(["Call {} or write to {} from {} now", "So {} and {} with {} there", "Ask ({}), mail {}, server {}."]).format(phone, mail, host))
        texts.append(f"Order {number(4)}-{number(4)}-{number(4)} of version {number(3)}.{number(3)}.9{number(2)}.{number(3)} took {number(3)} {number(3)}.{number(3)} hours, mail x @ y.9z")
    hidden = ["Call (212) 555-0199 please", "Call jo [at] mail [dot] example [dot] com please", "It came from 10[.]20[.]30[.]40 last night"]
    docs = spark.createDataFrame(list(enumerate(texts + hidden)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal.personal_data(docs).collect()}
    added = [[(s.kind, hidden[i][s.start : s.end]) for s in found[len(texts) + i]] for i in range(3)]
    assert added == [[("phone", "(212) 555-0199")], [("email", "jo [at] mail [dot] example [dot] com")], [("ip", "10[.]20[.]30[.]40")]]
    assert not any(s for i in range(1, 1200, 2) for s in found[i])
    assert all([s.kind for s in found[i]] == ["phone", "email", "ip"] for i in range(0, 1200, 2))
    clean = {r.doc_id: r.text for r in personal.redacted(docs.filter(f"doc_id in (0, 1) or doc_id >= {len(texts)}").unionByName(docs.filter("doc_id between 2 and 1199"))).collect()}
    assert clean[len(texts)] == "Call [phone] please" and "[phone]" in clean[0] and "[email]" in clean[0] and "[ip]" in clean[0] and clean[1] == texts[1]


def test_personal_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in personal.query(spark, SF).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in BASE]
        assert set(want) <= set(r.spans.split(",") if r.spans else []) and r.n_added == len(r.spans.split(",") if r.spans else []) - len(want)
