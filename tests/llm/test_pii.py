import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleethazard.llm import pii
from fleethazard.llm.pii import KINDS, base_spans, find_personal_data, loose_spans, scored_graph, words

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        twice = [d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    return [(KINDS.index(k), m.start(), m.end()) for k in KINDS for m in re.finditer(FORMS[k], text or "") if valid(k, m[0])]


def tell(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def noise(rng, n):
    return "".join(rng.choice("0123456789 .-+()@a%é1:") for _ in range(n))


def test_base_forms():
    rng = random.Random(1)
    texts = [noise(rng, rng.randint(0, 60)) for _ in range(4000)]
    texts += ["a@b.c@d.e", "a@b.c.d@e.f", "x@@y.z", "é@b.c", "a@b.c.", "1.2.3.4.5.6.7.8", "01.002.0003.255", "256.1.1.1", "1.1.1.1.1", "4111 1111-1111 1111",
              "4111  1111", "+1 (988) 555-2485", "+12", "+1-2", "+1 234 567 890 1234567 +44 20 7946 0958 ", "12345678901234567890", ""]
    for text in texts:
        assert base_spans(text) == brute_base(text), text
        for kind, start, end in loose_spans(text, base_spans(text)):
            assert all(end <= s or e <= start for _, s, e in base_spans(text))


def test_scans_are_linear():
    for part in ("1", "1.", "a", "@", "a@", "+1 ", "1 ", "1-", "@a.", "(at)", "x@y ", "1:", "4xxx", "((("):
        begin = time.perf_counter()
        text = part * (1_000_000 // len(part))
        loose_spans(text, base_spans(text))
        assert time.perf_counter() - begin < 8, part


def brute_words(text):
    flat = re.sub(r"[\s\"'()\[\]<>{}]", " ", text, flags=re.ASCII)
    return re.findall(r"[^ :=]*[:=]|[^ :=]+", flat)


def test_words_end_with_colons():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab:= \n('é>") for _ in range(30))
        starts, ends, hashes = words(np.frombuffer(text.encode(), dtype=np.uint8))
        found = [text.encode()[s:e].decode() for s, e in zip(starts, ends)]
        assert found == brute_words(text)
        assert len(set(hashes.tolist())) == len(set(found))


def brute_found(rows, min_seeds=3, min_trust=0.8, rounds=3):
    """The whole method over lists and dictionaries."""
    key = lambda k, t: (k, re.sub("[^0-9]", "", t) if k > 1 else t.lower())
    slots, total = [], Counter()
    for n, (_, text) in enumerate(rows):
        text = text or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        seen = brute_words(low)
        total.update(("1", w) for w in seen[:-1])
        total.update(("2", *w) for w in zip(seen[:-1], seen[1:-1]))
        base = brute_base(text)
        for k, s, e in base + loose_spans(text, base):
            before = brute_words(low[:s])
            if not before or (s and low[s - 1] not in " \t\n\x0b\f\r\"'()[]<>{}:="):
                continue
            patterns = [("1", before[-1])] + ([("2", *before[-2:])] if len(before) > 1 else [])
            slots.append((n, k, s, e, key(k, text[s:e]), (k, s, e) in base, patterns))
    seeds, others, places = defaultdict(set), defaultdict(set), Counter()
    for _, k, _, _, v, seed, patterns in slots:
        for p in patterns:
            (seeds if seed else others)[k, p].add(v)
            places[k, p] += 1
    able = {p for p in places if len(seeds[p]) >= min_seeds and others[p] and places[p] >= min_trust * total[p[1]]}
    seeded = {v for _, _, _, _, v, seed, _ in slots if seed}
    score = defaultdict(float, {v: 1.0 for v in seeded})
    for _ in range(rounds):
        trust = {p: sum(score[v] for _, k, _, _, v, _, ps in slots for q in ps if (k, q) == p) / total[p[1]] for p in able}
        doubt = defaultdict(lambda: 1.0)
        for k, v, q in {(k, v, q) for _, k, _, _, v, _, ps in slots for q in ps if (k, q) in able}:
            doubt[v] *= 1 - min(trust[k, q], 1)
        score = defaultdict(float, {v: 1.0 if v in seeded else 1 - d for v, d in doubt.items()} | {v: 1.0 for v in seeded})
    added = defaultdict(dict)
    for n, k, s, e, v, seed, patterns in slots:
        if not seed and score[v] >= min_trust and any(trust.get((k, q), 0) >= min_trust for q in patterns):
            added[n][k, s, e] = score[v]
    out = []
    for n, (i, text) in enumerate(rows):
        base, taken = brute_base(text), []
        for (k, s, e), _ in sorted(added[n].items(), key=lambda x: (-round(x[1], 5), x[0][1], -x[0][2], x[0][0])):
            if all(e <= b or d <= s for _, b, d in taken):
                taken.append((k, s, e))
        counts = [sum(b[0] == k for b in base) for k in range(4)]
        out.append((i, *counts, hashlib.sha256(tell(base).encode()).hexdigest(), tell(sorted(base + taken))))
    return out


def some_rows():
    rng = random.Random(7)
    word = lambda: rng.choice(["the", "of", "order", "total", "Version", "é", "on", "call"])
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = []
    for i in range(60):
        number = phone() if i % 6 else f"{rng.randint(200, 999)}-555-{rng.randint(1000, 9999)}"
        rows.append((i, f"{word()} {word()} please PHONE: {number} {word()} {word()} {rng.randint(1000000, 9999999)}"))
        rows.append((100 + i, f"{word()} mail me <u{i}@{'host.example.org' if i % 4 else 'localhost'}>, {word()} {rng.randint(0, 9)}.{rng.randint(0, 9)}"))
        rows.append((200 + i, f"{word()} {word()} {phone() if i % 9 == 0 else word()} {rng.randint(10**9, 10**10)} {word()}"))
    rows += [(300 + i, f"é host= {rng.randint(1, 250)}.7.{rng.randint(1, 250)}.9 up") for i in range(8)] + [(310, "host= 2001:db8:0:1 up"), (311, "host= 300.7.9.9")]
    rows += [(400 + i, rows[0][1]) for i in range(90)]  # copies: a third of all rows
    return rows


@pytest.mark.parametrize("bits", [22, 5])
def test_contexts_find_unseen_identifiers(docs, odd_rows, bits, monkeypatch):
    monkeypatch.setattr(pii, "FILTER_BITS", bits)
    rows = some_rows() + odd_rows
    done = find_personal_data(docs(rows))
    assert done.columns == ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "found"]
    got = done.collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter(brute_found(rows))
    new = {r["doc_id"] for r in got for s in r["found"] if s["by_context"]}
    assert new == {i for i in range(0, 60, 6)} | {100 + i for i in range(0, 60, 4)} | {310, 311} | set(range(400, 490))


def test_no_seeds_no_finds(docs):
    rows = [(i, f"Phone: 555-{1000 + i}-22") for i in range(20)] + [(50, "phone: +1 222 333 4444"), (None, None), (51, "")]
    assert Counter(tuple(r)[:-1] for r in find_personal_data(docs(rows)).collect()) == Counter(brute_found(rows))
    assert find_personal_data(docs([])).count() == 0


def test_rounds_raise_trust(spark):
    """A pattern that three in five seeds fill becomes trusted when its other value stands after a trusted one too."""
    edges = [(3, 1, v, 1, True, 5) for v in (10, 11, 12)] + [(3, 1, 20, 2, False, 5)] + [(3, 2, 13, 9, True, 10), (3, 2, 20, 1, False, 10)]
    df = spark.createDataFrame(edges, "kind int, pattern long, value long, n long, seed boolean, total long")
    trust = [{r["pattern"]: r["trust"] for r in scored_graph(df, k)[0].collect()} for k in (1, 2)]
    assert trust[0] == {1: 600_000, 2: 900_000}
    assert trust[1] == {1: 600_000 + 400_000 * 96 // 100, 2: 996_000}
