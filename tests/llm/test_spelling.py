import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleethazard.llm import spelling
from fleethazard.llm.spelling import ReducedWords, near_words, spelling_variants, symbols_of, word_counts


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def brute(counts):
    words = [w for w in counts if w is not None]
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    root = {}
    for w in words:
        end = w
        while form[end] is not None:
            end = form[end]
        root[w] = end
    return Counter((w, form[w], root[w], counts[w], len(near[w]), counts.get(form[w]) if form[w] else None) for w in words)


def table(spark, counts):
    return spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n int, form string").repartition(3)


def some_words(seed, letters, n):
    rng = random.Random(seed)
    out = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))): rng.randint(1, 60) for _ in range(n)}
    return out | {"": 4, "a" * 3000: 9, "a" * 2999: 3, "a" * 1500 + "b" + "a" * 1499: 2, "ñandú": 7, "ñandu": 2, "日本語": 3, "日本": 8}


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return Counter(tuple(r) for r in df.collect())


# ample alphabets; crowded ones that go on to finer alphabets; a single symbol, where only lengths tell words apart
@pytest.mark.parametrize("symbols,crowd", [((8, 64), 1000), ((2, 8, 64), 3), ((1,), 1000), ((1, 2, 64), 1)])
def test_equals_brute_force(spark, symbols, crowd, monkeypatch):
    monkeypatch.setattr(spelling, "PLACES", 1000)
    counts = some_words(3, "abcdé", 400)
    assert result(spelling_variants(table(spark, counts), symbols, crowd)) == brute(counts)


def test_pairs_come_once(spark):
    counts = some_words(8, "ab", 100)
    pairs = [frozenset((r["a"]["word"], r["b"]["word"])) for r in near_words(table(spark, counts), (2, 3, 64), 2).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in counts for b in counts if one_edit(a, b)}


def test_odd_words(spark):
    assert result(spelling_variants(spark.createDataFrame([], "word string, n long"))) == Counter()
    # ties: equal counts on either side; a chain of forms
    counts = {"house": 40, "mouse": 40, "louse": 20, "lousy": 10, "lousey": 5, "ZZZZZ": 1, "zzzzz": 1}
    assert result(spelling_variants(table(spark, counts))) == brute(counts)
    rows = {r["word"]: r for r in spelling_variants(table(spark, {**counts, None: 3})).collect()}
    assert rows["lousey"]["root"] == "house" and rows["louse"]["form"] == "house" and rows["ZZZZZ"]["n_near"] == 0
    assert tuple(rows[None]) == (None, None, None, 3, 0, None)


def brute_counts(rows, modulus, min_chars, min_count):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if modulus and h % modulus == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


@pytest.mark.parametrize("modulus,min_chars,min_count", [(None, 5, 3), (2, 2, 1), (3, 5, 3), (1, 1, 1)])
def test_word_counts(docs, odd_rows, modulus, min_chars, min_count):
    rng = random.Random(2)
    words = ["Élan", "ÉLAN", "straße", "Straße", "THE", "the", "don't", "naïve×word", "co-op", "x1y2", "ﬁne", "абв", "Zürich"]
    rows = odd_rows + [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(40)]
    got = {r["word"]: r["n"] for r in word_counts(docs(rows), typo_modulus=modulus, min_chars=min_chars, min_count=min_count).collect()}
    assert got == brute_counts(rows, modulus, min_chars, min_count)
    assert word_counts(docs([])).count() == 0


def test_neighbours_are_the_whole_neighbourhood():
    """Each link between reduced words is made from exactly one end, and by one key."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(600)})
    form = lambda w: tuple(symbols_of([w], 3))
    forms = sorted({form(w) for w in words})
    found = ReducedWords(np.array([s for f in forms for s in f]), np.array([len(f) for f in forms]), 3)
    number = {h: k for k, h in enumerate(found.hashes().tolist())}
    assert len(number) == len(forms)
    made = [frozenset((int(k), number[h])) for owner, key in found.neighbours() for k, h in zip(owner, key.tolist()) if h in number]
    assert len(made) == len(set(made))
    assert set(made) == {frozenset((i, j)) for i, a in enumerate(forms) for j, b in enumerate(forms) if one_edit(a, b)}
