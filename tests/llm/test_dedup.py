"""Suffix-array dedup, substring dedup, SimHash near-dedup against brute force."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import GroupedData

from fleethazard.llm import repeats, simhash, suffix_dedup as suffix
from fleethazard.llm.components import connected_components
from fleethazard.llm.simhash import Probing, fingerprint, hamming_links, linked, simhash_dedup, simhash_groups
from fleethazard.llm.substring_dedup import substring_dedup


def passages(seed=1):
    """Texts that share passages, some cut at their ends, with runs of one letter."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, 60)
            parts += [" ".join(word() for _ in range(rng.randint(0, 30))), s[a:a + rng.randint(20, 200)]]
        rows.append((rng.randint(0, 10**6), " ".join(parts)))
    return rows + [(11, "z" * 400), (12, "z" * 130), (13, rows[0][1])]


def spans(flags):
    return sum(1 for a, b in zip([False, *flags], flags) if b and not a)


def brute_bytes(rows, width=50):
    least = {}
    for i, t in rows:
        x = (t or "").encode()
        for a in range(len(x) - width + 1 if i is not None else 0):
            least[x[a:a + width]] = min(i, least.get(x[a:a + width], i))
    out = []
    for i, t in rows:
        x = (t or "").encode()
        gone = [False] * len(x)
        for a in range(len(x) - width + 1 if i is not None else 0):
            if least[x[a:a + width]] < i:
                gone[a:a + width] = [True] * width
        out.append((i, len(x), sum(gone), spans(gone), bytes(b for b, g in zip(x, gone) if not g)))
    return out


@pytest.mark.parametrize("split", [5000, 1])
def test_suffix_dedup(docs, odd_rows, split, monkeypatch):
    monkeypatch.setattr(suffix, "SPLIT", split)
    rows = passages() + [(i, t[:3000] if t else t) for i, t in odd_rows]
    df = docs(rows)
    done = suffix.suffix_dedup(df, group_bytes=2000)
    assert done.columns[:len(df.columns)] == df.columns
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in done.collect()]
    assert Counter(got) == Counter(brute_bytes(rows))


def test_common_passage_sends_a_window_once_per_group(docs, monkeypatch):
    """A passage amid different surroundings makes one row for each of its windows and group of ids, not one per document."""
    monkeypatch.setattr(suffix, "SPLIT", 5)
    rng = random.Random(8)
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 90)))
    passage = "a banner that every third document holds, whatever is around it, and that is long"
    rows = [(i // 2 if i < 20 else i, noise() + (passage if i % 3 else "") + noise()) for i in range(300)]
    apply = GroupedData.applyInArrow

    def watched(self, fn, schema):
        def limited(table):
            held = Counter(zip(table.column("g").to_pylist(), table.column("piece").to_pylist()))
            assert max(held.values()) == 1
            return fn(table)

        return apply(self, limited if fn.__name__ == "sort_suffixes" else fn, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", watched)
    done = suffix.suffix_dedup(docs(rows), group_bytes=8000).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in done]
    assert Counter(got) == Counter(brute_bytes(rows))


def test_suffix_array_by_grouping():
    rng = random.Random(5)
    for _ in range(1500):
        s = bytes(rng.choice(b"abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 40)))
        assert suffix.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute_words(rows, width):
    first = {}
    for k, (i, t) in sorted(((k, r) for k, r in enumerate(rows) if r[0] is not None), key=lambda x: x[1][0]):
        w = (t or "").encode().split()
        for a in range(len(w) - width + 1):
            first.setdefault(tuple(w[a:a + width]), []).append((i, k, a))
    out = []
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - width + 1 if i is not None else 0):
            if any(j < i or n == k and b < a for j, n, b in first[tuple(w[a:a + width])]):
                gone[a:a + width] = [True] * width
        out.append((i, len(w), sum(gone), spans(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("width", [20, 3])
def test_substring_dedup(docs, odd_rows, width):
    rows = passages(2) + [(i, t[:3000] if t else t) for i, t in odd_rows] + [(70, "a b c a b c a b c")]
    done = substring_dedup(docs(rows), width=width, group_bytes=2000).collect()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], len(r["removed"]), r["text"]) for r in done]
    assert Counter(got) == Counter(brute_words(rows, width))
    assert all(sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in done)


def clustered():
    """Most ids in one dense run far from a few others, a third of the rows under one id, ids at the ends of their type."""
    rng = random.Random(3)
    texts = [t for _, t in passages(4)]
    ids = [(1 << 50) + k for k in range(50)] + [7] * 30 + [-(1 << 63), (1 << 63) - 1, 0, 1, None, None]
    return [(i, rng.choice(texts)[rng.randint(0, 40):] + f" {k}") for k, i in enumerate(ids)]


@pytest.mark.parametrize("cells", [1 << 16, 40])
def test_groups_of_clustered_and_repeated_ids(docs, cells, monkeypatch):
    """Groups are bounded by their bytes and ordered by id; only those of one rank share an id."""
    monkeypatch.setattr(repeats, "CELLS", cells)
    rows = clustered()
    grouped, n = repeats.grouped_by_id(docs(rows), "doc_id", "text", 4000)
    held = defaultdict(list)
    for r in grouped.where("g >= 0").collect():
        held[r["g"]].append((r["id"], len(r["text"].encode()) + repeats.ROW_BYTES))
    assert n == -(-sum(len(t.encode()) + repeats.ROW_BYTES for _, t in rows) // 4000)
    if cells > 40:
        assert max(sum(size for _, size in v) for i, v in held.items() if len({x for x, _ in v}) > 1) <= 4000
    assert len({g for g, v in held.items() if v[0][0] == 7}) > 2
    ranked = defaultdict(set)
    for g, v in held.items():
        ranked[int(repeats.rank_of(np.array([g]))[0])] |= {i for i, _ in v}
    order = [ranked[k] for k in sorted(ranked)]
    assert all(max(a) < min(b) for a, b in zip(order, order[1:]))
    assert all(len(ranked[g // repeats.SHARES]) == 1 for g in held if g % repeats.SHARES)


@pytest.mark.parametrize("cells", [1 << 16, 40])
def test_dedup_of_clustered_and_repeated_ids(docs, cells, monkeypatch):
    monkeypatch.setattr(repeats, "CELLS", cells)
    rows = clustered()
    done = suffix.suffix_dedup(docs(rows), group_bytes=4000).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in done]
    assert Counter(got) == Counter(brute_bytes(rows))
    done = substring_dedup(docs(rows), width=5, group_bytes=4000).collect()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], len(r["removed"]), r["text"]) for r in done]
    assert Counter(got) == Counter(brute_words(rows, 5))


def test_id_ranges_narrow_to_the_bytes(spark):
    rows = [((1 << 40) + k, 10) for k in range(500)] + [(3, 1000), (4, 1), ((1 << 62), 10)]
    ranges = repeats.id_ranges(spark.createDataFrame(rows, "id long, bytes long"), 100)
    assert ranges["bytes"].sum() == 6011 and len(ranges) < 2 * 6011 // 100 + 2
    assert all(r.bytes <= 100 or r.low == r.high for r in ranges.itertuples())


def test_buckets_reached():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1000, dtype=np.uint64))
    for n in (1, 7, 5000):
        got = repeats.by_bucket(values, n)
        assert [(k, a, b) for k, a, b in got if a == b] == [] and got[0][1] == 0 and got[-1][2] == 1000
        for k, a, b in got:
            assert {int(v >> 32) * n >> 32 for v in values[a:b].tolist()} == {k}
    assert repeats.by_bucket(values[:0], 7) == []


def test_periodic_texts_make_short_pieces(docs, monkeypatch):
    """Long stretches of a period become pieces of bounded length; what is removed stays that of the windows."""
    long = b"ab" * 400_000
    pieces = suffix.pieces_of([long], 50)
    assert pieces["n"].max() <= suffix.LONGEST and pieces["n"].sum() == len(long) - 49
    monkeypatch.setattr(suffix, "LONGEST", 32)
    rows = [(5, "z" * 400), (2, "z" * 130 + "y"), (9, "x" + "ab" * 150), (4, "ab" * 60 + "q"), (4, "ba" * 200), (6, "abc" * 99)]
    done = suffix.suffix_dedup(docs(rows), group_bytes=300).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in done]
    assert Counter(got) == Counter(brute_bytes(rows))


def test_empty_tables(docs):
    empty = docs([])
    assert suffix.suffix_dedup(empty).count() == substring_dedup(empty).count() == 0
    assert simhash_groups(empty).count() == simhash_dedup(empty).count() == 0


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies():
    rng = random.Random(9)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(120)] for _ in range(25)]
    rows = [(1000 + k, " ".join(b)) for k, b in enumerate(base)]
    for k in range(120):
        b = list(rng.choice(base))
        b[rng.randrange(120)] = f"new{k}"
        rows.append((k, " ".join(b).title() if k % 2 else " \n".join(b)))
    return rows


def brute_roots(rows, distance=3):
    """The fingerprints, and for each row the number of a row that stands for its component."""
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            root[find(a)] = find(b)
    return prints, [find(k) for k in range(len(rows))]


def brute_components(rows):
    prints, roots = brute_roots(rows)
    ids = defaultdict(list)
    for root, (i, _) in zip(roots, rows):
        if i is not None:
            ids[root].append(i)
    return [(i, f"{prints[k]:016x}", min(ids[roots[k]], default=None)) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("hot", [20_000, 4])
def test_simhash(docs, odd_rows, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    rows = near_copies() + odd_rows
    got = [(r["id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in simhash_groups(docs(rows)).collect()]
    want = brute_components(rows)
    assert Counter(got) == Counter(want)
    assert len({w[2] for w in want}) < len(rows) - 50
    df = docs(rows)
    kept = simhash_dedup(df)
    assert kept.columns == df.columns
    # one row of every component: ids repeat in these rows, so they don't name a component
    assert kept.count() == len(set(brute_roots(rows)[1]))
    assert {r["doc_id"] for r in kept.collect()} == {w[2] for w in want}


def test_every_component_keeps_a_row(docs):
    """Ids that are null or repeat don't name a component: unlike texts under one id all stay."""
    rng = random.Random(21)
    a, b, c, d, e = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(80)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (5, c), (5, d), (8, c), (9, d), (9, d), (None, d), (7, e), (None, e)]
    kept = [(r["doc_id"], r["text"]) for r in simhash_dedup(docs(rows)).collect()]
    assert Counter(kept) == Counter([(None, a), (None, b), (5, c), (5, d), (7, e)])


def test_links_of_planted_neighbours(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-2**62, 2**62, 300)
    flips = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 5), replace=False)) for b in base]
    fps = sorted({int(x) for x in [*base, *flips]})
    links = hamming_links(spark.createDataFrame([(x,) for x in fps], "fp long"), 3).collect()
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 64 for r in links)
    comp = connected_components(spark.createDataFrame([(r["a"], r["b"]) for r in links], "a long, b long")).collect()
    root = {r["node"]: r["root"] for r in comp}
    for b, f in zip(base.tolist(), flips):
        near = ((b ^ f) & (2**64 - 1)).bit_count() <= 3
        assert (root.get(b, b) == root.get(f, f)) or not near


def test_thresholds_add_up_and_avoid_full_values():
    halves = np.full((4, 2, 256), 1 / 256)
    halves[0] = 0
    halves[0, :, 7] = 1.0  # all fingerprints agree in the first partition
    plan = Probing([list(range(16 * k, 16 * k + 16)) for k in range(4)], halves, 1_000_000, 3)
    got = plan.thresholds(np.array([[7 | 7 << 8, 1, 2, 3], [1, 1, 2, 3]]))
    assert (got.sum(axis=1) == 0).all() and (got >= -1).all()
    assert got[0, 0] == -1


def test_large_buckets_give_the_same_forest():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 80, dtype=np.uint64)) for c in centre]))
    a, b = linked(np.zeros(len(fp), dtype=np.int64), fp, 3)
    assert len(a) == len(fp) - 5
    assert len(a) < len(fp)


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (-5, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90, -5: -5, 200: -5}


def test_fingerprint_of_short_texts():
    assert fingerprint(None) == fingerprint(" \n") == 0
    for t in ("a", "a B", "A b c", "a b c d"):
        assert fingerprint(t) % 2**64 == brute_fingerprint(t)
