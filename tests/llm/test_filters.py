"""Line dedup, quality rules, decontamination, sharding."""

from collections import Counter, defaultdict
import random
import re
import time
import zlib

import pytest

from fleethazard.llm.decontamination import decontaminate
from fleethazard.llm.line_dedup import line_dedup
from fleethazard.llm.quality_rules import quality_rules
from fleethazard.llm.sharding import first_map, rebalanced, shard_documents

SPACES = " \t\n\x0b\f\r"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def some_texts():
    shared = "This very common line has more than forty characters in it."
    rows = [(i, "\n".join([f"own line {i} with words enough to stand", f"  {shared.upper() if i % 2 else shared}\t", "short", f"tail {i}"])) for i in range(8)]
    return rows + [(20, f"{shared}\n{shared}"), (21, "short\nshort")]


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: lower(line.strip(SPACES))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < min_docs or i == max(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("odd", [False, True])
def test_line_dedup(docs, odd_rows, odd):
    rows = some_texts() + (odd_rows if odd else [])
    df = docs(rows)
    done = line_dedup(df)
    assert done.columns == [*df.columns, "n_lines", "n_dropped"]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in done.collect()]
    assert Counter(got) == Counter(brute_lines(rows))


def test_texts_of_many_lines(docs):
    """100,000 lines, half of them common: about as long as they take to read; and rows without an id, each on its own."""
    common = [f"this is the very common line number {i} of more than forty characters" for i in range(50_000)]
    texts = ["\n".join(x for i, line in enumerate(common) for x in (line, f"own {k} {i}")) for k in range(6)]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "\n".join(common[:3])), (None, common[0]), (None, None), (6, common[1]), (6, common[1] + "\n")]
    begin = time.perf_counter()
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup(docs(rows)).collect()]
    assert time.perf_counter() - begin < 40
    assert Counter(got) == Counter(brute_lines(rows))


def test_empty_tables_stay_empty(docs, spark):
    empty = docs([])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup(empty).count() == quality_rules(empty).count() == shard_documents(empty).count() == 0
    assert decontaminate(empty, bench).count() == 0
    assert not decontaminate(docs([(1, "a b c")]), bench).first()["contaminated"]


def brute_rules(rows):
    words = lambda t: [w for w in re.split("[" + SPACES + "]+", t or "") if w]
    out = []
    for i, t in rows:
        w = words(t)
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        covered = {p for k, g in enumerate(grams) if g in twice for p in (k, k + 1, k + 2)}
        filled = [x for x in (t or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(filled) - len(set(filled)), len(covered), failed))
    return out


def test_quality_rules(docs, odd_rows):
    rows = odd_rows + some_texts() + [(30, "a b c a b c a b c d"), (31, "x|y # $ <b>"), (32, "a a a a")]
    got = quality_rules(docs(rows)).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(brute_rules(rows))
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_lines_of_a_host_deplete_documents(docs):
    body = lambda i: " ".join(f"word{i}x{k}" for k in range(60))
    banner = " ".join(f"banner{k}" for k in range(20))
    rows = [(i, f"{banner}\n{body(i)}") for i in range(11)] + [(50, "\n".join([banner] * 6 + ["a few own words " + body(1)[:20]]))]
    got = {r["doc_id"]: r for r in quality_rules(docs(rows)).collect()}
    assert all(got[i]["kept"] and got[i]["n_line_words"] == 20 and "banner" not in got[i]["clean_text"] for i in range(11))
    assert not got[50]["base_failed"] or got[50]["n_line_words"] == 120
    assert not got[50]["kept"]


def test_clean_text_of_many_lines_and_hosts(spark):
    """Lines over the limit go wherever they stand, host by host (none included), and texts of many lines stay quick."""
    rng = random.Random(6)
    common = [f"common line {k} of the host" for k in range(3000)]
    rows = []
    for i in range(36):
        host = ("a", "b", None)[i % 3]
        lines = [f"own {i} {k}" for k in range(40)] + ([f" {x.upper()}" if rng.random() < 0.5 else x for x in common] if host != "b" or i < 10 else [])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), host))
    rows += [(40, rows[0][1], "b"), (40, rows[0][1], "a"), (None, rows[0][1], "a"), (41, None, None), (42, "\n\n", None)]
    key = lambda line: lower(line.strip(SPACES))
    held, site = defaultdict(set), defaultdict(set)
    for i, t, host in rows:
        if i is not None:
            site[host].add(i)
            for line in (t or "").split("\n"):
                held[host, key(line)].add(i)
    over = {k for k, v in held.items() if len(v) >= 10 and 100 * len(v) >= 2 * len(site[k[0]]) and k[1]}
    want = [(i, host, t if t is None or i is None else "\n".join(x for x in t.split("\n") if (host, key(x)) not in over)) for i, t, host in rows]
    assert sum(t != w[2] for (_, t, _), w in zip(rows, want)) == 25
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    assert Counter((r["doc_id"], r["source"], r["clean_text"]) for r in got) == Counter(want)


def brute_leaks(rows, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    known = defaultdict(set)
    for item, t in items:
        w = words(t)
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if w else 0):
            known[tuple(w[k:k + n])].add(item)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in known:
                    hit |= set(range(k, k + n))
                    found |= known[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), ",".join(sorted(str(f) for f in found if f is not None)), bool(hit)))
    return out


def test_decontamination(docs, odd_rows, spark):
    text = [f"q{k}" for k in range(40)]
    items = [(1, " ".join(text[:12])), (2, "Alpha, beta; GAMMA"), (10, " ".join(text[20:40])), (3, None), (4, "..."),
             (None, "null item"), (5, "alpha beta gamma"), (6, " ".join(text[:12]))]
    rows = odd_rows + [(40, "x " + " ".join(text[1:11]) + " y"), (41, " ".join(text[1:10])), (42, "the alpha-beta gamma alpha beta GAMMA"),
                       (43, " ".join(text)), (43, "another row of the same id alpha beta gamma"), (44, "a null item here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in decontaminate(docs(rows), bench).collect()]
    assert Counter(got) == Counter(brute_leaks(rows, items))


def test_sharding(docs, odd_rows):
    rows = odd_rows + [(100 + i, "t" * (i % 37)) for i in range(3000)]
    got = shard_documents(docs(rows), n_slots=512).collect()
    assert len(got) == len(rows)
    load = Counter()
    places = defaultdict(list)
    for r in got:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert 0 <= r["shard"] < 8 and r["rebalanced_shard"] in (r["shard"], 8)
        places[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    big = max(len(t or "") for _, t in rows)
    assert max(load.values()) - min(load.values()) <= 4 * big


def test_slot_map_edits_move_little():
    totals = [(s, 10, 50 + s % 7) for s in range(4000)]
    now = first_map(totals, 8)
    size = {s: b for s, _, b in totals}
    load = lambda m, n: [sum(size[s] for s in m if m[s] == k) for k in range(n)]
    assert max(load(now, 8)) - min(load(now, 8)) <= 60
    later = rebalanced(totals, now, 9)
    moved = [s for s in now if now[s] != later[s]]
    assert all(later[s] == 8 for s in moved)
    assert max(load(later, 9)) < 1.02 * min(load(later, 9))
    grown = [(s, n, b * (40 if later[s] == 2 and s % 3 == 0 else 1)) for s, n, b in totals]
    again = rebalanced(grown, later, 9)
    size = {s: b for s, _, b in grown}
    assert max(load(again, 9)) < 1.1 * min(load(again, 9)) and sum(later[s] != again[s] for s in later) < 400


def brute_shards(rows, n_shards=8, n_slots=512):
    """Bytes by slot, largest first to the lightest shard, from the slots the operator reports."""
    size = Counter()
    for r in rows:
        size[r["virtual_slot"]] += r["size"]
    load, placed = [0] * n_shards, {}
    for slot in sorted(size, key=lambda s: (-size[s], s)):
        shard = min(range(n_shards), key=lambda k: (load[k], k))
        placed[slot] = shard
        load[shard] += size[slot]
    return placed


def test_first_map_equals_brute_force(docs, odd_rows):
    rows = odd_rows + [(i, f"text {i} " * (i % 17)) for i in range(1500)]
    got = shard_documents(docs(rows), n_slots=512).collect()
    assert {(r["virtual_slot"], r["shard"]) for r in got} == set(brute_shards(got).items())
    assert len({r["virtual_slot"] for r in got}) <= 512 and {r["map_version"] for r in got} == {0}


def test_the_map_outlives_a_run(docs, spark, tmp_path):
    """The same data read the same map; grown data and another shard edit it; each edit is one more version."""
    path = str(tmp_path / "map")
    rows = [(i, f"text {i} " * (1 + i % 17)) for i in range(2000)]
    more = rows + [(5000 + i, "another text " * (i % 40)) for i in range(1000)]
    place = lambda got: {r["virtual_slot"]: r["shard"] for r in got}
    runs = [shard_documents(docs(r), n, n_slots=512, map_path=path).collect() for r, n in ((rows, 8), (rows, 8), (more, 8), (more, 9))]
    maps = [place(got) for got in runs]
    versions = [got[0]["map_version"] for got in runs]
    assert maps[0] == maps[1] and versions[0] == versions[1] == 0 and versions[2] in (0, 1) and versions[3] == versions[2] + 1
    moved = [s for s in maps[1] if maps[2][s] != maps[1][s]]
    assert len(moved) < 0.2 * len(maps[1])
    assert {maps[3][s] for s in maps[2] if maps[3][s] != maps[2][s]} == {8}
    for got, n in zip(runs, (8, 8, 8, 9)):
        load = Counter()
        for r in got:
            load[r["shard"]] += r["size"]
        assert max(load.values()) < 1.1 * sum(load.values()) / n
    assert sorted(p.name for p in (tmp_path / "map").iterdir()) == [f"version={v}" for v in range(versions[3] + 1)]
    stored = spark.read.parquet(f"{path}/version={versions[3]}")
    assert {r["virtual_slot"]: r["shard"] for r in stored.collect()} == maps[3]
    assert stored.selectExpr("sum(n_rows)").first()[0] == 3000
    with pytest.raises(ValueError, match="more slots or shards"):
        shard_documents(docs(rows), 4, n_slots=512, map_path=path)


def test_rows_without_an_id_don_t_share_a_slot(docs):
    """A third of the rows lack an id, another third share one: the shards hold nearly the same bytes."""
    rows = [(None, f"no id {i} " * 20) for i in range(1000)] + [(7, f"one id {i} " * 20) for i in range(1000)] + [(100 + i, f"own {i} " * 20) for i in range(1000)]
    load = Counter()
    for r in shard_documents(docs(rows)).collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.02 * sum(load.values()) / 8


def test_quality_rules_cut_a_text_into_lines_once(spark):
    """The verdict reads the written lines; its words of a document are those of all rows with its id."""
    from fleethazard.llm.quality_rules import quality_rules

    common = " ".join(f"common{k}" for k in range(40))
    rows = [(i % 12, f"{common}\n\x0bnumber {i}\tof\r many \n\n" + " ".join(f"w{i}x{k}" for k in range(i)), "h") for i in range(24)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_words=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 0
    words = {d: sum(len(t.split()) for e, t, _ in rows if e == d) for d in range(12)}
    lost = 2 * len(common.split())  # both rows of an id hold the line
    got = {(r.doc_id, r.n_line_words, r.kept) for r in out.collect()}
    assert got == {(d, lost, 100 * (n - lost) >= 30 * n) for d, n in words.items()} and len({k for *_, k in got}) == 2
