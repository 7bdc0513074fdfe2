"""Language ID, quality classifier, BPE, and the pipeline."""

import functools
import math
import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleethazard.llm.bpe import WordBpe, bpe_encode
from fleethazard.llm.language_id import fit_text_model, identify_language, page_evidence
from fleethazard.llm.quality_classifier import Logistic, Pool, classify_quality, co_train, text_features
from fleethazard.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(open(tokenizer_path(), encoding="utf-8").read()), Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_the_library(docs, odd_rows, spark):
    library = Tokenizer.from_file(tokenizer_path())
    rows = odd_rows + [(50, "It's <|endoftext|>Foo's ΣΑΣ İI a\x1cb\x85 é ﬁ 漢字12 ½"), (51, "<|startoftext|><|endoftext|>")]
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = bpe_encode(docs(rows + real), tokenizer_path()).collect()
    assert len(got) == len(rows + real)
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_every_character(bpe):
    own, library = bpe
    for c in [*range(1, 0xD800, 7), *range(0xE000, 0x20000, 61), *range(0x20, 0x250)]:
        text = f"a{chr(c)}b 1{chr(c)}"
        ids = own.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, hex(c)
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_long_runs_without_spaces(bpe):
    own, library = bpe
    rng = random.Random(5)
    runs = ["a" * 1_000_000, "".join(rng.choice("etaoinshr") for _ in range(300_000)), "漢字" * 20_000, "ab" * 100_000 + "1" * 100_000]
    for run in runs:
        begin = time.perf_counter()
        ids = own.encode(run)
        assert time.perf_counter() - begin < 20
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(run, add_special_tokens=False).ids
    for n in (*range(2, 12), 47, 48, 49, 50, 130):  # around the bounds of the two ways to merge, and of the caches
        for _ in range(60):
            run = "".join(rng.choice("thean") for _ in range(n))
            assert np.frombuffer(own.encode(run), "<u4").tolist() == library.encode(run, add_special_tokens=False).ids


def test_cuts_never_lie_inside_a_token(bpe):
    own, _ = bpe
    rng = random.Random(2)
    for token in rng.sample(sorted(own.vocab), 3000):
        assert own.cuts(own._symbols(token)) == []
    for _ in range(500):
        symbols = own._symbols("".join(rng.choice("abcqxzjé") for _ in range(12)) + "</w>")
        edges = [0, *own.cuts(symbols), len(symbols)]
        assert [t for a, b in zip(edges, edges[1:]) for t in own.merge(symbols[a:b])] == own.merge(symbols)


def pages(spark):
    words = {"en": "the of and that with for this", "de": "der die und nicht ist das ein", "fr": "le la les des une dans est"}
    rng = random.Random(1)
    text = lambda lang, n: " ".join(rng.choice(words[lang].split()) for _ in range(n))
    samples = [(i, text(lang, 40), lang) for i, lang in enumerate(["en", "de", "fr"] * 30)]
    rows = [(i, f"http://www.site{i % 4}.example.{'de' if lang == 'de' else 'com'}/x", f'<html lang="{lang}"><script>the of</script><p>{text(lang, 30)}</p>')
            for i, lang in enumerate(["en", "de", "fr"] * 20)]
    return (spark.createDataFrame(samples, "id long, text string, lang string"),
            spark.createDataFrame(rows, "page_id long, url string, html string"), [s[2] for s in samples])


def test_language_of_pages(spark):
    samples, table, langs = pages(spark)
    model = fit_text_model(samples)
    extra = spark.createDataFrame([(900, None, None), (901, "", ""), (902, "no address", "<b>der die und nicht das</b>"),
                                   (903, "http://www.site1.example.de/q", '<html lang="de"></html>'), (903, "http://www.site1.example.de/q", '<html lang="de"></html>')], table.schema)
    got = identify_language(page_evidence(table.union(extra)), model, ["id"]).collect()
    assert len(got) == 65
    said = {r["id"]: r["lang"] for r in got}
    assert [said[i] for i in range(60)] == langs[:60]
    assert said[902] == said[903] == "de" and said[900] in ("en", "de", "fr")
    assert all(0 <= r["confidence"] <= 1 for r in got)


def brute_languages(rows, model, strength=5.0):
    """Language and confidence of each (id, text, declared, suffix, host, domain), by sums in plain Python."""
    n = len(model.languages)

    def posterior(logs):
        parts = [math.exp(x - max(logs)) for x in logs]
        return [p / sum(parts) for p in parts]

    ll = [model.log_likelihoods([(r[1] or "").encode()])[0].tolist() for r in rows]
    p = [posterior([a + b for a, b in zip(x, model.log_prior)]) for x in ll]
    add = lambda pairs: functools.reduce(lambda m, kv: m | {kv[0]: [a + b for a, b in zip(m.get(kv[0], [0.0] * n), kv[1])]}, pairs, {})
    whole = [sum(x[k] for x in p) for k in range(n)]
    share = [(x + 1) / (sum(whole) + n) for x in whole]
    smooth = lambda counts, prior: [(c + strength * q) / (sum(counts) + strength) for c, q in zip(counts, prior)]
    declared, suffix = (add((r[c], x) for r, x in zip(rows, p) if r[c] is not None) for c in (2, 3))
    hosts = add(((r[4], r[5]), x) for r, x in zip(rows, p) if r[4] is not None)
    domains = add((d, x) for (_, d), x in hosts.items() if d is not None)
    out = []
    for r, x in zip(rows, ll):
        logs = list(x)
        for key, sums in ((r[2], declared), (r[3], suffix)):
            if key is not None:
                logs = [v + math.log((sums[key][k] + strength * share[k] * 0.01) / (whole[k] + strength * share[k])) for k, v in enumerate(logs)]
        prior = share
        if r[4] is not None:
            prior = smooth(hosts[r[4], r[5]], smooth(domains[r[5]], share) if r[5] is not None else share)
        q = posterior([v + math.log(w) for v, w in zip(logs, prior)])
        out.append((r[0], model.languages[q.index(max(q))], max(q)))
    return out


def test_language_equals_brute_force(spark):
    samples, table, _ = pages(spark)
    model = fit_text_model(samples)
    extra = spark.createDataFrame([(900, None, None), (901, "", ""), (902, "no address", "<b>der die und nicht das</b>"), (904, "http://localhost/", "the"),
                                   (903, "http://www.site1.example.de/q", '<html lang="xx">le der the'), (903, "http://www.site1.example.de/q", '<html lang="xx">le der the')], table.schema)
    evidence = page_evidence(table.union(extra)).repartition(3)
    rows = [tuple(r) for r in evidence.select("id", "text", "declared", "suffix", "host", "domain").collect()]
    want = sorted(brute_languages(rows, model))
    got = sorted((r["id"], r["lang"], r["confidence"]) for r in identify_language(evidence, model, ["id"]).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-4)


def test_rare_languages_are_learnt(spark):
    """The bound is one for each language: a rare one keeps all its rows, and the priors still count every row."""
    words = {"en": "the and with that", "de": "der und nicht das", "nn": "ikkje berre noko eg"}
    rows = [(i, " ".join([words[lang]] * 3) + f" {i}", lang) for i, lang in enumerate(["en"] * 3000 + ["de"] * 300 + ["nn"] * 2)]
    samples = spark.createDataFrame(rows + [(None, "x", None), (1, None, "zz")], "id long, text string, lang string")
    model = fit_text_model(samples, max_docs=20)
    assert model.languages == ["de", "en", "nn"]
    assert np.allclose(np.exp(model.log_prior), np.array([301, 3001, 3]) / 3305)
    assert model.log_likelihoods([b"eg ikkje noko berre"])[0].argmax() == 2
    assert fit_text_model(samples, max_docs=20, max_languages=2).languages == ["de", "en"]


def test_language_without_rows_or_model(spark):
    samples, table, _ = pages(spark)
    model = fit_text_model(samples)
    assert identify_language(page_evidence(table.limit(0)), model, ["id"]).count() == 0
    none = fit_text_model(samples.limit(0))
    assert {r["lang"] for r in identify_language(page_evidence(table), none, ["id"]).collect()} == {None}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_text_model(docs.where("doc_id % 2 = 0").selectExpr("doc_id AS id", "text", "lang"))
    held = docs.where("doc_id % 2 = 1").selectExpr("doc_id AS id", "text", "string(null) AS declared", "string(null) AS suffix",
                                                   "string(null) AS host", "string(null) AS domain")
    said = identify_language(held, model, ["id"]).join(docs.selectExpr("doc_id AS id", "lang AS want"), "id").collect()
    assert np.mean([r["lang"] == r["want"] for r in said]) > 0.98


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classify_quality(docs, labels.where("doc_id % 3 > 0"))
    held = scored.join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in held]) > 0.93
    assert np.mean([r["kept"] for r in held if r["quality"] == 1]) > 0.97


def test_quality_of_odd_rows(docs, odd_rows, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = classify_quality(docs(odd_rows), labels).collect()
    assert len(got) == len(odd_rows) and all(r["kept"] and r["score"] == 0.5 for r in got)
    rng = random.Random(1)
    good = [(i, " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))) for i in range(100, 200)]
    bad = [(i, "SPAM!! " * rng.randint(20, 60)) for i in range(200, 300)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(100, 300)] + [(None, 1, 0), (100, None, 0), (100, 1, 0)], labels.schema)
    got = classify_quality(docs(good + bad + odd_rows), labels).collect()
    assert len(got) == 200 + len(odd_rows)
    assert all(r["kept"] == (r["doc_id"] < 200) for r in got if (r["doc_id"] or 0) >= 100)
    assert classify_quality(docs([]), labels).count() == 0


@pytest.mark.parametrize("n_bad,bound", [(1, 20_000), (2, 20_000), (60, 200), (60, 20_000)])
def test_quality_with_a_rare_class(docs, spark, n_bad, bound):
    """A few rejects among many labels, however thinned, still fit a model that finds many of the like."""
    rng = random.Random(3)
    good = [(i, " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))) for i in range(2000)]
    bad = [(i, "SPAM!! " * rng.randint(20, 60)) for i in range(5000, 5100)]
    rows = [(i, 1, 0) for i in range(2000)] + [(5000 + i, 0, 0) for i in range(n_bad)] + [(9000 + i, 0, 0) for i in range(500)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = classify_quality(docs(good + bad), labels, max_labelled=bound).collect()
    assert sum(r["kept"] for r in got if r["doc_id"] < 2000) >= 1990
    assert sum(r["kept"] for r in got if r["doc_id"] >= 5000) <= 70
    assert min(r["score"] for r in got if r["doc_id"] < 2000) > max(r["score"] for r in got if r["doc_id"] >= 5000)


def surest_of(text, meta, free, confidence, per_round, shift=0.0):
    """One round's choice, over arrays."""
    had = (set(), set())

    def surest(k, model, prior):
        odds = model.logit((text, meta)[k])
        alone, odds = odds - prior, odds + shift
        strength = np.round(np.where(odds * alone > 0, np.minimum(abs(odds), abs(alone)), 0.0), 9)
        rows = [i for i in free if strength[i] >= np.log(confidence / (1 - confidence)) and i not in had[1 - k]]
        rows = [i for y in (False, True) for i in sorted((i for i in rows if (odds[i] > 0) == y), key=lambda i: (-strength[i], i))[:per_round]]
        had[1 - k].update(rows)
        return text[rows], meta[rows], (odds[rows] > 0).astype(int)

    return surest


def two_views():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    text = np.c_[y + rng.normal(0, 0.4, 4000), rng.normal(0, 1, 4000)]
    return y, text, np.c_[y + rng.normal(0, 0.6, 4000), rng.normal(0, 1, 4000)]


def test_views_teach_each_other():
    y, text, meta = two_views()
    surest = surest_of(text, meta, range(400, 4000), 0.9, 250)
    model = co_train(text[:400], meta[:400], y[:400], np.arange(400) % 5, 3, surest)
    both = sum(c.logit(m.logit(v)[:, None]) for c, m, v in zip(model.calibrate, (model.text, model.metadata), (text, meta))) - model.prior
    assert ((both > 0) == (y == 1))[400:].mean() > 0.9
    assert co_train(text[:4], meta[:4], np.ones(4, dtype=int), np.arange(4) % 5, 3, surest) is None


def test_the_surest_rows_come_from_the_whole_table(spark):
    """Both views over two rounds, against the same choice over arrays."""
    y, text, meta = two_views()
    rows = [(None if i % 7 == 0 else i, i, text[i].tolist(), meta[i].tolist()) for i in range(400, 4000)]
    pool = Pool(spark.createDataFrame(rows, "id long, mark long, text array<double>, metadata array<double>").repartition(5), 0.3, 0.9, 40)
    brute = surest_of(text, meta, range(400, 4000), 0.9, 40, 0.3)
    for step in range(2):
        for k in (0, 1):
            model = Logistic.fit((text, meta)[k][step * 100:step * 100 + 200], y[step * 100:step * 100 + 200])
            got, want = pool.surest(k, model, 0.1), brute(k, model, 0.1)
            order = [np.lexsort(x[0].T) for x in (got, want)]
            assert len(want[2]) == 80 and all((g[order[0]] == w[order[1]]).all() for g, w in zip(got, want))


def test_text_features():
    text = "Ab c!|\n\nAb 9;é\n"
    n, chars, lines = 5.0, 11.0, 4.0
    assert text_features(text) == [3 / n, 2 / chars, 3 / chars, 1 / chars, 1 / chars, 1 / chars, 1 / chars, 1 / chars, np.log(n), chars / n, 3 / lines, chars, lines]
    assert text_features(None) == text_features("") == [0.0] * 8 + [0.0, 1.0, 1.0, 1.0, 1.0]


@pytest.mark.parametrize("values", [(1, 2), (0, 1, 2), (0, -1)])
def test_labels_other_than_0_and_1_are_refused(docs, spark, values):
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, quality int")
    with pytest.raises(ValueError, match="must be 0 or 1"):
        classify_quality(docs([(i, "a b") for i in range(5)]), labels)


def test_an_id_on_many_rows_teaches_once(docs, spark):
    """A labelled id on nine rows in ten: one of them reaches the driver, all are scored."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))) for i in range(100)] + [(i, "SPAM!! " * rng.randint(20, 60)) for i in range(100, 200)]
    rows += [(5, f"the same {i % 50}") for i in range(1800)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(0, 200, 2)] + [(5, 1)], "doc_id long, quality int")
    got = classify_quality(docs(rows), labels).collect()
    assert len(got) == 2000
    assert all(r["kept"] == (r["doc_id"] < 100) for r in got if r["doc_id"] != 5)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF)
        assert after.columns == docs.columns, name
        assert after.count() <= now.count()
        now = spark.createDataFrame(after.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert 0 < len(last) == now.count() < docs.count()
    assert {r["doc_id"]: r["n_tokens"] for r in last} == {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}


def test_texts_travel_in_batches_of_bounded_bytes(spark):
    from fleethazard.llm.bpe import bpe_encode
    from fleethazard.llm.queries import tokenizer_path
    from fleethazard.llm.quality_classifier import with_text_view
    import pyarrow as pa

    from fleethazard.llm.support import BATCH_BYTES

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('some words ', 500) AS text").coalesce(1)  # 22 MB
    for step in (with_text_view, lambda df: bpe_encode(df, tokenizer_path())):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        step(docs)
        found = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in found) == 4000 and max(r.size for r in found) < 1.1 * BATCH_BYTES
