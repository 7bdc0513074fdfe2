"""Language ID by Bayesian evidence fusion: text likelihoods, declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.support import packed
from fleethazard.session import written

CELLS = 1 << 14  # hashed byte trigrams
SLAB = 1 << 20
DEALT = 1 << 40
TEXT_EVIDENCE = 200.0  # a text speaks as this many trigrams at most: they are not independent


def trigram_cells(data: np.ndarray) -> np.ndarray:
    """The cell of the trigram that starts at each byte, A-Z lower-cased."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


def _slabs(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of texts, joined by a space with one at both ends."""
    a = size = 0
    for b, text in enumerate(texts, 1):
        size += len(text)
        if size >= SLAB or b == len(texts):
            yield a, b, np.frombuffer(b" " + b" ".join(texts[a:b]) + b"  ", dtype=np.uint8)
            a, size = b, 0


@dataclass
class TextModel:
    languages: list[str]
    log_prob: np.ndarray  # (cells, languages)
    log_prior: np.ndarray

    def log_likelihoods(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for a, b, data in _slabs(texts):
            cells = trigram_cells(data)
            sizes = np.array([len(t) + 1 for t in texts[a:b]])
            ends = np.cumsum(sizes)
            for k in range(len(self.languages)):
                total = np.r_[0.0, np.cumsum(self.log_prob[cells, k])]
                out[a:b, k] = total[ends] - total[ends - sizes]
            out[a:b] *= np.minimum(1.0, TEXT_EVIDENCE / sizes)[:, None]
        return out


def fit_text_model(samples: DataFrame, max_docs: int = 5_000, max_languages: int = 256) -> TextModel:
    """Smoothed trigram shares of each language from about ``max_docs`` rows a language of ``samples`` (id, text, lang), taken by a
    hash of id and text, so that a rare language keeps its rows. Rows without language or text are not used. Of more than
    ``max_languages`` languages the most frequent are learnt (ties: first by name). The priors count all rows."""
    samples = samples.dropna(subset=["lang", "text"])
    rows_of = samples.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(max_languages).collect()
    rows_of = {r["lang"]: r["rows"] for r in rows_of}
    shares = [(lang, int(DEALT * min(1.0, max_docs / n))) for lang, n in rows_of.items()]
    learnt = F.broadcast(samples.sparkSession.createDataFrame(shares, "lang string, share long"))
    samples = samples.join(learnt, "lang").where(F.pmod(F.xxhash64(F.lit("language"), "id", "text"), F.lit(DEALT)) < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = np.array(batch.column("text").cast(pa.binary()).to_pylist(), dtype=object)
            for lang in set(langs):
                mine = list(texts[langs == lang])
                total = totals.setdefault(lang, np.zeros(CELLS, dtype=np.int64))
                for _, _, data in _slabs(mine):
                    total += np.bincount(trigram_cells(data), minlength=CELLS)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(total)), pa.array(np.arange(len(total))), pa.array(total)],
                                             ["lang", "cell", "n"])

    sums = samples.select("lang", "text").mapInArrow(count, "lang string, cell long, n long")
    sums = sums.groupBy("lang", "cell").agg(F.sum("n").alias("n")).where("n > 0").toPandas()
    languages = sorted(rows_of)
    counts = np.zeros((CELLS, len(languages)))
    for k, lang in enumerate(languages):
        mine = sums[sums["lang"] == lang]
        counts[mine["cell"], k] = mine["n"]
    smoothed = counts + 0.5
    docs = np.array([rows_of[lang] + 1.0 for lang in languages])
    return TextModel(languages, np.log(smoothed / smoothed.sum(axis=0)), np.log(docs / docs.sum()))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(id, text, declared, suffix, host, domain) of ``pages`` (page_id, url, html): visible text, the language attribute of the
    html element, and the parts of the address. Missing parts are null."""
    body = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    none = lambda c: F.when(c != "", c)
    return pages.select(
        F.col("page_id").alias("id"), body.alias("text"), none(declared).alias("declared"),
        none(F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"), none(host).alias("host"),
        none(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"))


def identify_language(rows: DataFrame, model: TextModel, id_cols: list[str], strength: float = 5.0) -> DataFrame:
    """``id_cols`` with ``lang`` and ``confidence`` for each row of ``rows`` (id columns, text, declared, suffix, host, domain).

    The text gives a likelihood per language. Summed over all rows, the text's posteriors say how often each declared value and
    each suffix goes with each language, and how the languages spread over each host; a host's prior is smoothed by its
    domain's, and that by the whole table's, each with the weight of ``strength`` rows. The four are multiplied.

    Null or empty text speaks for no language, a null declaration, suffix or host adds nothing. Of equal posteriors the first
    language by name wins. Repeated rows count each. Without any known language, ``lang`` is null and ``confidence`` 0.
    An empty table gives an empty table. Only scores move; groups are summed map-side, so a host or value with a third of all
    rows is one row of each task, and the joins back can be split.
    """
    if not model.languages:
        return rows.select(*id_cols, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"))
    languages, n = model.languages, len(model.languages)

    @F.pandas_udf("array<double>")
    def likelihood(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model.log_likelihoods([(t or "").encode("utf-8", "surrogatepass") for t in texts])))

    def normal(logs: list[Column]) -> list[Column]:
        """Posteriors of log weights."""
        top = F.greatest(*logs) if n > 1 else logs[0]
        parts = [F.exp(x - top) for x in logs]
        total = reduce(lambda a, b: a + b, parts)
        return [p / total for p in parts]

    keys = ["declared", "suffix", "host", "domain"]
    scored = rows.select(*id_cols, *keys, likelihood("text").alias("ll"))
    ll = [F.get("ll", F.lit(k)) for k in range(n)]
    first = normal([x + float(p) for x, p in zip(ll, model.log_prior)])
    scored = scored.select("*", F.array(*first).alias("p"))
    scored = written(scored, "language-evidence")

    def spread(key: str) -> DataFrame:
        sums = [F.sum(F.get("p", F.lit(k))) for k in range(n)]
        return scored.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*sums).alias(f"{key}_n"))

    whole = scored.agg(*[F.sum(F.get("p", F.lit(k))) for k in range(n)]).first()
    total = sum(x or 0.0 for x in whole)
    share = [((x or 0.0) + 1.0) / (total + n) for x in whole]

    def share_of(counts: str, prior: list[Column], k: int) -> Column:
        size = reduce(lambda a, b: a + b, [F.get(counts, F.lit(j)) for j in range(n)])
        return F.coalesce((F.get(counts, F.lit(k)) + strength * prior[k]) / (size + strength), prior[k])

    hosts = written(scored.where("host IS NOT NULL").groupBy("host", "domain").agg(
        F.array(*[F.sum(F.get("p", F.lit(k))) for k in range(n)]).alias("host_n")), "host-languages")
    domains = hosts.where("domain IS NOT NULL").groupBy("domain").agg(
        F.array(*[F.sum(F.get("host_n", F.lit(k))) for k in range(n)]).alias("domain_n"))
    hosts = hosts.join(domains, "domain", "left")
    base = [F.lit(s) for s in share]
    by_domain = [share_of("domain_n", base, k) for k in range(n)]
    hosts = written(hosts.select(F.col("host").alias("h"), F.col("domain").alias("d"), F.array(
        *[F.log(share_of("host_n", by_domain, k)) for k in range(n)]).alias("prior")), "host-priors")

    def seen_with(key: str) -> DataFrame:
        """log P(value | language) of each value."""
        logs = [F.log((F.get(f"{key}_n", F.lit(k)) + strength * share[k] * 0.01) / (float(whole[k] or 0.0) + strength * share[k])) for k in range(n)]
        return written(spread(key).select(F.col(key).alias(f"{key}_is"), F.array(*logs).alias(f"{key}_log")), f"{key}-languages")

    joined = scored.join(hosts, (F.col("host") == F.col("h")) & F.col("domain").eqNullSafe(F.col("d")), "left")
    for key in ("declared", "suffix"):
        joined = joined.join(seen_with(key), F.col(key) == F.col(f"{key}_is"), "left")
    at = lambda c, k, default: F.coalesce(F.get(c, F.lit(k)), F.lit(default))
    logs = [ll[k] + at("declared_log", k, 0.0) + at("suffix_log", k, 0.0) + at("prior", k, float(np.log(share[k]))) for k in range(n)]
    joined = joined.select(*id_cols, F.array(*normal(logs)).alias("q"))
    best = F.array_max("q")
    return joined.select(*id_cols, F.element_at(F.array(*map(F.lit, languages)), F.array_position("q", best).cast("int")).alias("lang"),
                         F.round(best, 4).alias("confidence"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same for ``documents``: the declared language is their column ``lang``, the host their source."""
    return packed(docs, id="doc_id", text="text", declared="lang", host="source").select(
        "id", "text", "declared", F.lit(None).cast("string").alias("suffix"), "host", F.lit(None).cast("string").alias("domain"))
