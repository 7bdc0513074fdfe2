"""One query for each operator over its whole table, with SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethazard.llm.bpe import bpe_encode
from fleethazard.llm.clustering import cluster_vectors
from fleethazard.llm.decontamination import decontaminate
from fleethazard.llm.language_id import document_evidence, fit_text_model, identify_language, page_evidence
from fleethazard.llm.line_dedup import line_dedup
from fleethazard.llm.pii import find_personal_data
from fleethazard.llm.quality_classifier import classify_quality
from fleethazard.llm.quality_rules import FEATURES, quality_rules
from fleethazard.llm.sharding import shard_documents
from fleethazard.llm.simhash import simhash_groups
from fleethazard.llm.spelling import spelling_variants, word_counts
from fleethazard.llm.substring_dedup import substring_dedup
from fleethazard.llm.suffix_dedup import suffix_dedup
from fleethazard.llm.support import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def sha256(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


# ---------------------------------------------------------------- 1 language ID

@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and every document; the text model learns from the languages that documents and pages declare."""
    docs = table(spark, sf_dir, "documents")
    pages = page_evidence(table(spark, sf_dir, "pages"))
    samples = docs.select(F.col("doc_id").alias("id"), "text", F.lower("lang").alias("lang"))
    model = fit_text_model(samples.unionByName(pages.select("id", "text", F.col("declared").alias("lang"))))
    none = F.lit(None).cast("long")
    rows = (pages.withColumns({"doc_id": none, "page_id": F.col("id")})
            .unionByName(document_evidence(docs).withColumns({"doc_id": F.col("id"), "page_id": none})))
    return identify_language(rows.drop("id"), model, ["doc_id", "page_id"])


# ---------------------------------------------------------------- 2 suffix-array dedup

@query("op2_suffix_array_dedup")
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- 3 substring dedup

WINDOWS_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20),
p AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM s),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM p WHERE nth > 1),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT e.doc_id, word, e.i, g.i IS NOT NULL AS gone FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.i = g.i),
o AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o ON d.doc_id = o.doc_id"""


@query("op3_substring_dedup", WINDOWS_SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", sha256("text").alias("kept_sha256"))


# ---------------------------------------------------------------- 4 quality classifier

@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "text_score", "metadata_score", "score", "kept")


# ---------------------------------------------------------------- 5 BPE

def tokenizer_path() -> str:
    """The vocabulary of the contract; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- 6 line dedup

LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.last AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


@query("op6_line_dedup", LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


# ---------------------------------------------------------------- 7 benchmark decontamination

LEAKS_SQL = """
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
       FROM bw WHERE len(w) > 0),
bp AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM bs),
sizes AS (SELECT DISTINCT n FROM bp),
ds AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n),
dp AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM ds),
hit AS (SELECT doc_id, dp.n, i, item_id FROM dp JOIN bp ON dp.n = bp.n AND dp.phrase = bp.phrase),
cov AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""".replace("WITH RECURSIVE", "WITH")


@query("op7_benchmark_decontamination", LEAKS_SQL)
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# ---------------------------------------------------------------- 8 SimHash near-dedup

@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash_groups(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- 9 sharding

@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = shard_documents(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                       "virtual_slot", "map_version", "rebalanced_shard")


# ---------------------------------------------------------------- 10 quality rules

RULES_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS filled FROM d),
t AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM f WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM t),
r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM g WHERE n > 1) GROUP BY doc_id),
b AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM f LEFT JOIN r USING (doc_id)),
l AS (SELECT doc_id, source, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
h AS (SELECT source, count(DISTINCT doc_id) AS site_docs FROM d GROUP BY source),
o AS (SELECT l.source, key FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source WHERE w > 0 GROUP BY l.source, key, site_docs
      HAVING count(DISTINCT doc_id) >= 10 AND 100 * count(DISTINCT doc_id) >= 2 * site_docs),
x AS (SELECT doc_id, sum(w) AS lost FROM l JOIN o ON l.source IS NOT DISTINCT FROM o.source AND l.key = o.key WHERE w > 0 GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       coalesce(lost, 0)::BIGINT AS n_line_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - coalesce(lost, 0)) >= 30 * n_words AS kept
FROM b LEFT JOIN x USING (doc_id)"""


@query("op10_quality_rules", RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules(table(spark, sf_dir, "documents"))
    return done.select("doc_id", *FEATURES, "base_failed", "n_line_words", "kept")


# ---------------------------------------------------------------- 11 centroid clustering

def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Three rounds and a last assignment, each a pair of common table expressions."""
    steps = [f"""
v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS c FROM embeddings
      WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, c FROM
       (SELECT c, sha256('1:' || vec_id) AS h FROM v ORDER BY h LIMIT {k}))"""]
    far = "list_sum([(p.x - p.y) * (p.x - p.y) FOR p IN list_transform(list_zip(v.c, m.c), lambda z: {'x': z[1], 'y': z[2]})])::BIGINT"
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT vec_id, any_value(c) AS c, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM
        (SELECT v.vec_id, v.c, m.cluster, {far} AS d FROM v CROSS JOIN c{r} m) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT cluster, i, floor(sum(x) / count(*))::BIGINT AS x FROM
        (SELECT cluster, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM a{r}) GROUP BY cluster, i),
c{r + 1} AS (SELECT c{r}.cluster, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN
          (SELECT cluster, list(x ORDER BY i) AS c FROM s{r} GROUP BY cluster) n USING (cluster))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} m USING (cluster)"""


@query("op11_centroid_clustering", _clusters_sql())
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


# ---------------------------------------------------------------- 12 spelling variants

SPELLING_SQL = r"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k:
          CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k FROM
         (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
         GROUP BY ALL),
codes AS (SELECT *, list_transform(string_split(doc_id || ':' || w, ''), lambda x: unicode(x)) AS u FROM runs),
-- letters from U+00C0 on are two bytes in UTF-8
bytes AS (SELECT *, flatten(list_transform(u, lambda x: CASE WHEN x < 128 THEN [x] ELSE [195, x - 64] END)) AS b FROM codes),
hashed AS (SELECT w, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(b, lambda x: x::BIGINT)),
             lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]))) AS h FROM bytes, crc),
vocab AS (SELECT word, sum(k)::BIGINT AS n FROM
          (SELECT CASE WHEN h % 97 = 0 THEN w[1:(h % length(w))::BIGINT] || w[(h % length(w))::BIGINT + 2:] ELSE w END AS word, k FROM hashed)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
-- one byte for each letter, as the edit distance counts bytes
plain AS (SELECT *, translate(word, (SELECT string_agg(chr((192 + i)::INT), '' ORDER BY i) FROM range(64) r(i)),
          '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!"#$%&()*+,-./:;<=>?@[]^_`{|') AS p FROM vocab),
-- words one edit apart share a half: equal beginnings or equal ends
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM plain a JOIN plain b
          ON a.p[1:2] = b.p[1:2] AND abs(length(a.p) - length(b.p)) < 2 AND a.p <> b.p WHERE levenshtein(a.p, b.p) = 1
          UNION SELECT a.word, b.word, b.n FROM plain a JOIN plain b
          ON a.p[-2:] = b.p[-2:] AND abs(length(a.p) - length(b.p)) < 2 AND a.p <> b.p WHERE levenshtein(a.p, b.p) = 1),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
                 CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM vocab LEFT JOIN near USING (word)),
walk AS (SELECT word, word AS place FROM forms UNION ALL
         SELECT walk.word, forms.form FROM walk JOIN forms ON walk.place = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, walk.place AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk ON walk.word = forms.word JOIN forms last ON last.word = walk.place AND last.form IS NULL"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), typo_modulus=97))


# ---------------------------------------------------------------- 13 personal data

@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = find_personal_data(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
