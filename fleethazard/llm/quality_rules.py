"""Quality rules: rules on the words and lines of each text, and lines that too many documents of one host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.line_dedup import line_key
from fleethazard.llm.support import SPACES, hash128, packed, unpacked, words_of
from fleethazard.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 3
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _shift(name: str, value: Column, bits: Column) -> Column:
    return F.call_function(name, value, bits)


def with_text_rules(df: DataFrame) -> DataFrame:
    """``df`` with the counts of its column ``text`` (null: empty).

    ``n_repeat_words``: each window of three words becomes one long, its hash above and its position below, with as
    many position bits as the text needs. Sorted as plain longs, equal windows stand side by side; neighbours with equal
    hash bits are then compared word by word. That is n log n for any text, and no row per window.
    """
    body = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    df = df.withColumns({
        "words": words_of(F.col("text")),
        "filled_lines": lines,
        "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
    })
    df = df.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_dup_lines": (F.size("filled_lines") - F.size(F.array_distinct("filled_lines"))).cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w)),
    }).drop("filled_lines")
    bits = F.length(F.bin("n_words"))
    code = lambda i: _shift("shiftleft", F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]), bits).bitwiseOR(i)
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_words") - WINDOW)
    codes = F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(F.sort_array(F.transform(starts, lambda i: code(i.cast("int")).cast("long"))))
    df = df.withColumn("codes", codes)
    at = lambda c: c.bitwiseAND(_shift("shiftleft", F.lit(1).cast("long"), bits) - 1)
    phrase = lambda c: F.slice("words", at(c).cast("int") + 1, WINDOW)

    def same(c: Column, i: Column) -> Column:
        other = F.get("codes", i)
        return F.coalesce((_shift("shiftright", c, bits) == _shift("shiftright", other, bits)) & (phrase(c) == phrase(other)), F.lit(False))

    repeated = F.sort_array(F.transform(F.filter("codes", lambda c, i: same(c, i - 1) | same(c, i + 1)), at))
    df = df.withColumn("repeated", repeated)
    first = F.struct(F.lit(-WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("repeated", first, lambda s, p: F.struct(
        p.alias("last"), (s["n"] + F.least(F.lit(WINDOW).cast("long"), p - s["last"])).alias("n")), lambda s: s["n"])
    return df.withColumn("n_repeat_words", covered).drop("words", "hashes", "codes", "repeated")


def _among(values: Column, key: Column) -> Column:
    """Whether the ascending array ``values`` holds ``key``, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(values, at + step - 1) <= key, at + step).otherwise(at))
    return F.coalesce(F.get(values, place - 1) == key, F.lit(False))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_words: int = 50, max_repeat_percent: int = 50, line_min_docs: int = 10,
                  line_percent: int = 2, remain_percent: int = 30) -> DataFrame:
    """All columns of ``docs`` with the rule counts, ``base_failed``, ``n_line_words``, ``clean_text`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of the words inside
    three-word windows found twice or more. A line is over the limit when at least ``line_min_docs`` distinct documents
    of its host, and at least ``line_percent`` percent of them, hold it (compared stripped, A-Z lower-cased).
    ``clean_text`` is the text without such lines, ``n_line_words`` the number of words they hold. A document left with
    less than ``remain_percent`` percent of its words is rejected, as is one with ``base_failed``.

    Null text counts as empty and its ``clean_text`` is null; a null host is a host of its own. Rows with the same id
    are one document: their words are counted together for the depletion rule. Rows without an id count as no document
    and lose no line. An empty table gives an empty table. Input columns named like an added one give way.

    A text's lines are looked up among its sorted hashes over the limit, so many lines in one text do no harm. Only hashes, ids and
    counts are shuffled to reach a verdict; the text moves only if ``clean_text`` is asked for.
    """
    names = {"id": id_col, "text": text_col, "host": host_col}
    base = with_text_rules(packed(docs, **names))
    lines = (packed(docs, **names).where(F.col("id").isNotNull())
             .select("id", "host", F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
             .select("id", "host", *hash128(line_key(F.col("line"))), F.size(words_of(F.col("line"))).cast("long").alias("w"))
             .where(F.col("w") > 0))
    # read by the counts of the hosts, the lines to drop and the words of a document: texts are cut into lines once
    pairs = written(lines.groupBy("id", "host", "h1", "h2").agg(F.sum("w").alias("w")), "document-lines")
    held = pairs.groupBy("host", "h1", "h2").agg(F.count("id").alias("n")).where(F.col("n") >= line_min_docs)
    hosts = (packed(docs, **names).select("id", "host").distinct().groupBy(F.col("host").alias("site"))
             .agg(F.count("id").alias("site_docs")))
    over = (held.join(hosts, F.col("host").eqNullSafe(F.col("site")))
            .where(100 * F.col("n") >= line_percent * F.col("site_docs"))
            .select(F.col("host").alias("site"), "h1", "h2"))
    over = written(over, "host-lines").withColumnsRenamed({"h1": "o1", "h2": "o2"})
    hit = pairs.join(over, (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2")) & F.col("host").eqNullSafe(F.col("site")))
    lost = hit.groupBy(F.col("id").alias("owner")).agg(
        F.sum("w").alias("lost"), F.sort_array(F.collect_set(F.struct("host", "h1", "h2"))).alias("drop"))
    total = pairs.groupBy(F.col("id").alias("whole")).agg(F.sum("w").alias("doc_words"))  # no word goes over the end of a line
    lost = lost.join(total, F.col("owner") == F.col("whole")).drop("whole")
    judged = base.join(lost, F.col("id") == F.col("owner"), "left")

    keyed = F.transform(F.split("text", "\n", -1), lambda line: F.struct(
        line.alias("line"), F.struct(F.col("host").alias("host"), *hash128(line_key(line))).alias("key")))
    stay = F.transform(F.filter(keyed, lambda x: ~_among(F.col("drop"), x["key"])), lambda x: x["line"])
    depleted = F.coalesce(100 * (F.col("doc_words") - F.col("lost")) < remain_percent * F.col("doc_words"), F.lit(False))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    clean = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    return unpacked(judged, docs, names, {
        **{c: F.col(c) for c in FEATURES}, "base_failed": failed,
        "n_line_words": F.coalesce("lost", F.lit(0)).cast("long"), "clean_text": clean, "kept": ~failed & ~depleted})
