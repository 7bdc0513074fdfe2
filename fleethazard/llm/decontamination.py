"""Benchmark decontamination: winnowed fingerprints of both sides are joined, and hits are extended to exact windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.support import ascii_lower, hash128, packed, unpacked, words_of

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BROADCAST_ROWS = 500_000  # of 16 bytes each


def _words(text: Column) -> Column:
    return words_of(ascii_lower(text), SEPARATORS)


def _positions(n: Column) -> Column:
    """0 .. n - 1, none for n < 1."""
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))


def _grams(hashes: Column, k: int) -> Column:
    """The hash of every k consecutive words."""
    return F.transform(_positions(F.size(hashes) - (k - 1)), lambda i: F.xxhash64(F.lit(k), *[F.get(hashes, i + j) for j in range(k)]))


def _winnowed(grams: Column, span: int) -> Column:
    """The smallest hash of every ``span`` neighbouring grams: one entry for each window of words."""
    return F.transform(_positions(F.size(grams) - (span - 1)), lambda i: F.least(*[F.get(grams, i + j) for j in range(span)]))


def _phrase(words: Column, start: Column, length: int) -> Column:
    return F.struct(F.lit(length).alias("length"), *hash128(F.array_join(F.slice(words, start + 1, length), " ")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, gram: int = 5) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``items`` (ids of items found, as sorted strings), ``n_hit``,
    ``n_items`` and ``contaminated``.

    Words are runs of letters and digits, A-Z lower-cased. An item's windows are its runs of ``window`` words; an item
    with fewer words is one window. ``n_hit`` counts the words inside any occurrence of a window.

    Of each window's ``gram``-word hashes the smallest is kept, so a shared window always leaves the same fingerprint on
    both sides. Document fingerprints are joined with those of the benchmark; for a document with hits, the windows behind
    the hit fingerprints are compared by 128-bit hash, and their words are united. Items shorter than ``window`` are met
    by the hashes of all runs of their own length; only lengths that the benchmark has are computed.

    Null or wordless texts have no hit, null or wordless items none to give; an item without an id contaminates and is
    not listed. Repeated rows are judged each by itself. An empty benchmark leaves all documents clean. Input columns named
    like an added one give way.

    The benchmark's fingerprints are counted: up to ``BROADCAST_ROWS`` fixed-size rows are broadcast, more are joined by a
    shuffle. Documents leave their task only as distinct fingerprints (in the latter case) and, if hit, as text.
    """
    names = {"id": id_col, "text": text_col}
    span = window - gram + 1
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), _words(F.col(item_text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    lengths = sorted(r[0] for r in items.where(n < window).select(n.alias("n")).distinct().collect())
    long_items = items.where(n >= window)

    def marked(df: DataFrame) -> DataFrame:
        """``df`` with a fingerprint for each window in ``mins``, and for each run of a short length k in ``runs<k>``.

        Arrays that a lambda looks into are columns of their own: written inline, they would be built anew for each element.
        For the same reason they are exploded with ``explode_outer``: for ``explode``, Catalyst infers a filter on the array's size
        and pushes it through those columns, which inlines them."""
        df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        df = df.withColumns({"grams": _grams(F.col("hashes"), gram), **{f"runs{k}": _grams(F.col("hashes"), k) for k in lengths}})
        return df.withColumn("mins", _winnowed(F.col("grams"), span)).drop("grams", "hashes")

    known = marked(long_items).select(F.explode_outer("mins").alias("print"))
    for k in lengths:
        known = known.union(marked(items.where(n == k)).select(F.explode_outer(f"runs{k}").alias("print")))
    known = known.distinct()
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)

    phrases = long_items.select("item", F.explode_outer(F.transform(
        _positions(n - (window - 1)), lambda i: _phrase(F.col("words"), i, window))).alias("p"))
    for k in lengths:
        phrases = phrases.union(items.where(n == k).select("item", _phrase(F.col("words"), F.lit(0), k).alias("p")))
    phrases = phrases.groupBy("p").agg(F.collect_set("item").alias("items"))

    base = packed(docs, **names)
    runs = [f"runs{k}" for k in lengths]
    prints = marked(base.select("id", _words(F.col("text")).alias("words")))
    prints = prints.select("id", F.explode_outer(F.array_distinct(F.concat("mins", *runs))).alias("print"))
    hits = prints.join(known, "print").groupBy(F.col("id").alias("owner")).agg(F.collect_set("print").alias("hits"))
    suspects = base.select("id", "text").join(hits, F.col("id").eqNullSafe(F.col("owner"))).drop("owner").distinct()
    suspects = marked(suspects.select("id", *hash128(F.coalesce("text", F.lit(""))), _words(F.col("text")).alias("words"), "hits"))

    def behind(marks: str, k: int) -> Column:
        """Start and phrase of the windows whose fingerprint is a hit."""
        starts = F.filter(_positions(F.size(marks)), lambda i: F.array_contains("hits", F.get(marks, i)))
        return F.transform(starts, lambda i: F.struct(i.alias("start"), _phrase(F.col("words"), i, k).alias("p")))

    windows = F.concat(behind("mins", window), *[behind(f"runs{k}", k) for k in lengths])
    found = suspects.select("id", "h1", "h2", F.explode_outer(windows).alias("w"))
    found = found.select("id", "h1", "h2", "w.start", "w.p").join(phrases, "p")
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("p.length") - 1))))
    found = found.groupBy(F.col("id").alias("owner"), F.col("h1").alias("o1"), F.col("h2").alias("o2")).agg(
        F.size(covered).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    counted = base.withColumn("n_words", F.size(_words(F.col("text"))).cast("long"))
    h1, h2 = hash128(F.coalesce("text", F.lit("")))
    counted = counted.withColumns({"h1": h1, "h2": h2})
    judged = counted.join(found, F.col("id").eqNullSafe(F.col("owner")) & (F.col("h1") == F.col("o1"))
                          & (F.col("h2") == F.col("o2")), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return unpacked(judged, docs, names, {
        "n_words": F.col("n_words"), "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
        "n_items": F.size(listed).cast("long"), "items": listed, "contaminated": F.col("n_hit").isNotNull()})
