"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop lines over the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.support import SPACES, ascii_lower, hash128, packed, unpacked
from fleethazard.session import written


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
               min_docs: int = 5) -> DataFrame:
    """``docs`` without the lines that many documents hold.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents goes from
    every document but the one with the largest id. All columns of ``docs`` come back with the remaining lines in
    ``text_col``, and ``n_lines`` (before) and ``n_dropped`` beside them; input columns with these two names give way.

    Null text stays null and counts as one empty line. Rows with the same id are one document, and each row loses its
    lines by itself. Rows without an id count as no document and keep no line that ``min_docs`` documents hold. An empty
    table gives an empty table.

    Keys travel as 128-bit hashes with their place, written once; the places to drop return to each text, found by its id
    and hash, and the lines between them are put together again: work that grows with the lines, however many a text has. A
    key held by a third of all documents is counted map-side first; the joins have shuffles on both sides, so adaptive
    execution splits them.
    """
    names = {"id": id_col, "text": text_col}
    body = F.coalesce("text", F.lit(""))
    base = packed(docs, **names)
    marked = base.select("*", F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(7), body).alias("t2"))
    keyed = marked.select("id", "t1", "t2", F.posexplode(F.split(body, "\n", -1)).alias("place", "line"))
    keyed = keyed.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    keyed = written(keyed.select("id", "t1", "t2", "place", *hash128(F.col("key"))), "line-places")
    over = (keyed.select("id", "h1", "h2").distinct().groupBy("h1", "h2").agg(F.count("id").alias("n"), F.max("id").alias("last"))
            .where(F.col("n") >= min_docs).drop("n"))
    dropped = (keyed.join(written(over, "line-keys"), ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
               .groupBy(F.col("id").alias("owner"), F.col("t1").alias("o1"), F.col("t2").alias("o2"))
               .agg(F.array_sort(F.collect_set("place")).alias("drop")))
    same = (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2")) & F.col("id").eqNullSafe(F.col("owner"))
    judged = marked.join(dropped, same, "left").withColumn("lines", F.split(body, "\n", -1))
    n_dropped = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop"))

    def run(j: Column) -> Column:
        """The lines between the dropped ones number j - 1 and j."""
        start = F.coalesce(F.get("drop", j - 1) + 1, F.lit(0))
        return F.slice("lines", start + 1, F.coalesce(F.get("drop", j), F.size("lines")) - start)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("drop")), run))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    judged = judged.withColumns({"n_lines": F.size("lines").cast("long"), "n_dropped": n_dropped.cast("long"), "text": text})
    return unpacked(judged, docs, names, {"n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")})
