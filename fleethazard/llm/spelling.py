"""Spelling variants: letters are hashed to a few symbols, reduced words meet by their one-edit neighbourhoods, and the original
words behind them are compared."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.repeats import BASE, WORD, byte_values, mixed, powers
from fleethazard.llm.support import LOWER, UPPER, packed
from fleethazard.session import written

SYMBOLS = (8, 64)  # symbols of the reduced alphabet, and of the finer one for crowded reduced words
CROWD = 1000  # a reduced word of more words than this is crowded
PLACES = 1 << 16  # letters whose neighbours are made at a time
LETTERS = "A-Za-z\\u00C0-\\u00FF"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3,
                typo_modulus: int | None = None) -> DataFrame:
    """``word, n``: maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, of at least ``min_chars`` letters
    and ``min_count`` occurrences.

    With ``typo_modulus``, misspellings are planted first: where it divides the crc32 of "id:run", the run loses the letter
    at that number modulo its length. Null text has no words; a null id counts as an empty one; repeated rows count each. Equal words are
    added up in the task that reads them, so a frequent word is one row a task.
    """
    runs = packed(docs, id=id_col, text=text_col).select("id", F.explode(F.split(F.coalesce("text", F.lit("")), f"[^{LETTERS}]+")).alias("run"))
    run = F.col("run")
    low = F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    words = runs.where(F.char_length(run) >= min_chars).select("id", low.alias("word"))
    if typo_modulus is not None:
        h, at = F.col("h"), (F.col("h") % F.char_length("word")).cast("int")
        short = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        words = words.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary")))
        words = words.select(F.when(h % typo_modulus == 0, short).otherwise(F.col("word")).alias("word")).where(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def symbols_of(words: Sequence[str], symbols: int) -> np.ndarray:
    """The symbols of all letters of the words, one after the other: a hash of the code point."""
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return ((letters * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) >> np.uint64(7)) % np.uint64(symbols)


class ReducedWords:
    """Reduced words (at most 255 symbols) and their hashes: the sum of value(symbol) * BASE^place, closed with the length."""

    def __init__(self, symbol: np.ndarray, lengths: np.ndarray, symbols: int):
        self.symbol, self.lengths = symbol.astype(np.int64), lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(lengths)), self.lengths)
        self.values = byte_values()[:symbols]
        place = np.arange(len(self.symbol)) - self.starts[self.owner]
        self.head = place == 0
        self.scale = powers(BASE, 1 << max(10, int(self.lengths.max(initial=0)).bit_length()))[place]
        self.upto = np.r_[np.zeros(1, np.uint64), np.cumsum(self.values[self.symbol] * self.scale, dtype=np.uint64)]
        self.total = self.upto[self.starts + self.lengths] - self.upto[self.starts]

    @staticmethod
    def _closed(total: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mixed(total + lengths.astype(np.uint64)).astype(np.int64)

    def hashes(self) -> np.ndarray:
        return self._closed(self.total, self.lengths)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the word, hash of a neighbour), each neighbour once: one symbol less, or a higher symbol in one place. The
        rest of the neighbourhood, one symbol more or a lower one, is the same links seen from their other end."""
        back = np.uint64(pow(BASE, -1, WORD))
        for a in range(0, len(self.symbol), PLACES):
            at = slice(a, a + PLACES)
            owner, symbol, scale = self.owner[at], self.symbol[at], self.scale[at]
            total, lengths = self.total[owner], self.lengths[owner]
            k = np.arange(a, a + len(owner))
            before = self.upto[k] - self.upto[self.starts[owner]]
            after = total - before - self.values[symbol] * scale
            first = self.head[at] | (symbol != self.symbol[np.maximum(k - 1, 0)])  # of equal symbols in a row, one goes
            yield owner[first], self._closed(before + after * back, lengths - 1)[first]
            for higher in range(1, len(self.values)):
                put = symbol < higher
                yield owner[put], self._closed((total + (self.values[higher] - self.values[symbol]) * scale)[put], lengths[put])


def _reduced(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with ``form``, the reduced word as bytes, and its hash ``r``."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            found = ReducedWords(symbols_of(texts, symbols), np.array([len(t) for t in texts], dtype=np.int64), symbols)
            signs = found.symbol.astype(np.uint8).tobytes()
            forms = [signs[s:s + n] for s, n in zip(found.starts.tolist(), found.lengths.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.binary()), pa.array(found.hashes())],
                                             [*batch.schema.names, "form", "r"])

    return words.mapInArrow(reduce, words.select("*", F.lit(b"").alias("form"), F.lit(0).cast("long").alias("r")).schema)


def _links(forms: DataFrame, symbols: int) -> DataFrame:
    """``r1, r2``: the reduced words in use that are equal (r1 = r2) or one edit apart, each pair once."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, signs = batch.column("r").to_numpy(), batch.column("form").to_pylist()
            found = ReducedWords(np.frombuffer(b"".join(signs), dtype=np.uint8), np.array([len(s) for s in signs], dtype=np.int64), symbols)
            for owner, key in found.neighbours():
                yield pa.RecordBatch.from_arrays([pa.array(own[owner]), pa.array(key)], ["r", "key"])

    used = forms.select(F.col("r").alias("key")).distinct()
    met = forms.mapInArrow(near, "r long, key long").join(used, "key").where("r <> key")
    return met.select(F.least("r", "key").alias("r1"), F.greatest("r", "key").alias("r2")).distinct().union(
        used.select(F.col("key").alias("r1"), F.col("key").alias("r2")))


def _verified(links: DataFrame, words: DataFrame) -> DataFrame:
    """``a, b``: the words behind linked reduced words that are one edit apart, each pair once. Candidates are compared inside
    the join, so only pairs that stand the comparison become rows."""
    side = lambda name, r: words.select(F.col("r").alias(r), F.struct("word", "n", "crowded").alias(name))
    one_edit = (F.levenshtein("a.word", "b.word", 1) == 1) & ((F.col("r1") != F.col("r2")) | (F.col("a.word") < F.col("b.word")))
    left = links.join(side("a", "r1"), "r1").select("r1", "a", F.col("r2").alias("other"))
    return left.join(side("b", "r2"), (F.col("other") == F.col("r2")) & one_edit).select("a", "b")


def near_words(words: DataFrame, symbols: Sequence[int] = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``a, b`` (structs with ``word`` and ``n``): all pairs of ``words`` (``word, n``, distinct words) that differ by exactly one
    inserted, deleted or replaced code point, each pair once.

    Reduced words of more than ``crowd`` words, and those linked to them, are left out and go through the same with the next,
    finer alphabet; of those pairs the ones with a crowded end are the missing ones. The last alphabet takes what is left. The
    alphabets change how many candidates are compared, not the pairs found."""
    if "crowded" not in words.columns:
        words = words.select("word", "n", F.expr("array()").cast("array<boolean>").alias("crowded"))
    known = written(_reduced(words, symbols[0]), "reduced-words")
    links = _links(known.select("r", "form").distinct(), symbols[0])
    sizes = known.groupBy("r").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > crowd)
    if len(symbols) == 1 or sizes.isEmpty():
        return _verified(links, known)
    links = written(links, "reduced-links")
    hot = written(sizes.select(F.col("r").alias("hot")), "crowded")
    calm = links.join(hot, F.col("r1") == F.col("hot"), "left_anti").join(hot, F.col("r2") == F.col("hot"), "left_anti")
    beside = links.join(hot, F.col("r1") == F.col("hot")).select(F.col("r2").alias("r")).union(
        links.join(hot, F.col("r2") == F.col("hot")).select(F.col("r1").alias("r"))).distinct()  # a crowded one is linked to itself
    again = known.join(beside, "r", "left_semi").join(hot, F.col("r") == F.col("hot"), "left")
    again = again.select("word", "n", F.array_append("crowded", F.col("hot").isNotNull()).alias("crowded"))
    level = F.size("a.crowded")
    finer = near_words(again, symbols[1:], crowd).where(F.element_at("a.crowded", level) | F.element_at("b.crowded", level))
    drop = lambda name: F.struct(f"{name}.word", f"{name}.n", F.slice(f"{name}.crowded", F.lit(1), level - 1).alias("crowded")).alias(name)
    return _verified(calm, known).union(finer.select(drop("a"), drop("b")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of ``forms`` (``word, form``). Counts at least double along a chain, so it ends, and
    following two steps at a time takes rounds as the logarithm of the logarithm of the largest count."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(further, F.col("root") == F.col("at"), "left")
        now = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(words: DataFrame, symbols: Sequence[int] = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (``word, n``: distinct words and their counts).

    Near words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word with the largest n, the
    smallest in code-point order of equal ones, if its n is at least twice the word's own; else null. ``root`` follows
    forms to the last, and is the word itself without one. Every near pair counts, whatever the size of a group. A null word
    has no near words; an empty table gives an empty table.

    Neighbourhoods move as pairs of 64-bit hashes, once for each distinct reduced word; the words join only where two
    reduced words in use are linked. Hashes that meet by chance cost a comparison and change nothing.
    """
    words = written(words.select("word", "n"), "words")  # read twice, and often counted from a whole corpus
    pairs = near_words(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), symbols, crowd)
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = F.min(F.struct((-F.col("b.n")).alias("n"), F.col("b.word").alias("word")))
    near = both.groupBy(F.col("a.word").alias("of")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, F.col("word") == F.col("of"), "left").withColumn("kept", -F.col("best.n") >= 2 * F.col("n"))
    known = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(F.col("kept"), F.col("best.word")).alias("form"),
                                 F.when(F.col("kept"), -F.col("best.n")).alias("form_n")), "word-forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", "form")).withColumnRenamed("word", "of")
    return known.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
