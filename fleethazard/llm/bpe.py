"""BPE encoding and decoding with forced boundaries, for vocabularies with word ends (kind ``word_bpe``).

Two symbols that stand side by side inside no token can never be merged, whatever the merges do around them. A word is cut at
all such places, its fragments are encoded independently, and their tokens are concatenated.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleethazard.llm.support import in_small_batches, packed, unpacked

CACHED_WORDS, CACHED_PIECES = 200_000, 200_000  # entries of each half of a Python worker's two caches
LONGEST_CACHED = 128  # letters; longer words and pieces seldom come again, and would fill the caches
SHORT = 48  # fragments of more symbols are merged with a heap
ROWS_OUT = 256


class Cache:
    """The results of ``compute`` in two halves: a full young half becomes the old one, and what is used again returns."""

    def __init__(self, compute: Callable[[str], bytes], entries: int):
        self.compute, self.entries = compute, entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, key: str) -> bytes:
        if len(key) > LONGEST_CACHED:
            return self.compute(key)
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key) or self.compute(key)
            if len(self.young) >= self.entries:
                self.old = self.young.copy()
                self.young.clear()
            self.young[key] = got
        return got


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, spec: str):
        described = json.loads(spec)
        model = described["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pattern = next(p["pattern"]["Regex"] for p in described["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.spaces = regex.compile(r"\p{White_Space}+").split
        self.library = Tokenizer.from_str(spec)
        self.packed = {t: i.to_bytes(4, "little") for i, t in self.tokens.items()}
        self.inside = {pair for token in self.vocab for pair in self._pairs(self._symbols(token))}
        self.words_known, self.pieces_known = Cache(self._word, CACHED_WORDS), Cache(self._piece, CACHED_PIECES)

    def _symbols(self, token: str) -> list[str]:
        """The base symbols of a token; a word end belongs to the symbol before it."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    @staticmethod
    def _pairs(symbols: list[str]) -> Iterator[tuple[str, str]]:
        return zip(symbols, symbols[1:])

    def cuts(self, symbols: list[str]) -> list[int]:
        """Places where no token can lie across."""
        return [i for i, pair in enumerate(self._pairs(symbols), 1) if pair not in self.inside]

    def merge(self, symbols: list[str]) -> list[str]:
        """The merges of lowest rank first, the leftmost of equal ones first."""
        if len(symbols) > SHORT:
            return self._merge_long(symbols)
        rank, never = self.ranks.get, len(self.ranks)
        each = [rank(pair, never) for pair in zip(symbols, symbols[1:])]
        while each:
            least = min(each)
            if least == never:
                break
            i = each.index(least)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del each[i]
            if i:
                each[i - 1] = rank((symbols[i - 1], symbols[i]), never)
            if i < len(each):
                each[i] = rank((symbols[i], symbols[i + 1]), never)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same in n log n: pairs wait in a heap by rank and place; a symbol merged away leaves its neighbours linked."""
        rank, never, n = self.ranks.get, len(self.ranks), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(rank(pair, never) for pair in zip(symbols, symbols[1:])) if r < never]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or not symbols[i] or rank((symbols[i], symbols[j]), never) != r:
                continue  # one of the two has changed since
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = rank((symbols[i], symbols[k]), never)
                if r < never:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0:
                r = rank((symbols[h], symbols[i]), never)
                if r < never:
                    heapq.heappush(heap, (r, h))
        return [s for s in symbols if s]

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece between the splits of the pattern, written in byte symbols."""
        symbols = list(piece)
        symbols[-1] += self.end
        edges = [0, *self.cuts(symbols), len(symbols)]
        return b"".join([self.packed[t] for a, b in zip(edges, edges[1:]) for t in self.merge(symbols[a:b])])

    def _pieces(self, part: str) -> list[str]:
        """Lower-cased pieces in byte symbols. Printable ASCII stands for itself; other text is normalised and split by the
        library, whose Unicode tables may be of another version than Python's."""
        if part.isascii() and part.isprintable():
            low = part.lower()
            return [low] if low.isalpha() else self.split(low)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]

    def _word(self, word: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a run without white space."""
        found = []
        for k, part in enumerate(self.specials(word) if "<|" in word else [word]):
            if k % 2:
                found.append(self.packed[part])
            elif part:
                found += [self.pieces_known.of(piece) for piece in self._pieces(part)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        words = [w for w in self.spaces(text) if w] if odd else text.split()
        found = list(map(self.words_known.young.get, words))
        if None in found:
            found = [f or self.words_known.of(w) for f, w in zip(found, words)]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The tokens joined by a space, as the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@functools.cache
def _loaded(spec: str) -> WordBpe:
    return WordBpe(spec)


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``ids`` (binary, little-endian unsigned 32-bit), ``n_tokens`` and ``decoded``.

    Equal to the tokenizers library with add_special_tokens=False and decode(ids, skip_special_tokens=False). Null and
    empty texts have no ids. A run without white space takes n log n, however long. Repeated rows are encoded each by itself; an empty table gives an empty table. Input columns
    named like an added one give way. Each row is encoded where it is read: no shuffle, and whole texts in batches of
    ``ROWS_OUT`` rows on the way out. The file (a few MB) is read by the driver and travels with the task.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                ids = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
                columns = [*[part.column(c) for c in part.schema.names if c != "text"],
                           pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*[c for c in part.schema.names if c != "text"], "ids", "decoded"])

    names = {"id": id_col, "text": text_col}
    base = in_small_batches(packed(docs, **names))
    base = base.withColumn("whole", F.col("text"))
    schema = base.drop("text").schema.add("ids", "binary").add("decoded", "string")
    done = base.mapInArrow(encode, schema).withColumnRenamed("whole", "text")
    return unpacked(done, docs, names, {
        "ids": F.col("ids"), "n_tokens": F.floor(F.octet_length("ids") / 4).cast("long"), "decoded": F.col("decoded")})
