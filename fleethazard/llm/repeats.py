"""What the two exact substring deduplications share: rolling hashes, groups of documents in id order, packed hash lists.

Documents are dealt into groups by ranges of their ids, so that of two groups one holds the smaller ids throughout, or both hold
rows of one id. A group sends each distinct hash once, as sorted lists packed by difference, to the bucket that owns the hash's
range. The bucket knows from the group numbers alone which group holds the smallest id, and answers the later groups only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleethazard.llm.support import packed
from fleethazard.session import written

WORD = 1 << 64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
CELLS = 1 << 16  # measured id ranges that the driver holds at most; beyond that they are divided evenly
SHARES = 1 << 20  # groups that the rows of one id can be dealt to
ROW_BYTES = 64  # what a row counts beside its text
SLAB = 1 << 20  # bytes hashed at a time


@functools.cache
def byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(x: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hashes (modulo 2^64) of every ``width`` neighbours, from hashes of 1, 2, 4 ... neighbours."""
    if len(x) < width:
        return np.zeros(0, dtype=np.uint64)
    whole, whole_span, part, span, left = None, 0, x, 1, width
    while True:
        if left & 1:
            if whole is None:
                whole = part
            else:
                n = min(len(whole), len(part) - whole_span)
                whole = whole[:n] + part[whole_span:whole_span + n] * np.uint64(pow(base, whole_span, WORD))
            whole_span += span
        left >>= 1
        if not left:
            return whole[:len(x) - width + 1]
        part = part[:-span] + part[span:] * np.uint64(pow(base, span, WORD))
        span *= 2


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of ``byte_values`` of a text, from prefix sums."""
    size = 1 << max(20, int(len(values)).bit_length())
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASE, size)[:len(values)], out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * powers(pow(BASE, -1, WORD), size)[starts] + (ends - starts).astype(np.uint64))


def slabs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts of about ``SLAB`` bytes."""
    a = size = 0
    for b, text in enumerate(texts, 1):
        size += len(text)
        if size >= SLAB or b == len(texts):
            yield a, b
            a, size = b, 0


def merged(ranges: pd.DataFrame, limit: int) -> pd.DataFrame:
    """``ranges`` with neighbours joined while they hold ``limit`` bytes together."""
    out: list[list[int]] = []
    for low, high, size in zip(ranges["low"].tolist(), ranges["high"].tolist(), ranges["bytes"].tolist()):
        if out and out[-1][2] + size <= limit:
            out[-1][1:] = [high, out[-1][2] + size]
        else:
            out.append([low, high, size])
    return pd.DataFrame(out, columns=["low", "high", "bytes"], dtype="int64")


def id_ranges(sizes: DataFrame, limit: int) -> pd.DataFrame:
    """The ids of ``sizes`` (id, bytes) in ascending ranges, each with its first and last id and its bytes.

    Each range holds at most ``limit`` bytes or one id alone. One that holds more is cut evenly by value, and measured again from
    the first to the last id in each part, so that it narrows to where the bytes are."""
    measures = [F.min("id").alias("low"), F.max("id").alias("high"), F.sum("bytes").alias("bytes")]
    ranges = sizes.agg(*measures).dropna().toPandas()
    while True:
        ranges = merged(ranges.sort_values("low"), limit)
        heavy = (ranges["bytes"] > limit) & (ranges["low"] < ranges["high"])
        if not heavy.any():
            return ranges
        parts = np.where(heavy, 1 + 2 * -(-ranges["bytes"] // limit), 1).tolist()
        starts = np.array([low + (high + 1 - low) * k // n for low, high, n in zip(ranges["low"].tolist(), ranges["high"].tolist(), parts)
                           for k in range(n)], dtype=np.int64)
        ranges = sizes.groupBy(_place(starts)(F.col("id"))).agg(*measures).select("low", "high", "bytes").toPandas()


def _place(starts: np.ndarray):
    """How many of the ascending ``starts`` don't exceed a value."""

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy(), side="right"))

    return place


def grouped_by_id(docs: DataFrame, id_col: str, text_col: str, group_bytes: int) -> tuple[DataFrame, int]:
    """``docs`` packed, with group number ``g``, and the number of groups that its bytes fill.

    The groups follow the ids and hold about ``group_bytes`` each, by measured ranges; where the corpus has more than a quarter of
    ``CELLS`` groups, a range holds several, divided evenly by value. What an id holds beyond a group is dealt by text to groups
    of the same rank (``rank_of``). Rows without an id are spread by their text over groups of their own, below 0."""
    base = packed(docs, id=id_col, text=text_col)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    sizes = written(base.select(F.col("id").cast("long").alias("id"), size.alias("bytes")), "id-bytes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, -(-total // group_bytes))
    ranges = merged(id_ranges(sizes.dropna(), max(1, group_bytes // 4, 4 * total // CELLS)), group_bytes)
    if not len(ranges):
        ranges = pd.DataFrame({"low": [0], "high": [0], "bytes": [0]})
    low, high = ranges["low"].to_numpy(), ranges["high"].to_numpy()
    pieces = np.maximum(1, -(-ranges["bytes"].to_numpy() // group_bytes))
    shares = np.where(low == high, np.minimum(pieces, SHARES), 1)
    parts = np.where(low == high, 1, pieces)
    rank = np.cumsum(parts) - parts

    @F.pandas_udf("long")
    def group(ids: pd.Series, dealt: pd.Series) -> pd.Series:
        x = ids.to_numpy(dtype=np.int64)
        r = np.maximum(np.searchsorted(low, x, side="right") - 1, 0)
        first = low[r].astype(np.float64)
        part = (x.astype(np.float64) - first) / np.maximum(high[r].astype(np.float64) - first, 1.0) * parts[r]
        part = np.clip(part.astype(np.int64), 0, parts[r] - 1)
        return pd.Series((rank[r] + part) * SHARES + dealt.to_numpy() % shares[r])

    by_text = F.xxhash64(F.coalesce("text", F.lit("")))
    known = group(F.coalesce(F.col("id").cast("long"), F.lit(0)), by_text if shares.max() > 1 else F.lit(0).cast("long"))
    return base.withColumn("g", F.when(F.col("id").isNull(), -1 - F.pmod(by_text, F.lit(n))).otherwise(known)), n


def rank_of(g: np.ndarray) -> np.ndarray:
    """Of groups with different ranks, the lower one holds the smaller ids; groups of one rank share a single id."""
    return g // SHARES


def in_id_order(docs: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """The rows of a group by id, their ids and their texts as UTF-8; rows without an id have no part in any match."""
    docs = docs.combine_chunks()
    if docs.num_rows and docs.column("id").null_count:
        return docs, np.zeros(docs.num_rows, dtype=np.int64), _utf8(docs)
    docs = docs.take(pa.array(np.argsort(docs.column("id").to_numpy(), kind="stable")))
    return docs, docs.column("id").to_numpy(), _utf8(docs)


def _utf8(docs: pa.Table) -> list[bytes]:
    return [t or b"" for t in docs.column("text").cast(pa.binary()).to_pylist()]


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit integers as differences, byte planes apart: the high planes are nearly all zero and compress away."""
    steps = np.diff(values, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def by_bucket(values: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Number, start and end of those of ``n`` even hash ranges that the sorted ``values`` reach."""
    bucket = (values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, dtype=np.int64)
    return list(zip(bucket[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist()))


def flags(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Of ``n`` places, those within ``width`` places from a start on."""
    if not len(starts):
        return np.zeros(n, dtype=bool)
    marks = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + width, n), minlength=n + 1)
    return np.cumsum(marks[:n]) > 0


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edge = np.flatnonzero(np.diff(np.r_[0, marked.astype(np.int8), 0]))
    return edge[::2], edge[1::2]


def spans_array(spans: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a, _ in spans])].astype(np.int32)
    start, end = (np.concatenate([s[k] for s in spans] or [np.zeros(0)]).astype(np.int64) for k in (0, 1))
    kind = pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(start), pa.array(end)], fields=list(kind)))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), True)


