"""SimHash near-dedup by the generalised pigeonhole principle.

The 64 bits are dealt into partitions, correlated bits together. If the thresholds of the partitions add up to the distance
less the number of partitions plus one, two fingerprints within the distance agree up to the threshold in at least one
partition; a threshold of -1 skips a partition. Each fingerprint gets the thresholds with the fewest estimated candidates, by
dynamic programming over the partitions; its neighbours in the partitions probed are then verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.llm.components import connected_components
from fleethazard.llm.support import hash128, packed, unpacked
from fleethazard.session import written

SEED = 42
PARTITIONS = 4
HALF = 8  # bits of a histogram: half a partition
CHUNK = 200_000  # shingles hashed at a time
PROBE_COST = 2.0  # of a probed value, in candidates
DENSE = 64  # buckets with more members are searched from frontier to frontier
HOT = 20_000  # buckets with more members are cut by the principle's second use


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text, as a signed 64-bit integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    k = min(shingle, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at:min(n, at + CHUNK)].tolist(), ends[k - 1 + at:k - 1 + min(n, at + CHUNK)].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, shingle: int) -> DataFrame:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn("fp", of("text"))


def bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def grouped_bits(together: np.ndarray, n: int, partitions: int = PARTITIONS) -> list[list[int]]:
    """Bits in equal partitions, each grown from the most correlated free pair by the bit most correlated with it.

    ``together[i, j]``: number of fingerprints with both bits set."""
    mean = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    scale = np.sqrt(np.clip(mean * (1 - mean), 1e-12, None))
    corr = np.abs(cov / np.outer(scale, scale))
    free, groups = list(range(64)), []
    while free:
        first = max(combinations(free, 2), key=lambda p: corr[p[0], p[1]])
        group = list(first)
        while len(group) < 64 // partitions:
            group.append(max((b for b in free if b not in group), key=lambda b: corr[b, group].sum()))
        groups.append(sorted(group))
        free = [b for b in free if b not in group]
    return groups


def project(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return bits[:, group].astype(np.int64) @ (1 << np.arange(len(group), dtype=np.int64))


@dataclass
class Probing:
    """The partitions of the bits, and how many fingerprints are expected near a value of each."""

    groups: list[list[int]]
    halves: np.ndarray  # (partition, half, value) -> share of the fingerprints
    n: int
    distance: int

    def __post_init__(self):
        values = np.arange(1 << HALF)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        at = [(apart == d).astype(float) for d in range(self.distance + 1)]
        # (partition, half, value, d): share at distance d
        self.near = np.stack([np.einsum("uv,phv->phu", a, self.halves) for a in at], axis=-1)
        width = len(self.groups[0])
        self.masks = [np.array([sum(1 << b for b in c) for r in range(t + 1) for c in combinations(range(width), r)], dtype=np.int64)
                      for t in range(self.distance + 1)]

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """(fingerprints, partitions) from their values: the allocation with the least estimated work."""
        m, top = len(self.groups), self.distance
        budget = top - m + 1 + m  # in steps above -1
        work = np.zeros((len(values), m, top + 2))
        for p in range(m):
            low = self.near[p, 0][values[:, p] & ((1 << HALF) - 1)]
            high = self.near[p, 1][values[:, p] >> HALF]
            found = 0.0
            for t in range(top + 1):
                found = found + sum(low[:, d] * high[:, t - d] for d in range(t + 1))
                work[:, p, t + 1] = self.n * found + PROBE_COST * len(self.masks[t])
        best = np.full((len(values), budget + 1), np.inf)
        best[:, 0] = 0
        came = np.zeros((len(values), m, budget + 1), dtype=np.int8)
        for p in range(m):
            new = np.full_like(best, np.inf)
            for s in range(budget + 1):
                for t in range(min(s, top + 1) + 1):
                    cost = best[:, s - t] + work[:, p, t]
                    better = cost < new[:, s]
                    new[better, s] = cost[better]
                    came[better, p, s] = t
            best = new
        out = np.zeros((len(values), m), dtype=np.int64)
        left = np.full(len(values), budget)
        rows = np.arange(len(values))
        for p in reversed(range(m)):
            out[:, p] = came[rows, p, left]
            left = left - out[:, p]
        return out - 1

    def rows(self, fps: np.ndarray) -> pd.DataFrame:
        """(key, fp, probes): a row in each partition's own bucket, and one for each further value probed."""
        bits = bit_matrix(fps)
        values = np.stack([project(bits, g) for g in self.groups], axis=1)
        chosen = self.thresholds(values)
        keys, owners, probes = [], [], []
        width = len(self.groups[0])
        for p in range(len(self.groups)):
            keys.append((p << width) | values[:, p])
            owners.append(fps)
            probes.append(chosen[:, p] >= 0)
            for t in range(1, self.distance + 1):
                who = np.flatnonzero(chosen[:, p] == t)
                masks = self.masks[t][1:]
                keys.append(((p << width) | (values[who, p][:, None] ^ masks[None, :])).ravel())
                owners.append(np.repeat(fps[who], len(masks)))
                probes.append(np.ones(len(who) * len(masks), dtype=bool))
        return pd.DataFrame({"key": np.concatenate(keys), "fp": np.concatenate(owners), "probes": np.concatenate(probes)})


def fit_probing(fps: DataFrame, distance: int, partitions: int = PARTITIONS) -> Probing:
    """Bit correlations and value histograms of all fingerprints; a fixed number of sums reaches the driver."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            bits = bit_matrix(b.column(0).to_numpy()).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        i, j = np.divmod(np.arange(4097), 64)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array([*total.ravel().astype(np.int64).tolist(), n])], ["i", "j", "n"])

    sums = fps.select("fp").mapInArrow(pairs, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(4097, dtype=np.int64)
    for r in sums:
        counts[r["i"] * 64 + r["j"]] = r["n"]
    n = int(counts[4096])
    groups = grouped_bits(counts[:4096].reshape(64, 64), n, partitions)

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(groups), 2, 1 << HALF), dtype=np.int64)
        for b in batches:
            bits = bit_matrix(b.column(0).to_numpy())
            for p, g in enumerate(groups):
                v = project(bits, g)
                total[p, 0] += np.bincount(v & ((1 << HALF) - 1), minlength=1 << HALF)
                total[p, 1] += np.bincount(v >> HALF, minlength=1 << HALF)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "n"])

    seen = np.zeros((len(groups), 2, 1 << HALF))
    for r in fps.select("fp").mapInArrow(halves, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        seen.flat[r["i"]] = r["n"]
    return Probing(groups, seen / max(n, 1), n, distance)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each component of ``n`` nodes under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, as a forest, the fingerprints within ``distance`` of each other that share a key.

    Rows are sorted by key. Small buckets are compared row by row at growing shifts. In a large one, those not yet reached are
    compared with the last ones reached: each member is compared once with what is left, and no pair is kept."""
    n = len(key)
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if n else np.array([0])
    sizes = np.diff(edges)
    small = np.repeat(sizes <= DENSE, sizes)
    ends = np.repeat(edges[1:], sizes)
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    rows = np.flatnonzero(small)
    for shift in range(1, DENSE):
        rows = rows[rows + shift < ends[rows]]
        if not len(rows):
            break
        near = rows[np.bitwise_count(fp[rows] ^ fp[rows + shift]) <= distance]
        a.append(near)
        b.append(near + shift)
    for k in np.flatnonzero(sizes > DENSE):
        left = np.arange(edges[k], edges[k + 1])
        frontier = left[:0]
        while len(left):
            if not len(frontier):
                frontier, left = left[:1], left[1:]
            probe, frontier = frontier[:256], frontier[256:]
            near = np.bitwise_count(fp[probe][:, None] ^ fp[left][None, :]) <= distance
            hit = near.any(axis=0)
            if hit.any():
                a.append(probe[near[:, hit].argmax(axis=0)])
                b.append(left[hit])
                frontier = np.concatenate([frontier, left[hit]])
                left = left[~hit]
    a_all, b_all = np.concatenate(a), np.concatenate(b)
    if not len(a_all):
        return fp[:0], fp[:0]
    names, node = np.unique(fp, return_inverse=True)
    root = _roots(len(names), node[a_all], node[b_all])
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved].view(np.int64), names[root[moved]].view(np.int64)


def hamming_links(fps: DataFrame, distance: int, partitions: int = PARTITIONS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints within ``distance`` bits."""
    plan = fit_probing(fps, distance, partitions)
    width = 64 // partitions

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pandas(plan.rows(b.column(0).to_numpy()), preserve_index=False)

    probes = written(fps.select("fp").mapInArrow(probe, "key long, fp long, probes boolean"), "probes")
    keys = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("probes").alias("asked")).where("n > 1 AND asked")
    keys = written(keys, "probe-keys")
    probes = probes.join(keys, "key")
    # within a bucket the pigeonhole holds again for the other bits: more parts than the distance, one of them equal
    parts = distance + 1
    others = F.array(*[F.struct(F.lit(i).alias("part"), _picked(plan.groups, width, i, parts).alias("value")) for i in range(parts)])
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("value")))
    probes = probes.withColumn("sub", F.explode(F.when(F.col("n") > HOT, others).otherwise(whole)))
    dealt = probes.select(F.xxhash64("key", "sub.part", "sub.value").alias("bucket"), "fp")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key, fp):
            a, b = linked(key, fp, distance)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        keys_held, fps_held = [], []
        for batch in batches:
            keys_held.append(batch.column(0).to_numpy())
            fps_held.append(batch.column(1).to_numpy().view(np.uint64))
            if sum(map(len, keys_held)) < 500_000:
                continue
            key, fp = np.concatenate(keys_held), np.concatenate(fps_held)
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if cut:
                yield links(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
            keys_held, fps_held = [key], [fp]
        if keys_held:
            yield links(np.concatenate(keys_held), np.concatenate(fps_held))

    return dealt.mapInArrow(verify, "a long, b long")


def _picked(groups: list[list[int]], width: int, part: int, parts: int):
    """The bits outside a row's own partition that belong to ``part``, in place: a value that equal parts share."""
    masks = []
    for p in range(len(groups)):
        rest = [b for q, g in enumerate(groups) if q != p for b in g]
        value = sum(1 << b for b in rest[part::parts])
        masks.append(value - (1 << 64) if value >= 1 << 63 else value)
    return F.col("fp").bitwiseAND(F.element_at(F.array(*map(F.lit, masks)), (F.shiftright("key", width) + 1).cast("int")))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``(id, t1, t2, fp)`` of each row, and ``(fp, first, root)`` of each fingerprint: its smallest id and the fingerprint that
    names its component."""
    base = packed(docs, id=id_col, text=text_col)
    h1, h2 = hash128(F.coalesce("text", F.lit("")))
    prints = with_fingerprint(base.select("id", h1.alias("t1"), h2.alias("t2"), "text"), shingle).drop("text")
    prints = written(prints, "fingerprints")
    first = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = connected_components(hamming_links(first, distance))
    return prints, first.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   distance: int = 3) -> DataFrame:
    """``(id, t1, t2, fp, component_id)`` for each row of ``docs``: the 128-bit hash of its text, its fingerprint and the smallest
    id among all rows reachable by fingerprints at most ``distance`` bits apart.

    Words are runs without white space, A-Z lower-cased; shingles of ``shingle`` words are hashed by XXH64 and vote on each
    bit. Texts with fewer words are one shingle; texts without words (and null) have fingerprint 0, which links like any
    other. Rows without an id take part and never name a component, unless no row of it has an id (then it is null).
    An empty table gives an empty table.

    Only 64-bit fingerprints are compared, each distinct one once, so copies cost nothing however many there are. Buckets of
    more than ``HOT`` fingerprints are cut by further bits; what leaves a bucket is a forest, never all pairs.
    """
    prints, rooted = _rooted(docs, id_col, text_col, shingle, distance)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(named, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("id", "t1", "t2", "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component of ``simhash_groups``: that with the smallest id (of rows that repeat an id, the
    one with the smallest text hash). A component without any id keeps one of its rows. Components are told apart by their
    fingerprints, not by ids, which may be null or repeat."""
    prints, rooted = _rooted(docs, id_col, text_col, shingle, distance)
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "t1", "t2")
    chosen = (prints.groupBy("fp").agg(F.min(rank).alias("t")).join(rooted.select("fp", "root"), "fp")
              .groupBy("root").agg(F.min("t").alias("t")).select(F.col("t.id").alias("owner"), "t.t1", "t.t2"))
    names = {"id": id_col, "text": text_col}
    h1, h2 = hash128(F.coalesce("text", F.lit("")))
    base = packed(docs, **names).withColumns({"h1": h1, "h2": h2})
    kept = base.join(chosen, F.col("id").eqNullSafe(F.col("owner")) & (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2")))
    nth = F.row_number().over(Window.partitionBy("id", "h1", "h2").orderBy("id"))
    return unpacked(kept.withColumn("nth", nth).where("nth = 1"), docs, names, {})
