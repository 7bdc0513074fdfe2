"""Sharding by fixed virtual slots: records hash into slots, and a versioned table says which shard holds a slot."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleethazard.llm.support import packed, unpacked
from fleethazard.session import folder_names, scratch

SLOT_MAP = "virtual_slot int, shard int, n_rows long, n_bytes long"


def with_virtual_slot(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = 4096) -> DataFrame:
    """``docs`` packed, with ``virtual_slot`` from id and text, ``size`` and ``text_crc32``. Rows that share an id, or have none, are spread
    by their texts."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return packed(docs, id=id_col, text=text_col).withColumns({
        "virtual_slot": F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), text), F.lit(n_slots)).cast("int"),
        "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text)})


def slot_totals(slotted: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, rows, bytes) of every slot in use: at most ``n_slots`` entries, whatever the table."""
    rows = slotted.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).collect()
    return sorted((r["virtual_slot"], r["n"], r["b"]) for r in rows)


def first_map(totals: list[tuple[int, int, int]], n_shards: int) -> dict[int, int]:
    """Slots by falling bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for slot, _, size in sorted(totals, key=lambda t: (-t[2], t[0])):
        load, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def rebalanced(totals: list[tuple[int, int, int]], placed: dict[int, int], n_shards: int) -> dict[int, int]:
    """``placed`` edited for ``n_shards``, moving few slots: with shards that hold nothing yet, slots move only into
    those; otherwise from shards above the mean into any below it. Slots in use that the map lacks are placed first.

    A slot moves only while its shard stays at the mean or above and the target stays below its shard's old load."""
    size = {slot: b for slot, _, b in totals}
    load = [0] * n_shards
    for slot, shard in placed.items():
        load[shard] += size.get(slot, 0)
    fresh = [k for k in range(n_shards) if k not in set(placed.values())] or list(range(n_shards))
    placed = dict(placed)
    lightest = lambda among: min(among, key=lambda k: (load[k], k))
    for slot in sorted(set(size) - set(placed), key=lambda s: (-size[s], s)):
        placed[slot] = lightest(range(n_shards))
        load[placed[slot]] += size[slot]
    mean = sum(load) / n_shards
    for slot in sorted(size, key=lambda s: (-size[s], s)):
        old, new = placed[slot], lightest(fresh)
        if load[old] - size[slot] >= mean and load[new] + size[slot] < load[old]:
            placed[slot] = new
            load[old] -= size[slot]
            load[new] += size[slot]
    return placed


def read_map(spark: SparkSession, path: str) -> tuple[int, dict[int, int]] | None:
    """(version, shard of each slot) of the newest map under ``path``, if there is one."""
    versions = [int(n.split("=")[1]) for n in folder_names(spark, path) if n.startswith("version=")]
    if not versions:
        return None
    rows = spark.read.schema(SLOT_MAP).parquet(f"{path}/version={max(versions)}").collect()  # n_slots rows at most
    return max(versions), {r["virtual_slot"]: r["shard"] for r in rows}


def write_map(spark: SparkSession, path: str, version: int, placed: dict[int, int], totals: list[tuple[int, int, int]]) -> None:
    """A new version of the map, beside the earlier ones; a version is never written twice."""
    counted = {slot: (n, b) for slot, n, b in totals}
    rows = [(slot, shard, *counted.get(slot, (0, 0))) for slot, shard in sorted(placed.items())]
    spark.createDataFrame(rows, SLOT_MAP).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def current_map(spark: SparkSession, path: str, totals: list[tuple[int, int, int]], n_shards: int, n_slots: int) -> tuple[int, dict[int, int]]:
    """(version, map) for these totals: the newest map edited where it must be, or a first one. An edit is a new version."""
    known = read_map(spark, path)
    if known is None:
        version, placed = 0, first_map(totals, n_shards)
    else:
        if max(known[1], default=0) >= n_slots or max(known[1].values(), default=0) >= n_shards:
            raise ValueError(f"the map under {path} has more slots or shards than {n_slots} and {n_shards}")
        placed = rebalanced(totals, known[1], n_shards)
        if placed == known[1]:
            return known
        version = known[0] + 1
    write_map(spark, path, version, placed, totals)
    return version, placed


def shard_documents(docs: DataFrame, n_shards: int = 8, n_slots: int = 4096, id_col: str = "doc_id",
                    text_col: str = "text", map_path: str | None = None) -> DataFrame:
    """All columns of ``docs`` with ``size``, ``text_crc32``, ``law`` (bytes), ``virtual_slot``, ``shard``, ``slot``,
    ``map_version`` and ``rebalanced_shard``.

    A record's virtual slot is a hash of its id and text modulo ``n_slots`` and never changes. Bytes are summed per slot, and a
    table maps slots to shards so that the shards hold nearly the same bytes. The map is kept under ``map_path``, version by
    version: a later run on other data, or with more shards, reads the newest one, moves the few slots that bring the
    shards nearer to each other, and writes the next. Without a path the map is this run's alone. ``slot`` is the record's
    place in its shard, from 0 without gaps. ``rebalanced_shard`` is its shard once the map is edited for one more shard: slots
    move only into the new one.

    Null text counts as empty, null ids as an empty one; rows alike in id and text share a slot and are placed side by side;
    an empty table gives an empty table. A map for more slots or shards than asked for raises ValueError. Input columns named like an added one give way. A slot holds about 1/``n_slots`` of the rows however hot a
    source, text or passage is; at most ``n_slots`` totals reach the driver, and places within a shard are the sums of the slots
    before plus the place in the slot, so that no task gets a whole shard.
    """
    spark = docs.sparkSession
    names = {"id": id_col, "text": text_col}
    slotted = with_virtual_slot(docs, id_col, text_col, n_slots)
    totals = slot_totals(slotted)
    version, now = current_map(spark, map_path or scratch(spark, "slot-map"), totals, n_shards, n_slots)
    later = rebalanced(totals, now, n_shards + 1)
    seen = dict.fromkeys(range(n_shards), 0)
    before = []
    for slot, n, _ in totals:
        before.append((slot, seen[now[slot]]))
        seen[now[slot]] += n
    rows = [(slot, now[slot], offset, later[slot]) for slot, offset in before]
    lookup = F.broadcast(spark.createDataFrame(rows, "s int, shard int, offset long, rebalanced_shard int"))  # n_slots rows at most
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("id", "size", "text_crc32"))
    placed = slotted.join(lookup, F.col("virtual_slot") == F.col("s")).withColumn("slot", F.col("offset") + place - 1)
    return unpacked(placed, docs, names, {
        "size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("bytes"),
        "virtual_slot": F.col("virtual_slot"), "shard": F.col("shard"), "slot": F.col("slot").cast("long"),
        "map_version": F.lit(version), "rebalanced_shard": F.col("rebalanced_shard")})
