"""Suffix-array dedup: exact removal of byte strings that also start in an earlier document.

Documents are cut where the smallest 24-byte hash inside a window of ``width`` bytes changes. The cuts depend on the bytes
around them alone, so equal windows lie in pieces with the same smallest hash (their anchor). Pieces equal as a whole are
settled by their hashes. Different pieces under one anchor are compared by suffix arrays, built by linear grouping: suffixes
are grouped by their longest Lyndon prefix, and each group's order is then emitted, without renaming or recursion.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.repeats import (SPANS, by_bucket, byte_values, flags, grouped_by_id, in_id_order, mixed, pack, rank_of, rolling,
                                     runs, slabs, span_hashes, spans_array, unpack)
from fleethazard.llm.support import unpacked

GRAM = 24  # bytes hashed for anchors
LONGEST = 1_024  # windows of one piece; only periodic stretches have more than width - GRAM + 1 under one anchor
SHARED = 4  # groups whose packed lists fill a bucket
SPLIT = 5_000  # different pieces under one anchor beyond which they are sent window by window
BATCH = 1 << 18  # bytes of candidates in one suffix array
KNOWN_BEFORE, COMPARE, COMPARE_WINDOWS, FOUND = range(4)


def lyndon_groups(text: bytes) -> tuple[list[int], list[int]]:
    """For each suffix, the first place of its group in suffix order, and the previous smaller suffix (-1: none).

    Groups start as equal first bytes and are processed in descending order. For each member, the previous smaller suffix is the
    nearest one to the left in a lower group: the processed group's prefix extends the prefix of that suffix, which moves
    behind the rest of its own group; suffixes extended more often move further."""
    n = len(text)
    places = defaultdict(set)
    for i, b in enumerate(text):
        places[b].add(i)
    members: dict[int, set[int]] = {}
    start_of_end: dict[int, int] = {}
    group = [0] * n
    at = 0
    for b in sorted(places):
        members[at] = places[b]
        for i in places[b]:
            group[i] = at
        start_of_end[at + len(places[b])] = at
        at += len(places[b])
    previous = [-1] * n
    end = n
    while end > 0:
        g = start_of_end[end]
        extended: dict[int, int] = {}
        for i in sorted(members[g]):
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                extended[j] = extended.get(j, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, times in extended.items():
            by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            moving: dict[int, list[int]] = {}
            for p in by_times[times]:
                moving.setdefault(group[p], []).append(p)
            for s, moved in moving.items():
                old = members[s]
                if len(moved) == len(old):
                    continue  # the whole group: its place in the order stays
                old.difference_update(moved)
                new, stop = s + len(old), s + len(old) + len(moved)
                members[new] = set(moved)
                for p in moved:
                    group[p] = new
                start_of_end[stop], start_of_end[new] = new, s
        end = g
    return group, previous


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes in ascending order, in time linear in the text (but for sorting each group's members).

    In suffix order, each suffix says which ones end their Lyndon prefix where it starts: the one to its left and, from there,
    previous smaller ones, up to the first already placed. Each goes to the next free place of its group."""
    group, previous = lyndon_groups(text)
    n = len(text)
    order, placed = [0] * n, bytearray(n)
    free: dict[int, int] = {}
    for rank in range(-1, n):
        j = (order[rank] if rank >= 0 else n) - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            to = free.get(g, g)
            order[to], free[g], placed[j] = j, to + 1, 1
            j = previous[j]
    return order


def repeated_windows(pieces: list[bytes], ids: np.ndarray, width: int) -> list[np.ndarray]:
    """For each piece, the windows whose bytes also occur in a piece with a smaller id, from a suffix array.

    Only runs of windows whose hash occurs under two ids go into the array, each different run once: the smallest id of any run
    that holds a window settles it for all."""
    found = [np.zeros(0, dtype=np.int64) for _ in pieces]
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    hashes = rolling(byte_values()[data], width)
    if not len(hashes):
        return found
    lengths = np.array([len(p) for p in pieces])
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(pieces)), lengths)[:len(hashes)]
    inside = np.arange(len(hashes)) + width <= (begins + lengths)[owner]
    twice = np.zeros(len(hashes), dtype=bool)
    at = np.flatnonzero(inside)
    if not len(at):
        return found
    at = at[np.argsort(hashes[at], kind="stable")]
    heads = np.flatnonzero(np.r_[True, hashes[at][1:] != hashes[at][:-1]])
    held = ids[owner[at]]
    differ = np.minimum.reduceat(held, heads) != np.maximum.reduceat(held, heads)
    twice[at[np.repeat(differ, np.diff(np.r_[heads, len(at)]))]] = True
    cut = np.r_[True, owner[1:] != owner[:-1]]
    heads = np.flatnonzero(twice & (cut | ~np.r_[False, twice[:-1]]))
    if not len(heads):
        return found
    sizes = np.flatnonzero(twice & np.r_[cut[1:] | ~twice[1:], True]) + 1 - heads
    number: dict[bytes, int] = {}  # equal runs go in once
    run = np.array([number.setdefault(data[a:a + n + width - 1].tobytes(), len(number)) for a, n in zip(heads.tolist(), sizes.tolist())])
    text = b"\xff".join(number) + b"\xff"  # a byte that UTF-8 doesn't have
    lengths_in = np.array([len(t) + 1 for t in number])
    begins_in = np.cumsum(lengths_in) - lengths_in
    smallest = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(smallest, run, ids[owner[heads]])
    order = np.array(suffix_array(text))
    starts = np.zeros(len(text), dtype=bool)  # where windows start
    starts[np.repeat(begins_in, lengths_in - width) + _counting(lengths_in - width)] = True
    order = order[starts[order]]
    windows = [text[at:at + width] for at in order.tolist()]
    first = np.flatnonzero(np.r_[True, [x != y for x, y in zip(windows, windows[1:])]])
    least = np.zeros(len(text), dtype=np.int64)  # the smallest id that holds a window
    held = np.repeat(smallest, lengths_in)[order]
    least[order] = np.repeat(np.minimum.reduceat(held, first), np.diff(np.r_[first, len(order)]))
    source = np.repeat(owner[heads], sizes)
    later = least[np.repeat(begins_in[run], sizes) + _counting(sizes)] < ids[source]
    places = (np.repeat(heads, sizes) + _counting(sizes) - begins[source])[later]
    return np.split(places, np.searchsorted(source[later], np.arange(1, len(pieces))))


def pieces_of(texts: list[bytes], width: int) -> dict[str, np.ndarray]:
    """Anchor, hash, text number, first window (from the text's start) and number of windows of every piece."""
    out = {k: [np.zeros(0, dtype=t)] for k, t in (("anchor", np.uint64), ("hash", np.uint64), ("owner", int), ("first", int), ("n", int))}
    for a, b in slabs(texts):
        data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
        values = byte_values()[data]
        least = mixed(rolling(values, GRAM))
        if len(data) < width:
            continue
        span = 1
        over = width - GRAM + 1
        while 2 * span <= over:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < over:
            least = np.minimum(least[:span - over], least[over - span:])
        lengths = np.array([len(t) for t in texts[a:b]])
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(b - a), lengths)[:len(least)]
        inside = np.arange(len(least)) + width <= ends[owner]
        change = np.r_[True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])]
        heads = np.flatnonzero(inside & (change | ~np.r_[False, inside[:-1]]))
        tails = np.flatnonzero(inside & np.r_[change[1:] | ~inside[1:], True]) + 1
        parts = -(-(tails - heads) // LONGEST)
        tails = np.repeat(tails, parts)
        heads = np.repeat(heads, parts) + _counting(parts) * LONGEST
        tails = np.minimum(tails, heads + LONGEST)
        out["anchor"].append(mixed(least[heads]) >> np.uint64(24))  # minima crowd at the low end; mixed, they fill the buckets evenly
        out["hash"].append(span_hashes(values, heads, tails + width - 1))
        out["owner"].append(owner[heads] + a)
        out["first"].append(heads - (ends - lengths)[owner[heads]])
        out["n"].append(tails - heads)
    return {k: np.concatenate(v) for k, v in out.items()}


def windows_once(asked_for: np.ndarray, pieces: dict[str, np.ndarray], ids: np.ndarray, texts: list[bytes],
                 width: int) -> tuple[dict[bytes, tuple[int, int, int]], list[tuple[int, int, int, bytes]]]:
    """Of the pieces with the hashes ``asked_for``: the first (id, hash, place) of each different window, by id, and all others
    with their window."""
    hashes, index = np.unique(pieces["hash"], return_index=True)  # the first is that of the smallest id
    index = np.sort(index[np.searchsorted(hashes, asked_for)])  # a group is asked only for what it has sent
    first: dict[bytes, tuple[int, int, int]] = {}
    again = []
    for i in index.tolist():
        k, a, h = pieces["owner"][i], int(pieces["first"][i]), int(pieces["hash"][i])
        doc, text = int(ids[k]), texts[k]
        for at in range(int(pieces["n"][i])):
            window = text[a + at:a + at + width]
            if first.setdefault(window, (doc, h, at)) != (doc, h, at):
                again.append((doc, h, at, window))
    return first, again


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                 group_bytes: int = 4 << 20) -> DataFrame:
    """All columns of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``removed`` (maximal byte intervals) and ``kept``
    (binary: the UTF-8 bytes left, which may start or end inside a character).

    A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id; overlaps count, matches
    never cross documents, and strings are judged on the input. Null text counts as empty; texts shorter than ``width`` lose
    nothing. Rows with the same id are separate documents, neither of them earlier; rows without an id lose nothing and are
    earlier than none. An empty table gives an empty table; input columns named like an added one give way.

    The text is shuffled once, by groups of ids of about ``group_bytes`` each (rows of one id are dealt to several by their text; rows
    equal in both stay together). Periodic stretches make pieces of at most ``LONGEST`` windows. Anchors and hashes of pieces travel as packed lists; whole pieces are equal if
    their 64-bit hashes and anchors are, parts of pieces by their bytes. A piece of any number of copies is sent for comparison once (for an
    id dealt to several groups, once from each).
    Anchors with more than ``SPLIT`` different pieces are compared window by window, spread by the windows' hashes; a group
    sends equal windows once and answers its later documents itself.
    """
    names = {"id": id_col, "text": text_col}
    base, n_groups = grouped_by_id(docs, id_col, text_col, group_bytes)

    def own(table: pa.Table):
        table, ids, texts = in_id_order(table)
        return table, ids, texts, pieces_of(texts, width)

    def send(table: pa.Table) -> pa.Table:
        g = table.column("g")[0].as_py()
        out = []
        if g >= 0:
            _, _, _, pieces = own(table)
            hashes, index = np.unique(pieces["hash"], return_index=True)
            anchors = pieces["anchor"][index]
            by = np.argsort(anchors, kind="stable")
            anchors, hashes = anchors[by], hashes[by]
            out = [(k, g, pack(anchors[a:b]), hashes[a:b].tobytes())
                   for k, a, b in by_bucket(anchors << np.uint64(24), max(1, n_groups // SHARED))]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], ["bucket", "g", "anchors", "hashes"])

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("g")
        groups = table.column("g").to_numpy()
        lists = [unpack(b.as_py()) for b in table.column("anchors")]
        g = np.repeat(groups, [len(x) for x in lists])
        anchors = np.concatenate(lists)
        hashes = np.concatenate([np.frombuffer(b.as_py(), dtype=np.uint64) for b in table.column("hashes")])
        by = np.lexsort((hashes, anchors))  # keeps the order of groups
        anchors, hashes, g = anchors[by], hashes[by], g[by]
        new_anchor = np.r_[True, anchors[1:] != anchors[:-1]]
        first = new_anchor | np.r_[True, hashes[1:] != hashes[:-1]]
        number = np.cumsum(new_anchor) - 1
        different = np.bincount(number[first])[number]
        rank = rank_of(g)
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        kind = np.where(rank > rank[head], KNOWN_BEFORE, np.where(different > SPLIT, COMPARE_WINDOWS, np.where(different > 1, COMPARE, -1)))
        out = []
        for k in (KNOWN_BEFORE, COMPARE, COMPARE_WINDOWS):
            mine = np.flatnonzero(kind == k)
            mine = mine[np.lexsort((hashes[mine], g[mine]))]
            edges = np.flatnonzero(np.diff(g[mine], prepend=-1, append=-1))
            out += [(int(g[mine[a]]), k, pack(hashes[mine[a:b]])) for a, b in zip(edges, edges[1:])]
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                     pa.array([o[2] for o in out], pa.binary())], ["g", "kind", "hashes"])

    def told(answers: pa.Table, kind: int) -> np.ndarray:
        lists = [unpack(b) for k, b in zip(answers.column("kind").to_pylist(), answers.column("hashes").to_pylist()) if k == kind]
        return np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *lists]))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            _, ids, texts, pieces = own(left)
            g = left.column("g")[0].as_py()
            hashes, index = np.unique(pieces["hash"], return_index=True)  # the first is that of the smallest id
            asked_for = told(right, COMPARE)
            at = np.searchsorted(hashes, asked_for)  # a group is asked only for what it has sent
            for h, i in zip(asked_for.tolist(), index[at].tolist()):
                k, a, n = pieces["owner"][i], pieces["first"][i], pieces["n"][i]
                out.append((int(pieces["anchor"][i]), g, h, 0, int(ids[k]), texts[k][a:a + n + width - 1]))
            first, _ = windows_once(told(right, COMPARE_WINDOWS), pieces, ids, texts, width)
            windows = list(first)
            for a, b in slabs(windows):
                data = np.frombuffer(b"".join(windows[a:b]), dtype=np.uint8)
                values = mixed(rolling(byte_values()[data], width)[::width]) >> np.uint64(24)
                out += [(v, g, h, at, doc, w) for v, w in zip(values.tolist(), windows[a:b]) for doc, h, at in (first[w],)]
        key = pa.array([o[0] for o in out], pa.int64())
        bucket = pa.array([(o[0] * n_groups) >> 40 for o in out], pa.int64())
        return pa.Table.from_arrays([bucket, key, pa.array([o[1] for o in out], pa.int64()),
                                     pa.array(np.array([o[2] for o in out], dtype=np.uint64).view(np.int64)),
                                     pa.array([o[3] for o in out], pa.int32()), pa.array([o[4] for o in out], pa.int64()),
                                     pa.array([o[5] for o in out], pa.binary())], ["bucket", "key", "g", "hash", "at", "id", "piece"])

    def sort_suffixes(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.take(pa.array(np.lexsort((table.column("id").to_numpy(), table.column("key").to_numpy()))))
        key, ids = table.column("key").to_numpy(), table.column("id").to_numpy()
        pieces = table.column("piece").to_pylist()
        same, seen = np.arange(len(pieces)), {}  # the first row with the same piece under the same key
        for r, piece in enumerate(pieces):
            if r and key[r] != key[r - 1]:
                seen = {}
            same[r] = seen.setdefault(piece, r)
        different = np.flatnonzero(same == np.arange(len(pieces)))
        hits = [np.zeros(0, dtype=np.int64) for _ in pieces]
        a = size = 0
        for b in range(1, len(different) + 1):
            size += len(pieces[different[b - 1]])
            if b == len(different) or size >= BATCH and key[different[b]] != key[different[b - 1]]:
                batch = different[a:b]
                for r, found in zip(batch, repeated_windows([pieces[r] for r in batch], ids[batch], width)):
                    hits[r] = found
                a, size = b, 0
        for r in np.flatnonzero(same != np.arange(len(pieces))):
            hits[r] = np.arange(len(pieces[r]) - width + 1) if ids[r] > ids[same[r]] else hits[same[r]]
        g, hashes, at = table.column("g").to_numpy(), table.column("hash").to_numpy(), table.column("at").to_numpy()
        row = np.repeat(np.arange(len(pieces)), [len(h) for h in hits])
        places = np.concatenate(hits) + at[row]
        out = []
        for x in np.unique(g[row]):
            mine = g[row] == x
            out.append((int(x), hashes[row[mine]].astype("<i8").tobytes() + places[mine].astype("<i8").tobytes()))
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([FOUND] * len(out), pa.int32()),
                                     pa.array([o[1] for o in out], pa.binary())], ["g", "kind", "hashes"])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        left, ids, texts, pieces = own(left)
        marked = [np.zeros(0, dtype=np.int64) for _ in texts]
        if left.num_rows and not left.column("id").null_count:
            hashes, index, number = np.unique(pieces["hash"], return_index=True, return_inverse=True)
            smallest = ids[pieces["owner"][index]]
            before = np.isin(hashes, told(right, KNOWN_BEFORE))
            gone = before[number] | (ids[pieces["owner"]] > smallest[number])
            windows = [(np.repeat(pieces["owner"][gone], pieces["n"][gone]),
                        np.repeat(pieces["first"][gone], pieces["n"][gone]) + _counting(pieces["n"][gone]))]
            rows = [np.frombuffer(b, dtype="<i8").reshape(2, -1) for k, b in zip(right.column("kind").to_pylist(), right.column("hashes").to_pylist()) if k == FOUND]
            first, again = windows_once(told(right, COMPARE_WINDOWS), pieces, ids, texts, width)
            if again:
                hit = {(h, at) for r in rows for h, at in zip(r[0].view(np.uint64).tolist(), r[1].tolist())}
                later = [(h, at) for doc, h, at, w in again if doc > first[w][0] or first[w][1:] in hit]
                rows.append(np.array([np.array([x[0] for x in later], dtype=np.uint64).view(np.int64), [x[1] for x in later]], dtype=np.int64))
            if rows:
                found = np.concatenate(rows, axis=1)
                found = found[:, np.argsort(found[0].view(np.uint64), kind="stable")]
                part = np.flatnonzero(~gone)
                low = np.searchsorted(found[0].view(np.uint64), pieces["hash"][part])
                n = np.searchsorted(found[0].view(np.uint64), pieces["hash"][part], side="right") - low
                windows.append((np.repeat(pieces["owner"][part], n),
                                np.repeat(pieces["first"][part], n) + found[1][np.repeat(low, n) + _counting(n)]))
            owner, at = (np.concatenate([w[k] for w in windows]) for k in (0, 1))
            by = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[by], np.arange(len(texts) + 1))
            marked = [at[by[a:b]] for a, b in zip(edges, edges[1:])]
        removed, spans, kept = [], [], []
        for text, starts in zip(texts, marked):
            dropped = flags(starts, len(text), width)
            removed.append(int(dropped.sum()))
            spans.append(runs(dropped))
            kept.append(np.frombuffer(text, dtype=np.uint8)[~dropped].tobytes() if removed[-1] else text)
        rest = [c for c in left.schema.names if c != "g"]
        return pa.Table.from_arrays(
            [*[left.column(c) for c in rest], pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
             pa.array([len(s[0]) for s in spans], pa.int64()), spans_array(spans), pa.array(kept, pa.binary())],
            [*rest, "n_bytes", "n_removed", "n_spans", "removed", "kept"])

    schema = base.drop("g").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    schema = schema.add("removed", SPANS).add("kept", "binary")
    packed_answer = "g long, kind int, hashes binary"
    sent = base.groupBy("g").applyInArrow(send, "bucket long, g long, anchors binary, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, packed_answer)
    asked = answers.where(F.col("kind").isin(COMPARE, COMPARE_WINDOWS))
    compared = base.groupBy("g").cogroup(asked.groupBy("g")).applyInArrow(
        compare, "bucket long, key long, g long, hash long, at int, id long, piece binary")
    found = compared.groupBy("bucket").applyInArrow(sort_suffixes, packed_answer)
    verdicts = answers.where(F.col("kind").isin(KNOWN_BEFORE, COMPARE_WINDOWS)).union(found)
    done = base.groupBy("g").cogroup(verdicts.groupBy("g")).applyInArrow(remove, schema)
    return unpacked(done, docs, names, {c: F.col(c) for c in ("n_bytes", "n_removed", "n_spans", "removed", "kept")})


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
