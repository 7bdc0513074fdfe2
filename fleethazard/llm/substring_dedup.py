"""Substring dedup: Rabin-Karp hashes of every window of words, counted over the corpus; repeated windows merge into intervals."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.repeats import (SPANS, by_bucket, byte_values, flags, grouped_by_id, in_id_order, mixed, pack, rank_of, rolling, runs,
                                     slabs, span_hashes, spans_array, unpack)
from fleethazard.llm.support import SPACES, unpacked


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the number of words of each text."""
    space = np.zeros(256, dtype=bool)
    space[[ord(c) for c in SPACES]] = True
    hashes, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for a, b in slabs(texts):
        data = np.frombuffer(b" ".join(texts[a:b]) + b" ", dtype=np.uint8)
        blank = space[data]
        starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        ends = np.flatnonzero(blank & np.r_[False, ~blank[:-1]])
        edges = np.r_[0, np.cumsum([len(t) + 1 for t in texts[a:b]])]
        counts.append(np.diff(np.searchsorted(starts, edges)))
        hashes.append(span_hashes(byte_values()[data], starts, ends))
    return np.concatenate(hashes), np.concatenate(counts)


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word (from the first word of all texts) of every window, and the words of each text."""
    words, counts = word_hashes(texts)
    all_hashes = mixed(rolling(words, width))
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)[:len(all_hashes)]
    start = np.arange(len(all_hashes))
    inside = start + width <= ends[owner]
    return all_hashes[inside], owner[inside], start[inside], counts


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20,
                    group_bytes: int = 16 << 20) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``n_removed``, ``removed`` (maximal intervals of word numbers) and, in
    ``text_col``, the words kept, joined by a space (a text that loses nothing is written so as well).

    A word goes if a window of ``width`` words that covers it also starts earlier: in a document with a smaller id, or
    earlier in the same one. Windows are judged on the input. Texts of fewer words lose nothing; null text has no words and
    becomes empty. Rows with the same id are separate documents, neither of them earlier. Rows without an id lose nothing and
    are earlier than none. An empty table gives an empty table; input columns named like an added one give way.

    Equal 64-bit hashes count as equal windows: among n windows about n * n / 2^65 wrong matches are expected (0.001 for 10^8).
    The text is shuffled once, by groups of ids of about ``group_bytes`` each (rows of one id are dealt to several by their
    text; rows equal in both stay together); hashes travel as packed sorted lists of about six bytes, once for each
    group that holds them, and only lists of removable ones return. A passage shared by any number of documents is one
    hash for each group.
    """
    names = {"id": id_col, "text": text_col}
    base, n_groups = grouped_by_id(docs, id_col, text_col, group_bytes)

    def send(table: pa.Table) -> pa.Table:
        g = table.column("g")[0].as_py()
        out = []
        if g >= 0:
            _, _, texts = in_id_order(table)
            hashes = np.unique(windows(texts, width)[0])
            out = [(k, g, pack(hashes[a:b])) for k, a, b in by_bucket(hashes, n_groups)]
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                     pa.array([o[2] for o in out], pa.binary())], ["bucket", "g", "hashes"])

    def answer(table: pa.Table) -> pa.Table:
        groups = table.column("g").to_numpy()
        order = np.argsort(groups, kind="stable")
        lists = [unpack(table.column("hashes")[int(k)].as_py()) for k in order]
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        hashes = np.concatenate(lists)
        del lists
        by = np.argsort(hashes, kind="stable")  # of equal hashes, the lowest group comes first
        hashes, owner = hashes[by], owner[by]
        rank = rank_of(groups[order])[owner]
        head = np.maximum.accumulate(np.where(np.r_[True, hashes[1:] != hashes[:-1]], np.arange(len(hashes)), 0))
        later = rank > rank[head]
        hashes, owner = hashes[later], owner[later]
        out = [(int(groups[order[k]]), pack(hashes[owner == k])) for k in np.unique(owner)]
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                                    ["g", "held_before"])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        left, ids, texts = in_id_order(left)
        hashes, owner, start, counts = windows(texts, width)
        gone = np.zeros(len(hashes), dtype=bool)
        if left.num_rows and not left.column("id").null_count:
            before = np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *[unpack(b.as_py()) for b in right.column("held_before")]]))
            if len(before):
                at = np.minimum(np.searchsorted(before, hashes), len(before) - 1)
                gone |= before[at] == hashes
            by = np.argsort(hashes, kind="stable")
            same = np.r_[False, hashes[by][1:] == hashes[by][:-1]]
            first = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))] if len(by) else by
            gone[by] |= (ids[owner[by]] > ids[owner[first]]) | (same & (owner[by] == owner[np.r_[by[:1], by[:-1]]]))
        dropped = flags(start[gone], int(counts.sum()), width)
        edges = np.r_[0, np.cumsum(counts)]
        removed, kept, spans = [], [], []
        for text, a, b in zip(texts, edges, edges[1:]):
            mine = dropped[a:b]
            removed.append(int(mine.sum()))
            words = text.split()
            kept.append(b" ".join(compress(words, ~mine) if removed[-1] else words))
            spans.append(runs(mine))
        rest = [c for c in left.schema.names if c not in ("text", "g")]
        return pa.Table.from_arrays(
            [*[left.column(c) for c in rest], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
             pa.array(removed, pa.int64()), spans_array(spans)], [*rest, "text", "n_words", "n_removed", "removed"])

    schema = base.drop("text", "g").schema.add("text", "string").add("n_words", "long").add("n_removed", "long")
    schema = schema.add("removed", SPANS)
    sent = base.groupBy("g").applyInArrow(send, "bucket long, g long, hashes binary")
    before = sent.groupBy("bucket").applyInArrow(answer, "g long, held_before binary")
    done = base.groupBy("g").cogroup(before.groupBy("g")).applyInArrow(remove, schema)
    return unpacked(done, docs, names, {c: F.col(c) for c in ("n_words", "n_removed", "removed")})
