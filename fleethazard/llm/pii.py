"""Personal data by bootstrapped contextual extraction: identifiers of known form seed lexical patterns (the words before them), a
graph of patterns and values is scored in rounds, and trusted patterns bring in identifiers that no form describes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.repeats import BASE, byte_values, mixed, slabs, span_hashes
from fleethazard.llm.support import SPACES, hash128, packed
from fleethazard.session import written

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind:int,start:int,`end`:int>"
SLOT = "struct<kind:int,start:int,`end`:int,value:long,one:long,two:long,seed:boolean>"
FILTER_BITS = 22  # the filter of contexts has 2^22 bits, whatever the corpus
UNIT = 1_000_000  # scores are added up in millionths, so that sums don't depend on their order

# fixed values: the forms of the contract
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can only begin where a run of digits does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# what may stand in an identifier's place, by kind; each begins where a word does, and all lengths but the e-mail's are bounded
EDGE = r"""(?<![^\s"'()\[\]<>{}:=])"""
LOOSE = (
    re.compile(EDGE + r"""[^\s"'()\[\]<>{}:=@]++(?:@|\(at\)|\[at\])[^\s"'()\[\]<>{}:=@]++"""),
    re.compile(EDGE + r"[0-9A-Fa-f]{1,4}(?:[.:]{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z])"),
    re.compile(EDGE + r"[0-9Xx*](?:[ -]?[0-9Xx*]){11,18}(?![0-9A-Za-z])"),
    re.compile(EDGE + r"\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])"),
)
TELLING = re.compile(r"[0-9@]").search
TRAILING = ".,;!?-"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the identifiers of known form, by kind and start; every scan is linear in the text."""
    found, free = [], 0
    for m in DOMAIN.finditer(text):
        left = text[free:m.start()]
        local = len(left) - len(left.rstrip(LOCAL))
        free = m.start() + 1
        if local:
            found.append((0, m.start() - local, m.end()))
            free = m.end()
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() <= 38 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what looks remotely like an identifier and touches none of ``base``."""
    out = []
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], dtype=np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], dtype=np.int64)) if taken else starts
    for kind, form in enumerate(LOOSE):
        for m in form.finditer(text):
            start, end = m.start(), m.start() + len(m[0].rstrip(TRAILING))
            k = int(np.searchsorted(starts, end))  # spans that begin before the end
            if (k and reach[k - 1] > start) or (kind == 2 and len(digits_of(m[0])) < 4):
                continue
            out.append((kind, start, end))
    return out


def value_key(kind: int, text: str) -> int:
    """A hash of the identifier, however it is written: letters in lower case, or digits alone."""
    plain = digits_of(text) if kind > 1 else text.lower()
    return xxhash.xxh64_intdigest(f"{kind}:{plain or text}") - (1 << 63)


def _word_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.ones(256, dtype=bool)
    inside[[ord(c) for c in SPACES + "\"'()[]<>{}"]] = False
    closing = np.zeros(256, dtype=bool)
    closing[[ord(":"), ord("=")]] = True  # a word ends with these
    lower = np.arange(256)
    lower[65:91] += 32
    return inside, closing, lower


INSIDE, CLOSING, LOWERED = _word_tables()


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes (A-Z lower-cased) of the words of UTF-8 bytes: runs without white space, quotes and brackets, cut
    after a colon or an equals sign."""
    word = INSIDE[data]
    close = CLOSING[data] & word
    starts = np.flatnonzero(word & np.r_[True, (~word | close)[:-1]])
    ends = np.flatnonzero(word & np.r_[(~word)[1:], True] | close) + 1
    return starts, ends, span_hashes(byte_values()[LOWERED[data]], starts, ends)


def contexts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the pattern of this word and of this and the one before it (for what follows them)."""
    one = mixed(hashes + np.uint64(1)).view(np.int64)
    before = np.r_[np.zeros(1, np.uint64), hashes[:-1]] if len(hashes) else hashes
    return one, mixed(before * np.uint64(BASE) + hashes + np.uint64(2)).view(np.int64)


def slots_of(text: str) -> tuple[list[tuple], list[dict]]:
    """The base spans of a text, and all places (base or loose) with the patterns before them; null where words are missing or
    the place begins within a word."""
    if not (TELLING(text) or "(at)" in text or "[at]" in text):
        return [], []
    base = base_spans(text)
    places = sorted([(s, e, k, True) for k, s, e in base] + [(s, e, k, False) for k, s, e in loose_spans(text, base)])
    if not places:
        return base, []
    starts, ends, hashes = words(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8))
    one, two = contexts(hashes)
    out, at, bytes_at = [], 0, 0
    for s, e, kind, seed in places:
        bytes_at += s - at if text.isascii() else len(text[at:s].encode("utf-8", "surrogatepass"))
        at = s
        k = int(np.searchsorted(starts, bytes_at)) - 1
        clear = k >= 0 and ends[k] <= bytes_at
        out.append({"kind": kind, "start": s, "end": e, "value": value_key(kind, text[s:e]), "one": int(one[k]) if clear else None,
                    "two": int(two[k]) if clear and k else None, "seed": seed})
    return base, out


def find_places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, h1, h2`` (hashes of the text), ``base`` and ``slots`` of every row."""
    schema = f"id long, h1 long, h2 long, base array<{SPAN}>, slots array<{SLOT}>"
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    slot = pa.struct([*span, ("value", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("seed", pa.bool_())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots_of(t) for t in batch.column("text").to_pylist()]
            base = [[{"kind": k, "start": s, "end": e} for k, s, e in b] for b, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h1"), batch.column("h2"), pa.array(base, pa.list_(span)),
                                              pa.array([s for _, s in found], pa.list_(slot))], ["id", "h1", "h2", "base", "slots"])

    text = F.coalesce("text", F.lit(""))
    rows = packed(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), text.alias("text"), *hash128(text))
    return rows.mapInArrow(find, schema)


def pattern_totals(docs: DataFrame, patterns: DataFrame, text_col: str) -> DataFrame:
    """``pattern, total``: how often each of ``patterns`` stands before a word, counted over every whole text.

    A filter of 2^FILTER_BITS bits, which Spark adds up, lets each task drop nearly all other contexts before they move; the join
    is exact."""
    bit = F.pmod("pattern", F.lit(1 << FILTER_BITS))
    rows = patterns.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).cast("int").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("bits")).collect()  # 2^17 rows at most
    cells = np.zeros(1 << (FILTER_BITS - 5), dtype="<u4")
    cells[[r["cell"] for r in rows]] = [r["bits"] for r in rows]
    packed_filter = docs.sparkSession.sparkContext.broadcast(cells.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(packed_filter.value, dtype=np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in slabs(texts):
                data = np.frombuffer(b" ".join(texts[a:b]) + b" ", dtype=np.uint8)
                starts, _, hashes = words(data)
                first = np.searchsorted(starts, np.r_[0, np.cumsum([len(t) + 1 for t in texts[a:b]])])
                owner = np.repeat(np.arange(b - a), np.diff(first))
                followed = np.r_[owner[1:] == owner[:-1], False] if len(owner) else np.zeros(0, dtype=bool)
                led = followed & (np.r_[False, owner[1:] == owner[:-1]] if len(owner) else followed)
                one, two = contexts(hashes)
                met = np.concatenate([one[followed], two[led]])
                seen, n = np.unique(met[wanted[met & ((1 << FILTER_BITS) - 1)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], ["pattern", "n"])

    text = packed(docs, text=text_col).select("text")
    counted = text.mapInArrow(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counted.join(patterns.select("pattern").distinct(), "pattern")


def scored_graph(edges: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(``kind, pattern, trust``, ``kind, value, score``) after ``rounds`` over ``edges`` (``kind, pattern, value, n, seed, total``).

    A pattern's trust is the share of its places filled by identifiers, each by its score. A seed's score is 1; any other value's
    is the probability that not all of its patterns err. Both are in whole millionths."""
    score = written(edges.groupBy("kind", "value").agg(F.max(F.when(F.col("seed"), UNIT).otherwise(0)).cast("long").alias("score")), "scores")
    trust = None
    for _ in range(rounds):
        filled = F.sum(F.col("n").cast("decimal(20)") * F.col("score"))
        trust = edges.join(score, ["kind", "value"]).groupBy("kind", "pattern").agg(
            F.least(F.floor(filled / F.max("total")), F.lit(UNIT)).cast("long").alias("trust"))
        trust = written(trust, "trust")
        doubt = F.sum(F.round(-F.log(F.greatest(1 - F.col("trust") / UNIT, F.lit(1e-9))) * UNIT).cast("decimal(20)")).cast("double") / UNIT
        score = edges.join(trust, ["kind", "pattern"]).groupBy("kind", "value").agg(
            F.when(F.max("seed"), UNIT).otherwise(F.floor((1 - F.exp(-doubt)) * UNIT)).cast("long").alias("score"))
        score = written(score, "scores")
    return trust, score


def discovered(docs: DataFrame, places: DataFrame, text_col: str, min_seeds: int, min_trust: float, rounds: int) -> DataFrame:
    """``h1, h2, added``: for texts with identifiers that only their context gives away, the spans and their scores."""
    slots = places.select("h1", "h2", F.explode("slots").alias("s")).select("h1", "h2", "s.*")
    linked = slots.withColumn("pattern", F.explode(F.array("one", "two"))).where("pattern IS NOT NULL")
    edges = written(linked.groupBy("kind", "pattern", "value").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")), "pattern-values")
    # patterns with enough seeds and something to find
    patterns = edges.groupBy("kind", "pattern").agg(F.count_if("seed").alias("seeds"), F.count_if(~F.col("seed")).alias("others"), F.sum("n").alias("places"))
    patterns = written(patterns.where((F.col("seeds") >= min_seeds) & (F.col("others") > 0)), "patterns")
    totals = pattern_totals(docs, patterns, text_col)
    # a pattern mostly followed by other words can't become trusted, whatever the scores of its values
    able = patterns.join(totals, "pattern").where(F.col("places") >= min_trust * F.col("total")).select("kind", "pattern", "total")
    edges = written(edges.join(able, ["kind", "pattern"]), "pattern-values")
    trust, score = scored_graph(edges, rounds)
    need = round(min_trust * UNIT)
    found = linked.where(~F.col("seed")).join(trust.where(F.col("trust") >= need), ["kind", "pattern"])
    found = found.join(score.where(F.col("score") >= need), ["kind", "value"])
    return found.groupBy("h1", "h2").agg(F.collect_set(F.struct("score", "start", "end", "kind")).alias("added"))


def _together(base: list[dict], added: list[dict]) -> list[dict]:
    """All spans by kind and start; of added ones that overlap, the higher score stays, then the earlier, longer and first in kind."""
    taken: list[dict] = []
    for s in sorted(added, key=lambda s: (-s["score"], s["start"], -s["end"], s["kind"])):
        if all(s["end"] <= t["start"] or t["end"] <= s["start"] for t in taken):
            taken.append(s)
    spans = [(b["kind"], b["start"], b["end"], False) for b in base] + [(t["kind"], t["start"], t["end"], True) for t in taken]
    return [{"kind": KINDS[k], "start": s, "end": e, "by_context": c} for k, s, e, c in sorted(spans)]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_seeds: int = 3, min_trust: float = 0.8,
                       rounds: int = 3) -> DataFrame:
    """``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and ``found`` for every row of ``docs``.

    Base spans are those of the forms above. ``found`` has all spans (kind, start, end in code points, whether only the context
    gave it away) by kind and start, ``spans`` the same as text. The counts and the hash are of base spans.

    A pattern is the word, or the two words, right before an identifier. It counts with at least ``min_seeds`` different
    base identifiers of a kind, and is trusted if at least ``min_trust`` of all its occurrences in the corpus precede identifiers of that
    kind, after ``rounds`` of scoring values by patterns and patterns by values. What stands after a trusted pattern and has the loose
    form of its kind is added, unless it touches a base span. Words are counted over every whole text, copies included; an
    identifier that many copies repeat is still one seed.

    Null and empty texts have no spans. Repeated rows are treated alike, ids are only carried along. An empty table gives an empty
    table; other columns are not returned. Texts move once, from their reader to Python; what is shuffled are places,
    patterns of words next to them, and pre-added counts.
    """
    places = written(find_places(docs, id_col, text_col), "places")
    added = discovered(docs, places, text_col, min_seeds, min_trust, rounds)
    schema = ("id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
              "found array<struct<kind:string,start:int,`end`:int,by_context:boolean>>")
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_context", pa.bool_())])

    def tell(spans: list[dict]) -> str:
        return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column("base").to_pylist()
            found = [_together(b, a or []) for b, a in zip(base, batch.column("added").to_pylist())]
            counts = [[sum(s["kind"] == k for s in b) for b in base] for k in range(len(KINDS))]
            sha = [hashlib.sha256(tell([s for s in f if not s["by_context"]]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha), pa.array([tell(f) for f in found], pa.string()),
                 pa.array(found, pa.list_(kind))], ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "found"])

    done = places.join(added, ["h1", "h2"], "left").select("id", "base", "added").mapInArrow(compose, schema)
    return done.withColumnRenamed("id", id_col)
