"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens: letters (case folded) or numbers. Numbers, units after a number and
names (capitalised words inside a sentence) are slots; in a template they are typed placeholders. Windows of
``size`` template tokens of documents are hash-joined with those of the benchmark; a window with fewer than
``literals`` plain words keeps its slots' values in the hash, since placeholders alone say nothing. Each
window also counts with its names spelled out, so that a copy in other letter case is found.

A window whose slots are unchanged always counts. A window with changed slots counts if they agree with the
alignment's one-to-one map: of the value pairs of a (document, item, alignment) that contradict each other, the
one in most windows stands (the unchanged one on a tie). Changed slots mark a re-parameterised question. A document is contaminated by an item if at least ``enough`` of the item's windows
match (six windows are 13 words in a row) or at least ``share`` of them.

Items shorter than ``size`` words have one window of all their words, if they have at least ``least`` words;
shorter ones can't tell a leak from common phrases and match nothing. Null texts have no words.

Scale: token and window hashes are vectorised inside the tasks. A bit table of fixed size (2 MB) made of the
benchmark's hashes goes to every task and lets through about what can match; survivors meet the
benchmark's windows in a shuffle join, so neither the documents' windows nor the benchmark need fit anywhere.
A full table only lets more through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import bit_table, byte_texts, cut_lineage, in_table, light_side, pieces

UNITS = (
    "percent mm cm km m mg g kg t ml cl l kb mb gb tb hz khz mhz ghz w kw kwh v mph kmh inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons tonnes liter liters litre litres "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros pounds degree degrees"
).split()
BLOCK = 1 << 20
PLAIN, NUMBER, UNIT, NAME = 0, 1, 2, 3
M = (1 << 64) - 1

_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
_SLOT = _rng.integers(1, 1 << 63, 4, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_CLASS = np.zeros(256, np.uint8)  # 0 between tokens, 1 letter, 2 digit
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_BREAK = np.zeros(256, bool)
_BREAK[list(b".!?:;\n\"([")] = True


def _token_hash(word: bytes) -> int:
    h = 0
    for i, b in enumerate(word):
        h = (h + int(_BYTE[b]) * int(_POWER[i % 64])) & M
    return h


_UNIT_HASHES = np.unique(np.array([_token_hash(u.encode()) for u in UNITS], np.uint64))


def _fold(b: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case; lengths stay."""
    low = b + np.uint8(32) * ((b >= 65) & (b <= 90))
    latin = np.zeros(len(b), bool)
    latin[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
    return low + np.uint8(32) * latin


class Tokens:
    """Tokens of a run of texts: hash, kind, text number, byte range."""

    def __init__(self, texts: list[bytes]):
        raw = b"\n".join(texts) + b"\n"
        self.raw = raw
        b = np.frombuffer(raw, np.uint8)
        low = _fold(b)
        kind = _CLASS[b]
        two = np.flatnonzero((b[:-1] == 0xC2) & (b[1:] < 0xC0))  # Latin-1 signs, no-break space
        kind[two] = kind[two + 1] = 0
        three = np.flatnonzero((b[:-2] == 0xE2) & (b[1:-1] == 0x80)) if len(b) > 2 else []
        for i in range(3):  # general punctuation
            kind[np.asarray(three, np.int64) + i] = 0
        joint = np.flatnonzero((b[1:-1] == 46) | (b[1:-1] == 44)) + 1 if len(b) > 2 else np.zeros(0, np.int64)
        joint = joint[(kind[joint - 1] == 2) & (kind[joint + 1] == 2)]  # 3.14, 1,000
        kind[joint] = 2
        edge = np.concatenate(([True], kind[1:] != kind[:-1]))
        first = np.flatnonzero(edge)
        ends = np.append(first[1:], len(b))
        own = kind[first] > 0
        self.start, self.end = first[own], ends[own]
        word = np.flatnonzero(kind > 0)
        size = self.end - self.start
        offset = np.concatenate(([0], np.cumsum(size)))[:-1]
        place = np.arange(len(word)) - np.repeat(offset, size)
        mixed = _BYTE[low[word]] * _POWER[place & 63]
        self.hash = np.add.reduceat(mixed, offset) if len(offset) else np.zeros(0, np.uint64)
        borders = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(borders, self.start, side="right")
        number = kind[self.start] == 2
        self.kind = np.where(number, NUMBER, PLAIN).astype(np.uint8)
        if len(self.start):
            same = np.concatenate(([False], self.text[1:] == self.text[:-1]))
            after_number = np.concatenate(([False], number[:-1])) & same
            self.kind[after_number & np.isin(self.hash, _UNIT_HASHES)] = UNIT
            capital = (low[self.start] != b[self.start]) | ((self.end - self.start > 1) & (low[np.minimum(self.start + 1, len(b) - 1)] != b[np.minimum(self.start + 1, len(b) - 1)]) & (b[self.start] == 0xC3))
            breaks = np.cumsum(_BREAK[b])
            quiet = np.concatenate(([False], breaks[self.start[1:]] == breaks[self.end[:-1] - 1])) & same
            self.kind[capital & quiet & (self.kind == PLAIN)] = NAME

    def value(self, i: int) -> str:
        return self.raw[self.start[i] : self.end[i]].decode("utf-8", "replace").lower()


def window_hashes(t: Tokens, size: int, literals: int, names: bool) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of the windows inside one text, and their hashes; ``names``: names are placeholders too."""
    n = len(t.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    slot = t.kind > 0 if names else (t.kind == NUMBER) | (t.kind == UNIT)
    template = np.where(slot, _SLOT[t.kind], t.hash)
    plain = np.concatenate(([0], np.cumsum(~slot)))
    few = plain[size:] - plain[:-size] < min(literals, size)
    out, exact = np.full(n, np.uint64(size)), np.full(n, np.uint64(size + 99))
    any_few = few.any()
    for i in range(size):
        out = (out ^ template[i : i + n]) * _STEP
        out ^= out >> np.uint64(29)
        if any_few:
            exact = (exact ^ t.hash[i : i + n]) * _STEP
            exact ^= exact >> np.uint64(29)
    out = np.where(few, exact, out)
    inside = np.flatnonzero(t.text[: n] == t.text[size - 1 :])
    return inside, out[inside]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[list, Tokens]]:
    """Ids and tokens of pieces of the batch of about BLOCK bytes."""
    ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
    held, size, at = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= BLOCK or i == len(texts) - 1:
            yield ids[at : i + 1], Tokens(held)
            held, size, at = [], 0, i + 1


_SCHEMA = "id long, hash long, pos long, slots array<string>"


def _emit(ids: list, t: Tokens, start: np.ndarray, hashes: np.ndarray, size: int) -> pa.RecordBatch:
    first = np.searchsorted(t.text, np.arange(len(ids)))
    slots = [[t.value(j) if t.kind[j] else "" for j in range(i, i + size)] for i in start]
    own = t.text[start]
    return pa.RecordBatch.from_arrays(
        [pa.array([ids[k] for k in own], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(start - first[own]), pa.array(slots, pa.list_(pa.string()))],
        names=["id", "hash", "pos", "slots"],
    )


def benchmark_windows(items: DataFrame, size: int = 8, literals: int = 4, least: int = 5) -> DataFrame:
    """(id, hash, pos, slots, windows, size) of the items; slots are lower-case values, "" for plain words."""

    def run(it):
        for batch in pieces(it):
            for ids, t in _runs(batch):
                counts = np.bincount(t.text, minlength=len(ids)) if len(t.text) else np.zeros(len(ids), np.int64)
                for k in sorted({size, *(int(c) for c in counts if least <= c < size)}):
                    fits = counts >= size if k == size else counts == k
                    for names in (True, False):
                        start, hashes = window_hashes(t, k, literals, names)
                        keep = fits[t.text[start]] if len(start) else np.zeros(0, bool)
                        out = _emit(ids, t, start[keep], hashes[keep], k)
                        if out.num_rows:
                            yield out

    items = items.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string")).where("id IS NOT NULL")
    return items.mapInArrow(run, _SCHEMA).withColumn("size", F.size("slots")).dropDuplicates(["id", "hash", "pos"])


def surviving_windows(docs: DataFrame, table: np.ndarray, sizes: list[int], literals: int) -> DataFrame:
    """Windows of ``docs`` (doc_id, text) whose hash is marked in ``table``: (id, hash, pos, slots)."""
    packed = docs.sparkSession.sparkContext.broadcast(table)  # 2 MB, whatever the benchmark

    def run(it):
        marked = packed.value
        for batch in pieces(it):
            for ids, t in _runs(batch):
                for size in sizes:
                    base = None
                    for names in (True, False):
                        start, hashes = window_hashes(t, size, literals, names)
                        hit = in_table(marked, hashes)
                        if names:
                            base = hashes
                        else:
                            hit &= hashes != base
                        out = _emit(ids, t, start[hit], hashes[hit], size)
                        if out.num_rows:
                            yield out

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def leaks(docs: DataFrame, items: DataFrame, size: int = 8, literals: int = 4, least: int = 5, enough: int = 6, share: float = 0.5) -> DataFrame:
    """(doc_id, item_id, matched, windows, changed_slots) for every document and item that leaked into it.

    A doc_id stands for all rows that carry it; rows with a null doc_id are judged together, as doc_id null.
    """
    bench = cut_lineage(benchmark_windows(items, size, literals, least))
    sizes = [r["size"] for r in bench.select("size").distinct().collect()]  # at most ``size`` values
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, matched long, windows long, changed_slots long")
    table = bit_table(bench.select("hash"))
    found = cut_lineage(surviving_windows(docs, table, sorted(sizes), literals))
    item = bench.select("hash", F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    met = found.join(item, "hash").select(F.col("id").alias("doc_id"), "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "slots", "item_slots")
    # slot pairs of an alignment: one value of the item, one of the document
    pairs = F.filter(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: (p["a"] != "") & (p["b"] != ""))
    line = met.groupBy("doc_id", "item_id", "shift").agg(F.collect_set(F.struct(F.col("item_pos").alias("at"), pairs.alias("pairs"))).alias("seen"))
    line = line.withColumn("votes", F.expr("flatten(transform(seen, w -> w.pairs))"))
    line = line.withColumn("weights", F.expr("transform(array_distinct(votes), p -> struct(size(filter(votes, q -> q = p)) AS n, p.a = p.b AS same, p AS p))"))
    rivals = "exists(weights, y -> y.p <> x.p AND (y.p.a = x.p.a OR y.p.b = x.p.b) AND y > x)"
    line = line.withColumn("mapped", F.expr(f"transform(filter(weights, x -> NOT {rivals}), x -> x.p)"))
    line = line.withColumn("seen", F.expr("filter(seen, w -> forall(w.pairs, p -> p.a = p.b OR array_contains(mapped, p)))")).where(F.size("seen") > 0)
    line = line.select("doc_id", "item_id", F.expr("transform(seen, w -> w.at)").alias("at"), F.expr("array_distinct(flatten(transform(seen, w -> w.pairs)))").alias("pairs"))
    changed = F.size(F.filter("pairs", lambda p: p["a"] != p["b"]))
    whole = bench.groupBy("id").agg(F.countDistinct("pos").alias("windows"))
    both = line.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("matched"), F.min(changed).alias("changed_slots"))
    both = both.join(whole.withColumnRenamed("id", "item_id"), "item_id")
    hit = (F.col("matched") >= enough) | (F.col("matched") >= F.col("windows") * share)
    return both.where(hit).select("doc_id", "item_id", F.col("matched").cast("long"), "windows", F.col("changed_slots").cast("long"))


def verdicts(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, changed_slots), one row per row of ``docs``."""
    per = leaks(docs, items, **options).groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("changed_slots").alias("changed_slots"))
    per = cut_lineage(per)
    out = docs.select(F.col("doc_id").cast("long")).join(light_side(per), F.col("doc_id").eqNullSafe(F.col("id")), "left")
    none = F.array().cast("array<bigint>")
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("changed_slots", F.lit(0)).alias("changed_slots"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents; rows with a null doc_id stay, as no id names them."""
    bad = cut_lineage(leaks(docs, items, **options).select(F.col("doc_id").alias("__contaminated_id")).distinct())
    return docs.join(light_side(bad), F.col("doc_id") == F.col("__contaminated_id"), "left_anti")
