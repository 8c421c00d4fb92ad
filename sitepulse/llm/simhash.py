"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it set. Fingerprints
within ``distance`` bits are linked; linked texts form groups by connected components.

Search: the bits stand in a ring of ``segments`` segments of nearly equal width. If two fingerprints
differ in at most ``distance`` bits, then from some segment on, every chain of the next 1, 2, 3, ... segments
differs in at most its share of the budget (chain length x distance / segments). There are more segments than
``distance``, so the first segment of such a chain is equal: it is the key of an index, and the rest of
the chain prunes before the full check. Nothing is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm import buckets, graph
from sitepulse.llm.text import over_texts, spans, utf8
from sitepulse.session import stage

SEED = 42

#: One byte per bit of a byte, so that eight counters add in one 64-bit sum.
_SPREAD = np.array([int.from_bytes(bytes((v >> i) & 1 for i in range(8)), "little") for v in range(256)], np.uint64)
#: Counters of one byte hold that many additions.
_RUN = 255
#: Hashes spread at a time; bounds the memory of the counters at 64 bytes each.
_CHUNK = 1 << 17


@dataclass(frozen=True)
class Ring:
    """How fingerprints are searched."""

    bits: int = 64
    distance: int = 4
    segments: int = 5

    def __post_init__(self):
        if self.segments <= self.distance or self.bits % 64:
            raise ValueError("more segments than differing bits, and whole 64-bit words, lose no pair")

    def masks(self) -> np.ndarray:
        """[start, chain position, 64-bit word]: the bits of the chain's segments, for every segment."""
        found = np.zeros((self.segments, self.segments, self.bits // 64), np.uint64)
        layout = self.layout()
        for start in range(self.segments):
            for step in range(self.segments):
                for bit in layout[(start + step) % self.segments]:
                    found[start, step, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return found

    def layout(self) -> list[np.ndarray]:
        """The bit positions of each segment."""
        return np.array_split(np.arange(self.bits), self.segments)

    def budgets(self) -> list[int]:
        return [step * self.distance // self.segments for step in range(1, self.segments + 1)]


NEAR = Ring()


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    words: int = 4,
    bits: int = 64,
) -> DataFrame:
    """The ``keep`` columns (long) and ``fp0``, ``fp1``, ... (64 bits each, as long) of every row.

    A-Z are lower-cased, nothing else. A text of fewer than ``words`` words has one shingle, all of them; a
    null, empty or blank text has none and the fingerprint zero. Repeated rows give repeated rows.
    """
    size = bits // 64
    kept = [F.col(c).cast("bigint").alias(f"_k{i}") for i, c in enumerate(keep)]
    names = [*(f"_k{i}" for i in range(len(keep))), *(f"fp{w}" for w in range(size))]
    schema = ", ".join(f"{n} bigint" for n in names)

    def of_batch(given, texts):
        found = _fingerprints(texts, words, size)
        return given | {f"fp{w}": found[:, w] for w in range(size)}

    out = over_texts(docs.select(*kept, utf8(text).alias("_text")), schema, of_batch)
    return out.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})


def _hashes(text: bytes, words: int) -> list[int]:
    joined = b" ".join(text.lower().split())
    starts, ends = spans(joined)
    if not len(starts):
        return []
    of = xxhash.xxh64_intdigest
    if len(starts) <= words:
        return [of(joined, SEED)]
    return [of(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())]


def _fingerprints(texts: list[bytes], words: int, size: int) -> np.ndarray:
    out = np.zeros((len(texts), size), np.int64)
    held: list[int] = []
    counts: list[int] = []
    first = 0
    for at, text in enumerate(texts):
        found = _hashes(text, words)
        held += found
        counts.append(len(found))
        if len(held) >= _CHUNK or at + 1 == len(texts):
            out[first : at + 1] = _majority(np.array(held, np.uint64), np.array(counts), size)
            held, counts, first = [], [], at + 1
    return out


def _majority(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """One row per text (``counts`` hashes each): the bits set in over half of its hashes."""
    out = np.zeros((len(counts), size), np.int64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    ends = np.cumsum(counts[full])
    begins = ends - counts[full]
    runs = -(-counts[full] // _RUN)
    first_run = np.cumsum(runs) - runs
    run_starts = np.repeat(begins, runs) + _RUN * (np.arange(runs.sum()) - np.repeat(first_run, runs))
    for w in range(size):
        mixed = hashes if w == 0 else _mixed(hashes, w)
        sums = np.empty((len(run_starts), 8), np.uint64)
        stops = np.append(run_starts[1:], len(hashes))
        at = 0
        while at < len(run_starts):
            to = max(at + 1, int(np.searchsorted(stops, run_starts[at] + _CHUNK, side="right")))
            lo, hi = run_starts[at], stops[to - 1]
            spread = _SPREAD[mixed[lo:hi].view(np.uint8).reshape(-1, 8)]
            sums[at:to] = np.add.reduceat(spread, run_starts[at:to] - lo, axis=0)
            at = to
        per_text = np.add.reduceat(sums.view(np.uint8).reshape(-1, 64).astype(np.int64), first_run, axis=0)
        over = per_text * 2 > counts[full][:, None]
        out[full, w] = np.packbits(over, axis=1, bitorder="little").view(np.int64)[:, 0]
    return out


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of a hash: the finaliser of SplitMix64 on a shifted value (fixed constants)."""
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def links(classes: DataFrame, ring: Ring) -> DataFrame:
    """Links (u, v) that connect what lies within ``ring.distance``, among ``classes`` (_id, fp0, ...).

    ``classes`` holds every number once. The links of a bucket come as a spanning forest, never as
    all of its pairs; whatever two fingerprints are linked, some path of links joins them.
    """
    size = ring.bits // 64
    names = [f"fp{w}" for w in range(size)]
    layout, masks, budgets = ring.layout(), ring.masks(), ring.budgets()
    schema = ", ".join(["_bucket bigint", "_id bigint", *(f"{n} bigint" for n in names)])

    def index(batches):
        import pyarrow as pa

        for batch in batches:
            ids = np.asarray(batch.column(0))
            codes = np.stack([np.asarray(batch.column(1 + w)) for w in range(size)], axis=1)
            bit = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
            for s, places in enumerate(layout):
                value = bit[:, places] @ (1 << np.arange(len(places), dtype=np.int64))
                columns = [value + (s << 40), ids, *codes.T]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["_bucket", "_id", *names])

    def within(columns, i, j):
        start = columns["_bucket"][i] >> 40
        differ = [(columns[n][i] ^ columns[n][j]).view(np.uint64) for n in names]
        spent = np.zeros(len(i), np.int64)
        for step in range(1, ring.segments):  # the last step has spent all bits: the full check
            mask = masks[start, step]
            for w in range(size):
                spent += np.bitwise_count(differ[w] & mask[:, w])
            viable = spent <= budgets[step]
            i, j, start, spent = i[viable], j[viable], start[viable], spent[viable]
            differ = [x[viable] for x in differ]
            if not len(i):
                return None
        return i, j

    rows = classes.select("_id", *names).mapInArrow(index, schema)
    return buckets.compare(buckets.blocks(rows), within, buckets.spanning, "u bigint, v bigint")


def grouped(prints: DataFrame, ring: Ring) -> DataFrame:
    """Rows of (fp0, ..., _id, _group): every distinct fingerprint, its number and that of its group."""
    names = [f"fp{w}" for w in range(ring.bits // 64)]
    # One word numbers itself; of several, a 64-bit hash does (two among 10^8 agree with odds of 1 in 3,700).
    number = F.col("fp0") if len(names) == 1 else F.xxhash64(*names)
    classes = prints.select(*names).distinct().withColumn("_id", number)
    found = graph.components(links(classes, ring))
    return (
        classes.join(found.withColumnRenamed("node", "_id"), "_id", "left")
        .withColumn("_group", F.coalesce("component", "_id"))
        .drop("component")
    )


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, ring: Ring = NEAR) -> DataFrame:
    """Per row of ``docs``: ``key``, ``fp0``, ..., and ``component_id``, the smallest key of its group.

    Rows with a null key keep their fingerprint and link like others; their group's smallest key is the
    smallest one that is not null, or null if it has none. An empty table gives an empty one.
    """
    prints = stage(fingerprints(docs, text, (key,), words, ring.bits), "fingerprints")
    names = [f"fp{w}" for w in range(ring.bits // 64)]
    groups = grouped(prints, ring)
    least = prints.groupBy(*names).agg(F.min(key).alias("_least")).join(groups, names)
    smallest = least.groupBy("_group").agg(F.min("_least").alias("component_id"))
    by_print = least.select(*names, "_group").join(smallest, "_group").drop("_group")
    return prints.join(by_print, names)


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, ring: Ring = NEAR) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest key stays, nulls last.

    Groups are those of ``near_duplicates``. Rows that share the smallest key are told apart by a hash of the text, and
    rows that are equal in key and text are one row. Texts without words are one group. Columns are those of
    ``docs``, whatever their names; an empty table gives an empty one.
    """
    marked = docs.select(
        F.struct("*").alias("_row"),
        F.col(key).cast("bigint").alias("_row_key"),
        F.xxhash64(text).alias("_row_text"),
        F.col(text).alias("_row_words"),
    )
    kept = ("_row_key", "_row_text")
    names = [f"fp{w}" for w in range(ring.bits // 64)]
    first = F.struct(F.col("_row_key").isNull().alias("n"), *kept)
    prints = stage(
        fingerprints(marked, "_row_words", kept, words, ring.bits).groupBy(*names).agg(F.min(first).alias("_first")),
        "fingerprints",
    )
    stay = prints.join(grouped(prints, ring), names).groupBy("_group").agg(F.min("_first").alias("_first"))
    stay = stay.select(F.col("_first._row_key").alias("_stay_key"), F.col("_first._row_text").alias("_stay_text"))
    same = F.col("_row_key").eqNullSafe(F.col("_stay_key")) & (F.col("_row_text") == F.col("_stay_text"))
    staying = marked.drop("_row_words").join(stay, same, "left_semi")
    return staying.dropDuplicates(list(kept)).select("_row.*")
