"""Spelling variants of words, by an index of variable-length grams.

Two words are near if one inserted, deleted or replaced code point makes one of the other. Search:

1. Words are compared in classes: class c holds words of c code points, the long ones, and of c - 1, the short ones. Every
   word is long in one class and short in the next, and near words meet in the class of the longer one, at least one of
   them as a long one.
2. The gram dictionary: all grams of two code points, and longer ones, up to half of a class, whose beginning is
   frequent. Rare grams are not extended (their lists are short already), so the dictionary is given by its frequent
   grams, whose number is bounded.
3. A word is decomposed at each place into the longest gram of the dictionary that starts there, without those that lie
   inside an earlier one.
4. One edit changes at most so many of a word's grams, its bound: those that contain the place, and shorter ones right
   behind it that a new gram may swallow. The others stay, at their place, or one further in the longer word. With grams up to
   half of the class there is always one that stays.
5. A short word is in the lists of all its grams, at both places. A long word is in as many lists as its bound and one more,
   those of its rarest grams: of these one stays, whatever the edit. So each near pair meets in a list. Two long words
   take their lists in the same order of rarity, so they meet too. What meets in a list is verified.
"""

from __future__ import annotations

from collections.abc import Container, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm import buckets
from sitepulse.llm.text import arrow_schema, values
from sitepulse.session import stage

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of fewer code points are none; shorter words would have grams that one edit may change all.
SHORTEST = 7
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Code points of the shortest and, in any class, the longest gram.
GRAM, LONGEST = 2, 8
#: Frequent grams at most: a gram is frequent if it has more than its share of all. Broadcast, some MB.
FREQUENT = 1 << 16
#: Words of so many code points below 256 are verified as two numbers of 64 bits, others one by one.
PACKED = 16
#: Words of more code points are verified when their pairs are known, and have no say in which grams are frequent.
WIDE = 64
#: Pairs verified at a time.
_PAIRS = 1 << 18


def longest(size: int) -> int:
    """The longest grams of a class: half of its longer words, so that one edit leaves a gram of any word as it is."""
    return max(GRAM, min(LONGEST, size // 2))


# ---------------------------------------------------------------- words


def observed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): every lower-cased run of letters of every text, those that a checksum picks without one code point.

    The checksum is of key and run; a null key reads as the empty one. Equal runs of one text are counted before
    they leave its row's task.
    """
    lowered = F.translate(F.col(text), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"),
    )
    h = F.crc32(F.concat_ws(":", "_key", "_run").cast("binary"))
    marked = runs.withColumn("_h", h)
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.col("_run").substr(F.lit(1), at), F.col("_run").substr(at + 2, F.length("_run")))
    word = F.when(F.col("_h") % 31 == 0, cut).otherwise(F.col("_run"))
    return marked.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- grams


def frequent_grams(words: DataFrame, most: int = FREQUENT) -> dict[str, int]:
    """The grams that the dictionary extends, and how often they occur: those with more than their share of all grams.

    A word has one gram of each length at each place; a gram is frequent if it has over 1/``most`` of all, so there are
    fewer than ``most``. Words of over 64 code points have no say.
    """
    sizes = range(GRAM, LONGEST)
    places = sum((F.greatest(F.length("word") - size + 1, F.lit(0)) for size in sizes), F.lit(0))
    words = words.filter(F.length("word").between(SHORTEST, WIDE))
    total = words.agg(F.coalesce(F.sum(places.cast("bigint")), F.lit(0))).first()[0]

    def each(size: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("word") - size + 1), lambda i: F.substring("word", i, F.lit(size)))

    grams = words.select(F.explode(F.concat(*map(each, sizes))).alias("gram"))
    kept = grams.groupBy("gram").count().filter(F.col("count") * most > total)
    return {r.gram: r["count"] for r in kept.collect()}


def decomposed(word: str, frequent: Container[str], most: int) -> tuple[tuple[int, int], ...]:
    """The grams of a word as (first, last) places."""
    size, end, grams = len(word), -1, []
    for first in range(size - GRAM + 1):
        last = first + GRAM - 1
        while last - first + 1 < most and last + 1 < size and word[first : last + 1] in frequent:
            last += 1
        if last > end:
            grams.append((first, last))
            end = last
    return tuple(grams)


@lru_cache(1 << 16)
def bound(grams: tuple[tuple[int, int], ...], size: int, most: int) -> int:
    """How many grams of a long word one deleted or replaced code point changes at most."""
    starts, ends = np.array(grams).T
    short = np.concatenate([[0], np.cumsum(ends - starts + 1 < most)])
    # Grams are in order of first and of last place, so those that an edit changes are neighbours: those that contain the
    # place, and behind it shorter ones up to where a new gram reaches.
    at = np.arange(size)
    low, over = np.searchsorted(ends, at), np.searchsorted(starts, at, side="right")
    reach = np.maximum(np.searchsorted(ends, at + most - 1, side="right"), over)
    return int((over - low + short[reach] - short[over]).max())


def _entries(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """A row per word and list: ``_bucket``, ``_id``, ``_short``, the word as two numbers, or else as ``_word``, empty for a very long one."""
    schema = "_bucket bigint, _id bigint, _short int, _low bigint, _high bigint, _word string"
    target = arrow_schema(schema)
    digest = xxhash.xxh64_intdigest

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in target]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for given in batches:
            for number, word in zip(given.column("_id").to_pylist(), values(given.column("word"))):
                size = len(word)
                packed = _packed(word)
                # A very long word stays at home: it may have as many lists as letters.
                rest = (*packed, None) if packed else (0, 0, word if size <= WIDE else "")
                for short in (0, 1):
                    most = longest(size + short)
                    grams = decomposed(word, frequent, most)
                    if not short:
                        rarity = sorted((frequent.get(word[a : b + 1], 0), a, b) for a, b in grams)
                        grams = [(a, b) for _, a, b in rarity[: (bound if size <= WIDE else bound.__wrapped__)(grams, size, most) + 1]]
                    for a, b in grams:
                        for place in (a, a + 1) if short else (a,):
                            bucket = digest(f"{size + short} {place} {word[a : b + 1]}".encode(), 42) - (1 << 63)
                            rows.append((bucket, number, short, *rest))
                        if len(rows) >= 1 << 16:
                            yield batch(rows)
                            rows = []
        yield batch(rows)

    return words.select("_id", "word").mapInArrow(run, schema)


def _packed(word: str) -> tuple[int, int] | None:
    """A short word of single bytes as two numbers, its first code point lowest."""
    try:
        raw = word.encode("latin-1")
    except UnicodeEncodeError:
        return None
    if len(raw) > PACKED or 0 in raw:
        return None
    raw = raw.ljust(PACKED, b"\0")
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


# ---------------------------------------------------------------- pairs


def near_ids(words: DataFrame) -> DataFrame:
    """(u, v): the ids of every two near words, each pair once, of ``words`` (_id, word; both distinct).

    Words of fewer than 7 code points are left out. Lists of over 4,096 words are cut into pairs of blocks.
    """
    words = words.filter(F.length("word") >= SHORTEST).select("_id", "word")
    frequent = frequent_grams(words)
    entered = buckets.blocks(_entries(words, frequent), sample=_entries(words.filter(buckets.sampled()), frequent))
    dealt = entered.repartition("_bucket", "_pair").sortWithinPartitions("_bucket", "_pair", "_short")
    # Near words may meet in several lists.
    met = stage(dealt.mapInArrow(_met, "u bigint, v bigint, sure boolean").distinct(), "met-words")
    left, right = (words.select(F.col("_id").alias(x), F.col("word").alias(f"_{x}")) for x in "uv")
    verified = met.filter("NOT sure").join(left, "u").join(right, "v").filter("levenshtein(_u, _v, 1) = 1")
    return stage(met.filter("sure").select("u", "v").unionAll(verified.select("u", "v")), "near-words")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The near pairs of each list; a stretch of rows holds whole lists, its long words first."""
    rest: dict[str, np.ndarray] | None = None

    def found(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for u, v, sure in _near(columns):
            arrays = [np.minimum(u, v), np.maximum(u, v), np.full(len(u), sure)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["u", "v", "sure"])

    for batch in batches:
        if not len(batch):
            continue
        columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if rest is not None:
            columns = {name: np.concatenate([rest[name], x]) for name, x in columns.items()}
        last = (columns["_bucket"] == columns["_bucket"][-1]) & (columns["_pair"] == columns["_pair"][-1])
        whole = len(last) if last.all() else len(last) - int(np.argmin(last[::-1]))
        whole = 0 if last.all() else whole
        yield from found({name: x[:whole] for name, x in columns.items()})
        rest = {name: x[whole:] for name, x in columns.items()}
    if rest is not None:
        yield from found(rest)


def _near(columns: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of ids, and whether they are verified."""
    bucket, pair, short, side = (columns[name] for name in ("_bucket", "_pair", "_short", "_side"))
    n = len(bucket)
    if not n:
        return
    begins = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])]))
    end = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))
    # Every long word with all rows behind it in its list; two short ones are not compared.
    first = np.flatnonzero(short == 0)
    partners = end[first] - first - 1
    before = np.concatenate([[0], np.cumsum(partners)])
    lanes = _Lanes(columns)
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(before, before[at] + _PAIRS, side="right")) - 1)
        many = partners[at:to]
        i = np.repeat(first[at:to], many)
        j = i + 1 + np.arange(len(i)) - np.repeat(before[at:to] - before[at], many)
        if (side[i] >= 0).any():
            met = (side[i] < 0) | (side[i] != side[j])
            i, j = i[met], j[met]
        close, unread = lanes.one_edit(i, j)
        for which, sure in ((close, True), (unread, False)):
            if which.any():
                yield columns["_id"][i[which]], columns["_id"][j[which]], sure
        at = to


class _Lanes:
    """The words of a stretch as numbers, from the front and from the back."""

    def __init__(self, columns: dict[str, np.ndarray]) -> None:
        self.words = columns["_word"]
        self.odd = np.array([w is not None for w in self.words])
        self.unread = np.array([w == "" for w in self.words])
        self.front = np.ascontiguousarray(np.stack([columns["_low"], columns["_high"]], axis=1))
        letters = self.front.view(np.uint8).reshape(-1, PACKED)
        self.size = (letters != 0).sum(axis=1)
        at = self.size[:, None] - 1 - np.arange(PACKED)
        turned = np.where(at >= 0, np.take_along_axis(letters, np.maximum(at, 0), axis=1), 0)
        self.back = np.ascontiguousarray(turned).view(np.int64).reshape(-1, PACKED // 8)

    def one_edit(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether exactly one edit lies between the words of each pair, and whether that is not to be seen here; no j is longer."""
        most = self.size[i] - 1  # all but one letter of the longer word match from the front or from the back
        front = _equal(self.front, i, j)
        close = front < PACKED  # equal words are the same word
        close[close] = front[close] + _equal(self.back, i[close], j[close]) >= most[close]
        unread = self.unread[i] | self.unread[j]
        close &= ~unread
        for k in np.flatnonzero((self.odd[i] | self.odd[j]) & ~unread):
            close[k] = _one_edit_apart(self.text(j[k]), self.text(i[k]))
        return close, unread

    def text(self, at: int) -> str:
        return self.words[at] or self.front[at].tobytes().rstrip(b"\0").decode("latin-1")


def _equal(lanes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many letters are equal from the first one on, 16 if all are."""
    differ = lanes[i, 0] ^ lanes[j, 0]
    equal = np.bitwise_count((differ & -differ) - 1).astype(np.int64) >> 3
    same = np.flatnonzero(differ == 0)
    if len(same):
        rest = lanes[i[same], 1] ^ lanes[j[same], 1]
        more = np.bitwise_count((rest & -rest) - 1).astype(np.int64) >> 3
        equal[same] = 8 + np.where(rest == 0, 8, more)
    return equal


def _one_edit_apart(a: str, b: str) -> bool:
    """The same for two words as text, ``b`` not the shorter one."""
    if a == b or not 0 <= len(b) - len(a) <= 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


# ---------------------------------------------------------------- forms


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of ``counts`` (word, n; distinct): ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    A word's form is its near word that occurs most often (of several the first in code point order), if at least ``ratio``
    times as often as the word. Its root is the last of the forms' forms, the word itself if it has none. Counts rise along
    forms, so their chains are as short as the counts have digits; they are followed by doubling.
    """
    counts = stage(counts.select("word", "n", F.monotonically_increasing_id().alias("_id")), "word-counts")
    pairs = near_ids(counts)
    both = pairs.select(F.col("u").alias("_id"), F.col("v").alias("_other")).unionAll(
        pairs.select(F.col("v").alias("_id"), F.col("u").alias("_other"))
    )
    others = counts.select(F.col("_id").alias("_other"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other")))
    of_word = both.join(others, "_other").groupBy("_id").agg(F.count("*").alias("n_near"), best.alias("_best"))
    enough = -F.col("_best.minus") >= F.col("n") * ratio
    found = counts.join(of_word, "_id", "left").select(
        "word",
        F.when(enough, F.col("_best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("_best.minus")).alias("form_n"),
    )
    found = stage(found, "forms")
    most = counts.agg(F.max("n")).first()[0] or 0
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(len(str(most)).bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = stage(roots.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 2) -> DataFrame:
    """The words of all texts that occur at least ``least`` times and have 7 code points or more, as ``variants``.

    Null and empty texts have no words; repeated rows count repeatedly; an empty table gives an empty one.
    """
    counted = observed(docs, text, key).filter((F.length("word") >= SHORTEST) & (F.col("n") >= least))
    return variants(counted)
