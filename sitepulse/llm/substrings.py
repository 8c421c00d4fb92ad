"""Exact substring dedup: suffix automata of reference shards, texts streamed through for matching statistics.

A word goes if a window of ``window`` consecutive words that covers it also starts anywhere else, in another
text or elsewhere in its own. The whole corpus is its own reference, so its automaton can be neither one nor
broadcast. Every window is therefore dealt by content: the smallest hash among its ``gram``-word grams is its
anchor, equal windows have equal anchors, and all places around one anchor make one shard of the reference. A
task builds the suffix automaton of a shard, with occurrence counts, and streams the shard's own stretches of
text through it: where the longest suffix that occurs twice spans ``window`` words, that span goes.

Anchors found once are dropped before any text moves. A shard has fewer than ``shard`` places; an anchor with
more (a passage that very many texts share) is settled by counting its windows, each by a 128-bit digest.
Copies of one text are one text with a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import arrow_schema, over_texts, slices, spans, utf8
from sitepulse.session import stage

WINDOW = 35
GRAM = 8
SHARD = 512

#: Odd multipliers of the routing hashes. They only decide where windows meet, never whether they are equal.
_BYTE, _WORD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_TEXT = ("_t0", "_t1")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(joined, dtype=np.uint8)
    place = np.arange(len(raw)) - np.repeat(starts, np.append(starts[1:], len(raw)) - starts)
    power = np.cumprod(np.full(int(place.max()) + 1, _BYTE, dtype=np.uint64), dtype=np.uint64)
    return _mix(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * power[place], starts))


def _sliding(x: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """``of`` over every ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        x = of(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return of(x[:-rest], x[rest:]) if rest else x


def anchors(joined: bytes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the grams that are smallest in some window of a text."""
    starts, ends = spans(joined)
    if len(starts) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = _word_hashes(joined, starts, ends)
    grams = len(word) - gram + 1
    code = np.zeros(grams, np.uint64)
    for i in range(gram):
        code = code * _WORD + word[i : i + grams]
    code = _mix(code) | np.uint64(1)
    width = window - gram + 1
    least = _sliding(code, width, np.minimum)
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == code)
    return at, code[at].view(np.int64)


class Automaton:
    """Suffix automaton of word sequences, with the number of places of each state."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, at: int, word: bytes, to: int) -> int:
        """The state for the shorter suffixes of ``to``, reached from ``at`` by ``word``."""
        clone = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = clone
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        to = self.next[last].get(word)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return new

    def add(self, words: list[bytes], places: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
            self.count[last] += places

    def close(self) -> None:
        """Pass the number of places on to the suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]
        self.count[0] = 0

    def repeated(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans of ``words``, of ``least`` words or more, that lie in sequences found twice."""
        moves, link, length, count = self.next, self.link, self.length, self.count
        found: list[tuple[int, int]] = []
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state = moves[state][word]
                matched += 1
            while state and count[state] < 2:
                state = link[state]
                matched = length[state]
            if matched >= least:
                start = i + 1 - matched
                if found and start <= found[-1][1]:
                    found[-1] = (found[-1][0], i + 1)
                else:
                    found.append((start, i + 1))
        return found


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """Rows with 128 bits that stand for the text."""
    column = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"_t0": F.xxhash64(column), "_t1": F.xxhash64(F.lit("second"), column)})


def _surveyed(docs: DataFrame, text: str, key: str, window: int, gram: int) -> DataFrame:
    """One row per distinct text: its copies, a row that has it, its words, their digest and its anchors."""

    def of_batch(given, texts):
        n, digest, codes = [], [], []
        for t in texts:
            joined = b" ".join(t.split())
            n.append(joined.count(b" ") + 1 if joined else 0)
            digest.append(hashlib.sha256(joined).hexdigest())
            codes.append(anchors(joined, window, gram)[1])
        return given | {"n": n, "d": digest, "a": codes}

    rows = _texts(docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_own")), "_own")
    rows = rows.select("_key", *_TEXT, utf8("_own").alias("_text"))
    schema = "_key bigint, _t0 bigint, _t1 bigint, _n_words bigint, _digest string, _anchors array<bigint>"
    return (
        over_texts(rows, schema, of_batch)
        .groupBy(*_TEXT)
        .agg(
            F.count("*").alias("_copies"),
            F.min("_key").alias("_rep"),
            F.first("_n_words").alias("_n_words"),
            F.first("_digest").alias("_digest"),
            F.first("_anchors").alias("_anchors"),
        )
    )


def _stretches(candidates: DataFrame, window: int, gram: int, hot: bool) -> DataFrame:
    """The text around every anchor that repeats (``_code``), or, if ``hot``, the windows around very frequent ones."""
    reach = window - gram
    schema = "_code bigint, _t0 bigint, _t1 bigint, _start int, _data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, "_text"):
                rows = [
                    row
                    for t0, t1, data, codes, often in zip(*(part.column(i).to_pylist() for i in range(5)))
                    for row in of_text(t0, t1, data, set(codes), set(often))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip(zip(*rows) if rows else [[]] * 5, target)], schema=target
                )

    def of_text(t0, t1, data, codes, often):
        joined = b" ".join(data.split())
        at, code = anchors(joined, window, gram)
        starts, ends = spans(joined)
        n = len(starts)
        open_at: dict[int, list[int]] = {}
        frequent: set[int] = set()
        for i, c in zip(at.tolist(), code.tolist()):
            if c in often:
                frequent.update(range(max(0, i - reach), min(i, n - window) + 1) if hot else ())
            elif c in codes and not hot:
                lo, hi = max(0, i - reach), min(n, i + window)
                last = open_at.get(c)
                if last and lo <= last[1]:
                    last[1] = hi
                else:
                    if last:
                        yield (c, t0, t1, last[0], joined[starts[last[0]] : ends[last[1] - 1]])
                    open_at[c] = [lo, hi]
        for c, (lo, hi) in open_at.items():
            yield (c, t0, t1, lo, joined[starts[lo] : ends[hi - 1]])
        for lo in sorted(frequent):
            digest = xxhash.xxh3_128_digest(joined[starts[lo] : ends[lo + window - 1]])
            yield (int.from_bytes(digest[:8], "little", signed=True), t0, t1, lo, digest)

    return candidates.select(*_TEXT, utf8("_own").alias("_text"), "_codes", "_frequent").mapInArrow(run, schema)


def _shards(stretches: DataFrame, window: int) -> DataFrame:
    """Repeated spans (_t0, _t1, _from, _to) found with the automaton of each anchor's stretches."""
    schema = "_t0 bigint, _t1 bigint, _from int, _to int"

    def of_shard(places: list[tuple]) -> Iterator[tuple]:
        by_text: dict[bytes, list[tuple]] = {}
        for t0, t1, start, data in places:
            by_text.setdefault(data, []).append((t0, t1, start))
        split = {data: data.split(b" ") for data in by_text}
        if len(by_text) == 1:
            (words,) = split.values()
            found = {next(iter(split)): [(0, len(words))]} if len(places) > 1 else None
        else:
            found = None
        if found is None:
            automaton = Automaton()
            for data, words in split.items():
                automaton.add(words, len(by_text[data]))
            automaton.close()
            found = {data: automaton.repeated(words, window) for data, words in split.items()}
        for data, ranges in found.items():
            for t0, t1, start in by_text[data]:
                for lo, hi in ranges:
                    if hi - lo >= window:
                        yield t0, t1, start + lo, start + hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        held: list[tuple] = []
        current = None
        for batch in batches:
            out: list[tuple] = []
            for code, *place in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if code != current:
                    if held:
                        out.extend(of_shard(held))
                    held, current = [], code
                held.append(tuple(place))
            yield _rows(out, target)
        if held:
            yield _rows(list(of_shard(held)), target)

    dealt = stretches.select("_code", *_TEXT, "_start", "_data").repartition("_code").sortWithinPartitions("_code")
    return dealt.mapInArrow(run, schema)


def _rows(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(target)
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(columns, target)], schema=target)


def _cut(found: DataFrame, with_text: bool) -> DataFrame:
    """(_t0, _t1, _n_removed, _kept_digest, _kept) of texts (_own) with repeated spans (_spans)."""
    schema = "_t0 bigint, _t1 bigint, _n_removed bigint, _kept_digest string, _kept string, _removed array<int>"

    def of_batch(given, texts):
        removed, digests, kept_texts, cuts = [], [], [], []
        for text, ranges in zip(texts, given.pop("_spans").to_pylist()):
            words = text.split()
            gone = np.zeros(len(words) + 1, np.int32)
            ranges = np.asarray(ranges, np.int64).reshape(-1, 2)
            np.add.at(gone, ranges[:, 0], 1)
            np.add.at(gone, ranges[:, 1], -1)
            gone = np.cumsum(gone[:-1]) > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode("utf-8", "replace") if with_text else None)
            cuts.append(edge.astype(np.int32))
        return given | {"r": removed, "d": digests, "k": kept_texts, "s": cuts}

    rows = found.select(*_TEXT, "_spans", utf8("_own").alias("_text"))
    return over_texts(rows, schema, of_batch)


def removals(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    gram: int = GRAM,
    shard: int = SHARD,
    with_text: bool = True,
) -> DataFrame:
    """One row per distinct text, known by (_t0, _t1): what is removed from it.

    ``_n_words``, ``_n_removed``, ``_kept_digest`` (SHA-256 of the kept words joined by a space), and for texts
    that lose words ``_kept`` (those words) and ``_removed`` (begin, end, begin, end, ... in words). A null text is
    an empty one. Rows that repeat a text, in all columns or not, are occurrences of its windows like others.
    """
    survey = stage(_surveyed(docs, text, key, window, gram), "survey")
    places = survey.select(*_TEXT, F.explode("_anchors").alias("_code"))
    repeated = places.groupBy("_code").count().filter("count > 1")
    wanted = (
        places.distinct()
        .join(repeated, "_code")
        .groupBy(*_TEXT)
        .agg(
            F.collect_list("_code").alias("_codes"),
            F.collect_list(F.when(F.col("count") >= shard, F.col("_code"))).alias("_frequent"),
        )
        .join(survey.select(*_TEXT, "_rep"), list(_TEXT))
        .withColumns({"_r0": F.coalesce("_rep", F.lit(0)), "_r1": F.col("_rep").isNull()})
        .drop("_rep")
    )
    # One row of each text: that with the smallest key. The key takes part in the join, so copies spread.
    row_key = F.col(key).cast("bigint")
    rows = _texts(docs.select(F.coalesce(row_key, F.lit(0)).alias("_r0"), row_key.isNull().alias("_r1"),
                              F.col(text).alias("_own")), "_own")
    on = [*_TEXT, "_r0", "_r1"]
    candidates = stage(rows.join(wanted, on).dropDuplicates(on), "repeating-texts")
    few = _shards(_stretches(candidates, window, gram, False), window)
    hot = _stretches(candidates.filter(F.size("_frequent") > 0), window, gram, True)
    windows = stage(hot.select("_data", *_TEXT, "_start"), "windows")
    # As a table, so that adaptive execution can split the windows of a very frequent digest in the join.
    twice = stage(windows.groupBy("_data").count().filter("count > 1").select("_data"), "frequent-windows")
    often = windows.join(twice, "_data").select(
        *_TEXT, F.col("_start").alias("_from"), (F.col("_start") + window).alias("_to")
    )
    ranges = few.unionAll(often).groupBy(*_TEXT).agg(F.flatten(F.collect_list(F.array("_from", "_to"))).alias("_spans"))
    cut = _cut(candidates.select(*_TEXT, "_own").join(ranges, list(_TEXT)), with_text)
    whole = (F.col("_copies") > 1) & (F.col("_n_words") >= window)
    none = hashlib.sha256(b"").hexdigest()
    found = survey.select(*_TEXT, "_copies", "_n_words", "_digest").join(cut, list(_TEXT), "left").select(
        *_TEXT,
        "_n_words",
        F.when(whole, F.col("_n_words")).otherwise(F.coalesce("_n_removed", F.lit(0))).alias("_n_removed"),
        F.when(whole, F.lit(none)).otherwise(F.coalesce("_kept_digest", "_digest")).alias("_kept_digest"),
        F.when(whole, F.lit("")).otherwise(F.col("_kept")).alias("_kept"),
        F.when(whole, F.array(F.lit(0), F.col("_n_words").cast("int"))).otherwise(F.col("_removed")).alias("_removed"),
    )
    # As a table, so that the rows of a text with very many copies can be split when they are joined to it.
    return stage(found, "removals")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_removed`` and ``kept_sha256``."""
    found = removals(docs, text, key, with_text=False, **how)
    rows = _texts(docs.select(F.col(key).alias("_key"), F.col(text).alias("_own")), "_own").drop("_own")
    return rows.join(found, list(_TEXT)).select(
        F.col("_key").alias(key),
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_kept_digest").alias("kept_sha256"),
    )


def cleaned(docs: DataFrame, text: str = "text", key: str = "doc_id", chars: str = "n_chars", **how) -> DataFrame:
    """``docs`` with the repeated spans taken out of the texts.

    A text that loses words becomes its kept words joined by a space, and ``chars``, if there is such a column, its
    new length; other texts, null ones too, stay as they are to the byte. Every row stays, also if no word does.
    """
    found = removals(docs, text, key, **how).filter("_n_removed > 0").select(*_TEXT, "_kept")
    # The row goes as one struct, so no column of it can clash with ours.
    rows = _texts(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_own")), "_own").drop("_own")
    out = {c: F.col("_row")[c] for c in docs.columns}
    out[text] = F.coalesce("_kept", out[text])
    if chars in out:
        length = F.when(F.col("_kept").isNotNull(), F.length("_kept")).otherwise(out[chars])
        out[chars] = length.cast(docs.schema[chars].dataType)
    return rows.join(found, list(_TEXT), "left").select(*(x.alias(c) for c, x in out.items()))
