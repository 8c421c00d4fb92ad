"""Toxicity: a learned, weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters to Latin ones and digits or signs that stand for letters to those,
and leaves words parted by single spaces. Lexicon entries are whole words or word beginnings with a weight; the
weights of the matched words, outside of exception phrases, are summed, normalised by the number of words and
turned into a probability by one logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import values
from sitepulse.session import stage

# Letters that look like a Latin one, and signs that replace one.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "ѵ": "v",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"
#: Harmless phrases that hold words a lexicon may list; more are learned.
EXCEPTIONS = ("trash can", "trash bin", "pond scum", "class clown", "clown fish")

_SAME = str.maketrans(
    LOOKALIKES
    | {chr(0xFF41 + i): chr(0x61 + i) for i in range(26)}  # full-width letters
    | {chr(0xFF10 + i): chr(0x30 + i) for i in range(10)}
    | dict.fromkeys(INVISIBLE, "")
)
_SIGNS = str.maketrans(SUBSTITUTES)
#: Numbers that touch no letter, and signs before none, stand for themselves.
_LONE = re.compile(r"(?<![^\W_])(?<![@$!])[0-9]+(?![^\W_]|[@$!])|[@$!](?![^\W_]|[@$])")
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    """Bounds and thresholds of the fit; rows are taken in the order of a hash of their key."""

    rows: int = 20_000  # labelled documents at most
    entries: int | None = None  # lexicon entries at most, if bounded
    beginnings: tuple[int, ...] = (4, 5, 6)
    least_documents: float = 0.004  # share of the toxic rows that an entry is found in; two rows at least
    least_weight: float = 3.0
    least_share: float = 0.6  # of toxic documents among those a lexicon entry is found in, on other rows
    least_exception: int = 3
    phrases: int | None = None  # exception phrases at most, if bounded


@dataclass(frozen=True)
class Lexicon:
    """``weights``: entries as they stand in folded text, " word " or " begin"; ``curve``: offset and slope."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float]

    def matcher(self) -> Matcher:
        return Matcher(self)


def fold(text: str) -> str:
    """Folded words, parted and enclosed by spaces."""
    same = text.lower().translate(_SAME)
    return f" {' '.join(_WORDS.findall(_LONE.sub(' ', same).translate(_SIGNS)))} "


class Matcher:
    """The automaton of a lexicon and its exceptions."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.curve = lexicon.curve
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in lexicon.exceptions:
            folded = fold(phrase)
            if folded.strip():
                self.automaton.add_word(folded, (len(folded), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Weight of each matched word, by the place of the space before it, outside of exceptions."""
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        if self.empty:
            return found
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for lo, hi in excepted:
            for start in [x for x in found if lo <= x < hi]:
                del found[start]
        return found

    def density(self, text: str | None) -> float:
        """Weight per hundred words, damped for short texts, on a log scale."""
        folded = fold(text or "")
        words = folded.count(" ") - 1
        return math.log1p(100 * sum(self.hits(folded).values()) / (words + 10))

    def score(self, text: str | None) -> float:
        offset, slope = self.curve
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, offset + slope * self.density(text)))))


def fold_of(key: str | Column) -> Column:
    """CRC-32 of the key as text, modulo 3; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3))


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", training=Training()
) -> Lexicon:
    """Fit a lexicon on labelled rows whose ``fold_of`` is not 1; labels of the others are never read.

    Rows of remainder 0 give the entries and weights, rows of remainder 2 confirm them, give exception phrases and
    the curve. Null labels and keys do not count; a key labelled more than once is toxic if any of its labels is.
    Without a toxic row the lexicon is empty and every score 0.
    """
    train = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_toxic"))
        .filter(F.col("_key").isNotNull() & F.col("_toxic").isNotNull() & (fold_of("_key") != 1))
        .groupBy("_key")
        .agg(F.max("_toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(training.rows)
    )
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # At most training.rows rows of two numbers.
    sample = stage(texts.join(F.broadcast(train), "_key").withColumn("_fold", fold_of("_key")), "labelled")
    first, second = (sample.filter(F.col("_fold") == x).select("_text", "_toxic") for x in (0, 2))
    totals = {r._toxic: r["count"] for r in first.groupBy(F.col("_toxic").cast("int").alias("_toxic")).count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return Lexicon({}, EXCEPTIONS, (-60.0, 0.0))
    counted = _counts(first.filter("_toxic = 1"), training, None).filter(
        F.col("n") >= max(2, math.ceil(training.least_documents * toxic))
    )
    # The share of the toxic rows that an entry needs bounds their number by that of the words of 250 average texts.
    common = {r.entry: r.n for r in counted.collect()}
    among = {r.entry: r.n for r in _counts(first.filter("_toxic = 0"), training, frozenset(common)).collect()}
    weights = {
        e: math.log((n + 0.5) / (toxic + 1)) - math.log((among.get(e, 0) + 0.5) / (clean + 1)) for e, n in common.items()
    }
    ranked = sorted((e for e in weights if weights[e] >= training.least_weight), key=lambda e: (-weights[e], e))
    draft = Lexicon({e: weights[e] for e in ranked[: training.entries]}, EXCEPTIONS, (0.0, 0.0))
    return _confirmed(draft, second, training)


def _counts(texts: DataFrame, training: Training, only: frozenset[str] | None) -> DataFrame:
    """(entry, n): the number of texts with each entry, or with those in ``only``."""

    def run(batches):
        for batch in batches:
            found: Counter[str] = Counter()
            for text in values(batch.column(0)):
                words = set(fold(text).split())
                entries = {f" {w} " for w in words}
                entries.update(f" {w[:n]}" for w in words for n in training.beginnings if len(w) > n)
                found.update(entries if only is None else entries & only)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["entry", "n"]
            )

    return texts.select("_text").mapInArrow(run, "entry string, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))


def _confirmed(draft: Lexicon, texts: DataFrame, training: Training) -> Lexicon:
    """Drop entries that do not hold on ``texts``, add exception phrases, fit the curve."""
    matched = _usage(draft, texts).filter("kind = 'entry' and toxic > 0").collect()
    good = {r.entry for r in matched if r.toxic >= training.least_share * r.n}
    kept = {e: w for e, w in draft.weights.items() if e in good}
    phrases = (
        _usage(Lexicon(kept, draft.exceptions, draft.curve), texts)
        .filter(f"kind = 'phrase' and toxic = 0 and n >= {training.least_exception}")
        .orderBy(F.desc("n"), "entry")
    )
    if training.phrases is not None:
        phrases = phrases.limit(training.phrases)
    lexicon = Lexicon(kept, (*draft.exceptions, *(r.entry for r in phrases.collect())), draft.curve)

    @F.arrow_udf("double")
    def density(column: pa.Array) -> pa.Array:
        matcher = lexicon.matcher()
        return pa.array([matcher.density(x) for x in values(column)], pa.float64())

    # No more rows than the training bound, two numbers each.
    rows = texts.select(density("_text").alias("x"), F.col("_toxic").cast("double").alias("y")).collect()
    return Lexicon(kept, lexicon.exceptions, _curve([r.x for r in rows], [r.y for r in rows]))


def _usage(lexicon: Lexicon, texts: DataFrame) -> DataFrame:
    """How many texts, and toxic ones, hold each entry, and each two-word phrase around a match."""

    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found: dict[tuple[str, str], list[int]] = {}
            for text, toxic in zip(values(batch.column(0)), batch.column(1).to_pylist()):
                folded = fold(text)
                seen = set()
                if not matcher.empty:
                    for end, (length, weight) in matcher.automaton.iter(folded):
                        if weight is not None:
                            seen.add(("entry", folded[end - length + 1 : end + 1]))
                for start in matcher.hits(folded):
                    stop = folded.index(" ", start + 1)
                    if stop + 1 < len(folded):
                        seen.add(("phrase", folded[start + 1 : folded.index(" ", stop + 1)]))
                    if start:
                        seen.add(("phrase", folded[folded.rindex(" ", 0, start) + 1 : stop]))
                for item in seen:
                    n = found.setdefault(item, [0, 0])
                    n[0] += 1
                    n[1] += toxic
            columns = [[k for k, _ in found], [e for _, e in found], [n for n, _ in found.values()], [t for _, t in found.values()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string() if i < 2 else pa.int64()) for i, x in enumerate(columns)],
                names=["kind", "entry", "n", "toxic"],
            )

    rows = texts.select("_text", F.col("_toxic").cast("bigint").alias("_toxic"))
    out = rows.mapInArrow(run, "kind string, entry string, n bigint, toxic bigint")
    return out.groupBy("kind", "entry").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _curve(x: list[float], y: list[float], ridge: float = 0.05) -> tuple[float, float]:
    """Offset and slope of a logistic curve by Newton steps; the slope is not negative."""
    if not y or not sum(y):
        return (-60.0, 0.0)
    design = np.stack([np.ones(len(x)), np.array(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (np.array(y) - p) - ridge * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def score(lexicon: Lexicon, text: str | Column = "text") -> Column:
    """Probability that a text is toxic; a null text reads as the empty one."""

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        matcher = lexicon.matcher()
        return pa.array([matcher.score(x) for x in values(column)], pa.float64())

    return of(F.col(text) if isinstance(text, str) else text)


def accepted(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; empty and null texts are scored like others."""
    return docs.filter(score(lexicon, text) < threshold)
