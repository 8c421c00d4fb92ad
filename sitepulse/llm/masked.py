"""Language-model scores: pseudo-log-likelihood of a bidirectional window network.

The network predicts each word from the ``side`` words on its left and right. Its vocabulary comes from the word counts
of the whole corpus: the most frequent words have a code each, all others share hashed codes. A code is predicted in
two digits, P(high | both sides) P(low | both sides, high), so no step is as wide as the vocabulary. The network is
trained in numpy: every task goes through all texts of its partition from the same start, and the mean of what the tasks
learn, weighted by their words, starts the next round. A document's score is the sum over all its words of the log-
probability given both sides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import over_texts, utf8, values
from sitepulse.session import stage

#: A code that stands for what lies beyond an end of the text.
EDGE = 0


@dataclass(frozen=True)
class Settings:
    digit: int = 32  # codes: its square
    hashed: int = 256  # codes shared by words without one of their own
    side: int = 2
    width: int = 12
    hidden: int = 24
    batch: int = 4096
    rate: float = 1.0
    rounds: int = 1
    seed: int = 42

    @property
    def codes(self) -> int:
        return self.digit * self.digit


@dataclass(frozen=True)
class Vocabulary:
    """Codes of the most frequent words; 0 is the edge, the last ``hashed`` ones are shared."""

    words: tuple[bytes, ...]
    settings: Settings
    counts: tuple[int, ...] = ()
    others: int = 0  # the count of all other words

    def frequencies(self) -> np.ndarray:
        """Smoothed share of every code, those of shared ones taken as equal."""
        s = self.settings
        found = np.full(s.codes, 0.5)
        found[1 : 1 + len(self.counts)] += self.counts
        found[-s.hashed :] += self.others / s.hashed
        return found / found.sum()

    def table(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.words)}


class Coder:
    """Words to codes, in a Python worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        s = vocabulary.settings
        self.table = vocabulary.table()
        self.first, self.hashed = s.codes - s.hashed, s.hashed

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        known, first, hashed = self.table, self.first, self.hashed
        crc = zlib.crc32
        return np.array([known[w] if w in known else first + crc(w) % hashed for w in words], np.int32)


def vocabulary(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Vocabulary:
    """Count the words (A-Z lower-cased) of all texts and keep the most frequent ones, equal counts by bytes."""

    def run(batches):
        from collections import Counter

        for batch in batches:
            found: Counter[bytes] = Counter()
            for body in values(batch.column(0)):
                found.update(body.lower().split())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "n"]
            )

    counted = docs.select(utf8(text)).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stage(counted, "word-counts")
    top = counted.orderBy(F.desc("n"), "word").limit(settings.codes - settings.hashed - 1).collect()
    whole = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = tuple(r.n for r in top)
    return Vocabulary(tuple(bytes(r.word) for r in top), settings, counts, whole - sum(counts))


class Network:
    """Embeddings of the words around, one hidden layer, two softmax digits."""

    NAMES = ("embed", "hidden", "bias", "high", "high_bias", "low", "low_bias")

    def __init__(self, settings: Settings, weights: dict[str, np.ndarray] | None = None) -> None:
        self.s = s = settings
        if weights is None:
            rng = np.random.default_rng(s.seed)
            inputs = 2 * s.side * s.width
            shapes = {"embed": (s.codes, s.width), "hidden": (inputs, s.hidden), "high": (s.hidden, s.digit), "low": (s.hidden, s.digit)}
            weights = {n: rng.normal(0, 0.3 if n == "embed" else 0.3 / np.sqrt(x[0]), x) for n, x in shapes.items()}
            weights |= {"bias": np.zeros(s.hidden), "high_bias": np.zeros(s.digit), "low_bias": np.zeros((s.digit, s.digit))}
        self.w = {n: np.asarray(weights[n], np.float32) for n in self.NAMES}

    def starting_at(self, frequencies: np.ndarray) -> Network:
        """The network whose predictions begin near the given shares of codes."""
        table = frequencies.reshape(self.s.digit, self.s.digit)
        high = table.sum(axis=1)
        return Network(self.s, self.w | {"high_bias": np.log(high), "low_bias": np.log(table / high[:, None])})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[n].ravel() for n in self.NAMES])

    def with_flat(self, flat: np.ndarray) -> Network:
        at, weights = 0, {}
        for n in self.NAMES:
            size = self.w[n].size
            weights[n] = flat[at : at + size].reshape(self.w[n].shape)
            at += size
        return Network(self.s, weights)

    def _forward(self, around: np.ndarray, target: np.ndarray):
        w = self.w
        x = w["embed"][around].reshape(len(around), -1)
        h = np.tanh(x @ w["hidden"] + w["bias"])
        high, low = np.divmod(target, self.s.digit)
        logs = []
        for scores in (h @ w["high"] + w["high_bias"], h @ w["low"] + w["low_bias"][high]):
            scores -= scores.max(axis=1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
            logs.append(scores)
        return x, h, high, low, logs

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        _, _, high, low, (a, b) = self._forward(around, target)
        rows = np.arange(len(target))
        return a[rows, high].astype(np.float64) + b[rows, low]

    def step(self, around: np.ndarray, target: np.ndarray) -> None:
        """One step of gradient descent on the mean negative log-probability of a batch."""
        w, rows = self.w, np.arange(len(target))
        x, h, high, low, (a, b) = self._forward(around, target)
        rate = np.float32(self.s.rate / len(target))
        da, db = np.exp(a), np.exp(b)
        da[rows, high] -= 1
        db[rows, low] -= 1
        dh = (da @ w["high"].T + db @ w["low"].T) * (1 - h * h)
        dx = (dh @ w["hidden"].T).reshape(-1, self.s.width)
        w["high"] -= rate * (h.T @ da)
        w["high_bias"] -= rate * da.sum(axis=0)
        w["low"] -= rate * (h.T @ db)
        by_high = np.zeros((self.s.digit, len(target)), np.float32)
        by_high[high, rows] = 1
        w["low_bias"] -= rate * (by_high @ db)
        w["hidden"] -= rate * (x.T @ dh)
        w["bias"] -= rate * dh.sum(axis=0)
        codes = around.ravel()
        order = np.argsort(codes, kind="stable")
        found, first = np.unique(codes[order], return_index=True)
        w["embed"][found] -= rate * np.add.reduceat(dx[order], first, axis=0)


def windows(codes: list[np.ndarray], side: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes around every word of some texts, and the words' own."""
    gap = np.full(side, EDGE, np.int32)
    flat = np.concatenate([x for c in codes for x in (c, gap)] or [gap])
    flat = np.concatenate([gap, flat])
    own = np.concatenate([np.concatenate([np.ones(len(c), bool), np.zeros(side, bool)]) for c in codes] or [np.zeros(side, bool)])
    at = np.flatnonzero(own) + side
    offsets = [d for d in range(-side, side + 1) if d]
    return flat[at[:, None] + np.array(offsets)], flat[at]


def _batched(texts: Iterator[bytes], coder: Coder, words: int) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for text in texts:
        held.append(coder(text))
        size += len(held[-1])
        if size >= words:
            yield held
            held, size = [], 0
    if size:
        yield held


def train(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of a corpus; every word of every text is a training target in every round.

    What a task sends has the size of the network; it is summed by Spark in blocks, so neither driver nor task holds more
    than one network and a block of each task's.
    """
    vocab = vocabulary(docs, text, settings)
    network = Network(settings).starting_at(vocab.frequencies())
    block = 1 << 12

    for _ in range(settings.rounds):
        given = network.w

        def run(batches, given=given):
            coder, own, words = Coder(vocab), Network(settings, {n: x.copy() for n, x in given.items()}), 0
            texts = (body for batch in batches for body in values(batch.column(0)))
            for codes in _batched(texts, coder, 16 * settings.batch):
                around, target = windows(codes, settings.side)
                words += len(target)
                for i in range(0, len(target), settings.batch):
                    own.step(around[i : i + settings.batch], target[i : i + settings.batch])
            flat = own.flat().astype(np.float64) * words
            parts = [flat[i : i + block] for i in range(0, len(flat), block)] if words else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(parts), dtype=np.int32)),
                    pa.array([words] * len(parts), pa.int64()),
                    pa.array(parts, pa.list_(pa.float64())),
                ],
                names=["part", "words", "weights"],
            )

        def add(batches):
            """Sum the blocks of a task's partition, one sum per block number."""
            sums: dict[int, list] = {}
            for batch in batches:
                for part, words, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    have = sums.setdefault(part, [0, 0.0])
                    have[0] += words
                    have[1] = have[1] + np.asarray(weights.values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sums.keys(), pa.int32()),
                    pa.array([x[0] for x in sums.values()], pa.int64()),
                    pa.array([x[1] for x in sums.values()], pa.list_(pa.float64())),
                ],
                names=["part", "words", "weights"],
            )

        schema = "part int, words bigint, weights array<double>"
        sent = docs.select(utf8(text)).mapInArrow(run, schema)
        summed = sent.repartition("part").sortWithinPartitions("part", "words").mapInArrow(add, schema)
        # One network in all.
        found = sorted(summed.collect(), key=lambda r: r.part)
        if found:
            flat = np.concatenate([np.array(r.weights) / r.words for r in found])
            network = network.with_flat(flat.astype(np.float32))
    return vocab, network


def score(
    docs: DataFrame, vocab: Vocabulary, network: Network, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: the key, ``n_words``, ``pll`` (the sum of log-probabilities) and ``mean_pll`` (per word).

    A null, empty or blank text has no words, a sum of 0 and a null mean. Repeated rows have equal scores.
    """
    weights, settings = network.w, network.s

    def of_batch(given, texts):
        coder, own = Coder(vocab), Network(settings, weights)
        counts, sums = [], []
        for codes in _whole(texts, coder, settings.batch):
            around, target = windows(codes, settings.side)
            logs = np.concatenate(
                [own.log_probabilities(around[i : i + settings.batch], target[i : i + settings.batch]) for i in range(0, len(target), settings.batch)]
                or [np.zeros(0)]
            )
            sizes = np.array([len(c) for c in codes])
            ends = np.concatenate([[0.0], np.cumsum(logs)])[np.cumsum(sizes)]
            counts.extend(sizes.tolist())
            sums.extend(np.diff(ends, prepend=0.0).tolist())
        return given | {"n": counts, "s": sums}

    rows = docs.select(F.col(key).cast("bigint").alias("_key"), utf8(text).alias("_text"))
    out = over_texts(rows, "_key bigint, _n bigint, _sum double", of_batch)
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))
    return out.select(F.col("_key").alias(key), F.col("_n").alias("n_words"), F.col("_sum").alias("pll"), mean.alias("mean_pll"))


def _whole(texts: list[bytes], coder: Coder, words: int) -> Iterator[list[np.ndarray]]:
    """All texts in groups of at least ``words`` words; empty texts too."""
    held, size = [], 0
    for text in texts:
        held.append(coder(text))
        size += len(held[-1])
        if size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held
