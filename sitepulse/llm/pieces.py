"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct chunks (a run of word-boundary marks with what follows up to the next) are laid end to end. The
suffixes are sorted by their first characters, as many as the longest piece has; binary search finds the range of
suffixes that start with each piece, and every occurrence is an edge from its first character to the one after its
last. Edges are put in the order of their positions and relaxed: for a BPE model, by joining neighbours over the best
scored edge, leftmost first, until none is left; for a unigram model, by the best sum of scores up to each position.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import over_texts, utf8, values

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"

#: Characters indexed at a time; the table of edges has a row per character.
INDEX_CHARS = 200_000
#: Characters of text whose words are held at a time.
SLICE_CHARS = 2 << 20
#: Chunks whose pieces a Python worker remembers.
REMEMBERED = 100_000
#: Beyond this length one chunk's neighbours are joined with a heap of its own.
LONG_CHUNK = 1_000
_NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Model:
    """A vocabulary: pieces by id, scores, and what stands for characters that no piece covers."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    matchable: tuple[bool, ...]
    byte_ids: tuple[int, ...]  # of the bytes 0 to 255, empty without byte fallback
    unknown: int
    unigram: bool
    prefix: bool  # a mark is put before the text


def load(path: str = MODEL) -> Model:
    """Read a SentencePiece model file whose normaliser changes nothing but spaces to marks."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    normal = proto.normalizer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError(f"{path}: the model rewrites texts beyond spaces")
    if proto.trainer_spec.model_type not in (1, 2):
        raise ValueError(f"{path}: neither a unigram nor a BPE model")
    pieces = tuple(p.piece for p in proto.pieces)
    number = {p: i for i, p in enumerate(pieces)}
    return Model(
        pieces=pieces,
        scores=tuple(p.score for p in proto.pieces),
        matchable=tuple(p.type in (1, 4) for p in proto.pieces),
        byte_ids=tuple(number[f"<0x{b:02X}>"] for b in range(256)) if proto.trainer_spec.byte_fallback else (),
        unknown=proto.trainer_spec.unk_id,
        unigram=proto.trainer_spec.model_type == 1,
        prefix=normal.add_dummy_prefix,
    )


class Codec:
    """Encoder and decoder of a model, in a Python worker."""

    def __init__(self, model: Model) -> None:
        self.model = model
        ids = [i for i, ok in enumerate(model.matchable) if ok and model.pieces[i]]
        self.ids = np.array(ids, np.int32)
        self.lengths = np.array([len(model.pieces[i]) for i in ids], np.int64)
        self.longest = int(self.lengths.max())
        self.chars = np.unique(np.concatenate([_points(model.pieces[i]) for i in ids]))
        self.spelled = np.full((len(ids), self.longest), -1, np.int64)
        for row, i in enumerate(ids):
            self.spelled[row, : len(model.pieces[i])] = np.searchsorted(self.chars, _points(model.pieces[i]))
        distinct = np.unique(-np.array(model.scores))
        self.rank = np.searchsorted(distinct, -np.array(model.scores)).astype(np.int32)
        self.score = np.array(model.scores)
        inside = {c for i in ids if len(model.pieces[i]) > 1 for c in model.pieces[i]}
        crossing = any(MARK in model.pieces[i].lstrip(MARK) for i in ids)
        end = "" if "\n" in inside else "\n"
        # Where no piece crosses a boundary, chunks between boundaries are encoded on their own.
        pattern = rf"{MARK}*[^{MARK}{end}]+|{MARK}+" + (r"|\n" if end else "")
        self.chunk = re.compile("(?s).+" if crossing else pattern)
        self.remembered: dict[str, bytes] = {}
        spelled = [p.replace(MARK, " ").encode() for p in model.pieces]
        for value, i in enumerate(model.byte_ids):
            spelled[i] = bytes([value])
        for i, ok in enumerate(model.matchable):
            if not ok and i not in model.byte_ids:
                spelled[i] = " ⁇ ".encode() if i == model.unknown else b""
        self.bytes_of = spelled

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each begins (one more than texts)."""
        number: dict[str, int] = defaultdict(count().__next__)
        at: list[int] = []
        ends = [0]
        for text in texts:
            if text:
                marked = (MARK if self.model.prefix else "") + text.replace(" ", MARK)
                at.extend(map(number.__getitem__, self.chunk.findall(marked)))
            ends.append(len(at))
        flat, starts = self._of_chunks(list(number))
        chosen = np.array(at, np.int64)
        sizes = np.diff(starts)[chosen]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(starts[:-1][chosen] - before[:-1], sizes) + np.arange(before[-1])]
        return ids, before[ends]

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text

    def _of_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.remembered
        new = [c for c in chunks if c not in known]
        fresh: dict[str, bytes] = {}
        first = chars = 0
        for i, chunk in enumerate(new):
            chars += len(chunk)
            if chars >= INDEX_CHARS or i + 1 == len(new):
                part = new[first : i + 1]
                ids, starts = self._index(part)
                raw, edge = ids.tobytes(), (4 * starts).tolist()
                fresh.update(zip(part, (raw[a:b] for a, b in zip(edge, edge[1:]))))
                first, chars = i + 1, 0
        found = [known[c] if c in known else fresh[c] for c in chunks]
        if len(known) < REMEMBERED:
            known.update(zip(new[: REMEMBERED - len(known)], (fresh[c] for c in new)))
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
        return np.frombuffer(b"".join(found), np.int32), starts.astype(np.int64)

    def _index(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = _points("".join(chunks))
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        stop = np.repeat(ends, sizes)
        edge = self._edges(points, stop)
        relax = self._best_sums if self.model.unigram else self._joined
        length = relax(edge, starts, ends, stop)
        at = np.flatnonzero(length)
        ids = edge[at, length[at]]
        return self._spelled_out(points, at, ids, starts)

    def _edges(self, points: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """[position, length]: the piece that occurs there, or -1."""
        n = len(points)
        place = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        covered = self.chars[place] == points
        used = np.unique(place[covered])
        code_of = np.zeros(len(self.chars) + 1, np.int64)  # the last for no character
        code_of[used] = np.arange(2, len(used) + 2)
        code_of[-1] = 0
        codes = np.concatenate([np.where(covered, code_of[place], 1), np.zeros(self.longest, np.int64)])
        bits = max(1, int(len(used) + 1).bit_length())
        per_key = 62 // bits
        keys = []
        for first in range(0, self.longest, per_key):
            key = np.zeros(n, np.int64)
            for i in range(first, first + per_key):
                key = (key << bits) | (codes[i : i + n] if i < self.longest else 0)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        # Pieces spelled in this batch's characters, with the smallest and largest key they can begin.
        spelled = code_of[self.spelled]
        blank = np.arange(self.longest) >= self.lengths[:, None]
        possible = np.flatnonzero(((spelled > 0) | blank).all(axis=1))
        low = np.zeros((len(keys), len(possible)), np.int64)
        high = np.zeros_like(low)
        for k, first in enumerate(range(0, self.longest, per_key)):
            for i in range(first, first + per_key):
                out = blank[possible, i] if i < self.longest else True
                code = spelled[possible, i] if i < self.longest else 0
                low[k] = (low[k] << bits) | np.where(out, 0, code)
                high[k] = (high[k] << bits) | np.where(out, (1 << bits) - 1, code)
        lo = np.searchsorted(keys[0], low[0], "left")
        hi = np.searchsorted(keys[0], high[0], "right")
        for i in np.flatnonzero((self.lengths[possible] > per_key) & (hi > lo)):
            a, b = lo[i], hi[i]
            for k in range(1, -(-int(self.lengths[possible[i]]) // per_key)):
                part = keys[k][a:b]
                a, b = a + np.searchsorted(part, low[k, i], "left"), a + np.searchsorted(part, high[k, i], "right")
            lo[i], hi[i] = a, b
        counts = hi - lo
        before = np.cumsum(counts) - counts
        at = order[np.repeat(lo - before, counts) + np.arange(counts.sum())]
        piece = np.repeat(self.ids[possible], counts)
        size = np.repeat(self.lengths[possible], counts)
        inside = at + size <= stop[at]
        table = np.full((n, self.longest + 1), -1, np.int32)
        table[at[inside], size[inside]] = piece[inside]
        return table

    def _joined(self, edge: np.ndarray, starts: np.ndarray, ends: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Lengths of the final symbols, at their first positions, after joining by score."""
        n = len(stop)
        length = np.ones(n, np.int64)
        back = np.arange(n) - 1  # the symbol before
        back[starts] = -1
        rank = np.where(edge >= 0, self.rank[edge], _NONE)
        best = np.full(n, _NONE, np.int32)
        pairs = np.flatnonzero(np.arange(n) + 1 < stop)
        best[pairs] = rank[pairs, 2] if self.longest > 1 else _NONE

        def refresh(p: np.ndarray) -> None:
            q = p + length[p]
            has = q < stop[p]
            both = length[p] + np.where(has, length[np.minimum(q, n - 1)], 0)
            ok = has & (both <= self.longest)
            best[p] = np.where(ok, rank[p, np.where(ok, both, 0)], _NONE)

        for c in np.flatnonzero(ends - starts > LONG_CHUNK):
            _join_long(int(starts[c]), int(ends[c]), rank, length, self.longest)
            best[starts[c] : ends[c]] = _NONE
        chunks = np.flatnonzero((ends - starts > 1) & (ends - starts <= LONG_CHUNK))
        while len(chunks):
            sizes = (ends - starts)[chunks]
            before = np.cumsum(sizes) - sizes
            here = np.repeat(starts[chunks] - before, sizes) + np.arange(sizes.sum())
            now = best[here]
            least = np.minimum.reduceat(now, before)
            while True:
                active = least < _NONE
                if 2 * active.sum() < len(chunks):
                    break
                hit = np.flatnonzero((now == np.repeat(least, sizes)) & np.repeat(active, sizes))
                owner = np.searchsorted(before, hit, "right") - 1
                first = np.concatenate([[True], owner[1:] != owner[:-1]])
                p = here[hit[first]]
                q = p + length[p]
                length[p] += length[q]
                length[q] = 0
                best[q] = _NONE
                after = p + length[p]
                more = after < stop[p]
                back[after[more]] = p[more]
                refresh(p)
                earlier = back[p]
                refresh(earlier[earlier >= 0])
                now = best[here]
                least = np.minimum.reduceat(now, before)
            chunks = chunks[active]
        return length

    def _best_sums(self, edge: np.ndarray, starts: np.ndarray, ends: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Lengths of the symbols on the path with the best sum of scores; an uncovered character costs extra."""
        n = len(stop)
        floor = self.score[self.ids].min() - 10.0
        total = np.full(n + len(starts), -np.inf)  # one more position for each chunk's end
        shift = np.repeat(np.arange(len(starts)), ends - starts)
        total[starts + np.arange(len(starts))] = 0.0
        came = np.zeros(n + len(starts), np.int64)
        for offset in range(int((ends - starts).max())):
            p = starts[ends - starts > offset] + offset
            base = total[p + shift[p]]
            for size in range(1, self.longest + 1):
                ok = p + size <= stop[p]
                piece = edge[p, size]
                value = np.where(piece >= 0, self.score[piece], floor if size == 1 else -np.inf)
                to = np.where(ok, p + size + shift[p], 0)
                better = ok & (base + value > total[to])
                total[to[better]] = (base + value)[better]
                came[to[better]] = size
        length = np.zeros(n, np.int64)
        at = ends + np.arange(len(starts))
        first = starts + np.arange(len(starts))
        shift_at = np.arange(len(starts))
        while len(at):
            size = came[at]
            at = at - size
            length[at - shift_at] = size
            go = at > first
            at, first, shift_at = at[go], first[go], shift_at[go]
        return length

    def _spelled_out(self, points, at, ids, starts) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters that no piece covers as bytes or as the unknown id; where each chunk begins."""
        missing = np.flatnonzero(ids < 0)
        counts = np.ones(len(ids), np.int64)
        kinds, kind = np.unique(points[at[missing]], return_inverse=True)
        stand_in = [
            [self.model.byte_ids[b] for b in chr(c).encode("utf-8", "replace")] if self.model.byte_ids else [self.model.unknown]
            for c in kinds
        ]
        counts[missing] = np.array([len(x) for x in stand_in], np.int64)[kind] if len(missing) else 0
        place = np.cumsum(counts) - counts
        out = np.repeat(ids, counts)
        for k, values in enumerate(stand_in):
            for i, value in enumerate(values):
                out[place[missing[kind == k]] + i] = value
        edges = np.append(place, counts.sum())[np.searchsorted(at, np.append(starts, len(points)))]
        return out.astype(np.int32), edges


def _join_long(start: int, end: int, rank: np.ndarray, length: np.ndarray, longest: int) -> None:
    """The same joining for one long chunk, with a heap of neighbours."""
    size = dict.fromkeys(range(start, end), 1)
    before = {p: p - 1 for p in range(start + 1, end)}
    heap: list[tuple[int, int, int, int]] = []

    def push(p: int) -> None:
        q = p + size[p]
        if q < end and size[p] + size[q] <= longest:
            r = int(rank[p, size[p] + size[q]])
            if r < _NONE:
                heapq.heappush(heap, (r, p, size[p], size[q]))

    for p in range(start, end):
        push(p)
    while heap:
        _, p, a, b = heapq.heappop(heap)
        if size.get(p) != a or size.get(p + a) != b:
            continue
        del size[p + a]
        size[p] = a + b
        if p + a + b < end:
            before[p + a + b] = p
        push(p)
        if p in before:
            push(before[p])
    length[start:end] = 0
    for p, n in size.items():
        length[p] = n


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_CODECS: dict[int, tuple[Model, Codec]] = {}


def codec(model: Model) -> Codec:
    """The codec of a model, made once in a Python worker."""
    key = hash(model)
    if key not in _CODECS or _CODECS[key][0] != model:
        _CODECS.clear()
        _CODECS[key] = (model, Codec(model))
    return _CODECS[key][1]


def encode(text: str | Column, model: Model) -> Column:
    """Ids of a text's pieces, array<int>. A null or empty text has none."""
    column = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        own = codec(model)
        values, offsets = [], [np.zeros(1, np.int64)]
        done = 0
        for part in _parts(texts):
            ids, begins = own.encode(part)
            values.append(ids)
            offsets.append(begins[1:] + done)
            done += len(ids)
        flat = np.concatenate(values) if values else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(flat, pa.int32()))

    return of(F.coalesce(column, F.lit("")))


def _parts(texts: pa.Array):
    held, size = [], 0
    for text in values(texts):
        held.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def decode(ids: str | Column, model: Model) -> Column:
    """The text of an array of ids; a null array has none, an id beyond the vocabulary fails."""
    column = F.col(ids) if isinstance(ids, str) else ids

    @F.arrow_udf("string")
    def of(arrays: pa.Array) -> pa.Array:
        own = codec(model)
        return pa.array([None if x is None else own.decode(x) for x in _few(arrays)], pa.string())

    return of(column)


def _few(arrays: pa.Array, rows: int = 256):
    for first in range(0, len(arrays), rows):
        yield from arrays.slice(first, rows).to_pylist()


def encoded(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: the key, ``n_tokens``, ``ids`` and ``round_trip``, whether decoding gives the text back.

    A null or empty text has no ids and comes back empty. Decoding cannot tell a mark (U+2581) from a space.
    """

    def of_batch(given, texts):
        own = codec(model)
        texts = [t.decode("utf-8", "replace") for t in texts]
        ids, begins = own.encode(texts)
        same = [own.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, begins, begins[1:])]
        lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids, pa.int32()))
        return given | {"n": np.diff(begins), "ids": lists, "same": same}

    # One pass: as two expressions, the planner would encode again what it decodes.
    rows = docs.select(F.col(key).cast("bigint").alias("_key"), utf8(text).alias("_text"))
    found = over_texts(rows, "_key bigint, n_tokens bigint, ids array<int>, round_trip boolean", of_batch)
    return found.withColumnRenamed("_key", key)
