"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame functions alone.

A text is cut into paragraphs: the sentences of its lines, long ones in pieces. A sketch has three tables of ``width``
cells. The digest of every distinct paragraph is added to one cell of each: a cell holds how many digests it got and the
XOR of them and of a checksum of each. Sketches of two versions subtract cell by cell; what both have cancels out. A cell
left with a single digest (its count is 1 or -1 and its checksum fits) gives that digest away; taking it out of its other
cells may bare further ones, until all cells are empty and every differing digest is known, with its side. When cells
remain, the tables were too small: those pairs are sketched anew, four times as wide, until none is left.

A fingerprint is the sketch of the smallest width, as text. Rows are dealt once by a row number; sketches, subtraction
and peeling group by that number first, so they need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.session import stage

#: A sentence or the rest of a line, cut after 64 code points; every code point but a line break alone is in one.
PARAGRAPH = r"[^.!?\n]{1,64}[.!?\n]*|[.!?\n]+"
TABLES = 3
#: Cells a table of a fingerprint.
WIDTH = 4
#: Peeling steps of an attempt; each goes over one table.
STEPS = 6
#: Parts a shuffle partition of texts and sketches: digests grow into cells, which should stay in a task's memory.
PARTS = 4
#: Attempts; each is four times as wide as the one before, so this many are never needed.
ATTEMPTS = 20

_PAIR = ["_row", "_kind", "_width"]


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    found = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def shared_start(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common at their beginning."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False).cast("int")
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1)


# ---------------------------------------------------------------- neighbours


def with_next(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``_key``, ``_text`` and ``_next``, the text of the following row by ascending key; the first follows the last.

    Null keys come last; rows of one key follow each other by a hash of the text, equal rows in any order. A null text
    is the empty one. Rows are dealt to ranges of keys; the first row of a range goes to the range before as well, so
    the text is shuffled once.
    """
    given = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    place = F.struct(F.col("_key").isNull().alias("last"), F.col("_key").alias("key"), F.xxhash64("_text").alias("tie"))
    ranges = given.select(place.alias("_place")).repartitionByRange(_parts(docs), "_place")
    ranges = ranges.withColumn("_part", F.spark_partition_id())
    heads = sorted((r[0] for r in ranges.groupBy("_part").agg(F.min("_place")).select("min(_place)").collect()), key=_in_order)
    if not heads:
        return given.withColumn("_next", F.lit("")).filter("false")
    kind = given.schema["_key"].dataType
    starts = F.array(*(F.struct(F.lit(h.last).alias("last"), F.lit(h.key).cast(kind).alias("key"), F.lit(h.tie).alias("tie")) for h in heads))
    halves = F.array(*(F.lit(1 << b) for b in reversed(range(len(heads).bit_length()))))

    def dealt(p: Column) -> Column:
        own = F.aggregate(halves, F.lit(0), lambda low, step: F.when(F.get(starts, low + step) <= p, low + step).otherwise(low))
        ahead = lambda b: F.struct(((b + len(heads) - 1) % len(heads)).cast("int").alias("_bucket"), F.lit(False).alias("_own"))
        here = lambda b: F.struct(b.alias("_bucket"), F.lit(True).alias("_own"))
        # An array of one, so that the search and the hash run once a row.
        return F.flatten(F.transform(F.array(own), lambda b: F.when(F.get(starts, b) == p, F.array(here(b), ahead(b))).otherwise(F.array(here(b)))))

    entered = given.select("*", F.transform(F.array(place), lambda p: F.struct(p.alias("place"), dealt(p).alias("into")))[0].alias("_at"))
    entered = entered.select("_key", "_text", F.col("_at.place").alias("_place"), F.inline("_at.into"))
    order = Window.partitionBy("_bucket").orderBy(F.desc("_own"), "_place")
    return entered.withColumn("_next", F.lead("_text").over(order)).filter("_own").select("_key", "_text", "_next")


def _parts(rows: DataFrame) -> int:
    return PARTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _in_order(place) -> tuple:
    return (place.last, 0 if place.key is None else place.key, place.tie)


# ---------------------------------------------------------------- sketches


def _check(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed), F.lit(TABLES))


def _cell(table: int, key: Column, seed: int) -> Column:
    return (F.col("_width") * table + F.pmod(F.xxhash64(key, F.lit(seed), F.lit(table)), F.col("_width"))).cast("bigint")


def _content(cell: Column | int, count: Column | int, key: Column | int, check: Column | int, digest: Column | None = None) -> Column:
    fields = {"_cell": cell, "_count": count, "_key": key, "_check": check} | ({} if digest is None else {"_digest": digest})
    return F.struct(*((x if isinstance(x, Column) else F.lit(x)).cast("bigint").alias(name) for name, x in fields.items()))


def _added(rows: DataFrame) -> DataFrame:
    """Cells of the same place added up; empty ones go."""
    place = [*_PAIR, "_cell", *(["_digest"] if "_digest" in rows.columns else [])]
    added = rows.groupBy(*place).agg(
        F.sum("_count").alias("_count"), F.bit_xor("_key").alias("_key"), F.bit_xor("_check").alias("_check")
    )
    return added.filter("_cell < 0 OR _count <> 0 OR _key <> 0 OR _check <> 0")


def subtracted(pairs: DataFrame, seed: int = 0) -> DataFrame:
    """The sketch of ``_a`` minus that of ``_b``, arrays of digests, for every ``_row`` and ``_kind``, ``_width`` wide."""
    signed = lambda side, sign: F.transform(side, lambda d: F.struct(d.alias("_key"), F.lit(sign).alias("_count")))
    entries = pairs.select(*_PAIR, F.inline(F.concat(signed("_a", 1), signed("_b", -1))))
    key = F.col("_key")
    into = [_content(_cell(t, key, seed), F.col("_count"), key, _check(key, seed)) for t in range(TABLES)]
    return _added(entries.select(*_PAIR, F.inline(F.array(*into))))


def peeled(cells: DataFrame, seed: int = 0, steps: int = STEPS, kept: bool = True) -> DataFrame:
    """``cells`` after peeling: what was recovered from the first side has cell -1, from the second -2.

    It comes as a row per ``_digest``, or, unless they are to be ``kept``, as one row a side with their number as ``_count``.
    """
    key, count, check = F.col("_key"), F.col("_count"), F.col("_check")
    if kept:
        cells = cells.withColumn("_digest", F.lit(None).cast("bigint"))
    none, known = (F.lit(None), F.col("_digest")) if kept else (None, None)
    for step in range(steps):
        table = step % TABLES  # a digest is in one cell of a table, so no step meets it twice
        here = F.floor(F.col("_cell") / F.col("_width")) == table
        pure = here & (F.abs(count) == 1) & (check == _check(key, seed))
        taken = [_content(_cell(t, key, seed), -count, key, check, none) for t in range(TABLES) if t != table]
        found = _content(F.when(count > 0, -1).otherwise(-2), 1, 0, 0, key if kept else None)
        after = F.when(pure, F.array(*taken, found)).otherwise(F.array(_content(F.col("_cell"), count, key, check, known)))
        cells = _added(cells.select(*_PAIR, F.inline(after)))
    return cells


def _settled(rows: DataFrame, kinds: dict[int, tuple[str | Column, str | Column]], kept: bool) -> list[DataFrame]:
    """Peeled cells of the pairs that left none, attempt by attempt, each staged.

    Pairs whose peeling ends with cells left are sketched again, with other hashes, at first as wide as all their digests
    ask for, then four times as wide each time; every pair is settled in the end.
    """
    results, todo = [], None
    for attempt in range(ATTEMPTS):
        if todo is None:
            given = rows.repartition(_parts(rows), "_row")
        else:
            # Both sides are dealt by row alike, and merged, so that the sketches need no further shuffle.
            failed = todo.repartition(_parts(rows), "_row").groupBy("_row").agg(F.collect_set("_kind").alias("_kinds"))
            given = rows.repartition(_parts(rows), "_row").join(failed.hint("merge"), "_row")
        each = []
        for kind, (a, b) in kinds.items():
            a, b = (F.col(side) if isinstance(side, str) else side for side in (a, b))
            wide = F.lit(WIDTH) if not attempt else WIDTH + (F.size(a) + F.size(b)) * 4 ** (attempt - 1)
            each.append(F.struct(F.lit(kind).alias("_kind"), wide.cast("bigint").alias("_width"), a.alias("_a"), b.alias("_b")))
        asked = F.array(*each) if todo is None else F.filter(F.array(*each), lambda p: F.array_contains("_kinds", p["_kind"]))
        state = peeled(subtracted(given.select("_row", F.inline(asked)), attempt), attempt, kept=kept)
        left = F.count_if(F.col("_cell") >= 0)
        if kept:
            state = state.withColumn("_left", left.over(Window.partitionBy("_row", "_kind")))
        else:
            side = lambda cell: F.coalesce(F.max(F.when(F.col("_cell") == cell, F.col("_count"))), F.lit(0))
            state = state.groupBy("_row", "_kind").agg(side(-1).alias("_first"), side(-2).alias("_second"), left.alias("_left"))
        state = stage(state, "differences")
        results.append(state.filter("_left = 0"))
        todo = state.filter("_left > 0").select("_row", "_kind").distinct()
        if todo.isEmpty():
            return results
    raise RuntimeError("sketches of any width left cells")


def _together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def differences(rows: DataFrame, kinds: dict[int, tuple[str | Column, str | Column]]) -> DataFrame:
    """The digests that only one of two columns has: ``_row``, ``_kind``, ``_digest``, and ``_side``, 1 or 2.

    ``rows`` are staged: ``_row`` is unique, the columns in ``kinds`` are arrays of distinct digests, by name or made of
    columns of ``rows`` after these are dealt.
    """
    found = _together(_settled(rows, kinds, True)).filter("_cell < 0")
    return found.select("_row", "_kind", "_digest", (-F.col("_cell")).cast("int").alias("_side"))


def difference_sizes(rows: DataFrame, kinds: dict[int, tuple[str | Column, str | Column]]) -> DataFrame:
    """How many digests only the first or second of two columns has: ``_row``, ``_kind``, ``_first``, ``_second``; no row for none."""
    return _together(_settled(rows, kinds, False)).select("_row", "_kind", "_first", "_second")


def _fingerprint(kind: int) -> Column:
    """The cells of one kind in order, as text."""
    cell = F.struct("_cell", "_count", "_key", "_check")
    cells = F.array_sort(F.collect_list(F.when(F.col("_kind") == kind, cell)))
    written = lambda c: F.concat_ws(":", c["_cell"], c["_count"], F.lower(F.hex(c["_key"])), F.lower(F.hex(c["_check"])))
    return F.array_join(F.transform(cells, written), " ")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: the key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last quarter replaced by the beginning of the next row's text (``with_next``). Likeness
    is the share of the distinct paragraphs of both texts that both have, from the digests that peeling recovers; two
    texts without any (empty ones) are alike, 1. A text without paragraphs has the fingerprint "". Repeated rows give
    repeated rows; an empty table gives an empty one.
    """
    quarter = "length(_text) div 4"
    edited = F.concat(F.expr(f"substring(_text, 1, length(_text) - {quarter})"), F.expr(f"substring(_next, 1, cast({quarter} AS int))"))
    rows = stage(
        with_next(docs, text, key)
        .withColumn("_edited", edited)
        .select(
            F.monotonically_increasing_id().alias("_row"),
            F.col("_key").alias(key),
            F.length("_text").cast("bigint").alias("n_chars"),
            F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
            digests(F.col("_text")).alias("_a"),
            digests(F.col("_edited")).alias("_b"),
            digests(F.col("_next")).alias("_c"),
        )
        .withColumn("_start", shared_start(F.col("_a"), F.col("_b")))
        .withColumn("_b", F.expr("slice(_b, _start + 1, size(_b))")),
        "versions",
    )
    # An edited text begins as the text does, so only the rest of its digests is stored and dealt.
    edited_digests = F.concat(F.expr("slice(_a, 1, _start)"), F.col("_b"))
    settled = difference_sizes(rows, {0: ("_a", edited_digests), 1: ("_a", "_c")})
    which = lambda name, kind: F.coalesce(F.max(F.when(F.col("_kind") == kind, F.col(name))), F.lit(0)).alias(f"{name}{kind}")
    sides = settled.groupBy("_row").agg(*(which(name, kind) for name in ("_first", "_second") for kind in (0, 1)))

    dealt = rows.repartition(_parts(rows), "_row")
    versions = [
        F.struct(F.lit(kind).alias("_kind"), F.lit(WIDTH).cast("bigint").alias("_width"), side.alias("_a"), F.expr("cast(array() AS array<bigint>)").alias("_b"))
        for kind, side in enumerate((F.col("_a"), edited_digests))
    ]
    prints = subtracted(dealt.select("_row", F.inline(F.array(*versions)))).groupBy("_row")
    prints = prints.agg(_fingerprint(0).alias("fingerprint"), _fingerprint(1).alias("edited_fingerprint"))

    def likeness(kind: int) -> Column:
        first, second = (F.coalesce(f"_{side}{kind}", F.lit(0)) for side in ("first", "second"))
        union = F.size("_a") + second
        return F.when(union == 0, F.lit(1.0)).otherwise((F.size("_a") - first) / union)

    joined = dealt.join(prints, "_row", "left").join(sides, "_row", "left")
    return joined.select(
        key,
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness(0).alias("near_edited"),
        likeness(1).alias("near_next"),
    )
