"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0 to 1, linear between knots. The integral of a schedule
is the source's weight; weights share the words to be mixed, and no source is repeated more than ``most`` times.
Inside a source, documents follow each other in the order of a hash, pass after pass, as long as the middle of a
document lies within the target: the running words are the source's demand, and the time at which its integrated
schedule reaches that demand is the training position. Range-sorting by position gives the training order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.llm.text import WORD
from sitepulse.session import stage

MOST = 3


@dataclass(frozen=True)
class Schedule:
    """Weight over time, linear between knots (time, weight); times rise from 0 to 1, weights are not negative."""

    knots: tuple[tuple[float, float], ...]

    def areas(self) -> list[float]:
        pairs = zip(self.knots, self.knots[1:])
        return [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in pairs]

    def weight(self) -> float:
        return sum(self.areas())

    def time_of(self, share: Column) -> Column:
        """When the integral reaches ``share`` (0 to 1) of its whole: the inverse, piece by piece."""
        found, reached = F.lit(1.0), self.weight()
        wanted = share * reached
        for ((t0, w0), (t1, w1)), area in reversed(list(zip(zip(self.knots, self.knots[1:]), self.areas()))):
            reached -= area
            rest = F.greatest(wanted - reached, F.lit(0.0))
            slope = (w1 - w0) / (t1 - t0)
            # w0 x + slope x^2 / 2 = rest, in the form that also holds for a slope of 0.
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            inside = F.when(rest > 0, F.lit(t0) + 2 * rest / (w0 + root)).otherwise(F.lit(t0))
            found = F.when(wanted < reached + area, F.least(inside, F.lit(t1))).otherwise(found)
        return found


#: Weights 5, 2 and 1: the first kind of source fades, the second is steady, the third comes in late.
SCHEDULES = (
    Schedule(((0.0, 7.5), (1.0, 2.5))),
    Schedule(((0.0, 2.0), (1.0, 2.0))),
    Schedule(((0.0, 0.5), (0.5, 0.5), (1.0, 2.5))),
)
_SOURCE = ("_no_source", "_source")


def _sized(docs: DataFrame, text: str, key: str, source: str) -> DataFrame:
    """The row as one struct, its words, its source, and its place in the order of a hash of the key."""
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("_size"),
        F.col(source).isNull().alias("_no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        order.alias("_order"),
        F.xxhash64(text).alias("_tie"),
    ).withColumn("_part", F.substring("_order", 1, 3))


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 in code point order, null last, without one task for all."""
    dealt = stage(sources.repartitionByRange(*_SOURCE).withColumn("_task", F.spark_partition_id()), "sources")
    # One row per task.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = dealt.groupBy("_task").count().select("_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_task").orderBy(*_SOURCE)) - 1
    return dealt.join(F.broadcast(tasks), "_task").withColumn("_rank", rank + F.col("_before")).drop("_task", "_before")


def targets(sources: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, most: int = MOST) -> DataFrame:
    """``sources`` (_no_source, _source, _source_size) with ``_rank`` and ``_target``, in words.

    The weights share the sum of all sizes; a target above ``most`` times its source's size stops there and the rest
    is shared anew among the others, until none is above. Each round is one small aggregate.
    """
    weight = F.lit(schedules[-1].weight())
    for i, schedule in enumerate(schedules[:-1]):
        weight = F.when(F.col("_rank") % len(schedules) == i, F.lit(schedule.weight())).otherwise(weight)
    ranked = stage(_ranked(sources).withColumn("_weight", weight), "ranked-sources")
    words = F.coalesce(F.sum("_source_size"), F.lit(0)).cast("double")
    total, weights = ranked.agg(words, F.coalesce(F.sum("_weight"), F.lit(0.0))).first()
    full, rest, shared = F.col("_source_size") * most, total, weights
    while shared:
        above = full < rest * F.col("_weight") / shared
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(above, full)), F.lit(0)).cast("double"),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if total - capped == rest and free == shared:
            break
        rest, shared = total - capped, free
    share = rest * F.col("_weight") / shared if shared else full.cast("double")
    return ranked.withColumn("_target", F.least(full.cast("double"), share)).drop("_weight")


def placed(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    schedules: tuple[Schedule, ...] = SCHEDULES,
    most: int = MOST,
    whole: bool = False,
) -> DataFrame:
    """Per row: the key (or with ``whole`` the row, as ``_row``), _size, _source_size, _target and ``_positions``.

    ``_positions`` has a training position between 0 and 1 for each time the mix takes the document, at most
    ``most``; an empty array leaves it out. Words are counted over whole texts; null and empty texts have none and take
    part without effect on the targets. A null source is a source of its own, the last. Rows that repeat a key
    follow each other by text and then size; equal rows are interchangeable. The order inside a source is computed in
    4,096 parts of it, so a source of any share of all rows is spread over the tasks.
    """
    sized = _sized(docs, text, key, source)
    if not whole:
        sized = sized.withColumn("_row", F.col("_row")[key])
    parts = stage(sized.groupBy(*_SOURCE, "_part").agg(F.sum("_size").alias("_words")), "parts")
    found = targets(parts.groupBy(*_SOURCE).agg(F.sum("_words").alias("_source_size")), schedules, most)
    earlier = Window.partitionBy(*_SOURCE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_offset", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    offsets = offsets.join(found, list(_SOURCE))
    inside = (
        Window.partitionBy(*_SOURCE, "_part")
        .orderBy("_order", "_tie", "_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at = sized.withColumn("_at", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(offsets, [*_SOURCE, "_part"])
    at = at.withColumn("_at", F.col("_at") + F.col("_offset"))

    def position(copy: int) -> Column:
        twice = 2 * (F.lit(copy) * F.col("_source_size") + F.col("_at")) + F.col("_size")
        share = twice / (2 * F.col("_target"))
        time = schedules[-1].time_of(share)
        for i, schedule in enumerate(schedules[:-1]):
            time = F.when(F.col("_rank") % len(schedules) == i, schedule.time_of(share)).otherwise(time)
        return F.when(twice < 2 * F.col("_target"), time)

    positions = F.array_compact(F.array(*(position(copy) for copy in range(most))))
    return at.select("_row", "_size", "_source_size", "_target", positions.alias("_positions"), "_order")


def report(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """Per row: the key, ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes."""
    return placed(docs, key=key, **how).select(
        F.col("_row").alias(key),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.size("_positions")).cast("bigint").alias("taken"),
    )


def training_order(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, range-sorted by training position."""
    rows = placed(docs, whole=True, **how).withColumn("_position", F.explode("_positions"))
    return rows.select("_row", "_position", "_order").repartitionByRange("_position", "_order").sortWithinPartitions(
        "_position", "_order"
    ).select("_row.*")


#: The check: the same sharing in closed form, by sources in the order in which they reach their limit.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source
), filling AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(3 * source_size) OVER before, 0)::DOUBLE AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS shared,
    row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), settled AS (
  SELECT rest, shared FROM filling WHERE 3 * source_size >= rest * weight / shared ORDER BY k LIMIT 1
), aimed AS (
  SELECT source, source_size,
    least((3 * source_size)::DOUBLE, coalesce((SELECT rest FROM settled) * weight / (SELECT shared FROM settled),
      (3 * source_size)::DOUBLE)) AS target
  FROM sources
), placed AS (
  SELECT sized.doc_id, sized.size, aimed.source_size, aimed.target,
    CAST(coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier
  FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * ((2 * earlier + size < 2 * target)::INT + (2 * (source_size + earlier) + size < 2 * target)::INT
    + (2 * (2 * source_size + earlier) + size < 2 * target)::INT) AS BIGINT) AS taken
FROM placed
"""
