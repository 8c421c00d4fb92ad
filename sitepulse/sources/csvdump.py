"""Database dumps as (gzip) CSV: NULL as ``\\N``, quotes escaped by a backslash."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from sitepulse.session import observed, shared_dir, stage
from sitepulse.sources import release, schemas

# Bad rows a load tolerates, rows per output file.
MAX_BAD_RECORDS = 10
ROWS_PER_FILE = 8_000_000
# Columns that identify a row of either table.
IDENTITIES = {
    "summary_pages": ("label", "urlShort"),
    "summary_requests": ("startedDateTime", "pageid", "urlShort"),
}

_CORRUPT = "_corrupt_record"


class TooManyBadRows(ValueError):
    """More rows do not fit the schema than a load tolerates."""


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a dump as text, column ``value``.

    A backslash before a line break continues the row, in any field; the break reads as a comma and a
    blank. Plain files are read in blocks by many tasks, and rows that cross a block are put together. Only lines
    that are part of a continued row are sorted and joined; the others pass as they are.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),  # rises with the lines of a block
        F.col("value").endswith("\\").alias("open"),
        "value",
    )
    lines = stage(lines, "csv-lines")
    # Where a block's last line goes on: the first line of the file's next block that has any.
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("_first"), F.max("id").alias("_last"))
    ahead = F.lead("_first").over(Window.partitionBy("file").orderBy("block"))
    blocks = blocks.select("file", "block", "_last", ahead.alias("_ahead"))
    opened = lines.where("open").select("file", "block", "id").join(blocks, ["file", "block"])
    follows = opened.select(F.when(F.col("id") < F.col("_last"), F.col("id") + 1).otherwise(F.col("_ahead")).alias("id")).dropna()
    marks = opened.select("id", F.lit(True).alias("open"), F.lit(False).alias("late"))
    marks = marks.unionAll(follows.select("id", F.lit(False), F.lit(True)))
    parts = stage(marks.groupBy("id").agg(F.max("open").alias("open"), F.max("late").alias("late")), "csv-parts")

    alone = lines.join(parts, "id", "left_anti").select("value")
    text = F.when(parts["open"], F.concat(F.expr("left(value, length(value) - 1)"), F.lit(", "))).otherwise(F.col("value"))
    pieces = lines.select("file", "block", "id", "value").join(parts, "id").withColumn("text", text)
    # A row is numbered by the rows that begin up to it: those of the blocks before, and those inside its own.
    begins = F.count_if(~F.col("late"))
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("file", "block").agg(begins.alias("_n"))
    totals = totals.select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = pieces.withColumn("_inside", begins.over(inside)).join(totals, ["file", "block"])
    rows = numbered.groupBy("file", (F.col("_before") + F.col("_inside")).alias("_row")).agg(
        F.array_sort(F.collect_list(F.struct("block", "id", "text"))).alias("_texts")
    )
    return alone.unionByName(rows.select(F.array_join("_texts.text", "").alias("value")))


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows as text columns, plus ``_corrupt_record`` for rows of the wrong width, and the row as ``_line``."""
    names = [T.StructField(field.name, T.StringType()) for field in schema]
    wide = T.StructType([*names, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": "\\", "nullValue": "\\N"}
    rows = read_records(spark, path).where(F.col("value") != "")
    parsed = F.from_csv("value", F.lit(wide.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), options)
    return rows.select(F.col("value").alias("_line"), parsed.alias("_r")).select("_line", "_r.*")


def _typed(name: str, dtype: T.DataType) -> Column:
    """A text column in its own type: missing text is empty, a missing number is NULL."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.col(name), F.lit(""))
    return F.nullif(F.trim(F.col(name)), F.lit("")).try_cast(dtype)


def _is_bad(schema: T.StructType) -> Column:
    bad = F.col(_CORRUPT).isNotNull()
    for field in schema:
        if not isinstance(field.dataType, T.StringType):
            given = F.nullif(F.trim(F.col(field.name)), F.lit("")).isNotNull()
            bad = bad | (given & _typed(field.name, field.dataType).isNull())
    return bad


def rejects_path(spark: SparkSession) -> str:
    """Where bad rows go that no other folder is named for: columns ``source`` (the dump) and ``line``."""
    return f"{shared_dir(spark)}/sitepulse/csv-rejects"


def load_dump(
    spark: SparkSession, path: str, schema: T.StructType, max_bad: int = MAX_BAD_RECORDS, rejects: str | None = None
) -> DataFrame:
    """Rows of a dump in their own types; refuses a dump with too many bad rows.

    Bad rows are appended as text below ``rejects`` in any case, by default in ``csv-rejects`` of the shared folder. The
    dump is read once, into the shared folder; the check and the result parse that.
    """
    rows = read_dump(spark, path, schema)
    rejects = rejects or rejects_path(spark)
    bad = rows.where(_is_bad(schema)).select(F.lit(path).alias("source"), F.col("_line").alias("line"))
    seen = Observation("csv dump")
    bad.observe(seen, F.count(F.lit(1)).alias("bad")).write.mode("append").parquet(rejects)
    if observed(seen).get("bad", 0) > max_bad:
        raise TooManyBadRows(f"{path}: more than {max_bad} bad rows")
    return rows.where(~_is_bad(schema)).select(*[_typed(f.name, f.dataType).alias(f.name) for f in schema])


def write_partition(
    rows: DataFrame, path: str, date: Column, client: Column, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write rows as one (date, client) partition, replacing it by default; files are split by rows."""
    (
        rows.withColumns({"date": date, "client": client})
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("date", "client")
        .parquet(path)
    )


def has_partition(spark: SparkSession, path: str, archive: str) -> bool:
    """Whether the table already holds the crawl of an archive."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    wanted = (F.col("date") == release.archive_date(F.lit(archive))) & (
        F.col("client") == release.archive_client(F.lit(archive))
    )
    return not table.where(wanted).isEmpty()


def load_archive(
    spark: SparkSession, archive: str, pages_csv: str, requests_csv: str, target: str, unique: bool = False
) -> dict[str, bool]:
    """Load both dumps of an archive such as ``mobile_Dec_15_2018`` below ``target``.

    A table that already holds the crawl is left alone; ``unique`` keeps one row per identity, the lowest id.
    Bad rows go to ``target/rejects``. Returns which tables were loaded.
    """
    loaded = {}
    for name, source, schema in (
        ("summary_pages", pages_csv, schemas.SUMMARY_PAGES),
        ("summary_requests", requests_csv, schemas.SUMMARY_REQUESTS),
    ):
        path = f"{target}/{name}"
        loaded[name] = not has_partition(spark, path, archive)
        if loaded[name]:
            rows = load_dump(spark, source, schema, rejects=f"{target}/rejects")
            rows = first_of_each(rows, IDENTITIES[name], schema[0].name) if unique else rows
            write_partition(
                rows, path, release.archive_date(F.lit(archive)), release.archive_client(F.lit(archive))
            )
    return loaded


def write_slices(rows: DataFrame, path: str, by: tuple[str, ...], replace: bool = False) -> None:
    """Append rows to a partitioned table, or replace exactly the partitions that ``rows`` holds."""
    (
        rows.write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def first_of_each(rows: DataFrame, identity: tuple[str, ...], *order: str) -> DataFrame:
    """One row per identity, the lowest by ``order``; of rows that share it one is taken. NULLs are an identity.

    A pruned rank: every task keeps only its lowest row of each identity before the one shuffle, so an identity that
    holds most rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*identity).orderBy(*order))
    return rows.withColumn("_first_of_each", rank).where("_first_of_each = 1").drop("_first_of_each")
