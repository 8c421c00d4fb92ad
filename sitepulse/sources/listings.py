"""Ranked domains, directory listings, rule lists and plain table files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_ENTRY = "_about string, `d:Title` string, `d:Description` string, topic string"


def read_ranked_domains(spark: SparkSession, path: str) -> DataFrame:
    """``rank,domain`` lines: columns ``alexa_rank, alexa_domain``."""
    return spark.read.schema("alexa_rank bigint, alexa_domain string").csv(path)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a directory dump in document order: ``position, url, title, description, topic``.

    The dump is cut at the closing tags, so a large file is read by many tasks, and each entry is
    parsed on its own. ``position`` orders entries by file, then by place in the file.
    """
    pieces = spark.read.option("lineSep", "</ExternalPage>").text(path)
    found = F.regexp_extract("value", r"(?s)(<ExternalPage\b.*)$", 1)
    entries = (
        pieces.select(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("position"),
            found.alias("_element"),
        )
        .where(F.col("_element") != "")
        .withColumn("_e", F.from_xml(F.concat("_element", F.lit("</ExternalPage>")), _ENTRY))
    )

    def text(name: str):
        # A missing element reads as an empty text.
        return F.coalesce(F.col("_e").getField(name), F.lit(""))

    return entries.select(
        "position",
        F.col("_e._about").alias("url"),
        text("d:Title").alias("title"),
        text("d:Description").alias("description"),
        F.col("_e.topic").alias("topic"),
    )


def read_rule_lists(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Lines of several rule lists: ``list, priority, line``; earlier lists take precedence."""
    result = None
    for priority, (name, path) in enumerate(paths.items()):
        lines = spark.read.text(path).select(
            F.lit(name).alias("list"), F.lit(priority).alias("priority"), F.col("value").alias("line")
        )
        result = lines if result is None else result.unionByName(lines)
    return result


def write_json_lines(rows: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Gzip files of one JSON document per row, NULL members included, split by rows if asked."""
    writer = rows.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False)
    writer.option("maxRecordsPerFile", rows_per_file).json(path)


def load_json_lines(spark: SparkSession, source: str, target: str, schema: T.StructType | str) -> DataFrame:
    """Load JSON lines into a columnar table of a declared schema."""
    spark.read.schema(schema).json(source).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_shards(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """All table shards in folders ``root/<prefix><suffix>``, with the ``suffix`` of each row."""
    name = F.regexp_extract("_metadata.file_path", rf"/{prefix}([^/]+)/[^/]+$", 1)
    return spark.read.parquet(f"{root}/{prefix}*").select("*", name.alias("suffix"))


def write_dates(dates: DataFrame, path: str) -> None:
    """A short list of dates as CSV without a header, in the given order."""
    dates.coalesce(1).write.mode("overwrite").csv(path)
