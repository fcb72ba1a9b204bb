"""Files as DataFrames: JSON messages, file listings and raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.constants import ENVELOPE_COLUMNS, ENVELOPE_SCHEMA

#: Older than any file, so that a stream skips none.
ANY_AGE = "1000000d"

#: The column of a table with lineage that names the file of each row.
SOURCE_FILE = "source_file"


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON with an inferred schema: one extra pass, base64 left as text."""
    return spark.read.json(path)


def read_messages(spark: SparkSession, path: str, schema: str = ENVELOPE_SCHEMA) -> DataFrame:
    """JSON messages with the fixed schema; BINARY columns are decoded from base64."""
    return spark.read.schema(schema).json(path)


def stream_messages(
    spark: SparkSession,
    path: str,
    schema: str = ENVELOPE_SCHEMA,
    files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """JSON messages as a stream, each file read once.

    `files_per_batch` bounds a micro-batch, so a large backlog is worked off in steps. Files
    older than the newest by more than `max_file_age` are skipped; by default none are, for
    which the driver remembers the name of every file it has read.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def message_columns(messages: DataFrame) -> DataFrame:
    """The envelope columns in their declared order, whatever order the source has."""
    return messages.select(*ENVELOPE_COLUMNS)


def query_files(
    spark: SparkSession, columns: str, path: str, file_format: str = "json", tail: str = ""
) -> DataFrame:
    """SQL straight over files; `tail` is any WHERE, GROUP BY or ORDER BY that follows."""
    return spark.sql(f"SELECT {columns} FROM {file_format}.`{path}` {tail}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of every file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def with_lineage(messages: DataFrame) -> DataFrame:
    """Rows read from files, in batch or as a stream, with the file each came from."""
    return messages.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def landing_status(spark: SparkSession, path: str, bronze: DataFrame) -> DataFrame:
    """Every file landed in a folder, its size, and the rows of it that a table with lineage has.

    `rows` is NULL for a file that is still to be ingested. File names are counted before they
    are joined; contents of files are not read.
    """
    landed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("landed_at"),
        )
    )
    ingested = bronze.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"))
    return landed.join(ingested, SOURCE_FILE, "left")


def pending_files(spark: SparkSession, path: str, bronze: DataFrame) -> DataFrame:
    """Files that have landed but of which the table has no row yet.

    A file without any row looks pending for ever; it has nothing to ingest.
    """
    return landing_status(spark, path, bronze).where("rows IS NULL").drop("rows")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """How many files have landed, their total size and the newest one's time."""
    return list_files(spark, path).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
    )


def preview_text(spark: SparkSession, path: str, lines: int = 20) -> DataFrame:
    """The first few lines as they are, for looking at an unknown file."""
    return spark.read.text(path).limit(lines)
