"""Saved tables and views as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsemart.sources.files import ANY_AGE


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stream_table(
    spark: SparkSession,
    name: str,
    files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """New rows of a table as a stream; the options are those of `files.stream_messages`."""
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.table(name)


def query_view(df: DataFrame, view: str, statement: str) -> DataFrame:
    """Name a DataFrame as a temporary view and run SQL over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)
