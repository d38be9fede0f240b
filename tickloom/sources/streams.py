"""Streaming sources. Anything with a ``value`` column can feed the message parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import CSV_TICK


def kafka_options(
    brokers: str,
    topic: str,
    max_offsets_per_trigger: int = 1000,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
    }


def kafka_source(spark: SparkSession, brokers: str, topic: str, **options) -> DataFrame:
    """Needs the Spark Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **options)).load()
    return text_messages(raw)


def text_messages(stream: DataFrame) -> DataFrame:
    return stream.withColumn("value", F.col("value").cast("string"))


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON messages, one per line, from a folder of text files."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def parquet_stream(
    spark: SparkSession, folder: str, schema: str, glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def csv_tick_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ticker prices from CSV files with a header; the time text becomes a timestamp."""
    reader = spark.readStream.schema(CSV_TICK).option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path).withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
