"""What the operators of this package share: text classes, let-bindings, stored tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import run_dir

# The white space of the word contract, as characters and as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# Whole texts travel to Python in batches of this many rows; long texts then stay within memory.
BATCH_ROWS = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null and for white space alone."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return let(
        trimmed,
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)),
    )


def count_words(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return let(
        trimmed,
        lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RUN))),
    ).cast("long")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows per Arrow batch of this session, so that batches of long texts fit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later reads survive lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: Column, parts: int) -> Column:
    """Fold number of a document: crc32 of the id as text, modulo ``parts``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def hash_order(doc_id: Column, seed: str) -> Column:
    """A pseudo-random order of documents that does not depend on where the rows lie."""
    return F.xxhash64(F.lit(seed), doc_id)


def balanced_sample(rows: DataFrame, label: str, per_class: int, seed: str) -> DataFrame:
    """At most ``per_class`` rows of each label, in hash order of their doc_id; null labels are left out.

    Labels are counted first, so that all but about twice the wanted rows are filtered where they lie;
    the window then ranks a bounded number of rows, however many one label has.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect()}
    order = hash_order(F.col("doc_id"), seed)
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == value, F.lit(min(1.0, 2.0 * per_class / n + 50.0 / n))).otherwise(share)
    drawn = F.pmod(F.shiftright(order, 20), F.lit(1 << 20)) < share * float(1 << 20)
    ranked = Window.partitionBy(label).orderBy(order, "doc_id")
    return rows.where(drawn).withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= per_class).drop("place")


def shipped(spark: SparkSession, value):
    """A function that returns ``value`` inside a task; sent once per executor, by value."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)
