"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.session import checkpoint_dir

#: Fixed value: the word separators of every contract, the six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
#: The same as a Java regular expression for ``split`` and ``regexp_replace``.
BLANK_RE = r"[\x20\x09-\x0D]+"
#: Fixed value: upper- and lower-case letters for an ASCII-only ``translate``.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but columnar, compressed and with
    column pruning; survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/wayfarer-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in Arrow batches of at most 1,000 rows, unless the session asks for
    another number than Spark's default: a worker's memory follows the texts of one batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the non-blank runs of ``text`` (null or blank text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RE), lambda w: w != "")


def text_key(text: Column) -> Column:
    """Identity of a whole text as a small struct: two independent hashes and the length."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.hash(t).alias("b"), F.length(t).alias("n"))
