"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, source mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``docs``; the last adds the
mixing columns, and keeps every document (its budget shows each source at least
once): ``n_tokens``, ``weight``, ``epochs`` and ``draws``, the positions of the
document's draws in the training order.

Where a stage changes a text, ``n_chars`` (if the table has it) follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.llm import decontam, line_dedup, mixing, quality_lines, simhash_vptree
from wayfarer.llm.common import read, stored


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return _with_length(quality_lines.clean_documents(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that spread over many sites."""
    cleaned = line_dedup.dedup_lines(docs)
    return _with_length(cleaned.select(*[
        (F.when(F.col("doc.text").isNotNull(), F.col("line_dedup.text")) if c == "text" else F.col(f"doc.`{c}`")).alias(c)
        for c in docs.columns]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash_vptree.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their draws at the target weights."""
    drawn = mixing.draw(docs, mixing.plan(docs))
    added = {"n_tokens": F.col("mix.n_tokens"), "weight": F.col("mix.weight"),
             "epochs": F.size("mix.draws").cast("long"), "draws": F.col("mix.draws")}
    return drawn.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in added],
                        *[c.alias(name) for name, c in added.items()])


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixture)]

#: Fingerprint links, template windows and mixing hashes are not expressible in DuckDB; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
