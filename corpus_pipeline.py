"""From raw documents to packed training sequences, one operator a stage.

Each stage reads all that the one before kept, from Parquet in the shared
folder: quality classifier, line dedup, near-dedup, benchmark
decontamination, packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.llm import curvepack, decontam, lines, neardup, quality
from accesslake.llm.common import stored


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~quality.held_out(F.col("doc_id")))
    row = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    scored = quality.score(row, quality.fit(docs, known), ("row",))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, exactly or nearly, go; n_chars follows the text."""
    return lines.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.keep_one(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 ids."""
    import public_tokenizers

    return curvepack.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", classify), ("lines", dedup_lines), ("near_duplicates", dedup_documents),
          ("decontamination", decontaminate), ("packing", pack)]

#: Trained weights, signatures and tokenizers have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
