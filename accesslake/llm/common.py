"""Helpers shared by the operators: scratch tables, text columns, sizes."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows sent to a Python worker at once; bounds its memory when texts are long.
ARROW_ROWS = 2000


def tuned(spark: SparkSession) -> SparkSession:
    """Set the Arrow batch size the Python operators expect."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: an executor lost later re-reads files, and later plans
    know the table's size (Spark broadcasts it only below its own threshold).
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def free(df: DataFrame | None) -> None:
    """Delete a scratch table that ``stored`` made and nothing will read again."""
    path = getattr(df, "_scratch", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def swept(spark: SparkSession) -> None:
    """Shuffle files leave the disk when the driver collects the plans that wrote them: ask for it between turns."""
    gc.collect()
    spark._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for: the unit that grows with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, text: str = "text") -> F.Column:
    """The text column with null as the empty text."""
    return F.coalesce(df[text].cast("string"), F.lit(""))
