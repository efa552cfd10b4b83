"""K4, A1, A2: summaries kept up to date batch by batch.

The node summary is a sum over lines, so a batch's own summary is a partial
sum: it is written beside the others and the summary is their sum.  No line is
read again when a batch arrives.  A batch writes its own folder, whole, so a
replay replaces its partial sums instead of adding them twice.

``compact`` adds the partial sums of old batches up once; a record says up to
which batch a compaction goes, and readers take the newest recorded one and the
batches after it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqlchain

SUMMARY_KEYS = ("date", "node", "http_method", "status", "user_type", "request_type", "client_request", "user_agent", "client_ip")
PARTS = ", ".join(f"{k} {'date' if k == 'date' else 'string'}" for k in SUMMARY_KEYS) + ", bytes long, transactions long"


def merged(parts: DataFrame) -> DataFrame:
    """One summary from partial ones (any number, of any lines)."""
    return parts.groupBy(*SUMMARY_KEYS).agg(F.sum("bytes").alias("bytes"), F.sum("transactions").alias("transactions"))


class KeptSummary:
    """The node summary of all batches appended at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}").parquet(f"{self.path}/{folder}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def compacted(self) -> int:
        """The last batch that a recorded compaction covers (-1: none)."""
        last = self._read("records", "upto long").agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def append(self, detail: DataFrame, batch_id: int, rule_sets: dict | None = None) -> None:
        """Add a batch of detail lines; the same batch again replaces its earlier sums.

        Batches are numbered upwards from 0; one that a compaction covers is final.
        """
        if batch_id > self.compacted():
            part = sqlchain.node_summary(detail, rule_sets).select(*SUMMARY_KEYS, "bytes", "transactions")
            part.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/parts/batch={int(batch_id)}")

    def parts(self) -> DataFrame:
        """All partial sums that count: the newest compaction and the batches after it."""
        upto = self.compacted()
        later = self._read("parts", PARTS + ", batch long").where(F.col("batch") > upto).drop("batch")
        return later.unionByName(self._read("merged", PARTS + ", upto long").where(F.col("upto") == upto).drop("upto"))

    def read(self) -> DataFrame:
        return merged(self.parts())

    def rollup(self) -> DataFrame:
        """A2 from the partial sums."""
        return sqlchain.all_node_rollup(self.read())

    def compact(self, upto: int) -> None:
        """Add up the partial sums of batches up to and including ``upto``."""
        if upto <= self.compacted():
            return
        old = self.compacted()
        parts = self._read("parts", PARTS + ", batch long").where((F.col("batch") > old) & (F.col("batch") <= upto)).drop("batch")
        parts = parts.unionByName(self._read("merged", PARTS + ", upto long").where(F.col("upto") == old).drop("upto"))
        merged(parts).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/merged/upto={int(upto)}")
        self.spark.createDataFrame([(int(upto),)], "upto long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/records/upto-{int(upto)}")
