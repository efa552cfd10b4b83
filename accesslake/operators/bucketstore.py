"""The event store as a bucketed table with a record of committed batches.

Rows are partitioned by month and bucketed by their hash, so the anti-join of
a batch with the store, and the reader's de-duplication, take the stored side
as it lies: only the batch is shuffled.

Every row carries its writer and batch.  A batch counts once its record is
written, after its rows; rows of a batch without a record are not read, so a
writer that dies leaves nothing visible and repeats the batch under the same
name.  Writers do not wait for each other: two of them can append the same
line at once.  Readers see the copy of the smallest (writer, batch), so the
line is one row whoever wrote it.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import make_folder
from .rules import sql_string
from .sinks import STORE_KEYS, batch_months, dedupe_by_hash

RECORDS = "writer string, batch long"
#: Records that are broadcast: some 10 MB.
FEW_RECORDS = 200_000


class BucketStore:
    """A store at ``path``; ``buckets`` (the session's shuffle partitions unless given) is fixed when it is created.

    Each writer has a folder of its own, so writers never share the commit of
    a job; the folders are partitions of one table.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows, self.records = f"{self.path}/rows", f"{self.path}/records"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "event_store_" + hashlib.md5(self.path.encode()).hexdigest()[:16]

    def _create(self, table: str, schema, partitions: tuple[str, ...], location: str) -> None:
        make_folder(self.spark, location)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in ("event_month", "store_writer"))
        named = ", ".join(f"{p} STRING" for p in partitions)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {named}) USING parquet PARTITIONED BY ({', '.join(partitions)})"
                       f" CLUSTERED BY (event_hash) INTO {self.buckets} BUCKETS LOCATION {sql_string(location)}")

    def _open(self) -> bool:
        """Make the catalog know the table with all its folders; False if nothing is stored yet."""
        if not self.spark.catalog.tableExists(self.table):
            try:
                schema = self.spark.read.parquet(self.rows).schema
            except AnalysisException as e:
                if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                return False
            self._create(self.table, schema, ("store_writer", "event_month"), self.rows)
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.table)
        return True

    def committed(self) -> DataFrame:
        """The records: one row for each batch that counts."""
        try:
            return self.spark.read.schema(RECORDS).parquet(f"{self.records}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RECORDS)

    def _visible(self, rows: DataFrame) -> DataFrame:
        good = self.committed()
        if good.count() <= FEW_RECORDS:  # one row a batch; beyond that Spark chooses the join
            good = F.broadcast(good)
        return rows.join(good, (rows["store_writer"] == good["writer"]) & (rows["store_batch"] == good["batch"]), "left_semi")

    def _held(self, batch: DataFrame) -> DataFrame:
        """Keys (_m, _h) of the committed rows in the months of ``batch``."""
        months = batch_months(batch)  # the batch's few months: only their folders are read
        known = F.col("event_month").isin([m for m in months if m is not None])
        held = self.spark.table(self.table).where(F.coalesce(known, F.lit(False)) | F.col("event_month").isNull() if None in months else known)
        return self._visible(held).select(F.col("event_month").alias("_m"), F.col("event_hash").alias("_h"))

    @staticmethod
    def _without(rows: DataFrame, held: DataFrame) -> DataFrame:
        # the hash alone is the join's key, as the buckets are: the months are compared beside it
        a, b = (F.coalesce(c, F.lit("")) for c in (rows["event_month"], held["_m"]))
        return rows.join(held, (rows["event_hash"] == held["_h"]) & (F.greatest(a, b) == F.least(a, b)), "left_anti")

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` that no committed batch holds, each once, dealt by hash as the buckets are.

        The keys are looked up first, so that a batch that brings nothing new
        costs their shuffle alone.  Whole rows are shuffled once: the join with
        the stored keys, the de-duplication and the write take them as they lie.
        """
        rows = batch.withColumn("event_month", F.col("event_month").cast("string"))
        if not self._open():
            return dedupe_by_hash(rows.repartition(self.buckets, "event_hash"))
        held = self._held(batch)
        if self._without(rows.select(*STORE_KEYS).distinct(), held).isEmpty():
            return rows.limit(0)
        return dedupe_by_hash(self._without(rows.repartition(self.buckets, "event_hash"), held))

    def append(self, batch: DataFrame, writer: str, batch_id: int, stored: bool = False) -> bool:
        """Add the rows of a batch; False if its record is there already (a replay adds nothing).

        The batch is evaluated once: it is persisted for the months, the
        anti-join and the write, unless it is ``stored`` (a stored table, or
        persisted).  A writer's batches follow one another.
        """
        if not re.fullmatch(r"[\w-]+", writer):
            raise ValueError(f"not a writer's name: {writer!r}")
        if not self.committed().where((F.col("writer") == writer) & (F.col("batch") == int(batch_id))).isEmpty():
            return False
        if not stored:
            batch = batch.persist()
        try:
            rows = self.new_rows(batch).withColumn("store_batch", F.lit(int(batch_id)).cast("long"))
            own = f"{self.table}_{hashlib.md5(writer.encode()).hexdigest()[:8]}"
            self._create(own, rows.schema, ("event_month",), f"{self.rows}/store_writer={writer}")
            columns = self.spark.table(own).columns
            rows.select(*columns).write.mode("append").insertInto(own)
            record = self.spark.createDataFrame([(writer, int(batch_id))], RECORDS)
            record.coalesce(1).write.mode("overwrite").parquet(f"{self.records}/{writer}-{int(batch_id)}")
        finally:
            if not stored:
                batch.unpersist()
        return True

    def read(self) -> DataFrame:
        """Every line of the committed batches once."""
        if not self._open():
            raise FileNotFoundError(self.rows)
        rows = self._visible(self.spark.table(self.table))
        first = Window.partitionBy(*STORE_KEYS).orderBy("store_writer", "store_batch")
        return rows.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy", "store_writer", "store_batch")
