"""Raw log scans (S1–S4, S6–S8) and source descriptors.

``read_lines`` is a plain text scan with the file path from the hidden
``_metadata`` column.  Gzip input is decompressed by the text source by file
suffix; gzip is not splittable, so one task reads one ``.gz`` file — pass
``repartition`` to spread the rows of few, large archives before parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a source table: it is written by hand and broadcast.
MAX_SOURCES = 10_000
SOURCE_COLUMNS = ("prefix", "organization", "url_domain", "url_scheme", "dataset", "cdn_format")


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None,
               recursive: bool = True, repartition: int | None = None) -> DataFrame:
    """``(file_path, value)`` – one row per line, every file under ``path``.

    ``glob`` is a file-name filter such as ``"*.gz"`` or ``"access_log*"``
    (include-pattern file choice).
    """
    r = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("value"))
    return df.repartition(repartition) if repartition else df


def stream_lines(spark: SparkSession, path: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental scan; the query checkpoint remembers which files were read."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("value"))


def node_from_path(path_col: str = "file_path", marker: str = "logs") -> F.Column:
    """The path segment right after ``/<marker>/`` (``…/logs/<node>/…``)."""
    return F.nullif(F.regexp_extract(F.col(path_col), f"/{marker}/([^/]+)/", 1), F.lit(""))


def _path_prefixes(path_col: str) -> F.Column:
    # every directory prefix of the path (ending in "/") plus the full path
    segs = F.split(F.col(path_col), "/")
    n = F.size(segs)
    dirs = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        i < n, F.concat(F.array_join(F.slice(segs, 1, i), "/"), F.lit("/"))).otherwise(F.col(path_col)))
    return dirs


def attach_source(lines: DataFrame, sources: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Constants of the longest source prefix that the file path starts with, as ``src_*`` columns.

    Prefixes are matched at directory boundaries (a prefix ends in ``/``) or
    as the whole path; paths are compared without their URI scheme and bucket
    (``s3://bucket/``).  A path that no source covers, or none at all, gets
    nulls; of repeated prefixes the smallest row counts.

    The source table is configuration (at most ``MAX_SOURCES`` rows, checked).
    Each line finds its longest known prefix by set lookups and meets the
    broadcast table on it: lines are read once and not shuffled, however many
    of them one source has, and the same plan runs on a stream.
    """
    found = sources.select(*SOURCE_COLUMNS).where("prefix is not null").limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    by = {}
    for r in sorted(found, key=lambda r: tuple((v is not None, v) for v in r), reverse=True):
        by[r["prefix"]] = tuple(r)
    schema = ", ".join(f"src_{c} string" for c in SOURCE_COLUMNS)
    table = F.broadcast(lines.sparkSession.createDataFrame(list(by.values()), schema))
    relative = F.regexp_replace(F.col(path_col), r"^[A-Za-z0-9+.\-]+:(?://[^/]*)?/", "")
    known = F.filter(F.col("__dirs"), lambda c: c.isin(list(by)) if by else F.lit(False))
    keyed = lines.withColumn("__rel", relative).withColumn("__dirs", _path_prefixes("__rel")).withColumn("__key", F.try_element_at(known, F.lit(-1)))
    return keyed.join(table, keyed["__key"] == table["src_prefix"], "left").drop("__rel", "__dirs", "__key")


def register_node_table(spark: SparkSession, name: str, location: str, fmt: str = "text") -> DataFrame:
    """A node-partitioned table over ``<location>/node=<n>/…``.

    Partition directories are discovered from the layout; new node directories
    appear on the next read (``spark.catalog.refreshByPath`` for cached reads).
    """
    df = spark.read.format(fmt).load(location).withColumn("file_path", F.col("_metadata.file_path"))
    df.createOrReplaceTempView(name)
    return df
