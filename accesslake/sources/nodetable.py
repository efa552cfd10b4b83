"""Raw lines of all nodes as one catalog table, one partition a node.

Each node's folder is a partition with a location of its own, so a folder
need not lie below the table's or carry the node in its name.  Folders named
``node=<n>`` below the table's location are found by ``recover_nodes``.  A
filter on ``node`` reads the folders of those nodes alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import sql_string
from ..session import make_folder


def _name(table: str) -> str:
    if not re.fullmatch(r"\w+(?:\.\w+){0,2}", table):
        raise ValueError(f"not a table name: {table!r}")
    return table


def create_node_table(spark: SparkSession, table: str, location: str, folders: dict[str, str] | None = None) -> None:
    """Create the table if it is not there, then add ``folders`` (node to location) and those below ``location``."""
    make_folder(spark, location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(table)} (value STRING, node STRING) USING text PARTITIONED BY (node)"
              f" LOCATION {sql_string(location)}")
    for node, folder in (folders or {}).items():
        add_node(spark, table, node, folder)
    recover_nodes(spark, table)


def add_node(spark: SparkSession, table: str, node: str, location: str) -> None:
    """Add one node's folder; a node that the table has already is pointed to the folder."""
    part = f"PARTITION (node = {sql_string(node)})"
    spark.sql(f"ALTER TABLE {_name(table)} ADD IF NOT EXISTS {part} LOCATION {sql_string(location)}")
    spark.sql(f"ALTER TABLE {_name(table)} {part} SET LOCATION {sql_string(location)}")


def recover_nodes(spark: SparkSession, table: str) -> None:
    """Take in folders that appeared below the table's location, and new files of known folders."""
    try:
        spark.sql(f"ALTER TABLE {_name(table)} RECOVER PARTITIONS")
    finally:
        spark.catalog.refreshTable(table)


def node_lines(spark: SparkSession, table: str, *nodes: str) -> DataFrame:
    """``(node, file_path, value)`` of the table's lines, of ``nodes`` alone if any are given."""
    rows = spark.table(_name(table))
    if nodes:
        rows = rows.where(F.col("node").isin(list(nodes)))
    return rows.select("node", F.col("_metadata.file_path").alias("file_path"), "value")
