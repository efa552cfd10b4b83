"""Address ranges to disjoint segments, and rows located in them by one sorted merge.

``flatten_ranges`` sweeps each cell of the address space: cells are cut at
quantiles of the range starts, a range goes to the cells in which it starts or
ends, and of the ranges that cover a whole cell only the best one does.

``locate`` merges rows and segments in order of address: rows are dealt to
buckets of neighbouring segments, a segment that crosses a border goes to both
sides, and in each bucket the last segment start at or before an address is
carried along.  Rows are read once and shuffled once.  A bucket is split over
as many tasks as the session has to spare, each with the bucket's segments, so
one hot address does not meet in one task.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sinks import materialize

PLACE = ("country", "region", "city", "lat", "lon")
#: Ranges that one task sweeps, about; and the most cells.
CELL_RANGES, MAX_CELLS = 50_000, 256
#: Segments of one bucket: what one task sorts beside its rows.
BUCKET_SEGMENTS = 200_000
_SEGMENT = "seg_start long, seg_end long, country string, region string, city string, lat double, lon double"


def _cell(address: F.Column, bounds: list[int]) -> F.Column:
    """The number of bounds at or below the address (null: 0)."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.coalesce(F.size(F.filter(cuts, lambda b: b <= address)), F.lit(0))


def _bounds(df: DataFrame, column: str, cells: int) -> list[int]:
    if cells <= 1:
        return []
    cut = df.approxQuantile(column, [i / cells for i in range(1, cells)], 0.2 / cells)
    return sorted({int(c) for c in cut})


def _sweep(key: tuple, ranges: pd.DataFrame) -> pd.DataFrame:
    """Disjoint segments of one cell: at every address the best range (narrowest, lowest start, smallest names)."""
    rows = ranges.astype(object).where(ranges.notna(), None).to_dict("records")
    order = sorted(rows, key=lambda r: (r["width"], r["ip_start"], *((r[c] is not None, r[c]) for c in PLACE)))
    rank = {id(r): i for i, r in enumerate(order)}
    rows.sort(key=lambda r: r["from"])
    points = sorted({r["from"] for r in rows} | {r["to"] + 1 for r in rows})
    out, active, i = [], [], 0
    for a, b in zip(points, points[1:]):
        while i < len(rows) and rows[i]["from"] == a:
            heapq.heappush(active, (rank[id(rows[i])], rows[i]["to"]))
            i += 1
        while active and active[0][1] < a:
            heapq.heappop(active)
        if active:
            r = order[active[0][0]]
            out.append((a, b - 1, *(r[c] for c in PLACE)))
    return pd.DataFrame(out, columns=["seg_start", "seg_end", *PLACE])


def flatten_ranges(ranges: DataFrame, cells: int | None = None) -> DataFrame:
    """``(seg_start, seg_end, country, region, city, lat, lon)``: disjoint segments of ranges that may overlap or nest.

    Ranges without a bound or with the end before the start are ignored;
    repeated ranges count once.  Segments are cut at the borders of cells.
    """
    r = ranges.select(F.col("ip_start").cast("long").alias("ip_start"), F.col("ip_end").cast("long").alias("ip_end"),
                      *(F.col(c).cast("double" if c in ("lat", "lon") else "string").alias(c) for c in PLACE))
    r = r.where("ip_start <= ip_end").withColumn("width", F.col("ip_end") - F.col("ip_start"))
    # of ranges with the same bounds only the best can win
    r = r.groupBy("ip_start", "ip_end", "width").agg(F.min(F.struct(*PLACE)).alias("p")).select("ip_start", "ip_end", "width", "p.*")
    bounds = _bounds(r, "ip_start", cells or min(MAX_CELLS, -(-r.count() // CELL_RANGES)))
    low = F.element_at(F.array(*[F.lit(b).cast("long") for b in [-1, *bounds]]), F.col("cell") + 1)
    high = F.element_at(F.array(*[F.lit(b).cast("long") for b in [*bounds, 1 << 40]]), F.col("cell") + 1) - 1
    met = (r.withColumn("cell", F.explode(F.sequence(_cell(F.col("ip_start"), bounds), _cell(F.col("ip_end"), bounds))))
           .withColumn("from", F.greatest("ip_start", low)).withColumn("to", F.least("ip_end", high)))
    whole = (F.col("from") == F.greatest(low, F.lit(0).cast("long"))) & (F.col("to") == high)
    keep = ["ip_start", "ip_end", "width", *PLACE, "from", "to"]
    best = met.where(whole).groupBy("cell").agg(F.min(F.struct("width", "ip_start", *PLACE, "ip_end", "from", "to")).alias("b"))
    parts = met.where(~whole).select("cell", *keep).unionByName(best.select("cell", "b.*").select("cell", *keep))
    return parts.groupBy("cell").applyInPandas(_sweep, _SEGMENT)


def locate(df: DataFrame, ip_col: str, segments: DataFrame, bucket_segments: int = BUCKET_SEGMENTS) -> DataFrame:
    """``df`` and ``__place`` (a struct of PLACE): the segment that holds ``ip_col``; null where none does."""
    spark = df.sparkSession
    segments = materialize(segments, "geo-segments", partition_by=None)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(parts, -(-segments.count() // bucket_segments))
    bounds = _bounds(segments, "seg_start", buckets)
    copies = max(1, parts // (len(bounds) + 1))
    s = segments.select(
        F.explode(F.sequence(_cell(F.col("seg_start"), bounds), _cell(F.col("seg_end"), bounds))).alias("__bucket"),
        F.col("seg_start").alias(ip_col), F.struct("seg_end", *PLACE).alias("__seg"), F.lit(0).alias("__kind"))
    s = s.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = df.withColumns({"__bucket": _cell(F.col(ip_col), bounds), "__kind": F.lit(1),
                           "__copy": F.pmod(F.monotonically_increasing_id(), F.lit(copies)).cast("int")})
    both = rows.unionByName(s, allowMissingColumns=True)
    along = Window.partitionBy("__bucket", "__copy").orderBy(ip_col, "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__last", F.last("__seg", ignorenulls=True).over(along)).where("__kind = 1")
    place = F.when(F.col(ip_col) <= F.col("__last.seg_end"), F.struct(*(F.col(f"__last.{c}").alias(c) for c in PLACE)))
    return both.withColumn("__place", place).drop("__bucket", "__copy", "__kind", "__seg", "__last")
