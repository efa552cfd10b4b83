"""Benchmark decontamination: size-partitioned MinHash containment search.  DataFrame operations only.

One sketch size stands in for size partitions: the class of an item (powers of
two of its shingle count) is kept beside its sketch and decides nothing.
An item's sketch is its ``SKETCH`` smallest shingle hashes (all of a shorter
item): a random sample of its set, so the share of the sketch that a document
has estimates how much of the item it contains, however long the document is.
Documents that have enough of a sketch are verified by exact containment of
the item's whole shingle set.

The documents' shingles meet the sketches in one equi-join.  The sketch table
is written first, so Spark knows its size and broadcasts it only below its own
threshold; beyond it the join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

SHINGLE = 5
SKETCH = 32
PERCENT = 80
#: Share of the sketch a candidate must have, well below PERCENT: P(miss) < 1e-9 for 32 of 80 %.
ENOUGH = 25


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space."""
    return F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")


def _at(size: int) -> list[Column]:
    return [F.get("words", F.col("i") + k) for k in range(size)]


def _shingles(rows: DataFrame, keep: list[str], sizes: list[int], hashed: bool = True) -> DataFrame:
    """``keep``, size and shingle (its hash, or its words) of every run of ``sizes`` words."""
    parts = []
    for size in sizes:
        p = rows.where(F.size("words") >= size).select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("i"))
        s = F.xxhash64(F.lit(size), *_at(size)) if hashed else F.concat_ws(" ", *_at(size))
        parts.append(p.select(*keep, F.lit(size).alias("size"), s.alias("shingle")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, item_id, n_shingles, n_found: items of which a document has ``percent`` or more.

    ``docs``: doc_id, text; ``items``: item_id, text.  Items with fewer than
    five words are one shingle of their own length; null or empty items and
    texts match nothing; items that repeat an item_id are one item with all
    their shingles; rows without a doc_id are reported with null.  Extra
    columns are ignored.
    """
    text = text_of(docs)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(text).alias("words"))
    q = items.select(items["item_id"].cast("long").alias("item_id"), words(text_of(items)).alias("words")).where("size(words) > 0")
    sizes = [r[0] for r in q.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("s")).distinct().collect()]  # five numbers at most
    own = F.least(F.size("words"), F.lit(SHINGLE))
    if not sizes:
        return d.where("false").select("doc_id", "text_hash", F.lit(0).cast("long").alias("item_id"),
                                       F.lit(0).alias("n_shingles"), F.lit(0).alias("n_found"))
    parts = [_shingles(q.where(own == s), ["item_id"], [s]) for s in sizes]
    texts = [_shingles(q.where(own == s), ["item_id"], [s], hashed=False) for s in sizes]
    for k in range(1, len(sizes)):
        parts[0], texts[0] = parts[0].union(parts[k]), texts[0].union(texts[k])
    hashes, full = parts[0].distinct(), stored(texts[0].distinct(), "items")
    order = F.xxhash64("shingle", F.lit(9))
    sketch = hashes.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "shingle"))).alias("all"))
    # how many of the sketch's hashes must be found follows from the sketch; size_class only goes along
    sketch = sketch.select("item_id", F.floor(F.log2(F.size("all"))).alias("size_class"), F.slice("all", 1, SKETCH).alias("some")).select(
        "item_id", "size_class", F.ceil(F.size("some") * ENOUGH / 100).alias("need"), F.explode("some.shingle").alias("shingle"))
    sketch = stored(sketch, "item-sketches")
    hits = _shingles(d, ["doc_id", "text_hash"], sizes).join(sketch, "shingle").select(
        "doc_id", "text_hash", "item_id", "need", "shingle").distinct()
    candidates = stored(hits.groupBy("doc_id", "text_hash", "item_id", "need").count().where("count >= need").select(
        "doc_id", "text_hash", "item_id"), "leak-candidates")
    suspects = candidates.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    near = d.join(suspects, d["doc_id"].eqNullSafe(suspects["_id"]) & (d["text_hash"] == suspects["_hash"]), "left_semi")
    present = _shingles(near, ["doc_id", "text_hash"], sizes, hashed=False).join(
        full.select("shingle").distinct(), "shingle", "left_semi").distinct()
    total = full.groupBy("item_id").agg(F.count(F.lit(1)).cast("int").alias("n_shingles"))
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), F.col("item_id").alias("c_item"))
    pairs = present.join(full, ["shingle", "size"])
    kept = pairs.join(c, pairs["doc_id"].eqNullSafe(c["c_id"]) & (pairs["text_hash"] == c["c_hash"]) & (pairs["item_id"] == c["c_item"]), "left_semi")
    found = kept.groupBy("doc_id", "text_hash", "item_id").agg(F.count(F.lit(1)).cast("int").alias("n_found"))
    return found.join(total, "item_id").where(F.col("n_found") * 100 >= F.col("n_shingles") * percent).select(
        "doc_id", "text_hash", "item_id", "n_shingles", "n_found")


def clean(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns stay."""
    bad = stored(contained(docs, items, percent).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    same = docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (F.xxhash64(text_of(docs)) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
