"""MinHash near-dedup with circulant signatures.

C-MinHash: one permutation places every shingle on a circle of ``CIRCLE``
cells, a second one gives each cell a value; coordinate k of the signature is
the smallest value seen when the circle is shifted by k.  Two permutations
thus make all coordinates, and the values a shingle needs lie next to each
other in memory.

Texts with equal shingle sets form a class; only one text of a class goes
through banding.  In a bucket every member is compared with one hub, the hub
then leaves; buckets whose members are already connected close.  This tests
every pair of a bucket that could still join two components, without listing
all pairs.  Pairs whose sizes or signatures rule out a link are left out
inside that join; links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import partitions, stored, text_of, tuned
from .components import bucketed
from .words import U, mix, shingles, word_hashes

CIRCLE_BITS = 20
BANDS, ROWS = 40, 6
_tables: dict = {}


def _windows(width: int) -> np.ndarray:
    """Row p: the values of cells p, p + 1, ... of the circle."""
    if width not in _tables:
        p = np.random.Generator(np.random.PCG64(7)).permutation(1 << CIRCLE_BITS).astype(np.uint32)
        _tables[width] = np.lib.stride_tricks.sliding_window_view(np.concatenate([p, p[:width]]), width)
    return _tables[width]


def signature(distinct: np.ndarray, width: int = BANDS * ROWS) -> np.ndarray:
    """``width`` circulant min-hashes of a set of 64-bit shingles."""
    rows, out = _windows(width), np.full(width, 2**32 - 1, np.uint32)
    cells = np.unique(distinct >> U(64 - CIRCLE_BITS)).astype(np.int64)
    for i in range(0, len(cells), 1024):
        np.minimum(out, rows[cells[i : i + 1024]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    h = np.arange(1, bands + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
    for column in sig.reshape(bands, -1).T.astype(np.uint64):
        h = mix(h * U(0x100000001B3) + column)
    return h.view(np.int64)


def low_bits(sig: np.ndarray) -> np.ndarray:
    """The two low bits of each coordinate, the lowest ones first, as longs."""
    bits = np.packbits(np.stack([sig & 1, (sig >> 1) & 1]).astype(np.uint8), axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.int64).ravel()


def agreeing(percent: int, coordinates: int = BANDS * ROWS, sigmas: float = 4.5) -> str:
    """Condition on two classes' (n, bits): sizes and signatures allow a coefficient of ``percent``.

    The sizes' part is exact.  A pair at the threshold agrees in the two low
    bits of ``a`` of its coordinates, and three in a million such pairs in
    fewer than ``a`` less 4.5 standard deviations.
    """
    a = percent / 100 + (1 - percent / 100) / 4
    most = int(coordinates * (1 - a) + sigmas * (coordinates * a * (1 - a)) ** 0.5)
    longs = -(-coordinates // 64)
    unlike = " + ".join(f"bit_count((info.bits[{i}] ^ hub_info.bits[{i}]) | (info.bits[{i + longs}] ^ hub_info.bits[{i + longs}]))"
                        for i in range(longs))
    return f"info.n * 100 >= hub_info.n * {percent} and hub_info.n * 100 >= info.n * {percent} and {unlike} <= {most}"


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    starts, h = shingles(*word_hashes(batch.column("text")), size)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        yield np.unique(h[a:b])


def _key(distinct: np.ndarray) -> bytes | None:
    return hashlib.blake2b(distinct.tobytes(), digest_size=16).digest() if len(distinct) else None


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, key (digest of its set, null when empty), bands, bits."""

    def run(batches):
        for b in batches:
            keys, ns, bands, bits, seen = [], [], [], [], {}
            for s in _sets(b, size):
                k = _key(s)
                if k is not None and k not in seen:
                    sig = signature(s)
                    seen[k] = band_keys(sig), low_bits(sig)
                keys.append(k)
                ns.append(len(s))
                bands.append(None if k is None else seen[k][0])
                bits.append(None if k is None else seen[k][1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "key", "bands", "bits"])

    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, key binary, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, n, members) of the classes whose representatives ``wanted`` (doc_id, text_hash) names."""

    def run(batches):
        for b in batches:
            s = list(_sets(b, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(x) for x in s], pa.binary()), pa.array([len(x) for x in s], pa.int64()),
                 pa.array([x.tobytes() for x in s], pa.binary())], names=["key", "n", "members"])

    text = text_of(docs)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    w = wanted.select(F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"))
    picked = d.join(w, d["doc_id"].eqNullSafe(w["w_id"]) & (d["text_hash"] == w["w_hash"]), "left_semi")
    made = picked.select("text").mapInArrow(run, "key binary, n long, members binary")
    return made.repartition(partitions(docs.sparkSession), "key").dropDuplicates(["key"])


def _placed(sets: DataFrame) -> DataFrame:
    """``full_sets`` written in buckets of key: every round's joins leave them where they lie."""
    spark = sets.sparkSession
    path = scratch_path(spark, "llm-neardup-sets")
    table = "accesslake_" + re.sub(r"\W", "_", path.rsplit("/", 1)[1])
    sets.write.option("compression", "zstd").option("path", path).bucketBy(partitions(spark), "key").saveAsTable(table)
    return spark.table(table)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    def run(batches):
        for t in batches:
            a, b, keep = t.column("x").to_pylist(), t.column("y").to_pylist(), []
            for p, q in zip(a, b):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(sets.select(F.col("key").alias("a"), F.col("members").alias("x")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("members").alias("y")), "b")
    return full.mapInArrow(run, "a binary, b binary")


def link(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) of the classes that have a link to another class."""
    rows = classes.select("key", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("bucket")
    members = stored(rows.join(full, "bucket"), "neardup-buckets")
    involved = classes.join(members.select("key").distinct(), "key", "left_semi")
    sets = _placed(full_sets(docs, stored(involved.select("doc_id", "text_hash"), "neardup-wanted"), size))
    info = involved.select("key", F.struct("n", "bits").alias("info"))
    return bucketed(members, lambda pairs: confirm(pairs, sets, percent), "neardup", info, agreeing(percent))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a text with fewer
    than ``size`` words is one shingle.  Null or empty texts have no shingles
    and link with nothing.  Rows that repeat a doc_id are members of their own
    text's class; component_id is the smallest doc_id of the component (null
    only if all its doc_ids are null), kept is doc_id = component_id (true for
    a component without any doc_id).  Extra columns of ``docs`` are ignored.
    """
    tuned(docs.sparkSession)
    rows = stored(sketch(docs, size), "neardup-sketch")
    classes = rows.where("key is not null").groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("r"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    classes = stored(classes.select("key", "r.doc_id", "r.text_hash", "least", "n", "bands", "bits"), "neardup-classes")
    roots = link(docs, classes, size, percent)
    placed = classes.select("key", "least").join(roots.withColumnRenamed("node", "key"), "key")
    component = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("key", "component_id")
    grouped = classes.select("key", "least").join(component, "key", "left").select(
        "key", F.coalesce("component_id", "least").alias("component_id"))
    out = rows.select("doc_id", "text_hash", "n_shingles", "key").join(grouped, "key", "left")
    cid = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, cid.isNull()).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each component; empty texts and rows without a doc_id all stay, as do all columns."""
    found = stored(near_duplicates(docs, size, percent).where("kept"), "neardup-kept")
    w = found.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    same = docs["doc_id"].cast("long").eqNullSafe(w["_kept_id"]) & (F.xxhash64(text_of(docs)) == w["_kept_hash"])
    out = docs.join(w, same, "left_semi")
    again = found.where("n_shingles > 0 and component_id is not null").groupBy("component_id").count().where("count > 1")
    if again.isEmpty():
        return out
    # rows that repeat a doc_id: one row of each text class stays
    twice = stored(found.where("n_shingles > 0").join(again, "component_id", "left_semi"), "neardup-twice")
    t = twice.groupBy(F.col("component_id").alias("_c")).agg(F.min("doc_id").alias("_id"), F.min("text_hash").alias("_hash"), F.max("text_hash").alias("_hi"))
    key = F.struct(docs["doc_id"].cast("long").alias("d"), F.xxhash64(text_of(docs)).alias("h"))
    ids = twice.select(F.struct(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).alias("_k")).distinct()
    chosen = t.select(F.struct(F.col("_id").alias("d"), F.col("_hash").alias("h")).alias("_k")).distinct()
    single = out.join(ids, key.eqNullSafe(ids["_k"]), "left_anti")
    one = out.join(chosen, key.eqNullSafe(chosen["_k"]), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(one)
