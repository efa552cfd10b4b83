"""Packing along a space-filling curve.

A document's hashed token counts are projected to ``DIMENSIONS`` numbers, each
is cut to ``LEVELS`` bits by its normal quantile, and the cell's Hilbert key
orders the documents: neighbours on the curve have similar vocabulary.  The
documents are range-sorted by that key and laid end to end; every 2048 ids
make a sequence, so only the last one is not full.

Only keys and lengths are sorted and summed; the ids stay in one written table
and are cut where their position is known.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored, text_of, tuned
from .tokens import encoder

SEQUENCE = 2048
DIMENSIONS, LEVELS, CELLS = 4, 12, 4096
GROUP = 64  # documents counted at once
_SIGNS = np.random.Generator(np.random.PCG64(11)).choice(np.array([-1.0, 1.0], np.float32), (CELLS, DIMENSIONS))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of integer points (rows of ``cells``, ``bits`` bits a coordinate)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work of the axes, highest bit first
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document's projected token counts."""
    spots = np.zeros((len(ids), DIMENSIONS))
    for k in range(0, len(ids), GROUP):
        some = ids[k:k + GROUP]
        cells = (np.concatenate(some).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)
        cells = np.repeat(np.arange(len(some)) * CELLS, [len(d) for d in some]) + cells
        counts = np.bincount(cells, minlength=len(some) * CELLS).reshape(-1, CELLS).astype(np.float32)
        spots[k:k + GROUP] = counts @ _SIGNS / np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    quantile = 1 / (1 + np.exp(-1.702 * spots))  # close to the normal distribution function
    return hilbert(np.minimum((quantile * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1), LEVELS)


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """row, doc_id, n, curve, ids (16 bits each, with the end id) of every document, written."""
    tuned(docs.sparkSession)

    def run(batches):
        enc = encoder(tokenizer)
        for b in batches:
            raw = enc.encode(b.column("text").to_pylist())
            ids = [np.frombuffer(r, "<u2") for r in raw]
            if not ids:
                continue
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array([len(d) for d in ids], pa.int64()),
                 pa.array(curve_keys(ids), pa.int64()), pa.array(raw, pa.binary())], names=["row", "doc_id", "n", "curve", "ids"])

    d = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return stored(d.mapInArrow(run, "row long, doc_id long, n long, curve long, ids binary"), "pack-ids")


def positions(tokens: DataFrame) -> DataFrame:
    """row and at: ids before the document along the curve (ties by doc_id, then row)."""
    order = ["curve", "doc_id", "row"]
    spread = tokens.select("row", "doc_id", "n", "curve").repartitionByRange(partitions(tokens.sparkSession), *order)
    part = stored(spread.withColumn("part", F.spark_partition_id()), "pack-order")
    inside = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sizes = part.groupBy("part").agg(F.sum("n").alias("s"))
    base = sizes.select("part", (F.sum("s").over(Window.orderBy("part")) - F.col("s")).alias("base"))
    return part.withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, "part").select(
        "row", (F.col("base") + F.col("inside")).alias("at"))


def packed(docs: DataFrame, tokenizer: str, length: int = SEQUENCE) -> DataFrame:
    """Pieces of every document in sequences of ``length`` ids along the curve.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids
    (16-bit little-endian).  A null text is the empty text (its end id only);
    rows that repeat a doc_id are documents of their own.  No documents, no
    pieces.
    """
    tokens = tokenized(docs, tokenizer)
    placed = tokens.select("row", "doc_id", "n", "ids").join(positions(tokens), "row")

    def cut(batches):
        for b in batches:
            cols = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc, n, raw, at in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "ids", "at"))):
                ids, done = np.frombuffer(raw, "<u2"), 0
                wide = ids.astype("<u4").tobytes()
                while done < n:
                    seq, off = divmod(at + done, length)
                    take = min(n - done, length - off)
                    for k, v in (("doc_id", doc), ("start", done), ("length", take), ("doc_tokens", n), ("sequence_id", seq),
                                 ("offset", off), ("ids_crc32", zlib.crc32(wide[4 * done:4 * (done + take)])),
                                 ("ids", raw[2 * done:2 * (done + take)])):
                        cols[k].append(v)
                    done += take
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in cols.items()], names=list(cols))

    return placed.select("doc_id", "n", "ids", "at").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
