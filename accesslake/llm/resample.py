"""Importance resampling towards a target collection, on hashed word n-grams.

Features are the runs of 1 to ``LONGEST`` words of a text, hashed by CRC-32
into ``buckets`` cells.  A text is normalised once (words joined by one space)
and scanned once: the CRC after each word is kept.  With R(n) the CRC of the
first n bytes, the CRC of the bytes from s to e is R(e) xor shift(R(s), e - s),
where shift(c, k) is c after k zero bytes: a linear map over GF(2), taken from
tables.  So an n-gram's CRC needs two prefixes, whatever its length.

The cells' counts over all documents and all target texts give each cell a
gain; a document's weight is the sum of the gains of its features.  Gumbel
noise from a hash of the doc_id makes the highest scores a sample without
replacement.  Only the cells' counts (``buckets`` rows) reach the driver and
are broadcast.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored, text_of, tuned

LONGEST = 3
BUCKETS = 10_000
SEED = 42
MIN_WORDS = 20
PERCENT = 5
#: Bytes of text worked on at once.
CHUNK = 1 << 21
#: Letters (A-Z folded), digits and all bytes of characters beyond ASCII stay, the rest separates words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
U = np.uint32


def _byte_step() -> np.ndarray:
    c = np.arange(256, dtype=U)
    for _ in range(8):
        c = np.where(c & 1, c >> U(1) ^ U(0xEDB88320), c >> U(1))
    return c


STEP = _byte_step()


def _zero(c: np.ndarray) -> np.ndarray:
    """The register after one zero byte."""
    return STEP[c & U(255)] ^ (c >> U(8))


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map, given by its values on each of the four bytes."""
    return table[0][c & U(255)] ^ table[1][c >> U(8) & U(255)] ^ table[2][c >> U(16) & U(255)] ^ table[3][c >> U(24)]


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps for 0 to 255 zero bytes, and for 256 times each power of two."""
    small = np.empty((256, 4, 256), U)
    small[0] = np.arange(256, dtype=U)[None, :] << (U(8) * np.arange(4, dtype=U))[:, None]
    for n in range(1, 256):
        small[n] = _zero(small[n - 1])
    large = [_zero(small[255])]
    for _ in range(24):
        large.append(_apply(large[-1], large[-1]))
    return small, large


_SMALL, _LARGE = _tables()


def shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each register after its number of zero bytes (below 2**32)."""
    r = (n & 255).astype(np.int64)
    flat = _SMALL.reshape(-1)
    at = r * 1024
    out = (flat[at + (crc & U(255))] ^ flat[at + 256 + (crc >> U(8) & U(255))]
           ^ flat[at + 512 + (crc >> U(16) & U(255))] ^ flat[at + 768 + (crc >> U(24))])
    rest, k = n >> 8, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _apply(_LARGE[k], out[odd])
        rest, k = rest >> 1, k + 1
    return out


def running(words: list[bytes]) -> list[int]:
    """CRC-32 of the words joined by one space, after each word."""
    crc32, c, out = zlib.crc32, 0, []
    for w in words:
        c = crc32(w, c)
        out.append(c)
        c = crc32(b" ", c)
    return out


def _chunk(texts: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size, after, length = [], [], []
    for text in texts:
        words = text.translate(_NORMAL).split()
        size.append(len(words))
        after += running(words)
        length += map(len, words)
    size, after, length = np.array(size, np.int64), np.array(after, U), np.array(length, np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    end = np.cumsum(length + 1) - 1  # where each word ends, in bytes; one space between words
    start = end - length
    before = np.zeros(len(after), U)  # the CRC up to each word's start: a space after the word before
    before[1:] = _space(after[:-1])
    before[(np.cumsum(size) - size)[size > 0]] = 0
    at, crcs = [], []
    for n in range(longest):
        first = np.flatnonzero(text[:len(text) - n] == text[n:])
        crcs.append(after[first + n] ^ shift(before[first], end[first + n] - start[first]))
        at.append(text[first])
    return size, np.concatenate(at), np.concatenate(crcs)


def features(texts: list[str | None], longest: int = LONGEST):
    """Yields ``(sizes, text, crc)`` of neighbouring texts: words of each text; text and CRC-32 of each of their n-grams."""
    held, chars = [], 0
    for text in texts:
        held.append((text or "").encode())
        chars += len(held[-1])
        if chars >= CHUNK:
            yield _chunk(held, longest)
            held, chars = [], 0
    if held:
        yield _chunk(held, longest)


def _space(crc: np.ndarray) -> np.ndarray:
    """CRC-32 after one space more (the register is the inverted CRC)."""
    r = ~crc
    return ~(STEP[(r ^ U(32)) & U(255)] ^ (r >> U(8)))


def counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of ``texts`` (its column ``text``); a task sends one row a bucket at most."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, crcs in features(b.column(0).to_pylist()):
                total += np.bincount(crcs % U(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    tuned(texts.sparkSession)
    out = np.zeros(buckets, np.int64)
    rows = texts.select(text_of(texts).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target over that in the source."""
    b, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in
                     zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """row, doc_id, n_words, n_features, weight of every row of ``docs``; row tells equal rows apart."""
    shared, buckets = tuned(docs.sparkSession).sparkContext.broadcast(gain), len(gain)

    def run(batches):
        g, row = shared.value, TaskContext.get().partitionId() << 40
        for b in batches:
            done = 0
            for sizes, text, crcs in features(b.column("text").to_pylist()):
                n = len(sizes)
                m = np.bincount(text, minlength=n)
                w = np.bincount(text, weights=g[crcs % U(buckets)], minlength=n).astype(np.int64)  # exact below 2**53
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), b.column("doc_id").slice(done, n), *map(pa.array, (sizes, m, w))],
                                                 names=["row", "doc_id", "n_words", "n_features", "weight"])
                row, done = row + n, done + n

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: F.Column, seed: int = SEED) -> F.Column:
    """Gumbel noise in thousandths, from a hash of the seed and the doc_id (null: the empty text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``; rank counts the drawn rows from 1, the others have null.

    ``docs``: doc_id, text; ``target``: text.  ``percent`` of the rows with
    ``min_words`` words or more are drawn, by highest score; ties go to the
    smaller doc_id, null doc_ids last.  A null or empty text has no features
    and weight 0; long texts are scored whole; repeated rows are rows of their
    own, in any order among themselves; extra columns are ignored.  Empty
    documents give an empty table, an empty target a gain of no occurrence.
    """
    spark = docs.sparkSession
    gain = gains(counts(docs, buckets), counts(target, buckets))
    scored = stored(weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample-scores")
    drawn = math.floor(percent * scored.where(F.col("n_words") >= min_words).count() / 100)
    # ranks over all rows: sorted ranges, numbered inside, then moved by the sizes of the ranges before
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    ranges = scored.withColumn("eligible", F.col("n_words") >= min_words).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part)), pa.array(np.arange(at + 1, at + 1 + b.num_rows))],
                                             names=[*b.schema.names, "part", "at"])
            at += b.num_rows

    columns = ranges.select("doc_id", "n_features", "weight", "score", "eligible")
    numbered = stored(columns.mapInArrow(number, "doc_id long, n_features long, weight long, score long, eligible boolean, part long, at long"),
                      "resample-ranks")
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    base = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    rank = F.col("base") + F.col("at")
    return numbered.join(F.broadcast(base), "part").select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("eligible") & (rank <= drawn), rank).alias("rank"))
