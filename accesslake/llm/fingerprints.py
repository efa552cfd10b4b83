"""Document fingerprints by randomised edit embedding.

A shared random walk reads the text: at output step j the current character
stays for as many steps as shared random bits of (j, character) say (a
geometric number, at least one) before the walk goes on to the next.  Texts a
few edits apart fall back into step after an edit, so few output symbols
differ: edit distance becomes Hamming distance.  The fingerprint samples
``SAMPLES`` output symbols as hexadecimal digits; sample k lies at the output
step with the smallest k-th hash, so texts of different length sample the same
steps wherever both have them.

The whole text is read, in ascending order of doc_id within a partition, and
the walk of the edited text goes on from where the texts part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored, text_of, tuned
from .components import bucketed
from .words import U, mix

SAMPLES = 256
PERIOD = 1024  # the shared bits repeat after so many steps
CLASSES = 64
BANDS, LIKE = 32, 0.8


def _walk_table() -> list[int]:
    """Steps a character of each class stays when it is reached at step j mod PERIOD (class * PERIOD + j)."""
    bits = np.random.Generator(np.random.PCG64(5)).integers(0, 2, (CLASSES, PERIOD))
    gap = np.zeros((CLASSES, PERIOD), np.int64)
    for c in range(CLASSES):
        on = np.flatnonzero(np.tile(bits[c], 2))
        gap[c] = on[np.searchsorted(on, np.arange(PERIOD))] - np.arange(PERIOD) + 1
    return gap.ravel().tolist()


_GAP = _walk_table()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _classes(codes: np.ndarray) -> list[int]:
    return ((mix(codes.astype(np.uint64)) >> U(64 - 6)).astype(np.int64) * PERIOD).tolist()


def walk(classes: list[int], j: int = 0) -> list[int]:
    """Step after each character, starting at step j."""
    gap, last = _GAP, PERIOD - 1
    return [j := j + gap[c + (j & last)] for c in classes]


_minima: list = []


def _steps(n: int) -> np.ndarray:
    """For n output steps: the sampled step of each k, the one with the smallest k-th hash of 0..n-1.

    The records of the running minima are kept, so a longer text only extends
    the search.
    """
    if not _minima:
        _minima.append([0, np.full(SAMPLES, 2**64 - 1, np.uint64), [[] for _ in range(SAMPLES)], None])
    state = _minima[0]
    if state[0] < n:
        seeds = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
        while state[0] < n:
            stop = state[0] + 4096
            h = mix(np.arange(state[0], stop, dtype=np.uint64)[:, None] * U(0xD1342543DE82EF95) + seeds)
            run = np.minimum.accumulate(np.vstack([state[1], h]), axis=0)
            row, col = np.nonzero(run[1:] < run[:-1])
            for r, c in zip((row + state[0]).tolist(), col.tolist()):
                state[2][c].append(r)
            state[0], state[1] = stop, run[-1]
        table = np.full((SAMPLES, max(map(len, state[2]))), 2**62)
        for k, r in enumerate(state[2]):
            table[k, :len(r)] = r
        state[3] = table
    return state[3][np.arange(SAMPLES), (state[3] < n).sum(axis=1) - 1]


_HEX = np.array(list("0123456789abcdef"))


def fingerprint(codes: np.ndarray, steps: list[int]) -> str:
    """Hexadecimal digits of the sampled output symbols; the empty text has dashes."""
    if not len(codes):
        return "-" * SAMPLES
    at = _steps(steps[-1])
    symbol = codes[np.searchsorted(np.array(steps), at, "right")].astype(np.uint64)
    digit = mix(symbol * U(0x9E3779B97F4A7C15) + np.arange(SAMPLES, dtype=np.uint64)) >> U(60)
    return "".join(_HEX[digit.astype(np.int64)])


def likeness(a: str, b: str) -> float:
    """Share of equal digits."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    return float((x == y).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  The edited text replaces the last
    floor(n_chars / 4) code points by the first as many of the next document
    (by doc_id, then text; the last is followed by the first).  A null text is
    empty; rows without a doc_id come first; repeated rows follow each other;
    a lone document is its own next.
    """
    spark = tuned(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    n = partitions(spark)
    # cuts between ranges of doc_id: as many numbers as partitions
    cuts = sorted(set(d.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []))
    ranges = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.expr(f"cast(aggregate(array({', '.join(f'{c}L' for c in cuts) or '0L'}), 0, (s, c) -> s + if(doc_id >= c, 1, 0)) as int)"))
    ids = d.select("doc_id", ranges.alias("part"))
    heads = [tuple(r) for r in ids.groupBy("part").agg(F.min("doc_id")).collect()]  # one row a range
    heads = sorted(heads, key=lambda r: r[0])
    # the first document of a range, once more, as the last of the range before it
    where = {h[1]: heads[(k - 1) % len(heads)][0] for k, h in enumerate(heads)}
    rows = d.select("doc_id", "text", ranges.alias("part"), F.lit(0).alias("guest"))
    if heads:
        same = F.col("doc_id").isin([k for k in where if k is not None])
        if None in where:
            same = same | F.col("doc_id").isNull()
        firsts = rows.where(F.coalesce(same, F.lit(False))).groupBy("part", "doc_id").agg(F.min("text").alias("text"))
        back = spark.createDataFrame([(heads[k][0], heads[k - 1][0]) for k in range(len(heads))], "part int, before int")
        guests = firsts.join(back, "part").select("doc_id", "text", F.col("before").alias("part"), F.lit(1).alias("guest"))
        rows = rows.union(guests)

    def run(batches):
        part, held = None, None
        out: list = []

        def row(now, nxt):
            doc, text, codes, steps, fp = now
            cut = len(codes) // 4
            keep = len(codes) - cut
            edited = np.concatenate([codes[:keep], nxt[2][:cut]])
            if cut:
                tail = walk(_classes(edited[keep:]), steps[keep - 1])
                efp = fingerprint(edited, steps[:keep] + tail)
            else:
                efp = fp
            sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
            return doc, len(codes), sha, fp, efp, likeness(fp, efp), likeness(fp, nxt[4])

        def flush():
            nonlocal out
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            b = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)
            out = []
            return b

        for b in batches:
            for doc, text, p, guest in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest"))):
                codes = _codes(text)
                steps = walk(_classes(codes))
                now = (doc, text, codes, steps, fingerprint(codes, steps))
                if held is not None and part == p:
                    out.append(row(held, now))
                part, held = p, None if guest else now
                if len(out) >= 500:
                    yield flush()
        yield flush()

    placed = rows.repartitionByRange(n, "part").sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), "text")
    return placed.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def near_pairs(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """doc_id and class_id of every row of ``prints`` (doc_id, fingerprint): banded samples, verified by Hamming likeness.

    Rows with equal fingerprints are one class from the start.  The classes
    of each of the ``BANDS`` buckets are compared in rounds until every pair
    that could join two components is tested; pairs with at least ``like``
    equal digits link.  class_id is the smallest
    doc_id reachable.
    """
    size = SAMPLES // BANDS
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    keys = classes.select("fingerprint", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(F.col("fingerprint").substr(k * size + 1, F.lit(size))))).alias("band", "key"))
    keys = keys.select(F.xxhash64("band", "key").alias("bucket"), F.col("fingerprint").alias("key"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(SAMPLES)), lambda k: F.col("a").substr(k, F.lit(1)) == F.col("b").substr(k, F.lit(1))))
    roots = bucketed(stored(keys.join(shared, "bucket"), "print-buckets"), lambda pairs: pairs.where(same >= like * SAMPLES), "prints")
    placed = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    ids = placed.groupBy("root").agg(F.min("least").alias("class_id"))
    return prints.select("doc_id", "fingerprint").join(placed.select("fingerprint", "root"), "fingerprint").join(ids, "root").select("doc_id", "class_id")
