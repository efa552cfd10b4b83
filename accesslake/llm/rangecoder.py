"""Token-id files: an adaptive context-mixing range coder over independent blocks.

A block holds up to ``BLOCK`` ids and is read alone: header, CRC-32 of the
ids, the documents' pieces, and the coded lanes.  Its model starts empty.  The
ids are cut into lanes that are coded side by side and share one model:

* order 2 and order 1: the last id seen after the two ids (hashed) or the one
  id before, with a confidence;
* order 0: adaptive frequencies of the ids the higher orders did not foresee;
* the mix: for each pair of confidences, adaptive weights of the three orders.

The mixed probabilities drive a carry-less range coder with 64-bit state and
16-bit output words, one state a lane.  Files are Parquet with one block a
row, written by Spark's commit protocol into the shared folder, in ascending
document order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored, text_of, tuned
from .tokens import encoder

BLOCK = 1 << 21
LANES, LANE_MIN = 2048, 64  # a lane of a full block has 1024 steps: enough for the model to adapt
REFRESH = 4  # steps between order-0 updates
MIX_BITS, GAIN = 11, 3
ORDER2 = 1 << 17
MAGIC = b"CMR2"
HEAD = struct.Struct("<4sIIIIIQ")  # magic, ids, lanes, vocabulary, pieces, crc32, words
U = np.uint64
_TOP, _BOT = U(1 << 48), U(1 << 32)
MOST = 1 << 21  # sum of the order-0 frequencies: at most _BOT >> MIX_BITS, what the rarest kind has left


class Corrupt(ValueError):
    """A block's checksum or header does not hold."""


class _Model:
    def __init__(self, vocabulary: int):
        self.v = vocabulary
        # prediction and confidence (the low three bits) of a context in one number
        self.after1, self.after2 = np.zeros(vocabulary + 1, np.int64), np.zeros(ORDER2, np.int64)
        self.seen = np.ones((128, 3))
        self.freq = np.ones(vocabulary, np.int64)
        self.cum = np.zeros(vocabulary + 1, np.uint64)
        self.refresh()

    def refresh(self) -> None:
        np.cumsum(self.freq.view(np.uint64), out=self.cum[1:])
        if self.cum[-1] > MOST:  # the rarest id keeps a share that the coder can express
            self.freq = self.freq + 1 >> 1
            np.cumsum(self.freq.view(np.uint64), out=self.cum[1:])
        self.total = self.cum[-1]

    def predict(self, one: np.ndarray, two: np.ndarray):
        """Order-1 and order-2 predictions, and the cells of ``seen`` in which the kinds are counted."""
        self.one = one
        self.slot = ((two * 40503 + one * 30011) * 2654435761 >> 11) & (ORDER2 - 1)
        self.e1, self.e2 = self.after1.take(one), self.after2.take(self.slot)
        p1, p2 = self.e1 >> 3, self.e2 >> 3
        self.bucket = (((self.e2 & 7) << 4) | ((self.e1 & 7) << 1) | (p1 == p2)) * 3
        # of 2**MIX_BITS: the kinds' shares and where they start, order 2 first, then 1, then 0
        share = np.empty((128, 3), np.uint64)
        share[:, 1:] = (self.seen[:, 1:] * (((1 << MIX_BITS) - 3) / self.seen.sum(1))[:, None]).astype(np.uint64) + U(1)
        share[:, 0] = U(1 << MIX_BITS) - share[:, 1] - share[:, 2]
        start = np.zeros((128, 3), np.uint64)
        start[:, 2] = share[:, 1]
        start[:, 0] = share[:, 1] + share[:, 2]
        self.share, self.start = share.ravel(), start.ravel()
        return p1, p2

    def update(self, p1, p2, ids, cell, miss, t: int) -> None:
        """``cell``: place of each id's kind (0 order 0, 1 order 2, 2 order 1) in ``seen``; ``miss``: ids of order 0."""
        self.seen += np.bincount(cell, minlength=384).reshape(128, 3)
        for after, at, p, e in ((self.after1, self.one, p1, self.e1), (self.after2, self.slot, p2, self.e2)):
            c = e & 7
            after[at] = np.where(p == ids, e + (c < 7), ((np.where(c > 1, p, ids)) << 3) | (c >> 1))
        if len(miss):
            np.add.at(self.freq, miss, GAIN)
        if t % REFRESH == REFRESH - 1:
            self.refresh()


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // LANE_MIN))


def _active(n: int, lanes: int, t: int) -> int:
    return lanes if t < n // lanes else n % lanes


def _layout(n: int, lanes: int) -> np.ndarray:
    """Start of each lane; the first n % lanes lanes have one id more."""
    k = np.arange(lanes + 1)
    return k * (n // lanes) + np.minimum(k, n % lanes)


def _narrow(low, span, m, emit):
    """Renormalise the first m lanes; ``emit(idx)`` handles one 16-bit word of each lane in idx."""
    idx, lo, sp = np.arange(m), low[:m], span[:m]
    while len(idx):
        settled = (lo ^ (lo + sp)) < _TOP
        small = sp < _BOT
        need = np.flatnonzero(settled | small)
        if not len(need):
            return
        idx, lo, sp = idx.take(need), lo.take(need), sp.take(need)
        cut = ~settled.take(need)
        if cut.any():
            sp = np.where(cut, (U(0) - lo) & (_BOT - U(1)), sp)
        emit(idx, lo)
        lo, sp = lo << U(16), sp << U(16)
        low[idx], span[idx] = lo, sp


def _code(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(words of each lane, their number)."""
    n, lanes = len(ids), _lanes(len(ids))
    at, model = _layout(n, lanes), _Model(vocabulary)
    steps = -(-n // lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    width = 2 * steps + 8
    out, size, bound = np.zeros(lanes * width, np.uint16), np.zeros(lanes, np.int64), 0  # no lane has more than bound words
    base = np.arange(lanes) * width
    one, two = np.full(lanes, vocabulary, np.int64), np.full(lanes, vocabulary, np.int64)

    def emit(idx, lo):
        nonlocal out, width, base, bound
        bound += 1
        if bound >= width - 4:
            bound = int(size.max()) + 1
            if bound >= width - 4:
                out = np.concatenate([out.reshape(lanes, width), np.zeros((lanes, width), np.uint16)], axis=1).ravel()
                width *= 2
                base = np.arange(lanes) * width
        p = size[idx]
        out[base[idx] + p] = lo >> U(48)
        size[idx] = p + 1

    for t in range(steps):
        m = _active(n, lanes, t)
        s = ids.take(at[:m] + t)
        p1, p2 = model.predict(one[:m], two[:m])
        is2 = p2 == s
        cell = model.bucket + is2 + ((p1 == s) & ~is2) * 2
        r = span[:m] >> U(MIX_BITS)
        low[:m] += model.start.take(cell) * r
        span[:m] = model.share.take(cell) * r
        miss = np.flatnonzero((p1 != s) & ~is2)
        e = s[miss]
        if len(miss):
            r, first = span[miss] // model.total, model.cum[e]
            low[miss] += first * r
            span[miss] = (model.cum[e + 1] - first) * r
        _narrow(low, span, m, emit)
        model.update(p1, p2, s, cell, e, t)
        two[:m], one[:m] = one[:m], s
    out = np.concatenate([out.reshape(lanes, width), np.zeros((lanes, 2), np.uint16)], axis=1)
    last = low + (_BOT - U(1))  # top 32 bits inside [low, low + span)
    for k in range(2):
        out[np.arange(lanes), size] = ((last >> U(48 - 16 * k)) & U(0xFFFF)).astype(np.uint16)
        size += 1
    return out[np.arange(out.shape[1])[None, :] < size[:, None]], size


def _decode(words: np.ndarray, size: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    lanes = len(size)
    at, model = _layout(n, lanes), _Model(vocabulary)
    begin = np.cumsum(size) - size
    end, pos = begin + size, begin.copy()
    words = np.append(words, np.zeros(1, np.uint16)).astype(np.uint64)
    low, span, code = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64), np.zeros(lanes, np.uint64)

    def feed(idx, lo=None):
        p = pos[idx]
        code[idx] = (code[idx] << U(16)) | np.where(p < end[idx], words[np.minimum(p, len(words) - 1)], U(0))
        pos[idx] = p + 1

    for _ in range(4):
        feed(np.arange(lanes))
    ids = np.empty(n, np.int64)
    one, two = np.full(lanes, vocabulary, np.int64), np.full(lanes, vocabulary, np.int64)
    for t in range(-(-n // lanes)):
        m = _active(n, lanes, t)
        p1, p2 = model.predict(one[:m], two[:m])
        r = span[:m] >> U(MIX_BITS)
        mark = np.minimum((code[:m] - low[:m]) // r, U((1 << MIX_BITS) - 1))
        is2 = mark < model.share.take(model.bucket + 1)
        is0 = mark >= model.start.take(model.bucket)
        cell = model.bucket + is2 + (~is2 & ~is0) * 2
        low[:m] += model.start.take(cell) * r
        span[:m] = model.share.take(cell) * r
        s = np.where(is2, p2, p1)
        miss = np.flatnonzero(is0)
        e = miss
        if len(miss):
            r = span[miss] // model.total
            mark = np.minimum((code[miss] - low[miss]) // r, model.total - U(1))
            e = np.searchsorted(model.cum, mark, "right") - 1
            s[miss] = e
            first = model.cum[e]
            low[miss] += first * r
            span[miss] = (model.cum[e + 1] - first) * r
        ids[at[:m] + t] = s
        _narrow(low, span, m, feed)
        model.update(p1, p2, s, cell, e, t)
        two[:m], one[:m] = one[:m], s
    return ids


def pack_block(ids: np.ndarray, pieces: np.ndarray, vocabulary: int) -> bytes:
    """One block.  ``pieces``: int64 rows (doc_id, has a doc_id, ids of the document before this piece, length, ids in all)."""
    with np.errstate(over="ignore"):
        words, size = _code(ids.astype(np.int64), vocabulary)
    head = HEAD.pack(MAGIC, len(ids), len(size), vocabulary, len(pieces), zlib.crc32(ids.astype("<u4").tobytes()), len(words))
    body = pieces.astype("<i8").tobytes() + size.astype("<u4").tobytes() + words.astype("<u2").tobytes()
    return head + struct.pack("<I", zlib.crc32(body)) + body


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, pieces) of a block; raises Corrupt when a checksum fails."""
    magic, n, lanes, vocabulary, count, crc, length = HEAD.unpack_from(block)
    body = block[HEAD.size + 4:]
    if magic != MAGIC or struct.unpack_from("<I", block, HEAD.size)[0] != zlib.crc32(body):
        raise Corrupt("block body")
    pieces = np.frombuffer(body, "<i8", 5 * count).reshape(count, 5)
    size = np.frombuffer(body, "<u4", lanes, 40 * count).astype(np.int64)
    words = np.frombuffer(body, "<u2", length, 40 * count + 4 * lanes)
    with np.errstate(over="ignore"):
        ids = _decode(words, size, n, vocabulary).astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise Corrupt("ids")
    return ids, pieces


def write_tokens(docs: DataFrame, tokenizer: str, vocabulary: int = 1 << 16, end: int = 1) -> DataFrame:
    """Encode every text of ``docs`` and write the blocks; returns the written table.

    Rows: part and block (their order is the documents' order), first (ids of
    the part before the block), n_ids, data.  Documents are sorted by doc_id,
    then a hash of the text, then text; null doc_ids come first, a null text is the empty text (one id,
    the end), repeated rows are documents of their own.
    """
    tuned(docs.sparkSession)

    def run(batches):
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        held, pieces, count, first, block = [], [], 0, 0, 0

        def flush():
            nonlocal held, pieces, count, first, block
            data = pack_block(np.concatenate(held), np.array(pieces, np.int64).reshape(-1, 5), vocabulary)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([count], pa.int64()), pa.array([data], pa.binary())], names=["part", "block", "first", "n_ids", "data"])
            held, pieces, first, block, count = [], [], first + count, block + 1, 0
            return row

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids, done = np.frombuffer(enc.one(text), "<u2"), 0
                while done < len(ids):
                    take = min(len(ids) - done, BLOCK - count)
                    held.append(ids[done:done + take])
                    pieces.append((doc or 0, doc is not None, done, take, len(ids)))
                    done, count = done + take, count + take
                    if count == BLOCK:
                        yield flush()
        if count:
            yield flush()

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    # ranges are cut by doc_id and a hash: their samples go to the driver, so no text is in them
    ordered = (d.withColumn("_hash", F.xxhash64("text")).repartitionByRange(partitions(docs.sparkSession), "doc_id", "_hash")
               .sortWithinPartitions("doc_id", "_hash", "text").drop("_hash"))
    return stored(ordered.mapInArrow(run, "part long, block long, first long, n_ids long, data binary"), "token-file")


def _crc_shift(crc: int, n: int) -> int:
    """CRC-32 register after n zero bytes, by squaring the one-bit step."""
    def times(m, v):
        out = 0
        for row in m:
            if v & 1:
                out ^= row
            v >>= 1
        return out

    step = [0xEDB88320] + [1 << k for k in range(31)]
    n *= 8
    while n:
        if n & 1:
            crc = times(step, crc)
        step = [times(step, r) for r in step]
        n >>= 1
    return crc


def crc_join(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of the concatenation of byte strings given as (crc32, length)."""
    crc = 0
    for c, n in parts:
        crc = _crc_shift(crc, n) ^ c
    return crc


def read_pieces(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """Decode a token file: part, at (ids of the part before the document), doc_id, before, length, doc_tokens, crc, and the ids unless they are not wanted."""
    def run(batches):
        for b in batches:
            for part, first, data in zip(*(b.column(c).to_pylist() for c in ("part", "first", "data"))):
                ids, p = unpack_block(data)
                at = np.cumsum(p[:, 3]) - p[:, 3]
                cut = [ids[a:a + n].tobytes() for a, n in zip(at.tolist(), p[:, 3].tolist())]
                columns = [pa.array(np.full(len(p), part)), pa.array(first + at - p[:, 2]), pa.array(p[:, 0], mask=p[:, 1] == 0),
                           pa.array(p[:, 2]), pa.array(p[:, 3]), pa.array(p[:, 4]), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                names = ["part", "at", "doc_id", "before", "length", "doc_tokens", "crc"]
                if with_ids:
                    columns, names = [*columns, pa.array(cut, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part long, at long, doc_id long, before long, length long, doc_tokens long, crc long"
    return blocks.select("part", "first", "data").mapInArrow(run, schema + ", ids binary" * with_ids)


def digest(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of a token file, from its decoded ids."""
    pieces = read_pieces(blocks, with_ids=False)
    pieces = stored(pieces, "token-pieces")
    whole = pieces.where("length = doc_tokens").select("part", "at", "doc_id", "doc_tokens", "crc")

    def join(batches):
        for b in batches:
            crc = [crc_join([(x["crc"], 4 * x["length"]) for x in sorted(p, key=lambda x: x["before"])]) for p in b.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(crc, pa.int64())],
                                             names=["part", "at", "doc_id", "doc_tokens", "crc"])

    # the pieces of one document: their number follows from its own length
    cut = (pieces.where("length < doc_tokens").groupBy("part", "at", "doc_id", "doc_tokens")
           .agg(F.collect_list(F.struct("before", "length", "crc")).alias("p"))
           .mapInArrow(join, "part long, at long, doc_id long, doc_tokens long, crc long"))
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return whole.union(cut).join(base, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("doc_tokens").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
