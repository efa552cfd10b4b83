"""N-gram language model in Elias-Fano tries, queried from memory-mapped files.

Trigram model with absolute discounting, interpolated: p(w | g, h) = a(g, h, w)
+ b(g, h) * p(w | h) and p(w | h) = a(h, w) + b(h) * (c(w) + 1) / (N + V + 1),
where a = (c - D) / c(context) is the discounted share, b = D * T / c(context)
with T the number of distinct successors, and D of each order follows from how
many of all its n-grams, over all shards, occur once and twice.  The last factor
is the add-one unigram, so an unseen word after an unseen word gets the base
probability.  A context that was never seen leaves everything to the shorter
one.  Contexts don't reach beyond a text: its first word follows the end mark.

A shard holds the n-grams whose first word is in one range of 64-bit word hashes:

* level 1: the hashes (Elias-Fano), their counts, and monotone pointers
  (Elias-Fano) into level 2;
* level 2: for each word the sorted successors, kept relative to their
  context (context rank above, leading bits of the successor's hash below), so
  all are one monotone sequence (Elias-Fano), and pointers into level 3;
* level 3: the successors of each pair of level 2, in the same form.

Beside it lies a file with 8 bits for each share of levels 2 and 3 and for the
back-off weight of each pair, written when the discounts of all shards are known.

Counting pre-aggregates inside the scan's tasks; the shards are built by Spark
groups and written into the shared folder; scoring maps the files.  The number
of shards follows the session's shuffle partitions.
"""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import partitions, stored, text_of, tuned
from .words import U, word_hashes

END = U(0xE0D0C0B0A0908071)
CHUNK = 1_500_000  # tokens a task counts or scores at once; bounds its memory
STEP = 8.0  # quantiser: levels a halving
SUCCESSOR_BITS, THIRD_BITS = 40, 32


class EliasFano:
    """A non-decreasing sequence: packed low bits, unary high bits with ranks."""

    @staticmethod
    def arrays(x: np.ndarray) -> dict[str, np.ndarray]:
        n, top = len(x), int(x[-1]) if len(x) else 0
        low = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (x >> U(low)).astype(np.int64)
        ones = high + np.arange(n)
        words = np.zeros((int(ones[-1]) if n else 0) // 64 + 3, np.uint64)
        np.bitwise_or.at(words, ones >> 6, U(1) << (ones & 63).astype(np.uint64))
        bits = np.zeros(n * low // 64 + 2, np.uint64)
        if low:
            at = np.arange(n, dtype=np.int64) * low
            v, sh = x & U((1 << low) - 1), (at & 63).astype(np.uint64)
            np.bitwise_or.at(bits, at >> 6, v << sh)
            over = (at & 63) + low > 64
            np.bitwise_or.at(bits, (at[over] >> 6) + 1, v[over] >> (U(64) - sh[over]))
        rank = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=rank[1:])
        narrow = np.uint32 if len(rank) < 1 << 26 else np.int64
        return {"head": np.array([n, low], np.int64), "high": words, "low": bits, "rank": rank.astype(narrow),
                "zeros": (np.arange(len(rank)) * 64 - rank).astype(narrow)}

    def __init__(self, head, high, low, rank, zeros):
        self.n, self.l = int(head[0]), int(head[1])
        self.high, self.low, self.rank, self.zeros = high, low, rank, zeros

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        at = i * self.l
        w, sh = at >> 6, (at & 63).astype(np.uint64)
        v = self.low[w] >> sh
        v |= np.where(sh > 0, self.low[w + 1] << ((U(64) - sh) & U(63)), U(0))
        return v & U((1 << self.l) - 1)

    @staticmethod
    def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) set bit of each word."""
        pos = np.zeros(len(words), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            c = np.bitwise_count(words & U((1 << width) - 1)).astype(np.int64)
            go = k >= c
            k = np.where(go, k - c, k)
            pos += go * width
            words = np.where(go, words >> U(width), words)
        return pos

    def access(self, i: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.rank, i.astype(self.rank.dtype), "right") - 1
        one = w * 64 + self._select(self.high[w], i - self.rank[w].astype(np.int64))
        return ((one - i).astype(np.uint64) << U(self.l)) | self._low(i)

    def _after_zero(self, k: np.ndarray) -> np.ndarray:
        """Elements before the k-th zero of the high bits (from 1; 0: none), that is, in the high buckets below k."""
        j = np.maximum(k - 1, 0)
        w = np.searchsorted(self.zeros, j.astype(self.zeros.dtype), "right") - 1
        return np.where(k > 0, w * 64 + self._select(~self.high[w], j - self.zeros[w].astype(np.int64)) - j, 0)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, or -1: search for its successor among the elements with x's high bits."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high = (x >> U(self.l)).astype(np.int64)
        live = np.flatnonzero(high < int(self.zeros[-1]))
        want = x[live] & U((1 << self.l) - 1)
        lo, hi = self._after_zero(high[live]), self._after_zero(high[live] + 1)
        end = hi.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            below = self._low(mid) < want[todo]
            lo[todo] = np.where(below, mid + 1, lo[todo])
            hi[todo] = np.where(below, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        some = np.flatnonzero(lo < end)
        some = some[self._low(lo[some]) == want[some]]
        out[live[some]] = lo[some]
        return out


def _stream(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts with END after each, tokens of each text)."""
    starts, h = word_hashes(batch.column("text"))
    return np.insert(h, starts[1:], END), np.diff(starts) + 1


def _chunks(batches, size: int):
    """Lists of (batch, tokens, lengths) with about ``size`` tokens."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        t, k = _stream(b)
        held.append((b, t, k))
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _pairs(tokens: np.ndarray, inverse: np.ndarray, unique: np.ndarray) -> np.ndarray:
    before = np.empty_like(inverse)
    before[1:], before[0] = inverse[:-1], np.searchsorted(unique, END)
    return (before.astype(np.uint64) << U(32)) | inverse.astype(np.uint64)


def _triples(tokens: np.ndarray, inverse: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions whose context has two tokens of the same text or its start, context pair and token of each)."""
    at = 1 + np.flatnonzero(tokens[:-1] != END)
    return at, (pair[at - 1].astype(np.uint64) << U(32)) | inverse[at].astype(np.uint64)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U(32)) * U(shards)) >> U(32)


def _five(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _less(x: np.ndarray) -> bytes:
    """Small numbers, most of them equal: a twentieth of their size."""
    return zstandard.compress(x.astype("<u4").tobytes(), 3)


def _unfive(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


_PARTS = ["shard", "words", "counts", "fan", "successors", "pair_counts", "fan3", "successors3", "triple_counts"]


def counts(docs: DataFrame, shards: int, order: int = 3) -> DataFrame:
    """Pre-aggregated counts of words, pairs and (order 3) triples, one row a task, chunk and shard."""
    def run(batches):
        for held in _chunks(batches, CHUNK):
            t = np.concatenate([x[1] for x in held])
            u, inv, c = np.unique(t, return_inverse=True, return_counts=True)
            pk, pinv, pc = np.unique(_pairs(t, inv, u), return_inverse=True, return_counts=True)
            tk, tc = np.unique(_triples(t, inv, pinv)[1] if order > 2 else np.zeros(0, np.uint64), return_counts=True)
            del inv, pinv
            low = U(2**32 - 1)
            succ, succ3 = u[(pk & low).astype(np.int64)] >> U(64 - SUCCESSOR_BITS), u[(tk & low).astype(np.int64)] >> U(64 - THIRD_BITS)
            fan = np.bincount((pk >> U(32)).astype(np.int64), minlength=len(u))
            fan3 = np.bincount((tk >> U(32)).astype(np.int64), minlength=len(pk))
            first = np.searchsorted(_shard(u, shards), np.arange(shards + 1, dtype=np.uint64))
            at, at3 = np.append(0, np.cumsum(fan)), np.append(0, np.cumsum(fan3))
            rows = []
            for s, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                if b > a:
                    p, q = at[a], at[b]
                    x, y = at3[p], at3[q]
                    rows.append((s, u[a:b].tobytes(), _less(c[a:b]), _less(fan[a:b]), _five(succ[p:q]), _less(pc[p:q]),
                                 _less(fan3[p:q]), succ3[x:y].astype("<u4").tobytes(), _less(tc[x:y])))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(zip(*rows))], names=_PARTS)

    return docs.mapInArrow(run, ", ".join(f"{k} {'int' if k == 'shard' else 'binary'}" for k in _PARTS))


def _level(context: np.ndarray, succ: np.ndarray, count: np.ndarray, contexts: int, bits: int, given: int):
    """Sums a level's parts: (successor keys, counts, successors of each context, place of each part's row)."""
    key = (context.astype(np.uint64) << U(bits)) | (succ.astype(np.uint64) >> U(given - bits))
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    first, place = np.flatnonzero(new), np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    total = np.add.reduceat(count, first) if len(first) else count
    return key[first], total, np.bincount((key[first] >> U(bits)).astype(np.int64), minlength=contexts), place


def _short(name: str, c: np.ndarray) -> dict:
    """Counts in a byte each, those of 255 and more beside them."""
    big = np.flatnonzero(c >= 255)
    return {name: np.minimum(c, 255).astype(np.uint8), f"{name}.at": big, f"{name}.big": c[big].astype(np.int64)}


def _long(a: dict, name: str) -> np.ndarray:
    c = a[name].astype(np.int64)
    c[a[f"{name}.at"]] = a[f"{name}.big"]
    return c


def _file(parts: dict, **head) -> bytes:
    """Named arrays, each at a multiple of 8 bytes, behind a JSON head."""
    head, body, at = head | {"arrays": {}}, [], 0
    for name, a in parts.items():
        raw = np.ascontiguousarray(a).tobytes()
        head["arrays"][name] = [a.dtype.str, at, len(a)]
        raw += bytes(-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


_copies: dict[str, str] = {}


def _mappable(uri: str) -> str:
    """A path that can be mapped: the file's own, or a copy beside the worker that goes when the worker ends."""
    store, path = pafs.FileSystem.from_uri(uri)
    if isinstance(store, pafs.LocalFileSystem):
        return path
    if uri not in _copies:
        copy = os.path.join(tempfile.gettempdir(), uuid.uuid4().hex)
        atexit.register(lambda: os.path.exists(copy) and os.unlink(copy))
        with store.open_input_stream(path) as f, open(copy, "wb") as g:
            while block := f.read(1 << 24):
                g.write(block)
        _copies[uri] = copy
    return _copies[uri]


def _mapped(uri: str) -> tuple[dict, dict]:
    """(head, arrays) of a file, mapped as long as its arrays are held."""
    raw = np.memmap(_mappable(uri), np.uint8, "r")
    n = int(raw[:8].view("<u8")[0])
    head = json.loads(raw[8:8 + n].tobytes())
    return head, {k: raw[8 + n + at:][:size * np.dtype(t).itemsize].view(t) for k, (t, at, size) in head["arrays"].items()}


def _publish(folder: str, name: str, data: bytes) -> None:
    """Write a file whole or not at all; a retried task writes the same file again."""
    store, inner = pafs.FileSystem.from_uri(folder)
    store.create_dir(inner, recursive=True)
    trial, target = f"{inner}/.{uuid.uuid4().hex}", f"{inner}/{name}"
    with store.open_output_stream(trial) as f:
        f.write(data)
    try:
        store.move(trial, target)
    except OSError:  # stores that don't move onto a file
        if store.get_file_info(target).type == pafs.FileType.NotFound:
            raise
        store.delete_file(trial)


def shard_bytes(words, count, fan, succ, pair, fan3, succ3, triple) -> tuple[bytes, dict]:
    """File contents of a shard from its concatenated parts, and its sums: n, v, and how many n-grams occur once and twice."""
    u, inv = np.unique(words, return_inverse=True)
    total = np.zeros(len(u), np.uint64)
    np.add.at(total, inv, count)
    bits = min(SUCCESSOR_BITS, 64 - len(u).bit_length())
    key, c, width, place = _level(np.repeat(inv, fan), succ, pair, len(u), bits, SUCCESSOR_BITS)
    bits3 = min(THIRD_BITS, 64 - len(key).bit_length())
    key3, c3, width3, _ = _level(np.repeat(place, fan3), succ3, triple, len(key), bits3, THIRD_BITS)
    parts = {"counts": total} | _short("pairs", c) | _short("triples", c3)
    for name, seq in (("words", u), ("pointers", np.append(0, np.cumsum(width)).astype(np.uint64)), ("successors", key),
                      ("pointers3", np.append(0, np.cumsum(width3)).astype(np.uint64)), ("successors3", key3)):
        parts |= {f"{name}.{k}": v for k, v in EliasFano.arrays(seq).items()}
    sums = {"n": int(total.sum()), "v": len(u)} | {f"{name}{k}": int((x == k).sum()) for name, x in (("pairs", c), ("triples", c3)) for k in (1, 2)}
    return _file(parts, bits=bits, bits3=bits3), sums


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / max(1, once + 2 * twice)))


def _quantised(share: np.ndarray) -> np.ndarray:
    """Eighths of a halving, rounded to the smaller probability; 255 stands for all that is less."""
    return np.minimum(255, np.ceil(-np.log2(share) * STEP)).astype(np.uint8)


def _probability(level: np.ndarray) -> np.ndarray:
    return np.exp2(level.astype(np.float64) / -STEP)


def level_bytes(shard: "Shard", a: dict, discount: float, discount3: float) -> bytes:
    """The quantised shares of levels 2 and 3 and the back-off weights of level 2."""
    c, c3 = _long(a, "pairs"), _long(a, "triples")
    fan, fan3 = (np.diff(p.access(np.arange(p.n)).astype(np.int64)) for p in (shard.pointers, shard.pointers3))
    share = (c - discount) / np.repeat(shard.counts, fan)
    # what follows a pair: its own count, but for pairs that end a text (nothing follows those)
    share3 = (c3 - discount3) / np.repeat(c, fan3)
    return _file({"level2": _quantised(share), "back2": _quantised(np.where(fan3 > 0, discount3 * fan3 / c, 1.0)), "level3": _quantised(share3)})


class Shard:
    """A mapped shard file and its file of quantised probabilities."""

    def __init__(self, head: dict, a: dict, levels: dict | None = None):
        self.bits, self.bits3, self.counts, self.levels = head["bits"], head["bits3"], a["counts"], levels
        self.words, self.pointers, self.successors, self.pointers3, self.successors3 = (
            EliasFano(*(a[f"{k}.{f}"] for f in ("head", "high", "low", "rank", "zeros")))
            for k in ("words", "pointers", "successors", "pointers3", "successors3"))

    def pairs(self, ctx: np.ndarray, successor: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in level 2 or -1, share, weight of the unigram) for context ranks and successor hashes."""
        i = self.successors.find((ctx.astype(np.uint64) << U(self.bits)) | (successor >> U(64 - self.bits)))
        u, inv = np.unique(ctx, return_inverse=True)
        fan = (self.pointers.access(u + 1) - self.pointers.access(u)).astype(np.float64)
        return i, np.where(i >= 0, _probability(self.levels["level2"][np.maximum(i, 0)]), 0.0), (discount * fan / self.counts[u])[inv]

    def triples(self, pair: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(share, weight of the shorter context) for places in level 2 and successor hashes."""
        i = self.successors3.find((pair.astype(np.uint64) << U(self.bits3)) | (successor >> U(64 - self.bits3)))
        return np.where(i >= 0, _probability(self.levels["level3"][np.maximum(i, 0)]), 0.0) if len(self.levels["level3"]) else np.zeros(len(i)), \
            _probability(self.levels["back2"][pair])


def _shard_at(folder: str, s: int) -> Shard:
    """A shard, mapped until the caller lets it go: a worker holds the pages of one at a time."""
    return Shard(*_mapped(f"{folder}/shard-{s:06d}"), _mapped(f"{folder}/levels-{s:06d}")[1])


def train(docs: DataFrame, shards: int | None = None, order: int = 3) -> dict:
    """Model of ``order`` 2 or 3: count ``docs`` (text) and write the shards; returns folder, shards, n (tokens), v (distinct tokens), discounts."""
    spark = tuned(docs.sparkSession)
    shards = shards or partitions(spark)
    folder = scratch_path(spark, "llm-ngrams")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    sums = ["n", "v", "pairs1", "pairs2", "triples1", "triples2"]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        s = int(pdf["shard"].iloc[0])
        cat = lambda k, t: np.frombuffer(b"".join(pdf.pop(k)), t)
        small = lambda k: np.frombuffer(b"".join(map(zstandard.decompress, pdf.pop(k))), "<u4").astype(np.int64)
        data, made = shard_bytes(cat("words", "<u8"), small("counts").astype(np.uint64), small("fan"), _unfive(b"".join(pdf.pop("successors"))),
                                 small("pair_counts"), small("fan3"), cat("successors3", "<u4"), small("triple_counts"))
        _publish(folder, f"shard-{s:06d}", data)
        return pd.DataFrame({"shard": [s]} | {k: [made[k]] for k in sums})

    text = docs.select(text_of(docs).alias("text"))
    built = stored(counts(text, shards, order).groupBy("shard").applyInPandas(build, "shard int, " + ", ".join(f"{k} long" for k in sums)), "ngram-shards")
    n, v, p1, p2, t1, t2 = built.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in sums]).first()
    discount, discount3 = _discount(p1, p2), _discount(t1, t2)

    def smooth(batches):
        for pdf in batches:
            for s in pdf["shard"].tolist():
                head, a = _mapped(f"{folder}/shard-{s:06d}")
                _publish(folder, f"levels-{s:06d}", level_bytes(Shard(head, a), a, discount, discount3))
            yield pdf

    done = stored(built.select("shard").repartition(shards, "shard").mapInPandas(smooth, "shard int"), "ngram-levels")
    there = [r[0] for r in done.collect()]  # one number a shard
    return {"folder": folder, "shards": shards, "n": n, "v": v, "discount": discount, "discount3": discount3, "there": frozenset(there)}


def _log10(model: dict, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of a stream: known, base log10 probability, model log10 probability."""
    u, inv = np.unique(t, return_inverse=True)
    pk, pinv = np.unique(_pairs(t, inv, u), return_inverse=True)
    where3, triple = _triples(t, inv, pinv)
    tk, tinv = np.unique(triple, return_inverse=True)
    low = U(2**32 - 1)
    ctx, nxt = (pk >> U(32)).astype(np.int64), (pk & low).astype(np.int64)
    ctx3, nxt3 = (tk >> U(32)).astype(np.int64), (tk & low).astype(np.int64)
    first = np.searchsorted(_shard(u, model["shards"]), np.arange(model["shards"] + 1, dtype=np.uint64))
    c, rank, place = np.zeros(len(u), np.uint64), np.full(len(u), -1, np.int64), np.full(len(pk), -1, np.int64)
    share, weight, share3, weight3 = np.zeros(len(pk)), np.ones(len(pk)), np.zeros(len(tk)), np.ones(len(tk))
    for s in sorted(model["there"]):
        a, b = first[s], first[s + 1]
        if a == b:
            continue
        shard = _shard_at(model["folder"], s)
        rank[a:b] = shard.words.find(u[a:b])
        c[a:b] = np.where(rank[a:b] >= 0, shard.counts[np.maximum(rank[a:b], 0)], 0)
        p, q = np.searchsorted(ctx, [a, b])
        k = p + np.flatnonzero(rank[ctx[p:q]] >= 0)
        if len(k):
            place[k], share[k], weight[k] = shard.pairs(rank[ctx[k]], u[nxt[k]], model["discount"])
        x, y = np.searchsorted(ctx3, [p, q])
        k = x + np.flatnonzero(place[ctx3[x:y]] >= 0)
        if len(k):
            share3[k], weight3[k] = shard.triples(place[ctx3[k]], u[nxt3[k]])
    unigram = (c + U(1)).astype(np.float64) / (model["n"] + model["v"] + 1)
    prob = (share + weight * unigram[nxt])[pinv]
    prob[where3] = share3[tinv] + weight3[tinv] * prob[where3]
    return (c > 0)[inv], np.log10(unigram)[inv], np.log10(prob)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held (as given), n_tokens, n_known, base_score, score of every row of ``docs`` (doc_id, held, text)."""
    tuned(docs.sparkSession)

    def run(batches):
        for held in _chunks(batches, CHUNK // 2):
            known, base, prob = _log10(model, np.concatenate([x[1] for x in held]))
            n = np.concatenate([x[2] for x in held])
            at = np.cumsum(n) - n
            arrays = [pa.concat_arrays([x[0].column(k) for x in held]) for k in ("doc_id", "held")]
            arrays += [pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(known.astype(np.int64), at)),
                       pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(prob, at))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held", "n_tokens", "n_known", "base_score", "score"])

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "held", text_of(docs).alias("text"))
    return d.mapInArrow(run, "doc_id long, held boolean, n_tokens long, n_known long, base_score double, score double")


def lm_scores(docs: DataFrame) -> DataFrame:
    """Train on the rows whose crc32(doc_id as text) mod 7 is not 2 and score every row.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  A
    null text is the empty text (one token, the end).  Rows without a doc_id
    are never learned from and count as held out; repeated rows count as often
    as they occur.  Without training rows every token has the probability 1.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    marked = docs.select("doc_id", F.coalesce(rest == 2, F.lit(True)).alias("held"), "text")
    model = train(marked.where("not held"))
    return score(marked, model).select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known",
                                       F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score")
