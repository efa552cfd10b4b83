"""What document filters remove alone and in every order.

A byte transducer reads each text once: tables give each byte's class, the
next state (inside or outside a word) and the events of the step.  Every class
leads to one state whatever the state before, so numpy runs the steps of a
whole Arrow buffer at once.  The events count words, capitals, code points and
symbols and mark the words' spans.  The spans of a text go into an open-
addressing hash table of its own: the first span in a cell owns it, later
spans with its hash and length are compared with it byte by byte, and spans
that differ move to their next cell.  So the count of distinct words is exact.

Identical texts are found by SHA-256: copies are counted by digest and group
before any join, so a text that a third of all documents share costs a few
rows.  Patterns of failed filters are counted for each part; the orders are
expanded from those counts, never from documents.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, tuned
from .words import _BYTE, U, _power_tables, buffers, mix

BLANK, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
#: Byte to class.
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[32, *range(9, 14)]] = BLANK
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = SYMBOL
CLASS[0x80:0xC0] = CONTINUATION
OUTSIDE, INSIDE = 0, 1
#: State and class to the next state, and to the events of the step.
NEXT = np.array([[OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
START, END, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16
EVENTS = np.array([[(START if s == OUTSIDE and c != BLANK else 0) | (END if s == INSIDE and c == BLANK else 0)
                    | (IS_CAPITAL if c == CAPITAL else 0) | (IS_SYMBOL if c == SYMBOL else 0) | (IS_POINT if c != CONTINUATION else 0)
                    for c in range(5)] for s in (OUTSIDE, INSIDE)], np.uint8)
CHUNK = 1 << 21
FACTS = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")
#: Filters in letter order: a document fails when the condition holds.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
LETTERS = "ABCDE"


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes at a and at b are equal."""
    if not len(a):
        return np.zeros(0, bool)
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    equal = data[np.repeat(a, size) + step] == data[np.repeat(b, size) + step]
    return np.logical_and.reduceat(equal, first)


def distinct_spans(data: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray, n_texts: int) -> np.ndarray:
    """Distinct spans of each text, by a hash table a text: two to four cells a span, cells tried in steps that the hash gives."""
    n = np.bincount(text, minlength=n_texts)
    cells = np.where(n > 0, 2 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 0)
    base, mask = np.cumsum(cells) - cells, np.maximum(cells - 1, 0).astype(U)
    owner = np.full(int(cells.sum()), -1, np.int64)
    fresh = np.zeros(len(text), bool)
    left, turn = np.arange(len(text)), 0
    low, stride = hashes, (hashes >> U(32)) | U(1)
    while len(left):
        t = text[left]
        cell = base[t] + ((low[left] + U(turn) * stride[left]) & mask[t]).astype(np.int64)
        free = np.flatnonzero(owner[cell] < 0)[::-1]
        owner[cell[free]] = left[free]  # of several spans for a cell the last written stays: the first in the text
        own = owner[cell]
        mine = own == left
        fresh[left[mine]] = True
        like = ~mine & (hashes[own] == hashes[left]) & (size[own] == size[left])
        at = np.flatnonzero(like)
        like[at] = _same(data, start[own[at]], start[left[at]], size[left[at]])
        left, turn = left[~mine & ~like], turn + 1
    return np.bincount(text[fresh], minlength=n_texts)


def _run(off: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """The facts of neighbouring texts, in one pass of the transducer."""
    n_texts, at, b = len(off) - 1, off - off[0], data[off[0]:off[-1]]
    if not len(b):
        return [np.zeros(n_texts, np.int64)] * len(FACTS)
    classes = CLASS[b]
    state = NEXT[OUTSIDE][classes]
    before = np.empty_like(state)
    before[0], before[1:] = OUTSIDE, state[:-1]
    edges = at[:-1][at[:-1] < len(b)]
    before[edges] = OUTSIDE
    events = EVENTS.reshape(-1)[before * 5 + classes]

    def count(event: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(events & event), at))

    start = np.flatnonzero(events & START)
    closed = events & END > 0
    tail = at[1:][at[1:] > at[:-1]]  # a word that the end of its text cuts off
    tail = tail[state[tail - 1] == INSIDE]
    end = np.sort(np.concatenate([np.flatnonzero(closed), tail]))
    text = np.searchsorted(at, start, "right") - 1
    up, down = _power_tables(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[b] * up[:len(b)], dtype=np.uint64, out=total[1:])
    size = end - start
    hashes = mix((total[end] - total[start]) * down[start] + size.astype(np.uint64))
    return [np.bincount(text, minlength=n_texts), distinct_spans(b, text, start, size, hashes, n_texts), count(IS_CAPITAL), count(IS_SYMBOL), count(IS_POINT)]


def text_facts(texts: pa.Array) -> list[np.ndarray]:
    """The FACTS of each text of a string column, worked on in pieces of about CHUNK bytes, cut between texts."""
    off, data = buffers(texts)
    out, i = [[np.empty(0, np.int64)] for _ in FACTS], 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1)
        for k, v in enumerate(_run(off[i:j + 1], data)):
            out[k].append(v)
        i = j
    return [np.concatenate(v) for v in out]


def facts(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, digest (SHA-256 of the text) and FACTS of every row; a null text counts as the empty one, a null part as ''."""
    tuned(docs.sparkSession)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(v, pa.int64()) for v in text_facts(b.column(3)))],
                                             names=[*b.schema.names[:3], *FACTS])

    text = text_of(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{f} long" for f in FACTS))


def failures() -> F.Column:
    """The letters of the filters a document fails by its text alone."""
    n = F.col
    return F.concat(F.when(n("n_words") < MIN_WORDS, "A").otherwise(""),
                    F.when(100 * n("n_distinct") < DISTINCT_PERCENT * n("n_words"), "B").otherwise(""),
                    F.when(100 * n("n_capitals") > CAPITAL_PERCENT * n("n_points"), "C").otherwise(""),
                    F.when(n("n_symbols") > 0, "D").otherwise(""))


def patterns(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, failed (letters), good, toxic, n: documents of each part with each pattern of failed filters and labels.

    E fails where a row with a smaller doc_id has the same text.  Rows that
    repeat a doc_id are none smaller than the other; a null doc_id counts as
    larger than all others.  Repeated labels of a doc_id: the largest counts.
    """
    d = facts(docs, part).select("doc_id", "part", "digest", failures().alias("failed"))
    mark = labels.groupBy(labels["doc_id"].cast("string").alias("_id")).agg(
        (F.max(labels["quality"]) == 1).alias("good"), (F.max(labels["toxic"]) == 1).alias("toxic"))
    # rows without a doc_id get keys that meet no label and spread over the tasks
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none:"), F.hex("digest")))
    d = d.withColumn("_key", key).join(mark, F.col("_key") == F.col("_id"), "left")
    same = ["digest", "part", "failed", "good", "toxic"]
    d = d.select("digest", "part", "failed", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")),
                 F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"))
    ids = d.groupBy(*same, "id").agg(F.count(F.lit(1)).alias("n"))
    groups = ids.groupBy(*same).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    # a digest has few rows now: parts times labels
    least = F.min("first.id").over(Window.partitionBy("digest"))
    kept = F.when(F.col("first.id") == least, F.col("first.n")).otherwise(F.lit(0))
    split = groups.withColumn("kept", kept).select(*same[1:], F.explode(F.array(
        F.struct(F.lit("").alias("e"), F.col("kept").alias("m")), F.struct(F.lit("E").alias("e"), (F.col("n") - F.col("kept")).alias("m")))).alias("x"))
    return (split.where("x.m > 0").groupBy("part", F.concat("failed", "x.e").alias("failed"), "good", "toxic")
            .agg(F.sum("x.m").alias("n")))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs``: doc_id, text and ``part``; ``labels``: doc_id, quality, toxic.
    One row for each part, order of the five filters and step.  Long texts are
    read whole, extra columns are ignored, an empty table gives no rows; nulls,
    ties and repeated rows as ``patterns`` says.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    p = patterns(docs, labels, part).withColumn("filter_order", F.explode(orders))
    p = p.select("*", F.posexplode(F.split("filter_order", "")).alias("at", "letter"))
    earlier = F.expr("translate(substring(filter_order, 1, at), failed, '') <> substring(filter_order, 1, at)")
    fails = F.contains("failed", "letter")

    def total(condition: F.Column) -> F.Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    rows = p.groupBy("part", "filter_order", "at", "letter").agg(
        total(~earlier & ~fails).alias("kept"), total(~earlier & fails).alias("removed"), total(earlier & fails).alias("redundant"),
        total(F.col("failed") == F.col("letter")).alias("unique_fails"), total(~earlier & fails & F.col("good")).alias("good_lost"),
        total(~earlier & fails & F.col("toxic")).alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))  # 600 rows a part
    return rows.select("part", "filter_order", (F.col("at") + 1).cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
                       "good_lost", "toxic_lost", shapley.alias("shapley"))
