"""Word-table BPE, importance resampling and the filter audit against brute-force versions, and on odd tables."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from accesslake.llm import filteraudit, resample, wordtable

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000
ODD = [(1, "a b c d e f"), (2, None), (None, "x y z"), (3, ""), (3, "again again"), (3, "again again"), (4, "  \n\t "), (5, LONG),
       (7, "é ü 日本"), (None, None)]


def odd(spark):
    d = spark.createDataFrame(ODD, "doc_id long, text string")
    extra = ("block", "docs", "ids", "word", "at", "known", "row", "bucket", "n", "score", "rank", "part", "digest", "failed", "id", "_id", "_key")
    return d.select("*", F.lit("en").alias("lang"), *(F.lit("clash").alias(c) for c in extra))


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- word table -------------------------------------------------------------

def path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path())
    out = []
    for doc, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


TRICKY = ["", " ", "  ", "\n", "a  b", "a \n b", " \t\tx", "end  ", "don't we'll 's 'S it''s ''ll \n've x\n's", "<|endoftext|>", "a <|endoftext|>b<|endoftext|> ",
          "<|endoftext|", "1234 5½ Ⅷ ²", "naïve Ünïcödé 日本語テキスト", "😀😀 a😀'll 𝒜𝟙 𠀀", "tab\x00nul\x1c\x85\xa0x", "é ‍ ﻿", "a" * 5000, "!?" * 700,
          "x" + " " * 3000 + "y", "　wide em"]


def test_splitter_gives_the_library_s_words():
    t = wordtable.load(path())
    split = wordtable.Splitter(t)
    for text in TRICKY:
        if "<|endoftext|>" not in text:
            assert split.words(text) == [text[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(text)], text[:40]


def test_op11(spark):
    want = library([(r.doc_id, r.text) for r in docs(spark).collect()])
    assert rows(E.queries()["op11_word_table_bpe"](spark, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


@pytest.mark.parametrize("block", [1, 400, wordtable.BLOCK])
def test_op11_blocks(spark, block):
    texts = list(enumerate(TRICKY)) + [(99, TRICKY[8])] * 3
    d = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = wordtable.decode(wordtable.encode(d, path(), block), path())
    assert rows(got, "doc_id", "text") == sorted(((i, t) for i, t in texts), key=repr)


def test_op11_odd(spark):
    assert rows(wordtable.digests(odd(spark), path()), "*") == library(ODD)
    assert wordtable.digests(odd(spark).where("false"), path()).count() == 0


def test_decode_of_strange_ids(spark):
    from tokenizers import Tokenizer
    ids = [[0, 50256, 1], [60000, 5], [255, 222], []]
    d = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)] + [(9, None)], "doc_id long, ids binary")
    t = Tokenizer.from_file(path())
    want = {i: t.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)} | {9: ""}
    assert {r.doc_id: r.text for r in wordtable.decode(d, path()).collect()} == want


# --- importance resampling ----------------------------------------------------

def grams(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(texts, target, buckets=10_000, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, x in texts:
        s.update(c % buckets for c in grams(x)[1])
    for x in target:
        t.update(c % buckets for c in grams(x)[1])
    a, b = sum(s.values()), sum(t.values())
    out = []
    for doc, x in texts:
        n, g = grams(x)
        w = sum(math.floor(1000 * math.log((t[c % buckets] + 1.0) * (a + buckets) / ((s[c % buckets] + 1.0) * (b + buckets)))) for c in g)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    best = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(best[:percent * len(best) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_prefix_crcs():
    texts = ["", None, "a", "Hello, World! 1-2 é日本 x", "A" * 300 + " b " + "c" * 70_000 + " d e", "...", "x y z w é", ""]
    (size, at, crc), = resample.features(texts)
    for i, t in enumerate(texts):
        assert (size[i], sorted(crc[at == i].tolist())) == (grams(t)[0], sorted(grams(t)[1]))


def test_shift_is_zero_bytes():
    c, n = np.array([0, 1, 0xFFFFFFFF, 12345] * 5, np.uint32), np.array([0, 1, 255, 256, 257, 511, 65536, 70001, 3, 1 << 20] * 2)
    want = [zlib.crc32(b"\0" * k, int(x)) ^ zlib.crc32(b"\0" * k) for x, k in zip(c, n)]
    assert resample.shift(c, n).tolist() == want


def test_op12(spark):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_resample([(r.doc_id, r.text) for r in docs(spark).collect()], target)
    got = rows(E.queries()["op12_importance_resampling"](spark, SF), "doc_id", "n_features", "weight", "score", "rank")
    assert got == want and any(r[4] == 1 for r in got)


def test_op12_odd(spark):
    # n words a row: ties in score (equal rows), null doc_ids, and enough rows to draw some
    many = ODD + [(None, "t " * 25)] * 20 + [(8, "t " * 25)] * 20
    clash = odd(spark)
    d = spark.createDataFrame(many, "doc_id long, text string").select("*", *(F.lit("clash").alias(c) for c in clash.columns if c not in ("doc_id", "text")))
    target = spark.createDataFrame([("a b t",), (None,), ("",)], "text string")
    assert rows(resample.resample(d, target), "*") == brute_resample(many, ["a b t", None, ""])
    assert rows(resample.resample(clash, target.where("false")), "*") == brute_resample(ODD, [])
    assert resample.resample(clash.where("false"), target).count() == 0


# --- filter audit -------------------------------------------------------------

def fact(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return [len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(re.findall("[#$%&*|]", t)), len(t)]


def brute_audit(texts, labels):
    first = {}
    for doc, text, _ in texts:
        key = math.inf if doc is None else doc
        first[text or ""] = min(first.get(text or "", math.inf), key)
    parts, out = {}, []
    for doc, text, lang in texts:
        n, distinct, capitals, symbols, points = fact(text)
        failed = {c for c, x in zip("ABCDE", (n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * points, symbols > 0,
                                              (math.inf if doc is None else doc) > first[text or ""])) if x}
        parts.setdefault(lang or "", []).append((failed, labels.get(doc, (0, 0))))
    for part, found in parts.items():
        shapley = Counter()
        table = []
        for order in permutations("ABCDE"):
            for i, c in enumerate(order):
                gone = [any(x in f for x in order[:i]) for f, _ in found]
                removed = [c in f and not g for (f, _), g in zip(found, gone)]
                shapley[c] += sum(removed)
                table.append([part, "".join(order), i + 1, sum(c not in f and not g for (f, _), g in zip(found, gone)), sum(removed),
                              sum(c in f and g for (f, _), g in zip(found, gone)), sum(f == {c} for f, _ in found),
                              sum(r and l[0] == 1 for r, (_, l) in zip(removed, found)), sum(r and l[1] == 1 for r, (_, l) in zip(removed, found))])
        out += [tuple(r + [shapley[r[1][r[2] - 1]]]) for r in table]
    return sorted(out, key=repr)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_text_facts(spark):
    texts = ["", None, " ", "a", "A a A", "é É #", "x\ty\x0bz\x1cq", "w " * 5000, "   lead", "trail  ", "日本 日本 語 日", "a b", "b a"]
    texts += [r.text for r in docs(spark).collect()]
    assert np.array(filteraudit.text_facts(pa.array(texts))).T.tolist() == [fact(t) for t in texts]


def test_hash_table_verifies_spans(monkeypatch):
    monkeypatch.setattr(filteraudit, "mix", lambda h: h & np.uint64(3))  # nearly all spans collide
    texts = ["a b c d e f g a b c", "aa ab ba bb aa", "x", "", "one two three two one four"]
    assert np.array(filteraudit.text_facts(pa.array(texts))).T.tolist() == [fact(t) for t in texts]


def test_op13(spark):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    want = brute_audit([(r.doc_id, r.text, r.lang) for r in docs(spark).collect()], labels)
    assert rows(E.queries()["op13_filter_audit"](spark, SF), *AUDIT) == want


def test_op13_odd(spark):
    texts = [(i, t, "en") for i, t in ODD] + [(None, "again again", None), (9, "again again", None), (1, "again again", "fr"), (6, LONG, "fr"), (5, LONG, "")]
    clash = [c for c in odd(spark).columns if c not in ("doc_id", "text", "lang")]
    d = spark.createDataFrame(texts, "doc_id long, text string, lang string").select("*", *(F.lit("clash").alias(c) for c in clash))
    labels = spark.createDataFrame([(1, 1, 0, "x"), (3, 1, None, "x"), (3, 0, 1, "x"), (None, 1, 1, "x"), (5, None, 1, "x")],
                                   "doc_id long, quality int, toxic int, part string")
    assert rows(filteraudit.audit(d, labels), *AUDIT) == brute_audit(texts, {1: (1, 0), 3: (1, 1), 5: (None, 1)})
    assert filteraudit.audit(d.where("false"), labels).count() == 0
    assert rows(filteraudit.audit(d, labels.where("false")), *AUDIT) == brute_audit(texts, {})
