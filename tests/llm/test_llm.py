"""The operators against brute-force versions, and on odd tables."""

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from accesslake.llm import curvepack, decontam, fingerprints, licenses, lines, neardup, ngramlm, passages, quality, rangecoder
from accesslake.llm import components as C
from accesslake.llm import words as W
from accesslake.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
ODD = [(1, "a b c d e f"), (2, None), (None, "x y z"), (3, ""), (3, "again again"), (3, "again again"), (4, "  \n\t "), (5, "word " * 30_000),
       (7, "é ü 日本"), (None, None)]


def odd(spark):
    d = spark.createDataFrame(ODD, "doc_id long, text string")
    extra = ("key", "score", "n", "bucket", "root", "hub", "_id", "part", "row", "_gone", "n_lines", "words", "size")
    return d.select("*", *(F.lit("clash").alias(c) for c in extra))


def empty(spark):
    return odd(spark).where("false")


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(spark):
    return {r.doc_id: r.text or "" for r in docs(spark).collect()}


def ids_of(text, name, end=1):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = ids_of.__dict__.setdefault(name, Tokenizer.from_file(public_tokenizers.path(name)))
    return t.encode(text, add_special_tokens=False).ids + [end]


def path(name):
    import public_tokenizers
    return public_tokenizers.path(name)


def brute_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def shingle_set(words, size):
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def join(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- words, tokens ---------------------------------------------------------

def test_word_hashes_match_words():
    t = ["a B  c", "", "x\ty\nz é", None, "a b", "C c", " lead", "trail "]
    starts, h = W.word_hashes(pa.array(t))
    got = [h[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]
    seen = {}
    for text, hs in zip(t, got):
        words = brute_words(text or "")
        assert len(words) == len(hs)
        for w, x in zip(words, hs):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_short_texts():
    starts, h = W.shingles(*W.word_hashes(pa.array(["a", "a b", "a b c", ""])), 2)
    assert np.diff(starts).tolist() == [1, 1, 2, 0]
    assert h[1] == h[2] and h[0] != h[1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(spark, name):
    enc = Encoder(path(name))
    odd_texts = ["", " ", "a  b", "a\n\nb c", " x", "x ", "it's the dog's\t tab", "a b c", "q\x1cz", "<|endoftext|> a <|startoftext|>b",
                 "ÄÖ é é ́x", "日本 語 1234 12 34!!", "a \n b", "\n", "b\n", "x\r\ny", "Ünï-cödé, it's; ﬁne İstanbul ΣΑΣ", "x y　z", "\n-x y"]
    for t in odd_texts + list(texts(spark).values())[:60]:
        assert np.frombuffer(enc.one(t), "<u2").tolist() == ids_of(t, name), t[:60]


# --- 1 ---------------------------------------------------------------------

@pytest.mark.parametrize("ids", [[1], [5] * 200, list(range(5000)), [1, 2, 3] * 3000, [65535, 0] * 70])
def test_block_round_trip(ids):
    ids = np.array(ids, np.uint16)
    block = rangecoder.pack_block(ids, np.array([[7, 1, 0, len(ids), len(ids)]]), 1 << 16)
    got, pieces = rangecoder.unpack_block(block)
    assert (got == ids).all() and pieces.tolist() == [[7, 1, 0, len(ids), len(ids)]]
    bad = bytearray(block)
    bad[-3] ^= 1
    with pytest.raises(rangecoder.Corrupt):
        rangecoder.unpack_block(bytes(bad))


def test_repeats_code_small():
    ids = np.tile(np.random.default_rng(0).integers(0, 40000, 500), 200).astype(np.uint16)
    assert len(rangecoder.pack_block(ids, np.zeros((0, 5)), 1 << 16)) < len(ids) * 2 / 2


def test_prose_codes_below_its_order_0_entropy():
    """One full block of real ids: the adaptive contexts beat the best static code of single ids."""
    import pyarrow.parquet as pq
    enc = Encoder(path("word_bpe_49k.json"))
    prose = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].slice(0, 1200).to_pylist()
    ids = np.frombuffer(b"".join(enc.one(t or "") for t in prose), "<u2")[:rangecoder.BLOCK]
    share = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    bits = len(rangecoder.pack_block(ids, np.zeros((0, 5)), 1 << 16)) * 8 / len(ids)
    assert bits < 0.95 * -(share * np.log2(share)).sum()


def brute_tokens(rows, name):
    at, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(t or "", name)
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_op1(spark):
    got = [tuple(r) for r in E.queries()["op1_range_coded_tokens"](spark, SF).collect()]
    assert sorted(got) == brute_tokens(texts(spark).items(), "word_bpe_49k.json")


def test_op1_odd_and_long(spark, monkeypatch):
    monkeypatch.setattr(rangecoder, "BLOCK", 1000)
    name = path("word_bpe_49k.json")
    got = [tuple(r) for r in rangecoder.digest(rangecoder.write_tokens(odd(spark), name)).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute_tokens(ODD, "word_bpe_49k.json")
    assert rangecoder.digest(rangecoder.write_tokens(empty(spark), name)).count() == 0


def test_op1_rarest_id_keeps_a_share():
    model = rangecoder._Model(1 << 16)
    model.freq += 40
    model.refresh()
    least = int(rangecoder._BOT) >> rangecoder.MIX_BITS
    assert model.total <= least and model.freq.min() >= 1
    ids = np.random.default_rng(15).permutation(np.arange(1 << 16).repeat(40))[:1 << 21].astype("<u2")
    block = rangecoder.pack_block(ids, np.zeros((0, 5), np.int64), 1 << 16)
    assert (rangecoder.unpack_block(block)[0] == ids).all()


# --- 2 ---------------------------------------------------------------------

def test_op2_learns(spark):
    sf = "/root/testdata/sf0.1"
    got = E.queries()["op2_ngram_quality"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    out = [(r.score, labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for _, y, p in out]) > 0.9


def test_op2_odd(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (7, None)], "doc_id long, label int")
    got = quality.score(odd(spark), quality.fit(odd(spark), labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty(spark), quality.fit(empty(spark), labels)).count() == 0


def test_ftrl_separates():
    a, b = np.array([0, 1, 2], np.uint32), np.array([0, 3, 4], np.uint32)
    w = quality.ftrl([(a, 1.0), (b, 0.0)] * 50, bits=4)
    assert w[a].sum() > 1 and w[b].sum() < -0.5


# --- 3 ---------------------------------------------------------------------

def check_packing(rows, wanted):
    """``wanted``: multiset of (doc_id, ids)."""
    by, seqs = {}, {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert sum(sum(n for _, n in s) < 2048 for s in seqs.values()) <= 1
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.length, r.ids_crc32) for r in rows)
    total = sum(len(i) for _, i in wanted)
    assert sum(r.length for r in rows) == total
    return got


def test_op3(spark):
    rows = E.queries()["op3_curve_packing"](spark, SF).collect()
    all_ids = {d: ids_of(t, "byte_bpe_50k.json") for d, t in texts(spark).items()}
    check_packing(rows, list(all_ids.items()))
    for r in rows:
        ids = all_ids[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    # lists of pieces cover their documents
    for d, ids in all_ids.items():
        assert sorted((r.start, r.start + r.length) for r in rows if r.doc_id == d)[-1][1] == len(ids)


def test_op3_odd(spark):
    rows = curvepack.packed(odd(spark), path("byte_bpe_50k.json")).collect()
    check_packing(rows, [(d, ids_of(t or "", "byte_bpe_50k.json")) for d, t in ODD])
    assert curvepack.packed(empty(spark), path("byte_bpe_50k.json")).count() == 0


def test_hilbert_is_a_curve():
    n = 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << n)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = curvepack.hilbert(cells, n)
    assert sorted(key.tolist()) == list(range(8 ** n))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


# --- 4 ---------------------------------------------------------------------

def brute_windows(v, least):
    out = []
    for c in range(len(v)):
        l = c
        while l > 0 and v[l - 1] > v[c]:
            l -= 1
        r = c
        while r + 1 < len(v) and v[r + 1] >= v[c]:
            r += 1
        if r - l + 1 >= least:
            out.append((c, l, r))
    return out


def test_compact_windows():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1) for n in (3, 200, 0, 75, 10, 11)]
    starts = np.append(0, np.cumsum([len(p) for p in parts]))
    c, l, r = passages.compact_windows(np.concatenate(parts), starts, 10)
    want = [(a + s, b + s, e + s) for p, s in zip(parts, starts) for a, b, e in brute_windows(p.tolist(), 10)]
    assert sorted(zip(c.tolist(), l.tolist(), r.tolist())) == sorted(want)


def prose(rng, n):
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def test_op4_planted(spark):
    rng = np.random.default_rng(2)
    p, q = prose(rng, 60), prose(rng, 120)
    near = q[:50] + ["changed"] + q[51:]
    rows = [(k, " ".join(prose(rng, 80) + (p if k % 3 == 0 else []) + prose(rng, 90))) for k in range(30)]
    rows += [(100, " ".join(prose(rng, 30) + q + prose(rng, 50))), (101, " ".join(near + prose(rng, 200))), (102, " ".join(prose(rng, 300))),
             (103, " ".join(q)), (104, " ".join(q))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: r for r in got}
    assert set(found) == {k for k in range(30) if k % 3 == 0} | {100, 101, 103, 104}
    assert all(found[k].class_id == 0 for k in range(0, 30, 3)) and all(found[k].class_id == 100 for k in (100, 101, 103, 104))
    assert abs(found[100].start_word - 30) <= 6 and found[100].n_words >= 110
    assert all(abs(found[k].start_word - 80) <= 2 and found[k].n_words >= 56 for k in range(0, 30, 3))


def test_op4_two_passages(spark):
    """Two passages in one order with other text and stray common phrases between them are both found."""
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for k in range(0, 40, 2):
        p, q, stray = prose(rng, 60), prose(rng, 60), prose(rng, 7)
        edited = q[:30] + ["changed"] + q[31:]
        gap = 30 + 2 * k
        for side, last in ((k, q), (k + 1, edited)):
            a, b = prose(rng, gap // 2), prose(rng, gap - gap // 2)
            rows.append((side, " ".join(prose(rng, 40) + p + a + stray + b + last + prose(rng, 40))))
            want[side] = (40, 40 + 60 + gap + 7)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for side, starts in want.items():
        mine = [r for r in got if r.doc_id == side]
        assert all(r.class_id == side // 2 * 2 for r in mine)
        for s in starts:
            assert any(r.start_word <= s + 12 and r.start_word + r.n_words >= s + 48 and r.n_words <= 80 for r in mine), (side, s, mine)


def test_op4_common_lines(spark):
    """A passage of lines that many other texts hold alone is found, also by the texts between."""
    rng = np.random.default_rng(14)
    rows, want = [], set()
    for g in range(0, 3000, 100):
        p = [prose(rng, 20) for _ in range(3)]
        rows += [(g + k, " ".join(prose(rng, 40) + p[k % 3] + prose(rng, 40))) for k in range(1, 31)]
        rows += [(k, " ".join(prose(rng, 40) + sum(p, []) + prose(rng, 40))) for k in (g, g + 31)]
        want |= {g, g + 31}
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(1).sortWithinPartitions("doc_id")
    got = passages.repeated_passages(d).collect()
    assert {r.doc_id for r in got} == want
    assert all(r.class_id == r.doc_id // 100 * 100 and abs(r.start_word - 40) <= 2 and abs(r.n_words - 60) <= 4 for r in got)


def test_op4_links_all_pairs(spark):
    """Each of twelve texts that hold one passage has a link to each of the others."""
    rng = np.random.default_rng(17)
    p = prose(rng, 60)
    rows = [(k, " ".join(prose(rng, 40) + p + prose(rng, 40))) for k in range(12)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got) == [(k, 11, 0) for k in range(12)]


def test_op4_links_all_pairs_of_large_groups(spark):
    """Eighty texts that hold one passage, and a text that repeats itself: no link is left out."""
    rng = np.random.default_rng(18)
    p, r = prose(rng, 60), prose(rng, 3)
    rows = [(k, " ".join(prose(rng, 40) + p + prose(rng, 40))) for k in range(80)]
    rows += [(100, " ".join(prose(rng, 40) + r * 100)), (101, " ".join(r * 20 + prose(rng, 40)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got if r.doc_id < 80) == [(k, 79, 0) for k in range(80)]
    assert {r.doc_id: r.class_id for r in got if r.doc_id >= 80} == {100: 100, 101: 100}


def test_op4_runs_hold_all_pairs(monkeypatch):
    """Links of runs cover what links of all pairs of windows cover, whatever repeats, in blocks and turns too."""
    rng = np.random.default_rng(19)
    r = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    for size, turns in ((2048, 1), (3, 2)):
        monkeypatch.setattr(passages, "BLOCK", size)
        odd, common = r(1), r(70)
        loops = [np.tile(r(n), 150 // n) for n in (1, 2, 3, 20)] + [np.concatenate([np.concatenate([r(n), odd]) for n in (1, 1, 1, 4, 4, 9, 2, 2, 2)] * 6)]
        texts = [np.concatenate([r(int(rng.integers(0, 30))), loops[k % 5][:int(rng.integers(60, 150))], r(k), common[:k * 9]]) for k in range(15)]
        texts.append(np.concatenate([loops[1], loops[0], loops[1][1:], loops[0]]))
        starts, tokens = np.append(0, np.cumsum([len(t) for t in texts])), np.concatenate(texts)
        rows, want, got = [], {}, {}
        for k in (0, 1, passages.HASHES):
            if k < passages.HASHES:
                v = W.mix(tokens ^ passages._SEEDS[k])
                c, left, right = passages.compact_windows(v, starts)
                v = v[c]
            else:
                v, c = passages.exact_runs(tokens, starts)
                left, right = c, c + passages.EXACT - 1
            d = np.searchsorted(starts, c, "right") - 1
            rows.append((v.view(np.int64), d, np.full(len(c), k), c - starts[d], c - left, right - c))
        value, doc, k, c, left, right = (np.concatenate(x) for x in zip(*rows))
        for i, j in itertools.product(range(len(c)), repeat=2):
            if (k[i], value[i]) == (k[j], value[j]) and (doc[i], c[i]) > (doc[j], c[j]):
                a, b = min(left[i], left[j]), min(right[i], right[j])
                if a + b + 1 >= passages.EXACT:
                    want.setdefault((k[i], doc[i], doc[j], (c[j] - c[i]) // 16), []).append((c[i] - a, c[i] + b, c[j] - a, c[j] + b, c[j] - c[i]))
        work = passages.pieces(passages.runs(value, doc, k, c, left, right))
        assert size > 3 or any(n for _, n, _ in work)
        for _, n, run in work:
            for turn in range(turns):
                for i, j in passages._pairs(n, run, turn, turns):
                    for met in passages._met(run, i, j):
                        for kind, x, y, *span in zip(*met):
                            got.setdefault((kind, x, y, span[4] // 16), []).append(tuple(span))

        def joined(spans):
            out = []
            for a, b, oa, ob, ahead in sorted(spans):
                if out and a <= out[-1][1]:
                    out[-1] = (out[-1][0], max(b, out[-1][1]), min(oa, out[-1][2]), max(ob, out[-1][3]), min(ahead, out[-1][4]))
                else:
                    out.append((a, b, oa, ob, ahead))
            return out

        assert len(want) > 300 and {x: joined(y) for x, y in got.items()} == {x: joined(y) for x, y in want.items()}
        assert sum(map(len, got.values())) * 5 < sum(map(len, want.values()))


def test_op4_packed():
    """Columns come back from the packed form, whatever their width, and empty ones."""
    rng = np.random.default_rng(20)
    columns = [rng.integers(-2**63, 2**63, 500), np.arange(500, dtype=np.int32) * -7, rng.integers(0, 9, 500).astype(np.int8)]
    for some in (columns, [c[:0] for c in columns], [c[:1] for c in columns]):
        back = passages._decoded(passages._unpack(passages._pack(*passages._coded(some))))
        assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(some, back, strict=True))


def test_op4_whole_is_verified():
    """The test of many pairs at once says what the test of one pair says."""
    rng = np.random.default_rng(21)
    pairs = []
    for k in range(60):
        common = rng.integers(0, 40 if k % 3 else 2**63, int(rng.integers(20, 90))).astype(np.uint64)
        other = common.copy()
        other[rng.integers(0, len(other), k % 12)] = 7
        pairs.append(tuple(np.concatenate([rng.integers(100, 2**63, int(rng.integers(0, 20))).astype(np.uint64), c]) for c in (common, other)))
    pairs.append((np.arange(50, dtype=np.uint64), np.arange(50, 100, dtype=np.uint64)))
    x, y = zip(*pairs)
    got = passages._whole(np.concatenate(x).view(np.int64), np.array([len(s) for s in x]), np.concatenate(y).view(np.int64), np.array([len(s) for s in y]))
    held = 0
    for (u, v), fit, some, *rest in zip(pairs, *got):
        assert some == bool(np.isin(u, v).any())
        monkey = passages.verified(u, v, 0)
        if fit:
            held += 1
            assert [tuple(rest)] == [tuple(m) for m in monkey]
    assert 10 < held < len(pairs)


def test_exact_runs():
    """Any LEAST equal tokens have a run in common, wherever they stand."""
    rng = np.random.default_rng(15)
    r = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    for _ in range(300):
        p, texts = r(passages.LEAST), []
        for side in range(2):
            texts += [r(int(rng.integers(0, 60))), np.concatenate([r(int(rng.integers(0, 60))), p, r(int(rng.integers(0, 60)))])]
        starts = np.append(0, np.cumsum([len(t) for t in texts]))
        value, place = passages.exact_runs(np.concatenate(texts), starts)
        of = np.searchsorted(starts, place, "right") - 1
        assert set(value[of == 1].tolist()) & set(value[of == 3].tolist())
        assert ((place + passages.EXACT <= starts[of + 1]) & (place >= starts[of])).all()


def test_op4_copies(spark):
    """Texts that occur several times keep their passages beside the row of the whole text."""
    rng = np.random.default_rng(16)
    p, q = prose(rng, 60), prose(rng, 80)
    whole = " ".join(prose(rng, 50) + p + prose(rng, 50))
    rows = [(1, whole), (2, whole), (3, whole), (4, " ".join(prose(rng, 30) + p + prose(rng, 90))),
            (5, " ".join(q)), (6, " ".join(q)), (7, " ".join(prose(rng, 60) + q + prose(rng, 60)))]
    got = {(r.doc_id, r.start_word, r.n_words): (r.n_links, r.class_id) for r in passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v for k, v in got.items() if k[0] < 5} == {(d, 0, 160): (2, 1) for d in (1, 2, 3)} | {
        (d, 50, 60): (1, 1) for d in (1, 2, 3)} | {(4, 30, 60): (1, 1)}
    assert {k: v for k, v in got.items() if k[0] >= 5} == {(d, 0, 80): (2, 5) for d in (5, 6)} | {(7, 60, 80): (1, 5)}


def test_op4_odd(spark):
    got = passages.repeated_passages(odd(spark)).collect()
    assert all(r.doc_id == 5 for r in got)
    assert passages.repeated_passages(empty(spark)).count() == 0


# --- 5 ---------------------------------------------------------------------

def test_op5(spark):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, "Copyright (c) 2020 Some One\n" + mit.upper().replace(",", " ;")), (2, "prose\nReleased under the MIT Licence.\nmore prose"),
            (3, "Licensed under CC BY-NC 4.0."), (4, "nothing"), (5, None), (6, "© 2021 X\nAll rights reserved."), (None, "GPLv3")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].license_id == "MIT" and got[1].n_copyright_lines == 1
    assert got[2].license_id is None and got[2].line_licenses == "MIT" and got[2].n_license_lines == 1
    assert got[3].license_id == "CC-BY-NC-4.0" and got[4].line_licenses == "" and got[5].license_id is None
    assert got[6].n_copyright_lines == 2 and got[None].license_id == "GPL-3.0"
    assert licenses.scan(odd(spark)).count() == len(ODD) and licenses.scan(empty(spark)).count() == 0


def test_op5_whole_texts(spark):
    """Whole texts are known with a copyright line, other line breaks and cases, and without their title."""
    from importlib import resources
    folder, rows, want = resources.files("accesslake.llm") / "license_texts", [], {}
    for k in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "CC0-1.0"):
        t = (folder / f"{k}.txt").read_text("utf-8")
        forms = ["Copyright (c) 2020 Some One\n\n" + t, t.upper().replace(",", " ,")]
        if k.startswith("BSD") or k == "Zlib":
            forms += [re.sub(r"\n\n[123]\. ", "\n\n  * ", t), "(c) 2021 X\n" + t.split("\n\n", 1)[1].replace(" and ", "\n  and ")]
        if k == "Apache-2.0":
            forms += [t.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Some One"), t.split("   APPENDIX")[0]]
            forms += ["Copyright 2020 Some One\n" + t.split("[name of copyright owner]")[1]]
        if k == "GPL-2.0":
            forms += [t.split("How to Apply")[0].rstrip()]
        for f in forms:
            want[len(rows)] = k
            rows.append((len(rows), f))
    n = len(rows)
    rows += [(n, rows[0][1] + "\nand more"), (n + 1, rows[0][1][:5000])]
    got = {r.doc_id: r.license_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in want} == want, [(want[k], k) for k in want if got[k] != want[k]]
    assert got[n] is None and got[n + 1] is None


# --- 6 ---------------------------------------------------------------------

def char_set(line):
    return {line[i:i + 8] for i in range(max(1, len(line) - 7))}


def brute_lines(rows):
    found = [(d, p, l) for d, t in rows for p, l in enumerate((t or "").split("\n")) if l.strip(" ")]
    keys = sorted({l for _, _, l in found})
    sets = {k: char_set(k) for k in keys}
    pairs = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])]
    root = join(pairs, keys)
    first, gone = {}, set()
    for d, p, l in sorted(found, key=lambda r: (r[0], r[1])):
        if first.setdefault(root[l], (d, p)) != (d, p):
            gone.add((d, p))
    return gone


def test_line_signatures(spark):
    """Bands against plain Python arcs, and recall of pairs at the threshold."""
    rng = np.random.default_rng(3)
    made = ["short", "é日本 ü", "x" * 40] + ["".join(rng.choice(list("abcdefgh "), n)) for n in (9, 30, 300, 3000)]
    got = {r.line: r for r in lines.signatures(spark.createDataFrame([(l,) for l in made + made[:2]], "line string")).join(
        spark.createDataFrame([(l,) for l in made], "line string").select("line", lines._key("line")), "key").collect()}
    assert {l: r.times for l, r in got.items()} == {l: 2 if l in made[:2] else 1 for l in made}
    h = {s: x for s, x in spark.createDataFrame([(s,) for l in made for s in char_set(l)], "s string").distinct().select(
        "s", F.hash(lines._wide("s")).cast("long") + 2**31).collect()}
    assert all(len(r.bands) == lines.BANDS for r in got.values())
    arcs, circles = lines.BANDS * lines.ROWS, {}
    for l in made:
        values = sorted(h[s] for s in char_set(l))
        circles[l] = [next((x for x in values if x * arcs >> 32 >= k), values[0]) - 2**31 for k in range(arcs)]
    flat = [(l, b, [circles[l][b + r * lines.BANDS] for r in range(lines.ROWS)]) for l in made for b in range(lines.BANDS)]
    want = spark.createDataFrame(flat, "l string, b int, c array<int>").selectExpr(
        "l", "b", "xxhash64(b, " + ", ".join(f"c[{r}]" for r in range(lines.ROWS)) + ") as k").collect()
    assert {(r.l, r.b): r.k for r in want} == {(l, b): k for l, r in got.items() for b, k in enumerate(r.bands)}
    base = ["".join(rng.choice(list("abcdefghijklmnop "), 200)) for _ in range(200)]
    near = [t[:k] + "#" + t[k + 1:] for t in base for k in [int(rng.integers(20, 180))]]
    near = [t[:k] + "#" + t[k + 1:] for t in near for k in [int(rng.integers(20, 180))]]
    sig = {bytes(r.key): set(r.bands) for r in lines.signatures(spark.createDataFrame([(t,) for t in base + near], "line string")).collect()}
    import hashlib
    hit = [bool(sig[hashlib.md5(a.encode()).digest()] & sig[hashlib.md5(b.encode()).digest()]) for a, b in zip(base, near)]
    assert sum(hit) >= 0.97 * len(hit)


def test_line_recall_of_short_lines(spark):
    """Short lines at the threshold share a bucket: shingles of the smaller line over those of the larger are 0.8 to 0.82."""
    rng = np.random.default_rng(13)
    pairs = []
    for n, more in ((12, 1), (16, 2), (17, 2), (24, 4), (31, 6), (40, 8)) * 300:
        t = "".join(rng.choice(list("abcdefghijklmnop "), n + more))
        pairs.append((t[:n], t) if rng.random() < 0.5 else (t[more:], t))
    # at either side of the bounds between the two kinds of buckets
    for n in (76, 77, 83, 95, 96, 102, 103, 110) * 20:
        t = "".join(rng.choice(list("abcdefghijklmnop "), n))
        pairs.append((t[:7 + -(-(n - 7) * 82 // 100)], t))
    pairs = [(a, b) for a, b in pairs if a.strip() and len(char_set(a) & char_set(b)) * 100 >= 80 * len(char_set(a) | char_set(b))]
    assert len(pairs) > 1500
    rows = [(k, "\n".join(ab)) for k, ab in enumerate(pairs)]
    gone = {r.doc_id for r in lines.repeated(spark.createDataFrame(rows, "doc_id long, text string")).where("pos = 1").collect()}
    assert len(gone) >= 0.99 * len(pairs), len(gone) / len(pairs)


def test_op6(spark):
    rows = sorted(texts(spark).items())[:60]
    a = "this line of prose is long enough to be compared by its shingles, and it is the one that stays here"
    rows += [(9001, a + "\nshort"), (9002, "new\n" + a.replace("stays", "leave") + "\nshort"), (9003, a + "\n\n" + a)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.pos) for r in lines.repeated(d).collect()}
    want = brute_lines(rows)
    assert {(9002, 1), (9002, 2), (9003, 0), (9003, 2)} <= want and got == want
    out = {r.doc_id: r for r in lines.without_repeats(d).collect()}
    assert out[9003].text == "" and out[9003].n_dropped == 2 and out[9001].text == a + "\nshort"
    assert len(out) == len(rows)


def test_op6_odd(spark):
    out = lines.without_repeats(odd(spark))
    assert out.count() == len(ODD) and {r.doc_id for r in out.where("text is null").collect()} == {2, None}
    assert lines.without_repeats(empty(spark)).count() == 0


# --- 7 ---------------------------------------------------------------------

def test_op7(spark):
    rng = np.random.default_rng(4)
    item = prose(rng, 30)
    items = [(1, " ".join(item)), (2, "two words"), (3, None), (4, " ".join(prose(rng, 40))), (5, "")]
    rows = [(1, " ".join(prose(rng, 3000) + item + prose(rng, 3000))), (2, " ".join(item[:26]).upper()), (3, " ".join(item[:20])),
            (4, "these two words too"), (5, None), (6, ""), (None, " ".join(item))]
    got = decontam.contained(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()} == {
        (1, 1, 26, 26), (2, 1, 26, 22), (4, 2, 1, 1), (None, 1, 26, 26)}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in decontam.clean(d, spark.createDataFrame(items, "item_id long, text string")).collect()} == {3, 5, 6}


def test_op7_odd(spark):
    items = spark.createDataFrame([(1, "again again"), (1, "x y z")], "item_id long, text string")
    assert decontam.contained(odd(spark), items.where("false")).count() == 0
    assert decontam.contained(empty(spark), items).count() == 0
    assert decontam.clean(odd(spark), items.where("item_id = 9")).count() == len(ODD)


# --- 8 ---------------------------------------------------------------------

def test_op8(spark):
    import hashlib
    t = sorted(texts(spark).items())
    got = {r.doc_id: r for r in E.queries()["op8_edit_fingerprints"](spark, SF).collect()}
    assert len(got) == len(t)
    prints = {}
    for k, (d, text) in enumerate(t):
        nxt, cut = t[(k + 1) % len(t)], len(text) // 4
        edited = text[:len(text) - cut] + nxt[1][:cut]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert r.near_next == fingerprints.likeness(r.fingerprint, got[nxt[0]].fingerprint)
        codes = fingerprints._codes(edited)
        assert r.edited_fingerprint == fingerprints.fingerprint(codes, fingerprints.walk(fingerprints._classes(codes)))
    assert np.mean([r.near_edited for r in got.values()]) > 0.6 > np.mean([r.near_next for r in got.values()])


def test_op8_odd(spark):
    got = fingerprints.fingerprints(odd(spark)).collect()
    assert len(got) == len(ODD) and len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    assert fingerprints.fingerprints(empty(spark)).count() == 0
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_op8_pairs(spark):
    base = "the quick brown fox jumps over the lazy dog " * 20
    rows = [(1, base), (2, base[:-3] + "xyz"), (3, "an entirely different text " * 30), (4, base)]
    p = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in fingerprints.near_pairs(p).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}


def test_op8_pairs_beside_the_smallest(spark):
    """Two prints that are alike but unlike the smallest print of the only buckets they share."""
    size = fingerprints.SAMPLES // fingerprints.BANDS
    rng = np.random.default_rng(17)
    text = lambda n: "".join(rng.choice(list("123456789abcdef"), n))
    shared, rest = text(size), text(fingerprints.SAMPLES - size)
    # one digit of every other band differs, so the twins meet in the first band alone
    twin = "".join(c if k % size else "f" if c == "e" else "e" for k, c in enumerate(rest))
    rows = [(1, shared + "0" * len(rest)), (2, shared + rest), (3, shared + twin)]
    got = fingerprints.near_pairs(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 2, 3: 2}


# --- 9 ---------------------------------------------------------------------

def test_elias_fano():
    rng = np.random.default_rng(6)
    for x in (np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64)), np.array([0, 1, 2, 3, 64, 65], np.uint64), np.array([5], np.uint64),
              np.unique(rng.integers(0, 2000, 1500).astype(np.uint64))):
        a = ngramlm.EliasFano.arrays(x)
        ef = ngramlm.EliasFano(**a)
        assert (ef.access(np.arange(len(x))) == x).all()
        probe = np.concatenate([x, x + np.uint64(1), rng.integers(0, int(x[-1]) + 10, 500).astype(np.uint64)])
        want = [{int(v): i for i, v in enumerate(x)}.get(int(v), -1) for v in probe]
        assert ef.find(probe).tolist() == want


def test_op9(spark):
    from math import log10
    t = texts(spark)
    train = [brute_words(x) + [None] for d, x in t.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    count = {}
    for ws in train:
        for w in ws:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    gain = []
    for r in E.queries()["op9_ngram_trie_scores"](spark, SF).collect():
        ws = brute_words(t[r.doc_id]) + [None]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(ws), n, sum(w in count for w in ws))
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(log10((count.get(w, 0) + 1) / (n + v + 1)) for w in ws))
        assert r.score < 0
        if r.held_out:
            gain.append((r.score - r.base_score) / r.n_tokens)
    assert np.mean(gain) > 0


def brute_trigram(texts, query):
    """log10 probabilities of the tokens of ``query`` by the formula, without quantising."""
    from collections import Counter, defaultdict
    from math import log10
    c1, c2, c3, after, after3 = Counter(), Counter(), Counter(), defaultdict(set), defaultdict(set)
    for ws in texts:
        ws = ["</s>", *ws, "</s>"]
        c1.update(ws[1:])
        for i in range(1, len(ws)):
            c2[ws[i - 1], ws[i]] += 1
            after[ws[i - 1]].add(ws[i])
            if i > 1:
                c3[ws[i - 2], ws[i - 1], ws[i]] += 1
                after3[ws[i - 2], ws[i - 1]].add(ws[i])
    n, v = sum(c1.values()), len(c1)
    once = lambda c: sum(x == 1 for x in c.values())
    twice = lambda c: sum(x == 2 for x in c.values())
    d2, d3 = (min(0.95, max(0.1, once(c) / max(1, once(c) + 2 * twice(c)))) for c in (c2, c3))
    out, ws = [], ["</s>", *query, "</s>"]
    for i in range(1, len(ws)):
        h, w = ws[i - 1], ws[i]
        p = (c1[w] + 1) / (n + v + 1)
        if c1[h]:
            p = max(0, c2[h, w] - d2) / c1[h] + d2 * len(after[h]) / c1[h] * p
        if i > 1 and c2[ws[i - 2], h]:
            k, g = c2[ws[i - 2], h], (ws[i - 2], h)
            p = max(0, c3[(*g, w)] - d3) / k + d3 * len(after3[g]) / k * p
        out.append(log10(p))
    return out


def test_op9_brute(spark):
    """Every document of sf0.001 against the formula: the quantiser rounds down by an eighth of a halving at most."""
    from math import log10
    t = texts(spark)
    train = [brute_words(x) for d, x in t.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    scores = {r.doc_id: r for r in E.queries()["op9_ngram_trie_scores"](spark, SF).collect()}
    some = sorted(t)[::3]
    for d, want in ((d, brute_trigram(train, brute_words(t[d]))) for d in some[:12]):
        assert -2 * log10(2) / 8 * len(want) <= scores[d].score - sum(want) <= 1e-9


def test_op9_shards(spark):
    """A score does not depend on how many shards there are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "false as held", "text")
    got = [{r.doc_id: r.score for r in ngramlm.score(docs, ngramlm.train(docs, shards=k)).collect()} for k in (1, 7)]
    assert got[0].keys() == got[1].keys() and all(got[0][d] == pytest.approx(got[1][d], abs=1e-9) for d in got[0])


def test_op9_probabilities(spark):
    """Successors of a context sum to 1 at most, and the longer context decides where it was seen."""
    rows = [(k, "a b a c a b") for k in range(3)] + [(4, "b c"), (5, "x a z"), (6, "x a z")]
    model = ngramlm.train(spark.createDataFrame(rows, "doc_id long, text string"), shards=1)
    assert (model["n"], model["v"]) == (3 * 7 + 3 + 8, 6)
    last = lambda text: 10 ** ngramlm._log10(model, np.append(W.word_hashes(pa.array([text]))[1], ngramlm.END))[2][-2]
    p = {w: last(f"a {w}") for w in ("b", "c", "a", "z", "x", "zzz")}
    assert p["b"] > p["c"] > p["a"] > p["zzz"] > 0 and sum(p.values()) <= 1 + 1e-9
    assert last("x a z") > last("x a b") and last("b a c") > last("x a c")


def test_op9_odd(spark):
    assert ngramlm.lm_scores(odd(spark)).count() == len(ODD)
    assert ngramlm.lm_scores(empty(spark)).count() == 0
    nothing = ngramlm.lm_scores(odd(spark).where("doc_id is null")).collect()
    assert all(r.score == 0 and r.train_tokens == 0 for r in nothing)


# --- 10 --------------------------------------------------------------------

def brute_components(rows, size):
    sets = {d: shingle_set(brute_words(t), size) for d, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {d: (len(sets[d]), c) for d, c in join(pairs, ids).items()}


def test_op10(spark):
    rng = np.random.default_rng(8)
    base, rows = prose(rng, 200), sorted(texts(spark).items())
    for k in range(40):
        w = list(base)
        for i in rng.integers(0, 200, k % 9):
            w[i] = f"edit{rng.integers(100)}"
        rows.append((5000 + k, " ".join(w)))
    rows += [(6000, "One"), (6001, "one"), (6002, "two"), (6003, ""), (6004, " "), (6005, "A b"), (6006, "a  B")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_op10_odd(spark):
    got = neardup.near_duplicates(odd(spark), size=2).collect()
    assert len(got) == len(ODD) and neardup.near_duplicates(empty(spark), size=2).count() == 0
    kept = neardup.keep_one(odd(spark))
    assert kept.where("doc_id = 3 and text = 'again again'").count() == 1 and kept.columns == odd(spark).columns


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)
    a, b = np.unique(x[:900]), np.unique(x[100:])
    s, t = neardup.signature(a), neardup.signature(b)
    assert abs((s == t).mean() - 0.8) < 0.1


def test_copies_are_not_confirmed_once_for_each_hub(spark):
    rng = np.random.default_rng(12)
    rows = [(b, int(k)) for b in range(20) for k in rng.permutation(200)[:120]] + [(100, 1000), (100, 1001)]
    tested = []

    def confirm(pairs):
        tested.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("a < 1000")

    roots = {r.node: r.root for r in C.bucketed(spark.createDataFrame(rows, "bucket long, key long"), confirm, "test").collect()}
    assert roots == {k: 0 for k in range(200)}
    pairs = {(min(a, b), max(a, b)) for x, a in rows for y, b in rows if x == y and a != b}
    assert set(tested) <= pairs and (1000, 1001) in tested and len(tested) <= 400


def test_merged_components(spark):
    rng = np.random.default_rng(13)
    links = [[(int(a), int(b)) for a, b in rng.integers(0, 200, (60, 2)) if a != b] for _ in range(2)]
    roots = None
    for some in links:
        roots = C.merged(roots, spark.createDataFrame(some, "a long, b long"), "test")
    done = [p for some in links for p in some]
    assert {r.node: r.root for r in roots.collect()} == join(done, {k for p in done for k in p})


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in C.components(e).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert C.components(e.where("false")).count() == 0


def test_lines_that_cannot_link_are_left_out_before_the_pairs(spark):
    rng = np.random.default_rng(14)
    made = ["", "short", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for n in (12, 40, 120, 900):
        base = "".join(rng.choice(list("abcdefghij é"), n))
        made += [base] + [base[:i] + "Z" * k + base[i + k:] for k in (1, 2, 4, 9) for i in (0, n // 3, n - k)] + [base[n // c:] for c in (20, 10, 5, 4)]
    made += ["".join(rng.choice(list("abcdefghij é"), 100)) for _ in range(20)]
    made = sorted(set(made))
    t = spark.createDataFrame([(l,) for l in made], "line string").select(lines._key("line"), "line")
    info = lines._unlike(t).join(t, "key")
    got = {tuple(sorted((r.x, r.y))) for r in info.select(F.col("line").alias("x"), "info").crossJoin(
        info.select(F.col("line").alias("y"), F.col("info").alias("hub_info"))).where(lines.could_link(80)).collect()}
    sets = {l: {l[i:i + 8] for i in range(max(1, len(l) - 7))} for l in made}
    alike = {(x, y) for x in made for y in made if x < y and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    got = {p for p in got if p[0] != p[1]}
    assert alike <= got and len(alike) > 50 and len(got) < 2 * len(alike)


def test_banding_is_compiled_in_steps(spark):
    d = lines._banded(spark.createDataFrame([("a line of words",)], "line string"))
    code = d._jdf.queryExecution().debug().codegenToSeq()
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert sizes and 0 < min(sizes) and max(sizes) < 8000


# --- pipeline --------------------------------------------------------------

def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    d = docs(spark)
    n = d.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, sf)
        assert d.columns == docs(spark).columns
    assert 0.5 * n < d.count() < n
    rows = corpus_pipeline.STAGES[-1][1](spark, d, sf).collect()
    kept = {r.doc_id: r.text for r in d.collect()}
    assert {r.doc_id for r in rows} == set(kept)
    for r in rows:
        ids = ids_of(kept[r.doc_id] or "", "byte_bpe_50k.json")
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())


def test_pipeline_odd(spark):
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    d = spark.createDataFrame([(a, b, None, "s", None) for a, b in ODD], cols)
    for _, stage in corpus_pipeline.STAGES:
        d2 = stage(spark, d.where("false"), SF)
        assert d2.count() == 0
        d = stage(spark, d, SF)
    assert d.count() > 0
