"""Byte-level BPE through a table of distinct words.

Encoding: texts are cut into words in Spark tasks, the way the tokenizer file
cuts them.  A block of neighbouring texts keeps each of its words once and
holds its texts as positions in that list.  The lists, dealt by a hash of the
word, meet in tasks that each own some hash values: the word table.  There
every distinct word is encoded once, by the ``tokenizers`` library's merge
model.  The ids go back to the blocks and are joined to the texts by position.
Neither texts nor single words are shuffled: a block sends one packed list to
each hash value and gets one packed list of ids back.

Decoding joins ids to the pieces of the vocabulary by position and joins the
pieces' bytes.  The vocabulary has a fixed size (``MAX_VOCABULARY``, checked),
so it is broadcast.

The positions are ranks by count, words that occur once in a block share one
code: that makes them small.  A word comes once from each block at most, however often it occurs; a block
holds about ``BLOCK`` characters (or one longer text).  A task of the word
table holds its share of the distinct words, which shrinks as the session's
shuffle partitions grow.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, stored, text_of, tuned

BLOCK = 24_000_000
MAX_VOCABULARY = 1 << 20
#: Hash values for each shuffle partition, so that the partitions get nearly equal shares.
SHARES = 4
#: Between words in a packed list: a byte that UTF-8 does not have.
BETWEEN = b"\xff"
_LEVEL = 6
#: Texts of a block put together at once.
CHUNK_DOCS = 500
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: One character of each class (letter, number, white space, other), for those beyond the BMP.
_STAND_IN = {"L": "\xe4", "N": "1", "S": "　", "O": "!"}


def load(path: str):
    """The library's tokenizer without truncation and padding; its parts must be those this module knows."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    if t.normalizer is not None or type(t.pre_tokenizer).__name__ != "ByteLevel" or t.pre_tokenizer.add_prefix_space:
        raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
    if t.get_vocab_size() > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} pieces")
    if any(a.lstrip or a.rstrip or a.single_word for a in t.get_added_tokens_decoder().values()):
        raise ValueError("special tokens that take in their surroundings are not known here")
    return t


def classes(tokenizer, chars: list[str]) -> list[str]:
    """Letter, number, space or other: what the tokenizer's own cutting takes each character for."""
    probe = "".join(f"a{c}1{c}!" for c in chars)
    cuts = np.zeros(len(probe) + 1, bool)
    cuts[[span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(probe)]] = True
    cuts = cuts[:-1].reshape(-1, 5)  # a cut before a, c, 1, c, !
    found = np.where(~cuts[:, 1], "L", np.where(~cuts[:, 2], "N", np.where(~cuts[:, 4], "O", "S"))).tolist()
    return ["S" if c == " " else k for c, k in zip(chars, found)]


def _ranges(codes: list[int]) -> str:
    out, start = [], 0
    for i in range(1, len(codes) + 1):
        if i == len(codes) or codes[i] != codes[i - 1] + 1:
            out.append(f"{re.escape(chr(codes[start]))}-{re.escape(chr(codes[i - 1]))}")
            start = i
    return "".join(out)


class Splitter:
    """``words(text)``: the words whose ids, one after another, are the text's ids."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        bmp = [*range(0xD800), *range(0xE000, 0x10000)]
        by = {"L": [], "N": [], "S": [], "O": []}
        for c, k in zip(bmp, classes(tokenizer, [chr(c) for c in bmp])):
            by[k].append(c)
        letter, number, space = (_ranges(by[k]) for k in "LNS")
        # fixed values: the cutting rule of byte-level vocabularies
        self.rule = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{space}]+"
                               f"|[{space}]+(?![^{space}])|[{space}]+")
        special = sorted((a.content for a in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.astral: dict[int, str] = {}

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not _ASTRAL.search(text):
            return self.rule.findall(text)
        new = [c for c in set(_ASTRAL.findall(text)) if ord(c) not in self.astral]
        for c, k in zip(new, classes(self.tokenizer, new) if new else ()):
            self.astral[ord(c)] = _STAND_IN[k]
        return [text[m.start():m.end()] for m in self.rule.finditer(text.translate(self.astral))]

    def words(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out: list[str] = []
        for i, segment in enumerate(self.special.split(text)):
            out += [segment] if i % 2 else self._plain(segment)
        return out


_cached: dict = {}


def _once(kind, path: str):
    """One tokenizer or splitter a worker process."""
    if (kind, path) not in _cached:
        _cached[kind, path] = load(path) if kind == "tokenizer" else Splitter(_once("tokenizer", path))
    return _cached[kind, path]


class _Positions(dict):
    """Word to its position in the block's list, in order of appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _pack(*parts: bytes) -> bytes:
    """The parts' sizes, then the parts compressed together."""
    return np.array([len(parts), *map(len, parts)], "<u8").tobytes() + pa.Codec("zstd", _LEVEL).compress(b"".join(parts), asbytes=True)


def _unpack(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    size = np.frombuffer(data, "<u8", n, 8).astype(np.int64)
    whole = pa.decompress(data[8 + 8 * n:], int(size.sum()), "zstd", asbytes=True)
    ends = np.cumsum(size).tolist()
    return [whole[e - k:e] for e, k in zip(ends, size.tolist())]


def _planes(values: np.ndarray) -> bytes:
    """All first bytes of the 32-bit values, then all second bytes, and so on: they compress better apart."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _ranked(at: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, codes)``: words by falling count, those that occur once last, in order of appearance.

    A repeated word's code is its rank from 1 on; a word that occurs once has
    code 0, its rank follows from the order.
    """
    count = np.bincount(at, minlength=n_words)
    often = np.flatnonzero(count > 1)
    often = often[np.argsort(-count[often], kind="stable")]
    code = np.zeros(n_words, np.uint32)
    code[often] = np.arange(1, len(often) + 1)
    return np.concatenate([often, np.flatnonzero(count == 1)]), code[at]


def _ranks(codes: np.ndarray, n_words: int) -> np.ndarray:
    """The rank of each position's word, from ``_ranked``'s codes."""
    once = codes == 0
    return np.where(once, n_words - int(once.sum()) + np.cumsum(once) - 1, codes.astype(np.int64) - 1)


def _deal(words: list[str], shares: int) -> tuple[np.ndarray, list[dict]]:
    """Each word's hash value, and one packed list of words for each value."""
    raw = [w.encode() for w in words]
    share = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % shares
    order = np.argsort(share, kind="stable")
    first = np.flatnonzero(np.diff(share[order], prepend=-1))
    lists = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(raw)]):
        lists.append({"share": int(share[order[a]]), "base": a, "packed": _pack(BETWEEN.join([raw[i] for i in order[a:b].tolist()]))})
    return share, lists


def split_blocks(docs: DataFrame, path: str, block_chars: int = BLOCK) -> DataFrame:
    """One row a block of texts: block, docs (their doc_ids), sizes (words of each), positions (packed), lists of its words by hash value."""
    shares = SHARES * partitions(tuned(docs.sparkSession))

    def run(batches):
        cut, part, n = _once("splitter", path).words, TaskContext.get().partitionId(), 0
        ids, sizes, at, chars, where = [], [], array("I"), 0, _Positions()

        def flush():
            words = list(where)
            order, codes = _ranked(np.frombuffer(at, np.uint32), len(words))
            share, lists = _deal([words[i] for i in order.tolist()], shares)
            positions = _pack(_planes(codes), _planes(share))
            return pa.RecordBatch.from_pylist(
                [{"block": (part << 32) + n, "docs": ids, "sizes": sizes, "positions": positions, "lists": lists}], schema)

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py()
                words = cut(text)
                at.extend(map(where.__getitem__, words))
                ids.append(doc)
                sizes.append(len(words))
                chars += len(text)
                if chars >= block_chars:
                    yield flush()
                    n += 1
                    ids, sizes, at, chars, where = [], [], array("I"), 0, _Positions()
        if ids:
            yield flush()

    one = pa.struct([("share", pa.int64()), ("base", pa.int64()), ("packed", pa.binary())])
    schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("positions", pa.binary()),
                        ("lists", pa.list_(one))])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "block long, docs array<long>, sizes array<long>, positions binary,"
                                " lists array<struct<share: long, base: long, packed: binary>>")


def _alphabet() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}  # fixed values
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _WordTable(dict):
    """Word to its ids; a word is encoded when it is first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.merge, self.letters = tokenizer.model.tokenize, _alphabet()
        for i, a in tokenizer.get_added_tokens_decoder().items():
            self[a.content.encode()] = np.array([i], "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = array("I", [x.id for x in self.merge(word.decode("latin-1").translate(self.letters))]).tobytes()
        return ids


def encode_words(lists: DataFrame, path: str) -> DataFrame:
    """block, base, ids (packed) for each row of ``lists`` (block, share, base, packed): the ids of its words, in order.

    All lists of a hash value come to one task, so each distinct word of the
    table is encoded once.
    """
    def run(batches):
        table = _WordTable(_once("tokenizer", path))
        for b in batches:
            out = []
            for packed in b.column("packed").to_pylist():
                found = [table[w] for w in _unpack(packed)[0].split(BETWEEN)]
                ids = np.frombuffer(b"".join(found), "<u4")
                out.append(_pack(_planes(ids), _planes(np.fromiter(map(len, found), "<u4", len(found)) // 4)))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("base"), pa.array(out, pa.binary())], names=["block", "base", "ids"])

    return lists.repartition(partitions(lists.sparkSession), "share").select("block", "base", "packed").mapInArrow(
        run, "block long, base long, ids binary")


def gather(flat: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, ends)``: the items ``flat[offsets[k]:offsets[k + 1]]`` for each k wanted, one after another."""
    size = (offsets[1:] - offsets[:-1])[wanted]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[wanted] - (ends - size), size) + np.arange(total)], ends


def _assemble(batches):
    for b in batches:
        known = b.column("known")
        for i in range(b.num_rows):
            docs, sizes = b.column("docs")[i].as_py(), np.array(b.column("sizes")[i].as_py(), np.int64)
            codes, share = map(_values, _unpack(b.column("positions")[i].as_py()))
            flat, offsets, ranks = np.empty(0, "<u4"), np.zeros(1, np.int64), np.empty(0, np.int64)
            if len(codes):
                parts = [[_values(p) for p in _unpack(k["ids"])] for k in known[i].as_py()]  # in the order of base
                place = np.empty(len(share), np.int64)
                place[np.argsort(share, kind="stable")] = np.arange(len(share))
                flat, offsets = np.concatenate([p[0] for p in parts]), np.append(0, np.cumsum(np.concatenate([p[1] for p in parts]), dtype=np.int64))
                ranks = place[_ranks(codes, len(share))]
            first = np.append(0, np.cumsum(sizes))
            for a in range(0, len(docs), CHUNK_DOCS):
                own = first[a:a + CHUNK_DOCS + 1]
                values, after = gather(flat, offsets, ranks[own[0]:own[-1]])
                ends = 4 * np.append(0, after)[own - own[0]]
                ids = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(docs[a:a + CHUNK_DOCS], pa.int64()), ids.cast(pa.binary())], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, block_chars: int = BLOCK) -> DataFrame:
    """doc_id, ids (little-endian 32-bit) of every row's whole text, as the library encodes it.

    One row comes back for each row of ``docs``, repeated and null doc_ids
    included; a null text is the empty text and has no ids; a long text is one
    row, its words in one block; extra columns are ignored; an empty table
    gives an empty one.  The strings of special tokens in a text become their
    ids, as in the library.
    """
    blocks = stored(split_blocks(docs, path, block_chars), "word-blocks")
    lists = blocks.select("block", F.explode("lists").alias("x")).select("block", "x.share", "x.base", "x.packed")
    found = encode_words(lists, path).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("base", "ids"))).alias("known"))
    whole = blocks.drop("lists").join(found, "block", "left")
    return whole.select("docs", "sizes", "positions", "known").mapInArrow(_assemble, "doc_id long, ids binary")


def pieces(path: str) -> list[bytes]:
    """The bytes of every id's piece; ids without a piece have none, as the library's decoder skips them."""
    t = load(path)
    byte = {c: b for b, c in _alphabet().items()}
    vocabulary = t.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, i in vocabulary.items():
        out[i] = bytes(map(byte.__getitem__, piece)) if all(c in byte for c in piece) else piece.encode()
    return out


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns of ``rows`` and text: the pieces of ``ids`` (little-endian 32-bit) joined.

    Special tokens stay in the text.  Null ids are no ids; ids outside the
    vocabulary are skipped; bytes that are not UTF-8 become U+FFFD, as in the
    library.  ``rows`` may not have a column ``text``.
    """
    spark: SparkSession = tuned(rows.sparkSession)
    if "text" in rows.columns:
        raise ValueError("rows have a column text")
    shared = spark.sparkContext.broadcast(pieces(path))

    def run(batches):
        known = shared.value
        flat = np.frombuffer(b"".join(known), np.uint8)
        off = np.zeros(len(known) + 2, np.int64)  # one empty piece more, for ids outside
        np.cumsum([len(p) for p in known], out=off[1:-1])
        off[-1] = off[-2]
        for b in batches:
            texts = []
            for value in b.column(ids):
                at = np.frombuffer(value.as_py() or b"", "<u4")
                texts.append(gather(flat, off, np.minimum(at, len(known)).astype(np.int64))[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from its ids."""
    back = decode(encode(docs, path), path)
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
