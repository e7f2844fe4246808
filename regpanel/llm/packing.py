"""Concatenate-and-cut packing.

All documents' tokens stand in one line, which is cut every ``length`` tokens;
only the last sequence is short.  Pass one tokenizes each partition once and
writes ids with running token totals; the per-partition totals give global
offsets; pass two cuts every document at the window borders, so a document
across a border leaves one boundary piece on either side.

The tokenizer's pattern cuts lower-case text into pieces whose ids do not
depend on what is around them.  Where a text's characters are ones for which
lower case and character classes are beyond doubt, it is cut here at borders
where pieces always end, by Arrow for some rows at once, and each different
word of these rows is looked up once.  In other texts, words with other
characters go to the tokenizer whole.  A cache of two generations holds the ids
of words seen before: words that are met again move to the new one, and the old
one goes as a whole.  New pieces are asked for together.  Workers outlive their
tasks, so the cache is kept small, and a task's rows are encoded a few at a time.

Defined cases: a null or empty text is one end token; long texts are cut as
often as needed; repeated rows are packed one by one; an empty table gives no
pieces; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.common import Scratch
from regpanel.llm.prefix import partition_bases

LENGTH = 4096
END = 2
MAX_VOCABULARY_BYTES = 64 << 20  # what is broadcast: the tokenizer's file
CACHE_WORDS = 1 << 18  # of a generation
ROWS, BYTES = 256, 4 << 20  # encoded at once
PIECES = 1 << 16  # of a text, looked up at once
TOGETHER = 8  # new pieces that one call is made for
LETTERS, NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
OTHERS = "\0-\x08\x0e-\x1f!-/:-@\\[-`{-\x7f\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u20ac"  # but spaces
# the tokenizer's pattern for lower-case texts without UNSAFE characters
PIECE = re.compile(f"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[{OTHERS}]+")
# what NFC, lower case and the classes of Unicode's versions do not leave as simple
UNSAFE = re.compile("[^\0-\x7f\xa0-\u012f\u0131-\u017f\u2010-\u2027\u20ac]")
SPACE = re.compile("[ \n\t\r]")
# between which pieces always end: before letters, an apostrophe may belong to them
BORDERS = [f"([{LETTERS}])([{OTHERS}])", f"([{OTHERS.replace('!-/', '!-&(-/')}])([{LETTERS}])"]
KNOWN = [  # the tokenizer's steps for which all this holds
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        self.old: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = t = Tokenizer.from_str(vocabulary.decode())
        self.plain = Tokenizer(t.model)  # for pieces between spaces, which are normal already
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known = [x and json.loads(x.__getstate__()) for x in (t.normalizer, t.pre_tokenizer)] == KNOWN
        self.added = [a.content for a in t.get_added_tokens_decoder().values()]
        self.ends = np.array([(t.id_to_token(i) or "").endswith("</w>") for i in range(t.get_vocab_size())])

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = _packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 64:
            if len(self) >= CACHE_WORDS:
                self._age()
            self[piece] = ids
        return ids

    def _age(self) -> None:
        self.old = dict(self)
        self.clear()

    def _learn(self, pieces: list[str]) -> None:
        """Asks for many pieces at once: each has one id that ends it."""
        data = _packed(self.plain.encode(" ".join(pieces), add_special_tokens=False).ids)
        at = 4 * np.flatnonzero(self.ends[np.frombuffer(data, dtype="<u4")]) + 4
        self.update(zip(pieces, [data[i:j] for i, j in pairwise([0, *at.tolist()])], strict=True))

    def _pieces(self, text: str) -> list[str]:
        """A text's pieces, and whole words where the pattern here may not be the tokenizer's."""
        if not self.known:
            return [text]
        if any(token in text for token in self.added):
            return SPACE.split(text)
        if text.isascii() or not UNSAFE.search(text):
            return PIECE.findall(text.lower())
        return [p for word in SPACE.split(text) for p in ([word] if UNSAFE.search(word) else PIECE.findall(word.lower()))]

    def _some(self, pieces: list[str]) -> list[bytes]:
        got = list(map(self.get, pieces))
        at = [i for i, ids in enumerate(got) if ids is None]
        if at:
            new = {p for i in at if len(p := pieces[i]) <= 64}
            if len(self) + len(new) > CACHE_WORDS:
                self._age()
            old, ask = self.old, []
            for p in new:
                ids = old.pop(p, None)
                if ids is not None:
                    self[p] = ids
                elif p.isalpha() and self.known and PIECE.fullmatch(p):
                    ask.append(p)
            if len(ask) >= TOGETHER:
                self._learn(ask)
            for i in at:
                got[i] = self[pieces[i]]
        return got

    def _all(self, pieces: list[str]) -> list[bytes]:
        return [ids for i in range(0, len(pieces), PIECES) for ids in self._some(pieces[i:i + PIECES])]

    def encode(self, text: str) -> bytes:
        return b"".join(self._all(self._pieces(text)))

    def _simple(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without UNSAFE characters, each of their words looked up once."""
        t = pc.utf8_lower(texts)
        for space in "\n\t\r":
            t = pc.replace_substring(t, space, " ")
        for border in BORDERS:
            t = pc.replace_substring_regex(t, border, r"\1 \2")
        words = pc.split_pattern(t, " ")
        coded = words.flatten().dictionary_encode()
        ids = pa.array(self._all(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(coded.indices)
        at = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])[words.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[i:j]) for i, j in pairwise(at)]

    def encode_rows(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, UNSAFE.pattern) if self.known else pa.array([True] * len(texts))
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        simple = iter(self._simple(texts.filter(pc.invert(odd))))
        return [self.encode(t.as_py()) if o else next(simple) for t, o in zip(texts, odd.to_pylist(), strict=True)]


_encoders: dict[int, WordEncoder] = {}


def word_encoder(vocabulary: bytes) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(vocabulary)
    return _encoders[key]


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Starts and lengths of runs of rows, of BYTES at most unless of one row."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and (i - start == ROWS or size + n > BYTES):
            yield start, i - start
            start, size = i, 0
        size += n
    if len(texts):
        yield start, len(texts) - start


def _encoded(vocabulary, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = word_encoder(vocabulary.value), np.array([end], dtype="<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for b in (b.slice(i, n) for b in batches for i, n in _groups(b.column("text"))):
            ids = [got + tail for got in enc.encode_rows(b.column("text"))]
            n = [len(got) // 4 for got in ids]
            *at, before = accumulate(n, initial=before)
            cols = [b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                    pa.array([part] * len(n), pa.int32()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "n", "part", "before"])
        pa.default_memory_pool().release_unused()
    return run


def _cut(length: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, out = [], []
            for i, (ids, n, at) in enumerate(zip(b.column("ids"), b.column("n").to_pylist(),
                                                 b.column("at").to_pylist(), strict=True)):
                data, s = memoryview(ids.as_buffer()), 0
                while s < n:
                    seq, off = divmod(at + s, length)
                    e = min(n, s + length - off)
                    piece = data[4 * s:4 * e]
                    row.append(i)
                    out.append((s, e - s, zlib.crc32(piece), n, seq, off, *[bytes(piece)] * with_ids))
                    s = e
            cols = [b.column("doc_id").take(pa.array(row, pa.int64()))]
            types = [pa.int64()] * 6 + [pa.binary()] * with_ids
            cols += [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(types), types, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pack(docs: DataFrame, vocabulary_path: str, length: int = LENGTH, end: int = END, doc_id: str = "doc_id",
         text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and the ids, little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    scratch = Scratch(spark, "packing")
    coded = scratch.save(d.mapInArrow(_encoded(vocabulary, end), f"doc_id {id_type}, ids binary, n long, part int, before long"),
                         "encoded")
    bases, _, _ = partition_bases(coded, "n")
    at = coded.join(F.broadcast(bases), "part").select("doc_id", "ids", "n", (F.col("base") + F.col("before")).alias("at"))
    schema = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids binary" * with_ids)
    return at.mapInArrow(_cut(length, with_ids), schema)


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids: a sequence's pieces in order, padded to
    ``length`` unless its own length is a power of two."""
    s = (pieces.groupBy("sequence_id")
         .agg(F.array_sort(F.collect_list(F.struct("offset", "length", F.hex("ids").alias("ids")))).alias("p"),
              F.sum("length").alias("n_tokens")))
    fill = F.lit(np.array([pad], dtype="<u4").tobytes().hex())
    whole = F.array_join(F.transform("p", lambda x: x["ids"]), "")
    power = F.bit_count(F.col("n_tokens")) == 1
    ids = F.when(power, whole).otherwise(F.concat(whole, F.repeat(fill, (F.lit(length) - F.col("n_tokens")).cast("int"))))
    return s.select("sequence_id", "n_tokens", F.unhex(ids).alias("ids"))
