"""Byte BPE looks up each different chunk of some rows once; chunks end where the pattern's pieces always end."""

import hashlib
import random
import unicodedata
from itertools import pairwise
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql.types import LongType

from regpanel.llm import bpe
from regpanel.llm.packing import read_vocabulary

PATH = P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["'s", "'S", "'re", "'ll", "'d", "''", "'", "'sx", "don't", "the", " The", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c",
         "\x1c", "\x1f", "\0", "\x7f", "\x85", "\xa0", "\u1680", "\u2000", "\u200a", "\u200b", "\u2028", "\u202f", "\u205f", "\u3000",
         "\ufeff", ".", ",", "!!", "...", "7", "42", "²", "½", "é", "e\u0301", "ß", "Σ", "мир", "שלום", "٣", "߷", "日本", "。", "가", "🎉", "𝐀",
         "\U000e0020", "x" * 70, "." * 70]


class Counting:
    """A pattern that counts the characters it is asked to cut."""

    def __init__(self, pattern):
        self.pattern, self.chars = pattern, 0

    def findall(self, text):
        self.chars += len(text)
        return self.pattern.findall(text)

    def finditer(self, text):
        self.chars += len(text)
        return self.pattern.finditer(text)


class Rows:
    """As much of a DataFrame as the operator asks for, its rows in this process."""

    def __init__(self, *batches):
        self.batches = batches
        self.sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda v: SimpleNamespace(value=v)))
        self.schema = {"doc_id": SimpleNamespace(dataType=LongType())}

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return pa.Table.from_batches(run(iter(self.batches)))


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(read_vocabulary(PATH)), special_tokens={})


def _batch(texts):
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _odd_texts(n):
    rng = random.Random(5)
    simple = [c for c in map(chr, range(0x800)) if unicodedata.category(c) != "Cn"]  # else the libraries' Unicode versions differ
    return ["".join(rng.choice(rng.choice([simple, PARTS, PARTS, [" "]])) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def _check(got, texts, plain):
    want = [plain.encode_ordinary(t or "") for t in texts]
    assert got["n_tokens"].to_pylist() == [len(ids) for ids in want]
    assert got["ids_sha256"].to_pylist() == [hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() for ids in want]
    assert got["decoded_sha256"].to_pylist() == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]


def test_words_met_again_are_not_cut_again(spark, plain, monkeypatch):
    encoder = bpe.Encoder(read_vocabulary(PATH), P.PATTERN)
    encoder.pattern = counting = Counting(encoder.pattern)
    monkeypatch.setattr(bpe, "encoder", lambda vocabulary, pattern: encoder)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeéß", k=9)) for _ in range(100)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", ","]) for _ in range(100)) for _ in range(100)]
    _check(bpe.round_trip(Rows(_batch(texts)), PATH, P.PATTERN), texts, plain)
    assert counting.chars < sum(map(len, texts)) / 20


@pytest.mark.parametrize("size", [8 << 20, 200])
def test_ids_of_rows_together_are_tiktokens(spark, plain, monkeypatch, size):
    assert bpe.KNOWN == P.PATTERN
    monkeypatch.setattr(bpe, "BYTES", size)
    texts = _odd_texts(4000)
    texts[5:5] = [None, "", " ", None]
    rows = _batch(texts)
    _check(bpe.round_trip(Rows(rows.slice(0, 7), rows.slice(7)), PATH, P.PATTERN), texts, plain)
    _check(bpe.round_trip(Rows(_batch([None, "", None]), _batch([])), PATH, P.PATTERN), [None, "", None], plain)
    coded = bpe.encode(Rows(rows), PATH, P.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in coded["ids"].to_pylist()] == [plain.encode_ordinary(t or "") for t in texts]


def test_chunks_have_the_pieces_of_the_text():
    import regex
    cutter, pattern = bpe.Cutter(), regex.compile(P.PATTERN)

    def chunks(text):
        data = text.encode()
        at = [0, *(1 + np.flatnonzero(cutter.cut(np.frombuffer(data, np.uint8))[1:])).tolist(), len(data)]
        return [data[i:j].decode() for i, j in pairwise(at)]
    for text in _odd_texts(4000):
        assert [p for c in chunks(text) for p in pattern.findall(c)] == pattern.findall(text)
    text = "The cat, été мир 42 x7. New (line) 日本 " * 60000  # some million bytes
    assert chunks(text) == pattern.findall(text)


def test_other_patterns_cut_whole_texts(spark, plain, monkeypatch):
    pattern = r"\S+\s\S+|\s|\S"
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(read_vocabulary(PATH)), special_tokens={})
    texts = ["the cat, the dog", "a  b", None]
    _check(bpe.round_trip(Rows(_batch(texts)), PATH, pattern), texts, own)


@pytest.mark.parametrize("n", [1, bpe.FEW, bpe.FEW + 1, 1000])
def test_few_and_many_ids_are_decoded_alike(n):
    encoder = bpe.Encoder(read_vocabulary(PATH), P.PATTERN)
    ids = list(range(n))
    assert bpe.Decoder(encoder).feed(np.array(ids, "<u4").tobytes(), True) == b"".join(
        encoder.machine.tokens[i] for i in ids).decode(errors="replace")
    with pytest.raises((IndexError, ValueError)):
        bpe.Decoder(encoder).feed(np.array([len(encoder.bytes)] * n, "<u4").tobytes())
