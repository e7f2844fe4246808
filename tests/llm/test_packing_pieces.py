"""Packing cuts texts into pieces itself where that is sure to be the tokenizer's own way."""

import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from regpanel.llm import packing

PARTS = ["'s", "'T", "'re", "'VE", "'m", "'ll", "'d", "''", "'then", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "The", "the,", "($the)",
         "...", "\n\t", "  ", " ", "\u0085", " ", "　", "\x0b", "\x1c", "\0", "ΑΣ", "É", "é", "İ", "Ɓ", "ﬁ", "漢字", "가",
         "ª", "²", "½", "7", "x" * 70, "." * 70, "“q”", "€", "­"]


class Counting:
    def __init__(self, tokenizer, calls):
        self.tokenizer, self.calls = tokenizer, calls

    def encode(self, text, **options):
        self.calls.append(text)
        return self.tokenizer.encode(text, **options)


@pytest.fixture(scope="module")
def vocabulary():
    return packing.read_vocabulary(P.path("word_bpe_49k.json"))


def _ids(monkeypatch, encoder, texts):
    monkeypatch.setattr(packing, "word_encoder", lambda vocabulary: encoder)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rows = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    out = pa.Table.from_batches(packing._encoded(SimpleNamespace(value=b""), packing.END)(iter([rows.slice(0, 3), rows.slice(3)])))
    assert out["doc_id"].to_pylist() == [*range(len(texts))]
    return [np.frombuffer(x, dtype="<u4").tolist() for x in out["ids"].to_pylist()]


def _plain(vocabulary, texts):
    t = Tokenizer.from_str(vocabulary.decode())
    return [[*t.encode(x or "", add_special_tokens=False).ids, packing.END] for x in texts]


def test_new_words_are_asked_for_together(vocabulary, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeéß", k=9)) + rng.choice(["", ".", ","]) for _ in range(50)) for _ in range(40)]
    encoder, calls = packing.WordEncoder(vocabulary), []
    for name, value in list(vars(encoder).items()):
        if isinstance(value, Tokenizer):
            setattr(encoder, name, Counting(value, calls))
    assert _ids(monkeypatch, encoder, texts) == _plain(vocabulary, texts)
    assert len(calls) <= 10  # 2000 different words


@pytest.mark.parametrize("words, size", [(1 << 18, 4 << 20), (64, 100)])
def test_ids_are_the_tokenizers(vocabulary, monkeypatch, words, size):
    monkeypatch.setattr(packing, "CACHE_WORDS", words)
    monkeypatch.setattr(packing, "BYTES", size, raising=False)
    simple = [chr(c) for c in range(0x2200) if not 0x180 <= c < 0x2000]
    texts = [f"a{c}b{c.upper()}{c}1{c}.{c}'s{c} {c}{c}'{c}é{c}" for c in simple]
    rng = random.Random(4)
    for _ in range(2000):
        texts.append("".join(rng.choice(rng.choice([simple, PARTS, PARTS, [" "]])) for _ in range(rng.randint(0, 30))))
    texts[5:5] = [None, "", " ", None]
    assert _ids(monkeypatch, packing.WordEncoder(vocabulary), texts) == _plain(vocabulary, texts)
    assert _ids(monkeypatch, packing.WordEncoder(vocabulary), [None, ""]) == [[packing.END]] * 2


def test_other_tokenizers_get_whole_texts(vocabulary, monkeypatch):
    steps = json.loads(vocabulary)
    steps["normalizer"] = {"type": "NFC"}
    cased = json.dumps(steps).encode()
    texts = ["The CAT sat. DON'T", "the cat", None]
    assert _ids(monkeypatch, packing.WordEncoder(cased), texts) == _plain(cased, texts)
