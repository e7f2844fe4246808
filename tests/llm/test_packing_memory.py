"""What packing keeps in a Python worker, which outlives the task."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from regpanel.llm import packing
from regpanel.llm.common import components
from regpanel.llm.prefix import partition_bases


class Counting:
    """A tokenizer that counts the words it is asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode(self, word, **options):
        self.asked.append(word)
        return self.tokenizer.encode(word, **options)


@pytest.fixture(scope="module")
def vocabulary():
    return packing.read_vocabulary(P.path("word_bpe_49k.json"))


def test_the_cache_holds_two_generations_and_keeps_words_in_use(vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 64)
    encoder, plain = packing.WordEncoder(vocabulary), Tokenizer.from_str(vocabulary.decode())
    encoder.tokenizer = count = Counting(encoder.tokenizer)
    rng = random.Random(5)
    for i in range(1000):
        text = f"often w{i}x{rng.randint(0, 9)} Often, É{i}"
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder) + len(encoder.old) <= 2 * 64
    assert count.asked.count("often") == 1



def test_rows_are_encoded_a_few_at_a_time(vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 7)))
    texts = [None if i % 11 == 0 else f"some words of text {i}" for i in range(3 * packing.ROWS + 5)]
    rows = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    empty = rows.slice(0, 0)
    out = list(packing._encoded(SimpleNamespace(value=vocabulary), packing.END)(iter([empty, rows, empty, rows.slice(3, 4)])))
    assert max(b.num_rows for b in out) <= packing.ROWS
    got = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in got] == [*range(len(texts)), 3, 4, 5, 6]
    plain, before = Tokenizer.from_str(vocabulary.decode()), 0
    for r in got:
        ids = [*plain.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, packing.END]
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids
        assert (r["n"], r["part"], r["before"]) == (len(ids), 7, before)
        before += len(ids)


def _unpickles(df) -> bool:
    return "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_bases_and_empty_components_start_no_second_set_of_workers(spark):
    rows = spark.createDataFrame([(0, 5), (0, 7), (3, 1)], "part int, n long")
    bases, count, total = partition_bases(rows, "n")
    assert bases.schema.simpleString() == "struct<part:int,base_row:bigint,base:bigint>" and not _unpickles(bases)
    assert sorted(map(tuple, bases.collect())) == [(0, 0, 0), (3, 2, 12)] and (count, total) == (3, 13)
    none, count, total = partition_bases(rows.where("n < 0"), "n")
    assert none.collect() == [] and (count, total) == (0, 0)
    alone = components(spark, spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"))
    assert alone.schema.simpleString() == "struct<id:bigint,component:bigint>" and alone.collect() == [] and not _unpickles(alone)
