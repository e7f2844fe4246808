"""Word-level BPE by a prefix-sharing trie traversal.

A text is cut into words as the tokenizer cuts it, and the distinct words of a
block of texts are put into a trie.  The trie is walked depth first, and every
node, that is every prefix of a word, gets its last-token state: the one token
that ends the prefix's encoding.  It is the token that ends there, is its own
encoding and may stand behind the last token of the prefix before it (Berglund
and van der Merwe, "Formalizing BPE Tokenization", 2023).  A word's ids are
read off the states on its path, so a prefix that many words share is encoded
once.  The trie is kept as its words in order with the length that each shares
with the path before it: the walk needs nothing else, and a very long word
costs a few lists of its length.

A word's last symbol carries the end mark, so it is another symbol than the
same letter inside a word; a word that begins another one shares all but that.

Defined cases: null and empty texts and texts of white space have no tokens;
special tokens written out in a text are those tokens, as the tokenizer reads
them; long texts and long words are encoded whole; repeated rows give one
result each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.packing import read_vocabulary

BLOCK_CHARS = 4 << 20  # texts whose new words go through one trie together
CACHE_CHUNKS = 1 << 19
MAX_PAIRS = 1 << 19
_END = 1 << 10  # added to the code of a word's last symbol


class WordBpe:
    """The merges of a word BPE file, with the walk over the trie of words."""

    def __init__(self, vocabulary: bytes):
        import regex
        from tokenizers import Tokenizer
        spec = json.loads(vocabulary)
        model = spec["model"]
        plain = (model["type"] == "BPE" and model.get("end_of_word_suffix")
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback",
                                                    "ignore_merges")))
        added = spec["added_tokens"]
        if not plain or any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("only word BPE with an end mark and plain special tokens is read")
        self._merges(model)
        self._trie()
        self.pairs: dict[int, bool] = {}
        self.special = {a["content"]: str(a["id"]) for a in added}
        self.token = {str(i): t for t, i in model["vocab"].items()} | {str(a["id"]): a["content"] for a in added}
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
                                   ) if added else None
        tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.normalizer, self.cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.chunks: dict[str, str] = {}

    # ------------------------------------------------------------ the machine

    def _merges(self, model: dict) -> None:
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}  # 0 for single symbols
        self.merged: dict[tuple[int, int], int] = {}
        made = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in map(_pair, model["merges"])}
        if len(made) != len(model["merges"]):
            raise ValueError("two merges give the same token")
        self.symbols: dict[int, str] = {}
        for t, i in vocab.items():
            if i not in made:
                self.symbols[i] = t if len(t) == 1 else chr(ord(t.removesuffix(mark)) + _END)
                self.rank[i] = 0
        self.own = set(self.symbols)
        for k, (a, b) in enumerate(map(_pair, model["merges"]), 1):
            t, left, right = vocab[a + b], vocab[a], vocab[b]
            self.parts[t], self.rank[t], self.merged[left, right] = (left, right), k, t
            self.symbols[t] = self.symbols[left] + self.symbols[right]
        for t, (left, right) in self.parts.items():
            if left in self.own and right in self.own and not self._crossed(left, right, self.rank[t]):
                self.own.add(t)

    def _crossed(self, a: int, b: int, before: int) -> bool:
        """Whether a merge crosses the border of the tokens a and b, with all
        merges at hand ranked below ``before``: the merges beside the border
        are taken back, latest first, and a crossing one must be older."""
        rank, parts = self.rank, self.parts
        while True:
            t = self.merged.get((a, b))
            if t is not None and rank[t] < before:
                return True
            if not rank[a] and not rank[b]:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], parts[a][1]
            else:  # of equal merges the left one comes first, here the crossing one
                before, b = rank[b] + 1, parts[b][0]

    def _trie(self) -> None:
        """Trie of the tokens with suffix links; moves and ends are made when first needed."""
        child: list[dict[str, int]] = [{}]
        token: list[int] = [-1]
        for t in self.own:
            v = 0
            for c in self.symbols[t]:
                w = child[v].get(c)
                if w is None:
                    w = child[v][c] = len(child)
                    child.append({})
                    token.append(-1)
                v = w
            token[v] = t
        link, queue = [0] * len(child), deque(child[0].values())
        while queue:
            v = queue.popleft()
            for c, w in child[v].items():
                f = link[v]
                while f and c not in child[f]:
                    f = link[f]
                link[w] = child[f].get(c, 0)
                queue.append(w)
        self.child, self.link, self.token_at = child, link, token
        self.moves: dict[tuple[int, str], int] = {}
        self.ends: dict[int, list[tuple[int, int]]] = {}

    def _move(self, state: int, c: str) -> int:
        """The longest suffix, once c is read, that a token may go on from."""
        v = state
        while v and c not in self.child[v]:
            v = self.link[v]
        to = self.child[v][c]
        if to not in self.ends:
            out, u = [], to
            while u:
                if self.token_at[u] >= 0:
                    out.append((len(self.symbols[self.token_at[u]]), self.token_at[u]))
                u = self.link[u]
            self.ends[to] = out
        if len(self.moves) >= MAX_PAIRS:
            self.moves.clear()
        self.moves[state, c] = to
        return to

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of distinct words, in the depth-first order of their trie."""
        moves, ends, pairs = self.moves, self.ends, self.pairs
        state, last, size, path = [0], [-1], [0], ""  # of every prefix of the path
        for word in sorted(w[:-1] + chr(ord(w[-1]) + _END) for w in words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del state[shared + 1:], last[shared + 1:], size[shared + 1:]
            for i in range(shared, len(word)):
                c = word[i]
                to = moves.get((state[i], c))
                if to is None:
                    to = self._move(state[i], c)
                for n, t in ends[to]:
                    before = last[i + 1 - n]
                    if before < 0:
                        break
                    key = before << 32 | t
                    stays = pairs.get(key)
                    if stays is None:
                        if len(pairs) >= MAX_PAIRS:
                            pairs.clear()
                        stays = pairs[key] = not self._crossed(before, t, 1 << 62)
                    if stays:
                        break
                state.append(to)
                last.append(t)
                size.append(n)
            path, ids, i = word, [], len(word)
            while i:
                ids.append(last[i])
                i -= size[i]
            yield word[:-1] + chr(ord(word[-1]) - _END), ids[::-1]

    # ------------------------------------------------------------ texts

    def _words(self, chunk: str) -> list[str]:
        """The words of a run of characters without blanks, in the byte alphabet of the vocabulary."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        return [w for w, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(chunk))]

    def _cut(self, text: str) -> list[str]:
        return [c for c in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if c]

    def _segments(self, text: str) -> list[str]:
        """The text's chunks; a special token is a chunk of its own."""
        if self.split is None or not any(s in text for s in self.special):
            return self._cut(text)
        out: list[str] = []
        for i, s in enumerate(self.split.split(text)):
            out += [s] if i % 2 else self._cut(s)
        return out

    def encode(self, block: list[str]) -> Iterator[str]:
        """Every text's ids, as decimals joined by one space."""
        cut = [self._segments(t) for t in block]
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        new = {c: [] if c in self.special else self._words(c)
               for c in set().union(*cut) if c not in self.chunks}
        ids = {w: " ".join(map(str, i)) for w, i in self.walk(set().union(*new.values()))}
        for c, words in new.items():
            self.chunks[c] = self.special.get(c) or " ".join([ids[w] for w in words])
        get = self.chunks.__getitem__
        for c in cut:
            yield " ".join([x for x in map(get, c) if x])

    def decode(self, ids: str) -> str:
        """The tokens joined by one space: the file names no decoder."""
        return " ".join(map(self.token.__getitem__, ids.split(" "))) if ids else ""


def _pair(merge) -> tuple[str, str]:
    return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)


_machines: dict[int, WordBpe] = {}


def machine(vocabulary: bytes) -> WordBpe:
    """One machine per Python worker and vocabulary."""
    key = hash(vocabulary)
    if key not in _machines:
        _machines.clear()
        _machines[key] = WordBpe(vocabulary)
    return _machines[key]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc ids, texts) of about BLOCK_CHARS characters."""
    for b in batches:
        texts, start, size = b.column("text"), 0, 0
        lengths = np.asarray(pc.binary_length(texts).fill_null(0))
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= BLOCK_CHARS or i + 1 == len(lengths):
                yield (b.column("doc_id").slice(start, i + 1 - start),
                       [t or "" for t in texts.slice(start, i + 1 - start).to_pylist()])
                start, size = i + 1, 0


def _setup(docs: DataFrame, vocabulary_path: str, doc_id: str, column: str, kind: str):
    v = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{column}`").cast(kind).alias("text"))
    return v, d, d.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array of int)."""
    v, d, id_type = _setup(docs, vocabulary_path, doc_id, text, "string")

    def run(batches):
        m = machine(v.value)
        for doc, texts in _blocks(batches):
            ids = [np.array(x.split(), dtype=np.int32) for x in m.encode(texts)]
            yield pa.RecordBatch.from_arrays([doc, pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "ids"])
    return d.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids array<int>")


def decode(coded: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of a table of ids (null: empty)."""
    v, d, id_type = _setup(coded, vocabulary_path, doc_id, ids, "array<int>")

    def run(batches):
        m = machine(v.value)
        for b in batches:
            out = [m.decode(" ".join(map(str, x or []))) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])
    return d.mapInArrow(run, f"doc_id {id_type}, text string")


def round_trip(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids."""
    v, d, id_type = _setup(docs, vocabulary_path, doc_id, text, "string")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        m = machine(v.value)
        for doc, texts in _blocks(batches):
            n, a, c = [], [], []
            for ids in m.encode(texts):
                n.append(ids.count(" ") + 1 if ids else 0)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                c.append(hashlib.sha256(m.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([doc, pa.array(n, pa.int64()), pa.array(a, pa.string()),
                                              pa.array(c, pa.string())], names=names)
    return d.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
