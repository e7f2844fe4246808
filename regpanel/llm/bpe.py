"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges are compiled into a machine that reads bytes and emits tokens.
For every prefix of a piece exactly one token can end its encoding: the one
that is its own encoding and that does not merge with the token before it
(Berglund and van der Merwe, "Formalizing BPE Tokenization", 2023).  A state
holds the longest suffix of the input that a token may continue (a node of
the vocabulary's trie) and, for each shorter suffix a token may continue too,
the tokens since the last point that all of them share.  Tokens before that
point cannot change any more and are emitted, so the lookahead is bounded by
the longest token.  States and their moves are made when first needed; beyond
``MAX_STATES`` all are dropped and made anew, which changes no result.

With the pattern known here, some rows at once are cut into chunks where that
changes none of its pieces; each different chunk is looked up once, and new
ones go to the machine in order, as those that begin alike share states.  With other patterns, and texts larger than ``BYTES``, each text is
cut by its pattern alone.

Decoding joins the tokens' bytes and runs them through an incremental UTF-8
decoder, which holds back the bytes of an unfinished character.

Defined cases: null and empty texts have no tokens; long texts go through
piece by piece in bounded batches; repeated rows give one result each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import struct
from collections import deque
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.packing import read_vocabulary

CACHE_PIECES = 1 << 20
MAX_STATES = 1 << 18
MAX_PAIRS = 1 << 19
PIECES_AT_ONCE = 1 << 16
BYTES = 8 << 20  # of rows encoded together
FEW = 64  # ids, and less, are decoded without Arrow, whose calls cost more than they save
# the pattern for which it is known where pieces end and no lookahead goes on, and the kinds of characters before and after
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANK, WHITE, LETTER, NUMBER, QUOTE, OTHER, VISIBLE = range(1, 8)  # 0: unknown; a visible one is no white space
SEEN = (LETTER, NUMBER, QUOTE, OTHER)
BORDERS = [*((a, b) for a in (*SEEN, VISIBLE) for b in (BLANK, WHITE)),  # but not behind white space: (?!\S) looks on
           *((a, b) for a in SEEN for b in SEEN if a != b and {a, b} != {QUOTE, OTHER} and (a, b) != (QUOTE, LETTER))]


@contextmanager
def _uncollected():
    """No scans for unreachable cycles meanwhile: the states, of which there is
    a bounded number, are all in use until they are dropped together."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {v: k for k, v in ranks.items()}
        self._pairs: dict[int, bool] = {}
        self._steps: dict[int, tuple] = {}
        self._last_merges()
        self._trie()
        self._reset()

    def _trie(self) -> None:
        child: list[dict[int, int]] = [{}]
        depth, token = [0], [-1]
        for data, rank in self.ranks.items():
            v = 0
            for b in data:
                w = child[v].get(b)
                if w is None:
                    w = child[v][b] = len(child)
                    child.append({})
                    depth.append(depth[v] + 1)
                    token.append(-1)
                v = w
            token[v] = rank
        fail, queue = [0] * len(child), deque(child[0].values())
        while queue:
            v = queue.popleft()
            for b, w in child[v].items():
                f = fail[v]
                while f and b not in child[f]:
                    f = fail[f]
                fail[w] = child[f].get(b, 0)
                queue.append(w)
        self.child, self.depth, self.token, self.fail = child, depth, token, fail

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.moves: dict[int, tuple[int, tuple]] = {}  # of state << 8 | byte: the next state and what is emitted
        # of each state the node, the last token settled, and the chains from the longest suffix to the empty one,
        # the last of which is still to be emitted if the piece ends there; 0 is the start
        self.nodes, self.lasts, self.chains = [0], [-1], [((),)]

    def _last_merges(self) -> None:
        """The two parts that each token is merged from at last (single bytes:
        none), for the tokens that merging their bytes gives at all."""
        self.parts: dict[int, tuple[int, int]] = {}
        self.own: set[int] = set()
        ranks = self.ranks
        for data, rank in ranks.items():
            parts = [ranks[data[i:i + 1]] for i in range(len(data))]
            at = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best, k = min((ranks.get(at[i] + at[i + 1], rank), i) for i in range(len(parts) - 1))
                if best >= rank:
                    break
                parts[k:k + 2], at[k:k + 2] = [best], [at[k] + at[k + 1]]
            if len(parts) == 2:
                self.parts[rank] = parts[0], parts[1]
            if len(parts) <= 2:
                self.own.add(rank)
        self.merged = {v: k for k, v in self.parts.items()}

    def _stays(self, a: int, b: int) -> bool:
        """Token b can follow token a, that is, no merge ever crosses their border.

        The merges on both sides of the border are undone from the last (the
        greater rank; of equal ones the right one) to the first; a merge across
        the border must nowhere have come before the one just undone."""
        merged, parts = self.merged, self.parts
        before = 1 << 62  # a crossing merge of a lesser rank would have come first
        while True:
            crossing = merged.get((a, b))
            if crossing is not None and crossing < before:
                return False
            left, right = parts.get(a), parts.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                before, a = a, left[1]
            else:
                before, b = b + 1, right[0]

    def _suffixes(self, node: int) -> list[tuple[int, int]]:
        """(depth, token) of the node and of the shorter suffixes that a token
        may continue, down to the root; tokens that no merge gives count as none."""
        out = []
        while node:
            t = self.token[node]
            out.append((self.depth[node], t if t in self.own else -1))
            node = self.fail[node]
        return [*out, (0, -1)]

    def _step(self, node: int, b: int) -> tuple:
        """The trie's part of a move: the next node, which chains go on, and
        the tokens that may end here with the chain each would go behind."""
        place = {d: i for i, (d, _) in enumerate(self._suffixes(node))}
        v, child = node, self.child
        while v and b not in child[v]:
            v = self.fail[v]
        v = child[v][b]
        after = [(place[d - 1], t) for d, t in self._suffixes(v) if d]
        got = v, [i for i, _ in after], [(i, t) for i, t in after if t >= 0]
        self._steps[node << 8 | b] = got
        return got

    def _made(self, node: int, last: int, chains: tuple | list) -> int:
        self.nodes.append(node)
        self.lasts.append(last)
        self.chains.append(chains)
        return len(self.nodes) - 1

    def _move(self, s: int, b: int) -> tuple[int, tuple]:
        at = self.nodes[s]
        step = self._steps.get(at << 8 | b)
        node, on, ends = step if step is not None else self._step(at, b)
        old, last, pairs = self.chains[s], self.lasts[s], self._pairs
        kept = [old[i] for i in on]
        for i, t in ends:
            before = old[i]
            prev = before[-1] if before else last
            if prev < 0:
                break
            ok = pairs.get(prev << 32 | t)
            if ok is None:
                if len(pairs) >= MAX_PAIRS:
                    pairs.clear()
                ok = pairs[prev << 32 | t] = self._stays(prev, t)
            if ok:
                break
        kept.append(before + (t,))
        out = ()
        if kept[0]:  # only the longest suffix can begin where the settled tokens end
            low, high = min(kept), max(kept)  # what these two begin with, all chains between them begin with
            if low[0] == high[0]:  # such tokens are settled
                k, most = 1, min(len(low), len(high))
                while k < most and low[k] == high[k]:
                    k += 1
                out = low[:k]
        if out:
            last = out[-1]
            key = (node, last, *[c[k:] for c in kept])
            to = self.states.get(key)  # only what comes after settled tokens can be met again on other ways
            if to is None:
                to = self.states[key] = self._made(node, last, key[2:])
        else:
            to = self._made(node, last, kept)
        got = self.moves[s << 8 | b] = (to, out)
        return got

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token is that token
            return [whole]
        if len(self.moves) > self.max_states:
            self._reset()
        s, ids, moves = 0, [], self.moves
        for b in piece:
            m = moves.get(s << 8 | b)
            s, out = m if m is not None else self._move(s, b)
            if out:
                ids += out
        ids += self.chains[s][-1]
        return ids


class Cutter:
    """Places in UTF-8 where texts can be cut without changing the known pattern's pieces.

    Of characters of one or two bytes the kind is known; of longer ones only
    that their last two bytes are not those of a white space."""

    def __init__(self):
        import regex
        kinds = [(BLANK, " "), (WHITE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (QUOTE, "'"), (OTHER, ".")]
        which = regex.compile("|".join(f"({p})" for _, p in kinds), regex.DOTALL)
        start, end = np.zeros((2, 256, 256), np.uint8)
        end[0x80:0xc0, 0x80:0xc0] = VISIBLE
        for c in map(chr, range(0x800)):
            kind, data = kinds[which.match(c).lastindex - 1][0], c.encode()
            if len(data) == 1:
                start[data[0], :] = end[:, data[0]] = kind
            else:
                start[data[0], data[1]] = end[data[0], data[1]] = kind
        for c in regex.findall(r"\s", "".join(map(chr, [*range(0x800, 0xd800), *range(0xe000, 0x110000)]))):
            end[tuple(c.encode()[-2:])] = 0
        borders = np.zeros((8, 8), bool)
        borders[tuple(zip(*BORDERS, strict=True))] = True
        self.start, self.end, self.borders = start.ravel(), end.ravel() << 3, borders.ravel()

    def cut(self, data: np.ndarray) -> np.ndarray:
        """For each byte, whether a text can be cut before it."""
        out = np.empty(len(data), bool)
        for i in range(0, len(data), 1 << 20):  # the places of some bytes at a time
            some = np.zeros(min(1 << 20, len(data) - i) + 3, np.uint16)  # with two bytes before them and one behind
            low, high = max(i - 2, 0), min(i + (1 << 20) + 1, len(data))
            some[low - i + 2:high - i + 2] = data[low:high]
            two = some[:-1] << 8 | some[1:]
            out[i:i + (1 << 20)] = self.borders[self.end[two[:-2]] | self.start[two[2:]]]
        return out


class Encoder(dict):
    """piece, or some pieces of a text -> ids, little-endian unsigned 32-bit; a bounded cache over the transducer."""

    def __init__(self, vocabulary: bytes, pattern: str):
        super().__init__()
        import regex
        self.machine = Transducer(read_ranks(vocabulary))
        self.pattern = regex.compile(pattern)
        top = max(self.machine.tokens) + 1
        self.bytes = [self.machine.tokens.get(i) for i in range(top)]
        self.table = pa.array(self.bytes, pa.binary())
        self.cutter = Cutter() if pattern == KNOWN else None

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= 64:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[text] = ids
        return ids

    def __missing__(self, piece: str) -> bytes:
        return self._keep(piece, _packed(self.machine.encode(piece.encode())))

    def _chunk(self, chunk: str) -> bytes:
        pieces = self.pattern.findall(chunk)
        if len(pieces) == 1:
            return self[chunk]
        return self._keep(chunk, b"".join(map(self.__getitem__, pieces)))  # no piece anywhere is equal to it

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        got = list(map(self.get, chunks))
        for i in sorted([i for i, ids in enumerate(got) if ids is None], key=chunks.__getitem__):
            got[i] = self._chunk(chunks[i])
        return got

    def _together(self, texts: pa.Array) -> Iterator[list[memoryview]]:
        """The ids of each text, each different chunk of theirs looked up once."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        rows = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data, rows = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[rows[0]:rows[-1]], rows - rows[0]
        border = self.cutter.cut(data)
        border[rows[rows < len(data)]] = True
        starts = np.flatnonzero(border).astype(np.int32)
        at = np.append(starts, np.int32(len(data)))
        chunks = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        ids = pa.array(self._chunks(coded.dictionary.to_pylist()), pa.binary())
        size = np.append(0, np.cumsum(pc.binary_length(ids).to_numpy()[coded.indices.to_numpy()], dtype=np.int64))
        ids = memoryview(ids.take(coded.indices).buffers()[2] or b"")
        for i, j in pairwise(size[np.searchsorted(starts, rows)].tolist()):
            yield [ids[i:j]]

    def rows(self, texts: pa.Array) -> Iterator[Iterable[bytes | memoryview]]:
        """Of each text (null: empty) the ids, some pieces at a time."""
        for i, n, size in _groups(texts):
            if self.cutter and size <= BYTES:
                yield from self._together(texts.slice(i, n))
            else:
                yield from (self.stream(t or "") for t in texts.slice(i, n).to_pylist())

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text, some pieces at a time."""
        if len(text) <= PIECES_AT_ONCE:
            yield b"".join(map(self.__getitem__, self.pattern.findall(text)))
            return
        pieces = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(pieces, PIECES_AT_ONCE)):
            yield b"".join(map(self.__getitem__, some))

    def encode(self, text: str) -> bytes:
        return b"".join(self.stream(text))


class Decoder:
    """Streaming decode: feed ids, get the characters finished so far."""

    def __init__(self, encoder: Encoder):
        self.bytes, self.table = encoder.bytes, encoder.table
        self.utf8 = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: bytes, final: bool = False) -> str:
        ids = np.frombuffer(ids, dtype="<u4")
        if len(ids) <= FEW:
            return self.utf8.decode(b"".join(map(self.bytes.__getitem__, ids.tolist())), final)
        tokens = self.table.take(pa.array(ids))
        if tokens.null_count:
            raise ValueError("ids without a token")
        return self.utf8.decode(tokens.buffers()[2] or b"", final)


def _groups(texts: pa.Array) -> Iterator[tuple[int, int, int]]:
    """Starts, lengths and bytes of runs of rows, of BYTES at most unless of one row."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and size + n > BYTES:
            yield start, i - start, size
            start, size = i, 0
        size += n
    if len(texts):
        yield start, len(texts) - start, size


_encoders: dict[tuple, Encoder] = {}


def encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """One encoder per Python worker, vocabulary and pattern."""
    key = (hash(vocabulary), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, pattern)
    return _encoders[key]


def _setup(docs: DataFrame, vocabulary_path: str, doc_id: str, column: str):
    v = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{column}`").alias(column))
    return v, d, d.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit)."""
    v, d, id_type = _setup(docs, vocabulary_path, doc_id, text)

    def run(batches):
        enc = encoder(v.value, pattern)
        for b in batches:
            with _uncollected():
                ids = [b"".join(parts) for parts in enc.rows(b.column(text))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                              pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])
        pa.default_memory_pool().release_unused()
    return d.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids binary")


def decode(coded: DataFrame, vocabulary_path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of a table of ids."""
    v, d, id_type = _setup(coded, vocabulary_path, doc_id, ids)

    def run(batches):
        enc = encoder(v.value, pattern)
        for b in batches:
            out = []
            for x in b.column(ids).to_pylist():
                dec = Decoder(enc)
                out.append("".join([dec.feed((x or b"")[i:i + 4 * PIECES_AT_ONCE])
                                    for i in range(0, len(x or b""), 4 * PIECES_AT_ONCE)] + [dec.feed(b"", True)]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])
    return d.mapInArrow(run, f"doc_id {id_type}, text string")


def round_trip(docs: DataFrame, vocabulary_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids as they come."""
    v, d, id_type = _setup(docs, vocabulary_path, doc_id, text)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        enc = encoder(v.value, pattern)
        for b in batches:
            n, a, c = [], [], []
            with _uncollected():
                for parts in enc.rows(b.column(text)):
                    dec, size, of_ids, of_text = Decoder(enc), 0, hashlib.sha256(), hashlib.sha256()
                    for ids in parts:
                        size += len(ids) // 4
                        of_ids.update(ids)
                        of_text.update(dec.feed(ids).encode())
                    of_text.update(dec.feed(b"", True).encode())
                    n.append(size)
                    a.append(of_ids.hexdigest())
                    c.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                                              pa.array(c, pa.string())], names=names)
        pa.default_memory_pool().release_unused()
    return d.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
