"""N-gram Jaccard join by parity sketches.

A document's set of shingles is XOR-hashed into a sparse bit sketch: each
shingle flips one bit of one of P pieces.  The sketches of two sets differ in
no more bits than the sets differ in shingles, and a pair with Jaccard
similarity t or more, both sizes below ``hi``, differs in at most
D = 2 * (hi - 1) * (1 - t) / (1 + t) shingles.  With P = D + 1 pieces such a
pair agrees in at least one whole piece (pigeonhole), so documents are joined
on (size band, piece, fingerprint of the piece's bits).  A document probes its
own band and, if its size allows a partner there, the next one.

Some piece not only agrees but also has at most one differing bit in the
piece after it (the cyclic form of the pigeonhole).  Pieces with few bits say
little, so they are joined on that stronger condition: their key also holds
the following piece, once whole and once without each of its bits.

More pieces say more (the cycle lemma): some piece agrees and is followed, for
every r, by r pieces that differ in no more than r bits.  A few common
shingles are all that many pieces hold, and the texts that share them grow with
the table, their pairs with its square.  Rows of such pieces carry a 64-bit
sketch of the RUN pieces that follow; a bucket is parted into those that can be
reached over sketches that differ in RUN bits or less, before any set is
compared.

Candidates inside a bucket are compared on a dense sketch of a bit or more for
each shingle (a lower bound of the difference again, which large sets do not
fill up), those left on a wider one, and verified on the sets.  Buckets with the same members
become one; large ones are dealt out as pairs of blocks.  Documents already known
to be in one group are not compared again, so a group of near copies costs
its links once, not all its pairs.

Exact up to collisions of 64-bit hashes.  Defined cases: null or empty texts
(no words) have no shingles and link with nothing; fewer words than a shingle
count as one shingle; copies are collapsed first, so any number of them is
one member; texts of any length are used whole; an empty table gives an empty
result; extra columns are ignored by :func:`near_groups` and kept by
:func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.common import GOLDEN, Scratch, U, as_long, components, gram_hashes, mix, seeded, texts, word_hashes

RATIO = 1.5  # of a size band's bounds
SKETCH_BITS = 1024  # of a bucket's sketch at least
MOST_BITS = 1 << 17  # of a bucket's sketch at most, so that a bucket's rows stay small; the wider one has no such bound
WIDE = 4  # bits a shingle of the second sketch
FULL = 6  # shingles a piece should hold on average; sparser sketches only extend their empty pieces
LOW = 3  # pieces with fewer bits: in fuller sketches they also need the piece after them, and they carry a sketch of RUN pieces
RUN = 4  # pieces whose sketch tells apart texts that share a common piece
MATRIX = 64  # members of buckets whose sketches are compared as a matrix, many buckets at once
HELD = 1 << 16  # members of buckets that are parted
PIVOTS = 8  # rows that all others of a bucket are compared with before groups are joined
BLOCK_ROWS = 512  # of a large bucket
FILTER_BITS = 1 << 23  # of the filter that spares most texts a shuffle: 1 MB, broadcast
LARGE = 4096  # members of buckets that are named by them


def shingles(text: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles, A-Z lower-cased."""
    w = word_hashes(text, lower=True)
    if not len(w):
        return w
    return np.unique(gram_hashes(w, k) if len(w) >= k else gram_hashes(w, len(w)))


def set_id(s: np.ndarray) -> int:
    """A 64-bit name of the whole set."""
    with np.errstate(over="ignore"):
        h = np.array([np.bitwise_xor.reduce(mix(s + U(GOLDEN))) ^ (mix(s).sum() * U(3)) ^ U(len(s))], dtype=np.uint64)
    return int(mix(h).view(np.int64)[0])


def dense_sketch(s: np.ndarray, size: int = SKETCH_BITS) -> bytes:
    bits = (mix(s ^ U(77)) % U(size)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=size) & 1).astype(bool)).tobytes()


def bucket_sketch(s: np.ndarray) -> bytes:
    """A sketch of one to two bits for each shingle, a power of two."""
    return dense_sketch(s, min(max(SKETCH_BITS, 1 << len(s).bit_length()), MOST_BITS))


def wide_sketch(s: np.ndarray) -> bytes:
    """A sketch of WIDE bits or more for each shingle, a power of two: a sixteenth of the set's own bytes at most."""
    return dense_sketch(s, max(SKETCH_BITS, 1 << (WIDE * len(s)).bit_length() - 1))


def wide_difference(a: np.ndarray, b: np.ndarray) -> int:
    """Differing bits of two wide sketches; the longer one is folded to the
    shorter one's size, which gives the sketch of that size."""
    m = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, m), axis=0) for v in (a, b))
    return int(_POP[a ^ b].sum(dtype=np.int64))


class Bands:
    """Size bands and their number of pieces for a similarity of t / 100."""

    def __init__(self, t: int):
        self.t = t
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, int(bounds[-1] * RATIO)))
        self.bounds = np.array(bounds)

    def of(self, n: int) -> list[tuple[int, int]]:
        """(band, most differing shingles) to probe for a set of n shingles."""
        b = int(np.searchsorted(self.bounds, n, "right")) - 1
        out = []
        for band in (b, b + 1):
            lo, hi = int(self.bounds[band]), int(self.bounds[band + 1])
            if band == b or 100 * n >= self.t * lo:
                out.append((band, (100 - self.t) * 2 * (hi - 1) // (100 + self.t)))
        return out


def piece_keys(s: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit join keys of one set, and for those of few bits the sketch
    of the RUN pieces that follow (0 for the others).

    At one key at least that both have, the sketches of two similar sets
    differ in RUN bits or less."""
    keys, nears = [], []
    for band, most in bands.of(len(s)):
        if most == 0:  # only equal sets are similar enough, and those are one member
            continue
        n = most + 1
        h = mix(s ^ U(band + 1))
        bit = np.sort(((h >> U(20)) % U(n) << U(16)) | (h & U(0xFFFF)))
        odd, counts = np.unique(bit, return_counts=True)
        odd = odd[counts & 1 == 1]  # a bit flipped twice is as it was
        piece = (odd >> U(16)).astype(np.int64)
        value = mix(odd + U(GOLDEN))
        size = np.bincount(piece, minlength=n)
        first = np.cumsum(size) - size
        name = seeded(1000 + band, n)
        whole, spots = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
        full = size > 0
        if len(odd):
            whole[full] = np.bitwise_xor.reduceat(value, first[full])
            spots[full] = np.bitwise_xor.reduceat(U(1) << (value >> U(58)), first[full])
        key = mix(whole ^ name)
        near = _followers(spots)
        least = LOW if int(bands.bounds[band]) >= FULL * n * 0.9 else 1
        own = size >= least
        keys.append(key[own])
        nears.append(np.where(size < LOW, near, U(0))[own])
        i = np.flatnonzero(~own)
        j = (i + 1) % n
        many = size[j]
        of = np.repeat(np.arange(len(i)), many)
        without = whole[j[of]] ^ value[np.arange(len(of)) + (first[j] - (np.cumsum(many) - many))[of]]
        keys.append(mix(np.concatenate([without, whole[j]]) * U(3) + key[np.concatenate([i[of], i])]))
        nears.append(near[np.concatenate([i[of], i])])
    if not keys:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    keys, at = np.unique(np.concatenate(keys), return_index=True)
    return keys, np.concatenate(nears)[at]


def _followers(piece: np.ndarray) -> np.ndarray:
    """For each of the pieces of a cycle, the sketch of the RUN pieces after it (all others, where there are fewer)."""
    run = min(RUN, len(piece) - 1)
    ring, out = np.concatenate([piece, piece[:run]]), np.zeros(len(piece), dtype=np.uint64)
    for r in range(1, run + 1):
        out ^= ring[r:r + len(piece)]
    return out


# ------------------------------------------------------------ Spark steps


def _meta(k: int):
    def run(batches):
        for b in batches:
            sets = [shingles(t, k) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([bucket_sketch(s) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n", "sid", "sketch"])
    return run


def _pieces(k: int, t: int):
    def run(batches):
        bands, seen = Bands(t), set()
        for b in batches:
            keys, near, owner = [], [], []
            for text in texts(b.column("text")):
                s = shingles(text, k)
                sid = set_id(s) if len(s) else None
                if sid is None or sid in seen:  # copies met before in this task add nothing
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(sid)
                key, sketch = piece_keys(s, bands)
                keys.append(key)
                near.append(sketch)
                owner.append(np.full(len(key), sid, dtype=np.int64))
            cols = [as_long(np.concatenate([*c, np.empty(0, c[0].dtype if c else np.int64)])) for c in (keys, owner, near)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "sid", "near"])
    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            sets = [shingles(t, k) for t in texts(b.column("text"))]
            same = [len(s) > 0 and set_id(s) == sid for s, sid in zip(sets, b.column("sid").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("sid").filter(pa.array(same, pa.bool_())),
                 pa.array([len(s) for s, ok in zip(sets, same, strict=True) if ok], pa.int64()),
                 pa.array([wide_sketch(s) for s, ok in zip(sets, same, strict=True) if ok], pa.binary()),
                 pa.array([s.tobytes() for s, ok in zip(sets, same, strict=True) if ok], pa.binary())],
                names=["sid", "n", "wide", "set"])
    return run


def _spread(near: np.ndarray) -> np.ndarray:
    """For each sketch, the first one that is reached over differences of RUN bits or less."""
    label, left = np.empty(len(near), np.int64), np.arange(len(near))
    while len(left):
        start, todo = left[0], [left[0]]
        left = left[1:]
        label[start] = start
        while todo and len(left):
            close = np.bitwise_count(near[left] ^ near[todo.pop()]) <= RUN
            label[left[close]] = start
            todo += left[close].tolist()
            left = left[~close]
    return label


def _matrices(near: np.ndarray) -> np.ndarray:
    """:func:`_spread` of every row of a matrix."""
    m = near.shape[1]
    close = np.bitwise_count(near[:, :, None] ^ near[:, None, :]) <= RUN
    label = np.broadcast_to(np.arange(m), near.shape)
    while True:
        least = np.where(close, label[:, None, :], m).min(axis=2)
        if (least == label).all():
            return label
        label = least


def _apart(key: np.ndarray, sid: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole buckets, sorted by (key, sid): (key, sid) of their parts of two
    members or more.  The part of a bucket's first member keeps the key."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.r_[edge, len(key)])
    many = np.repeat(size > 1, size)
    key, sid, near, size = key[many], sid[many], near[many].view(np.uint64), size[size > 1]
    if not len(key):
        return key, sid
    edge = np.cumsum(size) - size
    label = np.repeat(edge, size)
    close = np.logical_and.reduceat(np.bitwise_count(near ^ near[label]) <= RUN, edge)
    for m in np.unique(size[~close]).tolist():
        at = edge[~close & (size == m)]
        if m > MATRIX:
            for i in at.tolist():
                label[i:i + m] = i + _spread(near[i:i + m])
            continue
        step = max(1, (1 << 20) // m ** 2)
        for some in (at[i:i + step, None] + np.arange(m) for i in range(0, len(at), step)):
            label[some] = some[:, :1] + _matrices(near[some])
    order = np.argsort(label, kind="stable")
    order = order[np.bincount(label, minlength=len(key))[label[order]] > 1]
    key, sid, first, bucket = key[order], sid[order], label[order], np.repeat(edge, size)[order]
    other = as_long(mix(key.view(np.uint64) ^ mix((first - bucket).astype(np.uint64))))
    return np.where(first == bucket, key, other), sid


class _Parts:
    """Streams rows sorted by (key, sid) and gives (key, sid) of the parts of
    keys with two members or more.  Of keys with more than HELD members all
    are passed on as they come."""

    def __init__(self):
        self.rows = [np.empty(0, np.int64)] * 3
        self.passing = False

    def feed(self, key: np.ndarray, sid: np.ndarray, near: np.ndarray, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        key, sid, near = (np.r_[x, y] for x, y in zip(self.rows, (key, sid, near), strict=True))
        if not len(key):
            return key, sid
        new = np.r_[True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])]
        key, sid, near = key[new], sid[new], near[new]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        cut, out = len(key) if end else int(edge[-1]), []  # what comes before is complete
        start = 0
        if self.passing and cut:  # the rest of the bucket that was being passed on
            start = int(edge[1]) if len(edge) > 1 else cut
            out.append((key[:start], sid[:start]))
            self.passing = False
        out.append(_apart(key[start:cut], sid[start:cut], near[start:cut]))
        if len(key) - cut > (1 if self.passing else HELD):  # pass on all but the last row
            out.append((key[cut:-1], sid[cut:-1]))
            cut, self.passing = len(key) - 1, True
        self.rows = [x[cut:] for x in (key, sid, near)]
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class _Buckets:
    """Streams rows sorted by (key, sid) and gives the members of keys with two
    members or more: (key, sid, place in the bucket, first member).

    A bucket of up to LARGE members is renamed to a hash of its members, so
    that the many pieces in which the same documents agree become one bucket.
    Larger ones keep their key and are passed on as they come; never more than
    LARGE members and one batch are held."""

    def __init__(self):
        self.key, self.sid = np.empty(0, np.int64), np.empty(0, np.int64)
        self.passed, self.first = 0, None  # of the bucket that is being passed on

    def feed(self, key: np.ndarray, sid: np.ndarray, end: bool = False) -> list[np.ndarray]:
        key, sid = np.r_[self.key, key], np.r_[self.sid, sid]
        if not len(key):
            return [key] * 4
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, sid = key[new], sid[new]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        cut = len(key) if end else int(edge[-1])  # what comes before is complete
        rows = self._complete(key[:cut], sid[:cut], edge[edge < cut])
        key, sid = key[cut:], sid[cut:]
        if len(key) > (0 if self.passed else LARGE) and not end:  # pass on all but the last row
            rows = [np.r_[x, y] for x, y in zip(rows, self._pass(key[:-1], sid[:-1]), strict=True)]
            key, sid = key[-1:], sid[-1:]
        self.key, self.sid = key, sid
        return rows

    def _pass(self, key, sid) -> list[np.ndarray]:
        if not len(key):
            return [key] * 4
        if not self.passed:
            self.first = sid[0]
        place = np.arange(self.passed, self.passed + len(sid))
        self.passed += len(sid)
        return [key, sid, place, np.full(len(sid), self.first)]

    def _complete(self, key, sid, edge) -> list[np.ndarray]:
        head = [np.empty(0, np.int64)] * 4
        if not len(key):
            return head
        if self.passed:  # the rest of the bucket that was being passed on
            n = int(edge[1]) if len(edge) > 1 else len(key)
            head = self._pass(key[:n], sid[:n])
            self.passed, self.first = 0, None
            key, sid, edge = key[n:], sid[n:], edge[1:] - n
            if not len(key):
                return head
        size = np.diff(np.r_[edge, len(key)])
        h = mix(sid.view(np.uint64))
        name = mix(np.add.reduceat(h, edge) ^ mix(np.bitwise_xor.reduceat(h, edge) + size.astype(np.uint64)))
        name = np.where(size <= LARGE, as_long(name), key[edge])
        keep = np.repeat(size > 1, size)
        place = np.arange(len(key)) - np.repeat(edge, size)
        rows = [np.repeat(name, size)[keep], sid[keep], place[keep], np.repeat(sid[edge], size)[keep]]
        return [np.r_[x, y] for x, y in zip(head, rows, strict=True)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, state = _Parts(), _Buckets()
    names = ["key", "sid", "place", "first"]
    for b in batches:
        rows = state.feed(*parts.feed(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sid", "near"))))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)
    rows = state.feed(*parts.feed(*[np.empty(0, np.int64)] * 3, end=True), end=True)
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)


def _bits(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size (FILTER_BITS bits) that holds all doc_id of a table, and others too."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    rows = (ids.select(F.floor(at / 32768).cast("int").alias("part"), F.pmod(at, F.lit(32768)).cast("long").alias("bit"))
            .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def _asked(bits: np.ndarray):
    def run(batches):
        for b in batches:
            at = b.column("at").to_numpy()
            yield b.select(["doc_id", "text"]).filter(pa.array(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1))
    return run


_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class _Sketches:
    """Sketches of several sizes, one matrix of 64-bit words for each size."""

    def __init__(self, rows: list[bytes]):
        self.size = np.array([len(r) // 8 for r in rows], dtype=np.int64)
        self.at, self.of = np.empty(len(rows), np.int64), {}
        for m in np.unique(self.size).tolist():
            mine = np.flatnonzero(self.size == m)
            self.at[mine] = np.arange(len(mine))
            self.of[m] = np.frombuffer(b"".join(rows[i] for i in mine), dtype=np.uint64).reshape(len(mine), m)

    def difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Differing bits of the rows a and b; the longer sketch is folded to the shorter one's size."""
        out = np.empty(len(a), np.int64)
        p, q = self.size[a], self.size[b]
        kind = p << 32 | q
        for both in np.unique(kind).tolist():
            mine, p, q = np.flatnonzero(kind == both), both >> 32, both & 0xFFFFFFFF
            m = min(p, q)
            step = max(1, (1 << 20) // max(p, q))
            for part in (mine[i:i + step] for i in range(0, len(mine), step)):
                x, y = self.of[p][self.at[a[part]]], self.of[q][self.at[b[part]]]
                x, y = (v if v.shape[1] == m else np.bitwise_xor.reduce(v.reshape(len(v), -1, m), axis=1) for v in (x, y))
                out[part] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        return out


def _compare(t: int, thin: bool):
    """Of rows sorted by bucket: the pairs of different groups whose sketches
    allow the similarity; ``thin`` leaves a forest of each batch's groups, and
    groups that it has joined already are not compared again, so that a bucket
    of near copies costs its links and not all its pairs."""

    def pairs(key, n, group, sketch, block):
        """Pairs of each bucket's first row, then its second one and so on
        (the order of rows is the same in all buckets, so that many batches
        find the same pairs), and their estimated difference in parts of the
        allowed one; ``group`` may change meanwhile."""
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[key]
        rest = np.arange(len(key))
        for d in range(len(key)):
            rest = rest[rest - first[rest] > d]
            if not len(rest):
                break
            a = first[rest] + d
            ok = (group[a] != group[rest]) & ((block[a] != block[rest]) | (block[a] < 0))
            a, b = a[ok], rest[ok]
            ok = 100 * np.minimum(n[a], n[b]) >= t * np.maximum(n[a], n[b])
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            h, both = sketch.difference(a, b), n[a] + n[b]
            ok = h * (100 + t) <= (100 - t) * both
            if ok.any():
                a, b, bits = a[ok], b[ok], 64 * np.minimum(sketch.size[a], sketch.size[b])[ok]
                met = -np.log1p(-np.minimum(2 * h[ok] / bits, 0.999)) * bits / 2  # with the bits that were flipped twice
                yield d, met * (100 + t) / ((100 - t) * both[ok]), a, b

    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table):
            key = np.stack([rows.column(c).to_numpy() for c in ("key", "x", "y")], axis=1)
            edge = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            key = np.repeat(np.arange(len(edge) + 1), np.diff(np.r_[0, edge, len(key)]))
            sid, n, label, block = (rows.column(c).to_numpy() for c in ("sid", "n", "label", "block"))
            names, group = np.unique(label, return_inverse=True)
            root = np.arange(len(names))

            def top(v):
                while root[v] != v:
                    v = root[v]
                return v

            def join(found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
                """The pairs, nearest first, that join groups."""
                far, a, b = (np.concatenate(c) for c in zip(*found, strict=True))
                keep, order, p, q = [], np.argsort(far, kind="stable"), group[a], group[b]
                pair = np.minimum(p, q) * len(names) + np.maximum(p, q)
                order = order[np.sort(np.unique(pair[order], return_index=True)[1])]  # many buckets hold the same two
                for i, p, q in zip(order.tolist(), p[order].tolist(), q[order].tolist(), strict=True):
                    p, q = top(p), top(q)
                    if p != q:
                        root[p] = q
                        keep.append(i)
                while (root[root] != root).any():
                    root[:] = root[root]
                group[:] = root[group]
                return a[keep], b[keep]
            ends, sure, doubtful = [], [], []
            for d, far, a, b in pairs(key, n, group, _Sketches(rows.column("sketch").to_pylist()), block):
                if not thin:
                    ends.append((a, b))
                    continue
                if sure and d >= PIVOTS:
                    ends.append(join(sure))
                    sure = []
                    left = group[a] != group[b]
                    far, a, b = far[left], a[left], b[left]
                is_sure = far <= 1
                sure.append((far[is_sure], a[is_sure], b[is_sure]))
                doubtful.append((far[~is_sure], a[~is_sure], b[~is_sure]))
            ends += [join(found) for found in (sure, doubtful) if found]
            a, b = (np.concatenate(c) for c in zip(*ends, strict=True)) if ends else [np.empty(0, np.int64)] * 2
            return pa.RecordBatch.from_arrays([pa.array(sid[a], pa.int64()), pa.array(sid[b], pa.int64())], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            table = pa.Table.from_batches(held)
            last = [table.column(c)[-1].as_py() for c in ("key", "x", "y")]
            same = np.ones(table.num_rows, bool)
            for c, v in zip(("key", "x", "y"), last, strict=True):
                same &= table.column(c).to_numpy() == v
            cut = int(np.argmax(same))  # buckets are complete up to the one at the end
            if cut:
                yield flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))
    return run


def near_groups(docs: DataFrame, k: int = 5, similarity: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row; the component
    is the least doc_id reachable over pairs of ``similarity`` per cent or more
    (doc_id must be an integer; a null doc_id is in no component)."""
    spark, t = docs.sparkSession, similarity
    scratch = Scratch(spark, "parity-join")
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    meta = scratch.save(d.mapInArrow(_meta(k), "doc_id long, n long, sid long, sketch binary"), "meta")
    pieces = d.select("text").mapInArrow(_pieces(k, t), "key long, sid long, near long")
    shared = (pieces.repartition("key").sortWithinPartitions("key", "sid")
              .mapInArrow(_shared, "key long, sid long, place long, first long")
              .groupBy("key", "sid").agg(F.min("place").alias("place"), F.min("first").alias("first")))
    shared = scratch.save(shared, "shared")
    members = scratch.save(meta.join(shared.select("sid").distinct(), "sid").groupBy("sid").agg(
        F.min("doc_id").alias("one"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "members")
    size = scratch.save(members.select("sid", "n", "sketch"), "sizes")

    def candidates(label: DataFrame | None, thin: bool) -> DataFrame:
        """Pairs of different groups that some bucket holds and the sketches allow."""
        known = shared.withColumn("label", F.col("sid")) if label is None else (
            shared.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid")))
        mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("place").alias("last"))
        blocks = F.floor(F.col("last") / BLOCK_ROWS).cast("int")
        mixed = mixed.where("lo <> hi").select("key", blocks.alias("blocks"))
        own, other = F.floor(F.col("place") / BLOCK_ROWS).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks")))
        # large buckets: every pair of blocks is a bucket of its own; a block with itself is compared in (x, x)
        dealt = (known.join(mixed, "key").withColumn("own", own).select("*", other.alias("other"))
                 .select("key", "sid", "label", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                         F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("block")))
        rows = (dealt.join(size, "sid").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "sid")
                .select("key", "x", "y", "sid", "n", "label", "block", "sketch"))
        pairs = rows.mapInArrow(_compare(t, thin), "a long, b long")
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    # a forest of likely links; whoever has any likely partner is on it
    forest = scratch.save(candidates(None, True), "forest")
    ends = forest.select(F.col("a").alias("sid")).unionAll(forest.select(F.col("b").alias("sid"))).distinct()
    one = scratch.save(members.join(ends, "sid").where("one is not null").select(F.col("one").alias("doc_id"), "sid"), "ends")
    # repeated rows go where the join has put them already
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at")
    likely = d.select("doc_id", "text", place).mapInArrow(_asked(_bits(one)), "doc_id long, text string")
    texts_ = (likely.join(one.hint("merge"), "doc_id")
              .withColumn("fp", F.xxhash64("text")).dropDuplicates(["doc_id", "sid", "fp"]))
    sets = scratch.save(texts_.select("sid", "text").mapInArrow(_sets(k), "sid long, n long, wide binary, set binary"), "sets")

    def verified(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The pairs tried, and whether those that the wide sketches allow are linked; only their sets move."""
        wide = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}"))
        screened = (pairs.join(wide("a"), "a").join(wide("b"), "b")
                    .mapInArrow(_screen(t), "a long, b long, likely boolean"))
        screened = scratch.save(screened, f"screened-{name}")
        judged = (screened.where("likely").select("a", "b")
                  .join(sets.select(F.col("sid").alias("a"), F.col("set").alias("sa")), "a")
                  .join(sets.select(F.col("sid").alias("b"), F.col("set").alias("sb")), "b")
                  .mapInArrow(_verify(t), "a long, b long, linked boolean"))
        return screened.select("a", "b"), scratch.save(judged, f"judged-{name}")

    def labels(found: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """The groups of the links found and of those known before, of which one link a member is enough."""
        links = found.where("linked").select("a", "b")
        if known is not None:
            links = links.unionAll(known.select("sid", "label"))
        return components(spark, links).select(F.col("id").alias("sid"), F.col("component").alias("label"))

    first, found = verified(forest, "forest")
    tried, label = [first], labels(found)
    scratch.drop("forest", "members", "ends")
    for name, thin in (("likely", True), ("rest", False)):
        pairs = candidates(label, thin)
        pairs = pairs.join(reduce(DataFrame.unionAll, tried), ["a", "b"], "left_anti")
        more, found = verified(pairs, name)
        tried.append(more)
        label = labels(found, label)
    scratch.drop("shared", "sizes", "sets", *[f"{x}-{n}" for n in ("forest", "likely", "rest") for x in ("screened", "judged")])
    groups = meta.join(label, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "sid").alias("g"))
    least = groups.where("g is not null").groupBy("g").agg(F.min("doc_id").alias("component_id"))
    return groups.join(least, "g", "left").select(
        "doc_id", "n_shingles", F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _screen(t: int):
    def run(batches):
        for b in batches:
            ok = []
            for n, m, x, y in zip(b.column("na").to_pylist(), b.column("nb").to_pylist(), b.column("wa"), b.column("wb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in (x, y))
                ok.append(wide_difference(x, y) * (100 + t) <= (100 - t) * (n + m))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "likely"])
    return run


def _verify(t: int):
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("sa"), b.column("sb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= t * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])
    return run


def keep_one(docs: DataFrame, k: int = 5, similarity: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all its columns: of the group's
    different texts the one of the least doc_id, and of rows with that id and
    text one.  Rows are told apart by id and text, so where one id has several
    texts, a near copy takes only itself.  Documents without words or without
    an id stay, each of them."""
    scratch = Scratch(docs.sparkSession, "keep-one")
    key, words = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")
    fp = F.xxhash64(words)
    own = docs.where(key.isNotNull() & words.isNotNull()).select(key.alias("id"), fp.alias("fp"), words.alias("text"))
    name = F.xxhash64("id", "fp").alias("doc_id")  # near_groups joins by it: each different (id, text) is a document of its own
    groups = near_groups(own.select(name, "text"), k, similarity)
    of = groups.where("n_shingles > 0").groupBy("doc_id").agg(F.first("component_id").alias("g"))
    members = own.groupBy("id", "fp").agg(F.count("*").alias("rows")).select("*", name).join(of, "doc_id")
    members = scratch.save(members.select("id", "fp", "rows", "g"), "members")
    least = members.groupBy("g").agg(F.min(F.struct("id", "fp")).alias("m")).select("m.*")
    gone = members.join(least, ["id", "fp"], "left_anti")
    many = members.where("rows > 1").join(least, ["id", "fp"], "left_semi")  # equal rows of a document that stays
    taken = gone.select("id", "fp").unionAll(many.select("id", "fp"))

    mark = "#"  # names that no column of the table begins with
    while any(c.startswith(mark) for c in docs.columns):
        mark += "#"

    def told(side: DataFrame, how: str) -> DataFrame:
        side = side.select(F.col("id").alias(f"{mark}id"), F.col("fp").alias(f"{mark}fp"))
        return docs.join(side, (key == F.col(f"`{mark}id`")) & (fp == F.col(f"`{mark}fp`")), how)
    repeated = told(many, "left_semi").withColumn(f"{mark}of", fp).dropDuplicates([doc_id, f"{mark}of"]).drop(f"{mark}of")
    return told(taken, "left_anti").unionByName(repeated)
