"""Substring deduplication with suffix automata of reference shards.

The reference is the corpus itself, so it is cut into shards that can share a
passage: every window of ``length`` words is represented by its least 8-word
gram (winnowing), and equal windows choose equal grams at equal places.  The
occurrences of a gram, each with the words that a window around it can reach,
are a reference shard.  Where all of a gram's surroundings are equal they are
repeated as a whole.  Otherwise the shard's distinct surroundings go into a
suffix automaton over words, every surrounding is streamed through it, and the
matching statistics restricted to states with a second owner give the maximal
repeated spans.  A marker at the gram keeps matches aligned, so that no place
matches itself.  Grams with more distinct surroundings than a shard may hold
are settled by counting hashes of halved ranges of windows (:func:`_bisected`),
an exact and splittable way.

:func:`reference_spans` is the broadcast form for a small outside reference:
its shards' automata are built once per worker and all documents stream
through them.

Exact up to collisions of 64-bit hashes.  Defined cases: null or empty texts
have no words; texts of any length are used whole; repeated rows are
occurrences of each other; texts shorter than a window keep all words; an
empty table gives an empty result; extra columns are ignored by :func:`spans`
and kept by :func:`remove`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.common import GOLDEN, Scratch, U, as_long, gram_hashes, mix, texts, word_bounds, word_hashes

LENGTH = 35
GRAM = 8
SHARD = 256  # distinct surroundings in one automaton
_STEP = 0xD1342543DE82EF95  # odd multiplier of the sequence polynomial
_BACK = pow(_STEP, -1, 1 << 64)
_PLACE = U((1 << 19) - 1)  # low bits that hold a place among the grams of 2^18 windows


class Automaton:
    """Suffix automaton of several word sequences, with owners per state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.owners, self._seen = [-1], [0], [0], [-1]

    def _new(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        self.owners.append(0)
        self._seen.append(-1)
        return len(self.len) - 1

    def _split(self, p: int, w, q: int) -> int:
        """The state of the words that p reaches by w, parted from the longer ones of q."""
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def add(self, words: list) -> None:
        last, moves, link, length = 0, self.next, self.link, self.len
        for w in words:
            q = moves[last].get(w)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, w, q)
                continue
            cur, p = self._new(length[last] + 1, {}, 0), last
            while p >= 0 and w not in moves[p]:
                moves[p][w] = cur
                p = link[p]
            if p >= 0:
                link[cur] = self._split(p, w, moves[p][w])
            last = cur

    def own(self, words: list, owner: int, weight: int = 1, enough: int | None = None) -> list[int]:
        """Count a sequence as an owner of all its substrings' states; the
        states of its prefixes.  Counts of ``enough`` owners may stay at that:
        what a state's words hold has as many owners at least."""
        v, path = 0, []
        moves, seen, owners, link = self.next, self._seen, self.owners, self.link
        for w in words:
            v = moves[v][w]
            path.append(v)
            u = v
            while u > 0 and seen[u] != owner and (enough is None or owners[u] < enough):
                seen[u] = owner
                owners[u] += weight
                u = link[u]
        return path

    def held(self, path: list[int], first: int, owners: int = 1) -> Iterator[tuple[int, int]]:
        """:meth:`statistics` of a sequence that was added, by the states that
        :meth:`own` gave: (end, length) from the end ``first`` on."""
        link, count, length = self.link, self.owners, self.len
        for e in range(first, len(path)):
            u = v = path[e]
            while u > 0 and count[u] < owners:
                u = link[u]
            yield e, e + 1 if u == v else length[u]

    def statistics(self, words, owners: int = 1) -> Iterator[int]:
        """For each end, the length of the longest suffix held by ``owners`` sequences or more."""
        v = size = 0
        for w in words:
            while v and w not in self.next[v]:
                v = self.link[v]
                size = self.len[v]
            if w in self.next[v]:
                v, size = self.next[v][w], size + 1
            u, n = v, size
            while u > 0 and self.owners[u] < owners:
                u = self.link[u]
                n = self.len[u]
            yield n if u > 0 else 0


# ------------------------------------------------------------ per text


def _sequence_sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(w)
    up, down = np.full(n + 1, _STEP, dtype=np.uint64), np.full(n + 1, _BACK, dtype=np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(w + U(GOLDEN)) * up[:n], out=sums[1:])
    return sums, down


def run_hashes(w: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of words [start, stop)."""
    sums, down = _sequence_sums(w)
    return mix((sums[stop] - sums[start]) * down[start] ^ mix((stop - start).astype(np.uint64)))


def anchors(w: np.ndarray, length: int, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The grams that represent a text's windows: their hashes and places."""
    if len(w) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    g = gram_hashes(w, k)
    span = length - k + 1
    picks = []
    for at in range(0, len(g) - span + 1, 1 << 18):
        part = g[at:at + (1 << 18) + span - 1]
        # the place in the low bits: of grams that are equal in the others the first is the least
        low, wide = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), 1
        while wide < span:  # the least of twice as many, or of what is left to a window
            step = min(wide, span - wide)
            low = np.minimum(low[:-step], low[step:])
            wide += step
        pick = (low & _PLACE).astype(np.int64) + at
        picks.append(pick[np.r_[True, pick[1:] != pick[:-1]]])  # places never go back
    pos = picks[0] if len(picks) == 1 else np.unique(np.concatenate(picks))
    return g[pos], pos


def _reach(pos: np.ndarray, n: int, length: int, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(pos - (length - k), 0), np.minimum(pos + length, n)


# ------------------------------------------------------------ Spark steps


def _anchors(length: int):
    def run(batches):
        for b in batches:
            out = []
            for key, text in zip(b.column("rk").to_pylist(), texts(b.column("text")), strict=True):
                w = word_hashes(text)
                gram, pos = anchors(w, length)
                if len(pos):
                    s, e = _reach(pos, len(w), length)
                    around = run_hashes(w, s, e) ^ mix((pos - s).astype(np.uint64))
                    out.append((as_long(gram), as_long(around), np.full(len(pos), key), pos))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["anchor", "around", "rk", "pos"])
    return run


def _surroundings(length: int):
    """The words around the asked places of each text."""
    def run(batches):
        for b in batches:
            out = []
            for key, text, at in zip(b.column("rk").to_pylist(), texts(b.column("text")), b.column("at").to_pylist(),
                                     strict=True):
                w = as_long(word_hashes(text))
                for x in at:
                    s, e = max(x["pos"] - (length - GRAM), 0), min(x["pos"] + length, len(w))
                    out.append((x["anchor"], key, x["pos"], s, x["c"], w[s:e].tobytes()))
            cols = zip(*out, strict=True) if out else [[]] * 6
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["anchor", "rk", "pos", "start", "c", "words"])
    return run


def shard_spans(rows: list[dict], length: int) -> Iterator[tuple[int, int, int]]:
    """(rk, start, stop) of what the surroundings of one gram share: rows with
    their words, the gram's place and how often they occur."""
    machine, marked = Automaton(), []
    for r in rows:
        w = np.frombuffer(r["words"], dtype=np.int64).tolist()
        at = r["pos"] - r["start"]
        marked.append([*w[:at], "gram", *w[at:]])
        machine.add(marked[-1])
    paths = [machine.own(w, i, min(r["c"], 2), enough=2) for i, (r, w) in enumerate(zip(rows, marked, strict=True))]
    for r, path in zip(rows, paths, strict=True):
        if r["c"] > 1:  # repeated as a whole
            continue
        at, best = r["pos"] - r["start"], {}
        for e, n in machine.held(path, max(at + 1, length), 2):
            if n > e - at and n > length:  # the match holds the gram's mark
                best[e - n + 1] = e
        for s, e in best.items():
            yield r["rk"], r["start"] + s, r["start"] + e  # the mark stands before the gram: one place less


def _shards(length: int):
    names = ["anchor", "rk", "pos", "start", "c", "words"]

    def run(batches):
        held: list[dict] = []
        for b in batches:
            out = []
            for r in b.select(names).to_pylist():
                if held and held[0]["anchor"] != r["anchor"]:
                    out += shard_spans(held, length)
                    held = []
                held.append(r)
            yield _span_batch(out)
        if held:
            yield _span_batch(list(shard_spans(held, length)))
    return run


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rk", "s", "e"])


def _halves(length: int):
    """For every surrounding and range [a, b] of words that a window may reach
    before the gram, two hashes: ``any`` of the words that all of the range's
    windows hold, ``all`` of the words that they cover (null where the text
    ends before).  Ranges without a window in the text go."""
    def run(batches):
        for b in batches:
            keep, some, whole = [], [], []
            w_, p_, s_, a_, b_ = (b.column(n).to_pylist() for n in ("words", "pos", "start", "a", "b"))
            for i, (w, pos, start, lo, hi) in enumerate(zip(w_, p_, s_, a_, b_, strict=True)):
                w, at = np.frombuffer(w, dtype=np.uint64), pos - start
                if lo > at or hi < at + length - len(w):
                    continue
                full = hi <= at and lo >= at + length - len(w)
                first = np.array([at - lo, at - hi if full else at - lo])
                stop = np.array([at - hi, at - lo if full else at - hi]) + length
                h = as_long(run_hashes(w, first, stop) ^ mix(np.array([2 * lo, 2 * lo + 1], dtype=np.uint64)))
                keep.append(i)
                some.append(int(h[0]))
                whole.append(int(h[1]) if full else None)
            t = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(some, pa.int64()), pa.array(whole, pa.int64())],
                                             names=[*t.schema.names, "any", "all"])
    return run


def _bisected(scratch: Scratch, around: DataFrame, length: int) -> DataFrame:
    """rk, s, e: what the surroundings of grams share, however many they are.

    The windows around a gram are told by the words they reach before it.
    Ranges of that number are halved: where a surrounding's words under all
    windows of a range occur twice, the range is repeated as a whole and one
    surrounding stands for its equals from there on; where the words that its
    windows have in common occur once, none is repeated; other ranges are cut
    in two.  All is counted by hashes, and rows grow with the surroundings."""
    names = ["anchor", "rk", "pos", "start", "c", "words"]
    top, out, depth = length - GRAM, [], 0
    cur = around.select(*names, F.lit(0).alias("a"), F.lit(top).alias("b"))
    while top >= 0:
        depth += 1
        if depth > 1 or top == 0:  # the words in common of the first range are the gram
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cur.schema)
            rows = scratch.save(cur.mapInArrow(_halves(length), f"{kinds}, any long, all long"), f"ranges-{depth}")
            rows = rows.withColumn("key", F.coalesce("all", F.xxhash64("rk", "pos")))
            equal = scratch.save(rows.groupBy("anchor", "a", "b", "key").agg(
                F.sum("c").alias("n"), F.count("all").alias("held"), F.min("any").alias("any"),
                F.min(F.struct("rk", "pos", "start", "words")).alias("one")), f"equal-{depth}")
            again = equal.where("n > 1 and held > 0").select("anchor", "a", "key")
            out.append(scratch.save(rows.where("c = 1").join(again, ["anchor", "a", "key"], "left_semi").select(
                "rk", (F.col("pos") - F.col("b")).alias("s"), (F.col("pos") - F.col("a") + length).alias("e")), f"spans-{depth}"))
            open_ = equal.where("a < b")
            met = open_.groupBy("anchor", "a", "any").agg(F.count("*").alias("k"), F.min("n").alias("rarest")) \
                .where("k > 1 and rarest = 1").select("anchor", "a", "any")
            cur = scratch.save(open_.join(met, ["anchor", "a", "any"], "left_semi").select(
                "anchor", "one.*", F.least(F.col("n"), F.lit(2)).alias("c"), "a", "b").select(*names, "a", "b"), f"open-{depth}")
            scratch.drop(f"ranges-{depth}", f"equal-{depth}", f"open-{depth - 1}")
            if cur.isEmpty():
                break
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        cur = cur.withColumn("half", F.explode(F.array(F.struct(F.col("a"), middle.alias("b")),
                                                       F.struct((middle + 1).alias("a"), F.col("b"))))) \
            .where("half.a <= half.b").select(*names, "half.a", "half.b")
    found = out[0]
    for more in out[1:]:
        found = found.unionAll(more)
    return found


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`").cast("string")
    return docs.select(F.xxhash64(F.col(f"`{doc_id}`"), t).alias("rk"), t.alias("text"))


def spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """rk, spans: the repeated word ranges [s, e) of each row that has any, by
    the hash ``rk`` of its id and text (ranges may overlap)."""
    scratch = Scratch(docs.sparkSession, "substrings")
    d = _keyed(docs, doc_id, text)
    found = scratch.save(d.mapInArrow(_anchors(length), "anchor long, around long, rk long, pos long"), "anchors")
    twice = (found.groupBy("anchor").agg(F.count("*").alias("c"), F.min("around").alias("lo"), F.max("around").alias("hi"))
             .where("c > 1").select("anchor", (F.col("lo") == F.col("hi")).alias("whole")))
    repeated = scratch.save(found.join(twice, "anchor"), "repeated")
    mixed = repeated.where("not whole")
    kinds = scratch.save(mixed.groupBy("anchor", "around").agg(
        F.count("*").alias("c"), F.min(F.struct("rk", "pos")).alias("at")), "kinds")
    per = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("c").alias("rarest"))
    kinds = kinds.join(per.where("rarest = 1"), "anchor")
    # a gram whose surroundings occur twice or more is repeated as far as a window reaches
    whole = repeated.where("whole").select("rk", "pos").unionAll(
        mixed.join(kinds.where("c > 1").select("anchor", "around"), ["anchor", "around"], "left_semi").select("rk", "pos")
        .unionAll(mixed.join(per.where("rarest > 1").select("anchor"), "anchor", "left_semi").select("rk", "pos")))
    whole = whole.select("rk", F.greatest(F.col("pos") - (length - GRAM), F.lit(0)).alias("s"), (F.col("pos") + length).alias("e"))
    ask = kinds.select("anchor", "c", "kinds", "at.rk", "at.pos")
    places = ask.groupBy("rk").agg(F.collect_list(F.struct("anchor", "pos", "c")).alias("at"))
    around = d.join(places, "rk").dropDuplicates(["rk"]).mapInArrow(
        _surroundings(length), "anchor long, rk long, pos long, start long, c long, words binary")
    around = scratch.save(around, "surroundings")
    large = per.where(F.col("kinds") > SHARD).select("anchor")
    shared = (around.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
              .mapInArrow(_shards(length), "rk long, s long, e long"))
    counted = _bisected(scratch, around.join(large, "anchor", "left_semi"), length)
    both = whole.unionAll(shared).unionAll(counted)
    return both.groupBy("rk").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def _kept(n: int, found: list | None) -> np.ndarray:
    """Which of a text's n words no span covers."""
    change = np.zeros(n + 1, dtype=np.int64)
    for x in found or ():
        change[x["s"]] += 1
        change[min(x["e"], n)] -= 1
    return np.cumsum(change[:n]) == 0


def _joined(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words [start, end) of a text, one space between them."""
    data, change = np.append(text, np.uint8(0x20)), np.zeros(len(text) + 2, dtype=np.int8)
    data[ends] = 0x20  # each word is kept with the byte after it
    change[starts] = 1
    change[ends + 1] -= 1
    return data[np.add.accumulate(change, dtype=np.int8)[:-1].view(bool)][:-1].tobytes()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, gone, sha = [], [], []
        for text, found in zip(texts(b.column("text")), b.column("spans").to_pylist(), strict=True):
            starts, ends = word_bounds(text)
            n.append(len(starts))
            if found:
                keep = _kept(len(starts), found)
                starts, ends = starts[keep], ends[keep]
            gone.append(n[-1] - len(starts))
            sha.append(hashlib.sha256(_joined(text, starts, ends)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def report(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per input row."""
    found = spans(docs, length, doc_id, text)
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    d = d.withColumn("rk", F.xxhash64("doc_id", "text")).join(found, "rk", "left").select("doc_id", "text", "spans")
    return d.mapInArrow(_digest, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")


def without(text: np.ndarray, found: list | None) -> str:
    """The text without the covered words and the white space after them."""
    data = text.tobytes()
    if not found:
        return data.decode()
    starts, _ = word_bounds(text)
    keep = _kept(len(starts), found)
    edges = np.flatnonzero(np.diff(np.r_[True, keep, True].astype(np.int8)))
    parts, at = [], 0
    ends = np.r_[starts, len(data)]
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):  # runs of covered words
        parts.append(data[at:starts[lo]])
        at = int(ends[hi])
    return b"".join([*parts, data[at:]]).decode()


def _removed(text_col: str):
    def run(batches):
        for b in batches:
            out = [None if null else without(t, f) for null, t, f in zip(
                b.column(text_col).is_null().to_pylist(), texts(b.column(text_col)), b.column("#spans").to_pylist(), strict=True)]
            names = [n for n in b.schema.names if n != "#spans"]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == text_col else b.column(n) for n in names],
                                             names=names)
    return run


def remove(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input, all rows and columns, with the repeated words cut from the text."""
    found = spans(docs, length, doc_id, text).select(F.col("rk").alias("#rk"), F.col("spans").alias("#spans"))
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    return docs.join(found, key == F.col("`#rk`"), "left").drop("#rk").mapInArrow(_removed(text), docs.schema)


# ------------------------------------------------------------ an outside reference

MAX_REFERENCE_WORDS = 4_000_000  # what may be broadcast: 32 MB of word hashes
SHARD_WORDS = 50_000  # of one automaton


def reference_spans(docs: DataFrame, reference: DataFrame, length: int = LENGTH, doc_id: str = "doc_id",
                    text: str = "text", reference_text: str = "text") -> DataFrame:
    """doc_id, spans: the maximal word ranges [s, e) of each row that are
    ``length`` words or more of one text of a small outside reference."""
    spark = docs.sparkSession
    words = (reference.select(F.col(f"`{reference_text}`").cast("string").alias("text"))
             .mapInArrow(_hashed, "n long, words binary"))
    words = Scratch(spark, "reference").save(words.where(F.col("n") >= length).distinct(), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    if total > MAX_REFERENCE_WORDS:
        raise ValueError(f"the reference has {total} words; up to {MAX_REFERENCE_WORDS} are broadcast")
    shards, size = [[]], 0
    for r in words.toLocalIterator():
        if size + r["n"] > SHARD_WORDS and shards[-1]:
            shards.append([])
            size = 0
        shards[-1].append(bytes(r["words"]))
        size += r["n"]
    sent = spark.sparkContext.broadcast(shards)
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machines = []
        for shard in sent.value:
            m = Automaton()
            for w in shard:
                m.add(np.frombuffer(w, dtype=np.int64).tolist())
            machines.append(m)
        for b in batches:
            out = []
            for t in texts(b.column("text")):
                w, best = as_long(word_hashes(t)).tolist(), {}
                for m in machines:
                    for e, n in enumerate(m.statistics(w, 0)):
                        if n >= length:
                            best[e + 1 - n] = max(best.get(e + 1 - n, 0), e + 1)
                out.append([{"s": s, "e": e} for s, e in sorted(best.items())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))],
                names=["doc_id", "spans"])
    return d.mapInArrow(run, f"doc_id {id_type}, spans array<struct<s: long, e: long>>")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w = [word_hashes(t) for t in texts(b.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in w], pa.int64()), pa.array([x.tobytes() for x in w], pa.binary())],
                                         names=["n", "words"])
