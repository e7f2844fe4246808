"""Source divergence audit: how far the sources of a language differ in their terms.

Terms are counted by length-bucketed packing.  The bytes of a block of texts
are cut into terms at once; terms of up to 8 bytes become one uint64 word,
those of up to 16 bytes two, and the words are put in order by a radix sort of
16-bit digits, so that equal terms of a group stand together and runs are
counted.  Longer terms go to buckets by length, sorted as byte strings.  Each
block gives one row per group and term, Spark adds them up (combined before
the shuffle).  Kept terms are then compared in slices of terms: a task holds
the shares of all sources for its terms only, so neither a large source nor a
large language is one task's work.  The sums over the slices are what the
audit reports; the number of pairs is the square of a language's sources, as
asked for, whatever the number of documents.

All arithmetic is exact: shares are integers, and counts beyond what 64 bits
can hold in between are computed with Python's integers.

Defined cases: null text, language and source are ''; empty texts and texts
without a term still make their group occur; a long text is cut whole, within
one block; every row is a document, so a repeated row counts twice; equal
values rank by item; an empty table gives no rows; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regpanel.llm.common import Scratch

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
BLOCK = 16 << 20  # bytes of text that are counted at once; a longer text is one block
CELLS = 1 << 21  # shares compared at once
SLICE = 1 << 18  # shares of a slice of terms, at least

_TERM = np.ones(256, dtype=bool)
_TERM[:128] = False
_TERM[65:91] = _TERM[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HEAD = np.array([0] + [(1 << 64) - (1 << 64 - 8 * n) for n in range(1, 9)], dtype=np.uint64)


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every term of texts that stand one behind the other."""
    term = np.zeros(len(data) + 2, dtype=bool)
    term[1:-1] = _TERM[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    inside = term[1:] & term[:-1] & ~cut  # no border of a term between this byte and the one before
    start = np.flatnonzero(term[1:-1] & ~inside[:-1])
    return start, np.flatnonzero(term[1:-1] & ~inside[1:]) + 1


def radix_order(words: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """Stable order by the words, the first one most significant: one radix pass for each 16-bit digit that differs."""
    for w in reversed(words):
        differ = int(np.bitwise_or.reduce(w ^ w[0])) if len(w) else 0
        for shift in range(0, 64, 16):
            if differ >> shift & 0xFFFF:
                digit = (w >> np.uint64(shift)).astype(np.uint16)
                if order is None:
                    order = np.argsort(digit, kind="stable")
                else:
                    order = order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(words[0])) if order is None else order


def _runs(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and number of documents of every run of equal keys."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = keys[0][1:] != keys[0][:-1]
    for k in keys[1:]:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    new[1:] |= doc[1:] != doc[:-1]
    return first, np.diff(np.append(first, len(doc))), np.add.reduceat(new.astype(np.int64), first)


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """(group, term bytes as an Arrow array, count, documents) by length bucket;
    ``offsets`` bound the texts in ``data``, ``group`` is a number per text."""
    start, end = _bounds(data, offsets)
    if not len(start):
        return
    size = end - start
    doc = np.searchsorted(offsets, start, "right") - 1
    of = group[doc].astype(np.uint64)
    low = np.zeros(len(data) + 16, dtype=np.uint8)
    low[:len(data)] = _LOWER[data]
    eight = np.ndarray((len(data) + 8,), dtype=">u8", buffer=low, strides=(1,))
    whole = low.tobytes()
    for least, most in _buckets(int(size.max())):
        at = np.flatnonzero((size >= least) & (size <= most))
        if not len(at):
            continue
        s, n = start[at], size[at]
        if most <= 16:
            words = [eight[s].astype(np.uint64) & _HEAD[np.minimum(n, 8)]]
            if most > 8:
                words.append(eight[s + 8].astype(np.uint64) & _HEAD[n - 8])
            order = radix_order([of[at], *words])
        else:  # terms hold no zero byte, so the padding is no part of them
            words = [np.array([whole[a:a + k] for a, k in zip(s.tolist(), n.tolist(), strict=True)], dtype=f"S{most}")]
            order = radix_order([of[at]], np.argsort(words[0], kind="stable"))
        first, count, docs = _runs([of[at][order], *[w[order] for w in words]], doc[at][order])
        pick = order[first]
        yield of[at][pick].astype(np.int64), _strings(low, s[pick], n[pick]), count, docs


def _buckets(longest: int) -> Iterator[tuple[int, int]]:
    yield 1, 8
    yield 9, 16
    w = 16
    while w < longest:
        yield w + 1, 2 * w
        w *= 2


def _strings(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.cumsum(size)
    at = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]))
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(low[at]))


def _count_block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(batches).combine_chunks()
    groups: dict[tuple, int] = {}
    of = np.array([groups.setdefault(g, len(groups))
                   for g in zip(t["lang"].to_pylist(), t["source"].to_pylist(), strict=True)], dtype=np.int64)
    text = t["text"].combine_chunks().cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    lang, source = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
    names = ["lang", "source", "term", "count", "docs"]
    zero = pa.array([0] * len(groups), pa.int64())
    yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(groups), pa.string()), zero, zero], names=names)
    for g, term, count, docs in count_terms(data, offsets - offsets[0], of):
        yield pa.RecordBatch.from_arrays([lang.take(pa.array(g)), source.take(pa.array(g)), term.cast(pa.string()),
                                          pa.array(count, pa.int64()), pa.array(docs, pa.int64())], names=names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in batches:
        bytes_of = np.asarray(pc.binary_length(b.column("text")))
        start = 0
        while start < b.num_rows:  # whole texts, about BLOCK bytes at a time
            ends = np.cumsum(bytes_of[start:])
            stop = start + max(1, int(np.searchsorted(ends, BLOCK - size, "right")))
            held.append(b.slice(start, stop - start))
            size += int(ends[stop - start - 1])
            start = stop
            if size >= BLOCK or start < b.num_rows:
                yield from _count_block(held)
                held, size = [], 0
    if held:
        yield from _count_block(held)


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents of every term
    of every group, and a row with a null term for every group that occurs."""
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    parts = named.mapInArrow(_counted, "lang string, source string, term string, count long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    of = total + 2 * kept
    if of and (total + 2) * SCALE >= 1 << 63:
        return np.array([1 + SCALE * (int(c) + 2) // of for c in count], dtype=np.int64)
    return 1 + SCALE * (count + 2) // of if of else np.zeros(len(count), dtype=np.int64)


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most 1 + SCALE, so all fits 64 bits."""
    return (p - q) ** 2 // (p + q)


def _compare(top: int):
    """One slice of a language's terms: every pair's sum over them, and every group's best terms."""
    def run(t: pa.Table) -> pa.Table:
        term = t["term"].combine_chunks()
        mark = np.asarray(pc.is_null(term))
        source = t["source"].to_pylist()
        count, total = np.asarray(t["count"]), np.asarray(t["lang_count"])
        marks = sorted((source[i], int(count[i]), int(total[i]), i) for i in np.flatnonzero(mark))
        names, kept = [m[0] for m in marks], int(t["kept"][marks[0][3]].as_py())
        place = {s: i for i, s in enumerate(names)}
        rows = np.flatnonzero(~mark)
        col = np.array([place[source[i]] for i in rows], dtype=np.int64)
        coded = term.take(pa.array(rows)).dictionary_encode()
        words, code = coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64)
        by_bytes = sorted(range(len(words)), key=lambda i: words[i].encode())
        rank = np.empty(len(words), dtype=np.int64)
        rank[by_bytes] = np.arange(len(words))
        code = rank[code]  # terms in the order of their bytes
        order = np.argsort(code, kind="stable")
        rows, col, code = rows[order], col[order], code[order]
        share = np.empty(len(rows), dtype=np.int64)
        for i, (_, n, _, _) in enumerate(marks):
            of = col == i
            share[of] = _share(count[rows[of]], n, kept)
        none = np.array([int(_share(np.zeros(1, dtype=np.int64), m[1], kept)[0]) for m in marks], dtype=np.int64)

        out: list[tuple] = []
        whole = _share(total[rows], marks[0][2], kept)
        over = np.flatnonzero(share > whole)
        value = _far(share[over], whole[over])
        best = over_order = np.lexsort((code[over], -value, col[over]))
        new = np.ones(len(best), dtype=bool)
        new[1:] = col[over][best][1:] != col[over][best][:-1]
        starts = np.flatnonzero(new)
        nth = np.arange(len(best)) - np.repeat(starts, np.diff(np.append(starts, len(best))))
        for i in over_order[nth < top].tolist():
            out.append(("term", names[col[over[i]]], words[by_bytes[code[over[i]]]], int(value[i])))

        sums = np.zeros((len(names), len(names)), dtype=np.int64)
        step = max(1, CELLS // max(1, len(names)))
        for lo in range(0, len(words), step):
            hi = min(lo + step, len(words))
            a, b = np.searchsorted(code, [lo, hi])
            table = np.repeat(none[:, None], hi - lo, axis=1)
            table[col[a:b], code[a:b] - lo] = share[a:b]
            for i in range(len(names) - 1):
                sums[i, i + 1:] += _far(table[i + 1:], table[i]).sum(axis=1)
        for i, a in enumerate(names):
            out += [("pair", a, names[j], int(sums[i, j])) for j in range(i + 1, len(names))]
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        lang = pa.array([t["lang"][0].as_py()] * len(out), pa.string())
        return pa.table([lang, *[pa.array(c, k) for c, k in zip(cols, [pa.string()] * 3 + [pa.int64()], strict=True)]],
                        names=["lang", "part", "source", "item", "value"])
    return run


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
               top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the
    language with its distance (``pair``), and the ``top`` terms that the
    source uses more than its language does (``term``)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    counts = scratch.save(term_counts(docs, lang, source, text), "counts")
    terms = counts.where("term is not null")
    kept = (terms.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    rows = scratch.save(terms.drop("docs").join(kept, ["lang", "term"]), "kept")
    groups = counts.where("term is null").select("lang", "source")
    in_group = rows.groupBy("lang", "source").agg(F.sum("count").alias("count"))
    in_lang = (rows.groupBy("lang", "term").agg(F.first("lang_count").alias("n"))
               .groupBy("lang").agg(F.sum("n").alias("lang_count"), F.count("*").alias("kept")))
    marks = (groups.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
             .na.fill(0, ["count", "lang_count", "kept"]))
    marks = scratch.save(marks, "groups")
    # slices by the size of the largest language; a slice holds more shares than it gives pairs of sources
    cells = F.greatest(F.lit(SLICE), 8 * F.count("*") * F.count("*"))
    sizes = marks.groupBy("lang").agg(F.ceil(F.max("kept") * F.count("*") / cells).alias("n"))
    n = max(1, sizes.agg(F.max("n")).first()[0] or 1)
    dealt = rows.select("lang", F.expr(f"cast(pmod(xxhash64(term), {n}) as int)").alias("slice"), "source", "term", "count",
                        "lang_count", F.lit(0).cast("long").alias("kept"))
    everywhere = marks.select("lang", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slice"), "source",
                              F.lit(None).cast("string").alias("term"), "count", "lang_count", "kept")
    parts = (dealt.unionByName(everywhere).groupBy("lang", "slice")
             .applyInArrow(_compare(top), "lang string, part string, source string, item string, value long"))
    sums = parts.groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.when(F.col("part") == "pair", F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"),
                                                                                         F.col("source").alias("item")))
                  ).otherwise(F.array(F.struct("source", "item")))
    both = sums.select("lang", "part", "value", F.explode(ways).alias("w")).select("lang", "w.source", "part", "w.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return both.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
