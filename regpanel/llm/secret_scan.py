"""Secret scan with corpus-wide ownership frequency.

Candidates are assignments, access keys, long hex strings and random-looking
strings.  Their values' hashes are counted over the whole corpus by distinct
repository and distinct owner (Spark combines both counts on the map side, so
a value in a third of all documents is no hot key).  A value that many owners
hold is a copied example; one that few hold is a live-looking credential.
Only hashes, places and counts are shuffled, never the values.

Defined cases: a null text counts as empty; a null repository or owner counts
as no owner; texts are scanned whole; repeated rows give one result row each;
an empty table gives an empty result; extra columns are ignored by
:func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.common import Scratch

KINDS = ("assign", "access", "hex", "random")
MAX_OWNERS = 2  # a value that more owners hold is an example
MIN_RANDOM, MIN_BITS = 24, 3.8  # length and Shannon bits a character of random-looking strings
MARK = "[SECRET]"

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
RANDOM = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RANDOM)
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _random(s: str) -> bool:
    """Digits, capitals and small letters mixed, with the entropy of random characters."""
    if not (re.search("[0-9]", s) and re.search("[A-Z]", s) and re.search("[a-z]", s)):
        return False
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) >= MIN_BITS


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) in code points, by start, then kind; each
    kind's matches are leftmost and do not overlap."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(0, m.start(), m.end(), m.group(1)) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, m.start(), m.end(), m.group()) for m in HEX.finditer(text)]
    base = [(s, e) for _, s, e, _ in out]
    out += [(3, m.start(), m.end(), m.group()) for m in RANDOM.finditer(text)
            if _random(m.group()) and not any(s < m.end() and m.start() < e for s, e in base)]
    out.sort(key=lambda x: (x[1], x[0]))
    return out


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.binary())])
_SPAN_SQL = "array<struct<kind: int, start: long, stop: long, value: binary>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's candidates, with a number of its own."""
    row = TaskContext.get().partitionId() << 40
    for b in batches:
        spans = [[{"kind": k, "start": s, "stop": e, "value": _digest(v)} for k, s, e, v in find(t or "")]
                 for t in b.column("text").to_pylist()]
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(row, row + n), pa.int64()), b.column("doc_id"), b.column("fp"), b.column("repo"),
             b.column("owner"), pa.array(spans, pa.list_(_SPAN))],
            names=["row", "doc_id", "fp", "repo", "owner", "spans"])
        row += n


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source",
         max_owners: int = MAX_OWNERS) -> DataFrame:
    """row, doc_id, fp (hash of the text), found: an array of (start, kind, stop, repos, owners, live),
    by start, then kind; one row per input row."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("fp"),
                    F.col(f"`{repo}`").cast("string").alias("repo"), F.col(f"`{owner}`").cast("string").alias("owner"),
                    F.col(f"`{text}`").alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = scratch.save(d.mapInArrow(_find, f"row long, doc_id {id_type}, fp long, repo string, owner string, spans {_SPAN_SQL}"),
                        "candidates")
    each = rows.select("row", "repo", "owner", F.explode("spans").alias("s"))
    counts = each.groupBy("s.value").agg(F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners"))
    judged = each.join(counts, each["s.value"] == counts["value"]).select(
        "row", F.struct("s.start", "s.kind", "s.stop", "repos", "owners",
                        (F.col("owners") <= max_owners).alias("live")).alias("f"))
    found = judged.groupBy("row").agg(F.array_sort(F.collect_list("f")).alias("found"))
    return rows.select("row", "doc_id", "fp").join(found, "row", "left").select(
        "row", "doc_id", "fp", F.coalesce("found", F.lit([]).cast(found.schema["found"].dataType)).alias("found"))


def is_base(f):
    return f["kind"] < 3


def is_reported(f):
    """Base spans always; the method's own where few owners hold the value."""
    return (f["kind"] < 3) | f["live"]


def _equals(k: int):
    return lambda x: x == k


def _joined(a):
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(a, lambda f: F.concat_ws(":", F.get(name, f["kind"]), f["start"].cast("string"),
                                                             f["stop"].cast("string"))), ",")


def report(docs: DataFrame, **columns) -> DataFrame:
    """The counts, the digest of the base spans, all reported spans, and how
    many of them are live-looking or copied examples."""
    f = scan(docs, **columns)
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    kinds = F.transform("found", lambda x: x["kind"])
    return f.select(
        "doc_id", *[F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(F.filter("found", is_base)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.filter("found", is_reported)).alias("spans"),
        count(lambda x: is_reported(x) & x["live"]).alias("n_live"),
        count(lambda x: is_reported(x) & ~x["live"]).alias("n_example"))


def _cut(text_col: str, mark: str):
    def run(batches):
        for b in batches:
            out = []
            for t, spans in zip(b.column(text_col).to_pylist(), b.column("#spans").to_pylist(), strict=True):
                if spans:
                    parts, at = [], 0
                    for s in spans:  # by start; overlapping ones are cut once
                        if s["stop"] > at:
                            if s["start"] >= at:
                                parts += [t[at:s["start"]], mark]
                            at = s["stop"]
                    t = "".join([*parts, t[at:]])
                out.append(t)
            cols = [pa.array(out, pa.string()) if n == text_col else b.column(n) for n in b.schema.names if n != "#spans"]
            yield pa.RecordBatch.from_arrays(cols, names=[n for n in b.schema.names if n != "#spans"])
    return run


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = MARK, **columns) -> DataFrame:
    """The input with every reported span replaced by ``mark``; all rows and columns stay."""
    f = scan(docs, doc_id=doc_id, text=text, **columns)
    spans = (f.withColumn("spans", F.filter("found", is_reported)).where(F.size("spans") > 0)
             .groupBy(F.col("doc_id").alias("#id"), F.col("fp").alias("#fp"))
             .agg(F.first("spans").alias("#spans")))  # rows of one id and text have the same spans
    on = (F.col(f"`{doc_id}`").eqNullSafe(F.col("`#id`"))) & (F.xxhash64(F.col(f"`{text}`")) == F.col("`#fp`"))
    joined = docs.join(spans, on, "left").drop("#id", "#fp")
    return joined.mapInArrow(_cut(text, mark), docs.schema)
