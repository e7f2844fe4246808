"""Repair of the role structure of conversations.

A conversation is right when its roles read ``(s?(ua)+)?``.  The cheapest edits
that make it so (keep 0, rerole 3, delete 4, insert 3; a truncated row that
stays adds 3; blank and repeated rows must go) are found by Hirschberg's
divide and conquer over the four states of that grammar: a forward and a
backward vector of costs meet in the middle row, the crossing state of least
cost is chosen, and both halves are solved alike, so only vectors are held.
Of equal costs the edits whose letters come first in ASCII are taken: the
forward vector also holds the order of the states' least letter strings.  Two
strings that end with the same row's edit are never one the beginning of the
other, so that order decides alone, and the crossing is exact.  The vectors of
costs, less their least one, are few; each and its move by a kind of row is
worked out once and looked up afterwards.

On Spark rows are put in order by ranges of (conversation, turn, role, text,
row), so a conversation of any size is spread over the tasks that its rows
fill, also when all its rows are equal.  Conversations within one task are
repaired there.  Those that reach a border of a task are put together from
their pieces: repeated texts are found over the pieces, every piece gives its
least costs from each state to each state, one pass over a conversation's
pieces (not rows) picks the crossing states, and the pieces are then solved on
their own.  Only the digest of a whole conversation, a SHA-256, has to read
its rows one after the other; they are streamed through it.

Defined cases: a null conversation id is a conversation; null role and text
are one space, a null turn comes first and counts in no gap; rows of one turn
stand in the order of role and text; equal rows are repeats of the first one;
a role other than ``s...``, ``u...``, ``a...`` (an empty one too) fits nowhere;
very long texts are read whole; an empty table gives no rows; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regpanel.llm.common import Scratch

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_BLANKS = " \t\n\x0b\x0c\r"
HELD = 64 << 20  # bytes of one conversation held before its rows are written as a piece

# ------------------------------------------------------------ grammar and costs
# states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_ACCEPT = (0, 3)
FAR = 1 << 60
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
# kinds of rows: the role's initial (o: other), a capital for a truncated one; b blank, x repeated
KINDS = "suaoSUAObx"


def _row_edits(kind: str) -> list[list[tuple[int, str]]]:
    """[p][q]: least (cost, letters) from p to q over one row, with inserts before it."""
    cut = CUT if kind.isupper() else 0
    table = [[(FAR, "")] * 4 for _ in range(4)]
    for p in range(4):
        at, cost, letters = p, 0, ""
        for _ in range(3):  # a third insert comes back to a state already met
            ways = [(at, DELETE, "D")]
            if kind not in "bx":
                ways += [(q, 0 + cut, "K") for c, q in _NEXT[at].items() if c == kind.lower()]
                ways += [(q, REROLE + cut, "R") for c, q in _NEXT[at].items() if c != "s"]
            for q, c, x in ways:
                table[p][q] = min(table[p][q], (cost + c, letters + x))
            at, cost, letters = _NEXT[at]["u" if at != 2 else "a"], cost + INSERT, letters + "I"
    return table


EDITS = {k: _row_edits(k) for k in KINDS}
#: state -> (cost, inserts) to end rightly
ENDS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]


@lru_cache(maxsize=1 << 15)
def _ahead(costs: tuple, ranks: tuple, kind: str) -> tuple[int, tuple, tuple]:
    """A forward vector one row on: what its least cost grew by, costs, order of letters."""
    best = [min((costs[p] + EDITS[kind][p][q][0], ranks[p], EDITS[kind][p][q][1]) for p in range(4)) for q in range(4)]
    least = min(b[0] for b in best)
    order = sorted({b[1:] for b in best if b[0] < FAR})
    return (least, tuple(min(b[0] - least, FAR) if b[0] < FAR else FAR for b in best),
            tuple(order.index(b[1:]) if b[0] < FAR else -1 for b in best))


@lru_cache(maxsize=1 << 15)
def _back(costs: tuple, kind: str) -> tuple[int, tuple]:
    """A backward vector one row earlier."""
    best = [min(EDITS[kind][p][q][0] + costs[q] for q in range(4)) for p in range(4)]
    least = min(best)
    return least, tuple(b - least if b < FAR else FAR for b in best)


def _only(state: int) -> tuple:
    return tuple(0 if q == state else FAR for q in range(4))


def forward(kinds: str, p: int) -> tuple[int, tuple, tuple]:
    """Cost of the cheapest state, each state's cost above it, order of their least letters; from state p."""
    base, costs, ranks = 0, _only(p), tuple(0 if q == p else -1 for q in range(4))
    for k in kinds:
        more, costs, ranks = _ahead(costs, ranks, k)
        base += more
    return base, costs, ranks


def backward(kinds: str, q: int) -> tuple:
    """Each state's cost to q over the rows, above the cheapest one's."""
    costs = _only(q)
    for k in reversed(kinds):
        _, costs = _back(costs, k)
    return costs


def _solve(kinds: str, p: int, q: int) -> list[str]:
    if len(kinds) <= 16:
        return _short(kinds, p, q)
    mid = len(kinds) // 2
    _, left, ranks = forward(kinds[:mid], p)
    right = backward(kinds[mid:], q)
    x = min((x for x in range(4) if left[x] < FAR and right[x] < FAR), key=lambda x: (left[x] + right[x], ranks[x]))
    return _solve(kinds[:mid], p, x) + _solve(kinds[mid:], x, q)


@lru_cache(maxsize=1 << 15)
def _short(kinds: str, p: int, q: int) -> list[str]:
    if len(kinds) <= 1:
        return [EDITS[kinds][p][q][1]] if kinds else []
    mid = len(kinds) // 2
    _, left, ranks = forward(kinds[:mid], p)
    right = backward(kinds[mid:], q)
    x = min((x for x in range(4) if left[x] < FAR and right[x] < FAR), key=lambda x: (left[x] + right[x], ranks[x]))
    return _short(kinds[:mid], p, x) + _short(kinds[mid:], x, q)


def repair(kinds: str) -> list[str]:
    """Every row's letters: inserts before it, its own edit, and after the last row the closing inserts."""
    if not kinds:
        return []
    _, costs, ranks = forward(kinds, 0)
    q = min((q for q in range(4) if costs[q] < FAR), key=lambda q: (costs[q] + ENDS[q][0], ranks[q]))
    edits = list(_solve(kinds, 0, q))
    edits[-1] += ENDS[q][1]
    return edits


# ------------------------------------------------------------ one conversation


class _Report:
    """The digest of a conversation, fed row by row."""

    def __init__(self):
        self.turns = [None, None, 0]  # least, greatest, distinct
        self.seen = dict.fromkeys("bxt", 0)
        self.illegal = self.cost = self.state = self.lines = 0
        self.before = None
        self.audit: list[str] = []
        self.sha = hashlib.sha256()

    def _line(self, role: str, text: str, step: str) -> None:
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        self.state = _NEXT[self.state][step]

    def add(self, turn, role: str, text: str, kind: str, edits: str) -> None:
        if turn is not None:
            if self.turns[0] is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = turn, self.turns[2] + 1
        if kind in "bx":
            self.seen[kind] += 1
        elif kind.isupper():
            self.seen["t"] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        for e in edits:
            to = "a" if self.state == 2 else "u"
            if e == "I":
                self.cost += INSERT
                self._line({"u": "user", "a": "assistant"}[to], "", to)
            elif e == "D":
                self.cost += DELETE
            else:
                self.cost += (CUT if kind.isupper() else 0) + (REROLE if e == "R" else 0)
                if e == "K":
                    self._line(role, text, role[0])
                else:
                    self._line({"u": "user", "a": "assistant"}[to], text, to)
        self.audit.append(edits)

    def row(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns[2] else 0
        return (gaps, self.seen["b"], self.seen["x"], self.seen["t"], self.illegal, self.cost, "".join(self.audit),
                self.sha.hexdigest())


def _names(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(",")]


_ROW = "turn long, role string, text string, kind string, h long"


def _first_pass(id_type: pa.DataType):
    """Rows in order -> a digest per conversation that surely lies within the
    task, the numbered rows of the others (the first and the last one's)."""
    out_names = ["conv_id", *_names(RESULT), "part", "pos", *_names(_ROW)]
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.string(), pa.int64()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                          names=out_names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos, out = TaskContext.get().partitionId(), 0, []
        none = (None,) * 8
        conv, rows, texts, seen, size, edge = None, [], [], set(), 0, True  # the first conversation may have begun before

        def piece():
            nonlocal rows, size, pos
            out.extend((conv[0], *none, part, pos + i, *r) for i, r in enumerate(rows))
            pos, rows, size = pos + len(rows), [], 0

        def whole():
            live = [r for r in rows if r[3] != "-"]
            report = _Report()
            for (turn, role, text, kind, _), e in zip(live, repair("".join([r[3] for r in live])), strict=True):
                report.add(turn, role, text, kind, e)
            out.append((conv[0], *report.row(), *(None,) * 7))

        for b in batches:
            for cid, turn, role, text, kind, h in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if conv is None:
                    conv = (cid,)
                elif conv[0] != cid:
                    if edge:
                        piece()
                    else:
                        whole()
                    conv, rows, seen, size, edge = (cid,), [], set(), 0, False
                if kind not in "b-" and h in seen:
                    kind = "x"
                elif kind != "-":
                    seen.add(h)
                rows.append((turn, role, text, kind, h))
                size += len(text)
                if size > HELD or (edge and len(rows) >= 1 << 12):
                    edge = True
                    piece()
                if len(out) >= 1 << 12:
                    yield batch(out)
                    out.clear()
        if rows:  # the last one may go on after
            piece()
        if out:
            yield batch(out)
    return run


# ------------------------------------------------------------ conversations over several tasks


def _kinds_of(t: pa.Table) -> tuple[str, list[int]]:
    t = t.sort_by("pos")
    return "".join(t["kind"].to_pylist()), t["pos"].to_pylist()


def _vectors(t: pa.Table) -> pa.Table:
    """A piece's least costs from every state to every state, and the order of the letters behind them."""
    kinds, _ = _kinds_of(t)
    costs, ranks = [], []
    for p in range(4):
        base, c, r = forward(kinds, p)
        costs += [base + x if x < FAR else FAR for x in c]
        ranks += r
    return pa.table([t["conv_id"].slice(0, 1), t["part"].slice(0, 1), pa.array([costs], pa.list_(pa.int64())),
                     pa.array([ranks], pa.list_(pa.int32()))], names=["conv_id", "part", "costs", "ranks"])


def _crossings(t: pa.Table) -> pa.Table:
    """The state before and after every piece of a conversation, and the closing inserts."""
    t = t.sort_by("part")
    at, rank, steps = list(_only(0)), [0, -1, -1, -1], []
    for costs, ranks in zip(t["costs"].to_pylist(), t["ranks"].to_pylist(), strict=True):
        best = [min((at[p] + costs[4 * p + q], rank[p], ranks[4 * p + q], p)
                    for p in range(4) if at[p] < FAR and costs[4 * p + q] < FAR) if any(
                    at[p] < FAR and costs[4 * p + q] < FAR for p in range(4)) else (FAR, -1, -1, -1) for q in range(4)]
        order = sorted({b[1:3] for b in best if b[0] < FAR})
        steps.append([b[3] for b in best])
        at, rank = [b[0] for b in best], [order.index(b[1:3]) if b[0] < FAR else -1 for b in best]
    q = min((q for q in range(4) if at[q] < FAR), key=lambda q: (at[q] + ENDS[q][0], rank[q]))
    closing, ways = [""] * len(steps), []
    closing[-1] = ENDS[q][1]
    for s in reversed(steps):
        ways.append((s[q], q))
        q = s[q]
    ways.reverse()
    return pa.table([t["conv_id"], t["part"], pa.array([w[0] for w in ways], pa.int32()),
                     pa.array([w[1] for w in ways], pa.int32()), pa.array(closing, pa.string())],
                    names=["conv_id", "part", "p", "q", "closing"])


def _piece_edits(rows: pa.Table, way: pa.Table) -> pa.Table:
    kinds, pos = _kinds_of(rows)
    p, q, closing = (way[c][0].as_py() for c in ("p", "q", "closing"))
    edits = list(_solve(kinds, p, q))
    edits[-1] += closing
    return pa.table([rows["part"], pa.array(pos, pa.int64()), pa.array(edits, pa.string())], names=["part", "pos", "edits"])


def _last_pass(id_type: pa.DataType):
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                          names=["conv_id", *_names(RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, report, out = None, _Report(), []
        for b in batches:
            for cid, turn, role, text, kind, edits in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if conv is None or conv[0] != cid:
                    if conv is not None:
                        out.append((conv[0], *report.row()))
                    conv, report = (cid,), _Report()
                    if len(out) >= 1 << 12:
                        yield batch(out)
                        out = []
                if kind != "-":
                    report.add(turn, role, text, kind, edits)
        if conv is not None:
            yield batch([*out, (conv[0], *report.row())])
    return run


def _joined(edge: DataFrame, id_sql: str, id_type: pa.DataType, scratch: Scratch) -> DataFrame:
    """The digests of conversations that reach a border of a task, from their numbered rows."""
    first = Window.partitionBy("conv_id", "h").orderBy("part")  # a text is first in a task at most once: few rows a key
    fresh = edge.where(~F.col("kind").isin("x", "b", "-"))
    again = F.when(F.row_number().over(first) > 1, "x").otherwise(F.col("kind"))
    settled = fresh.select("conv_id", "part", "pos", again.alias("kind"))
    light = scratch.save(settled.unionAll(edge.where(F.col("kind").isin("x", "b")).select("conv_id", "part", "pos", "kind")),
                         "kinds")
    vectors = light.groupBy("conv_id", "part").applyInArrow(
        _vectors, f"conv_id {id_sql}, part int, costs array<long>, ranks array<int>")
    ways = vectors.groupBy("conv_id").applyInArrow(_crossings, f"conv_id {id_sql}, part int, p int, q int, closing string")
    edits = (light.groupBy("conv_id", "part").cogroup(ways.groupBy("conv_id", "part"))
             .applyInArrow(_piece_edits, "part int, pos long, edits string"))
    settled = light.select("part", "pos", F.col("kind").alias("settled")).join(edits, ["part", "pos"])
    rows = edge.select("conv_id", "part", "pos", "turn", "role", "text", "kind").join(settled, ["part", "pos"], "left")
    rows = rows.select("conv_id", "part", "pos", "turn", "role", "text", F.coalesce("settled", "kind").alias("kind"), "edits")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos").drop("part", "pos")
            .mapInArrow(_last_pass(id_type), f"conv_id {id_sql}, {RESULT}"))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, gone: rows dropped (kept here with ``gone``, so that
    their conversation is known), emptied, stripped of full stops, repeated or
    given to the user, by the CRC-32 of ``conv_id:turn``."""
    r = rows.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                    F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    r = r.withColumn("how", F.crc32(key.cast("binary")) % 20).withColumn("row", F.monotonically_increasing_id())
    how = F.col("how")
    new = F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return r.select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), new.alias("text"),
                    (how == 0).alias("gone"), "row",
                    F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _kind() -> Column:
    core = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    cut = ~F.substring(core, -1, 1).isin(".", "!", "?")
    return (F.when(F.col("gone"), "-").when(core == "", "b").when(cut, F.upper(initial)).otherwise(initial))


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of rows as :func:`damage` gives them."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(rows.schema["conv_id"].dataType)
    id_sql = rows.schema["conv_id"].dataType.simpleString()
    scratch = Scratch(rows.sparkSession, "turn-repair")
    keyed = rows.withColumn("kind", _kind()).withColumn("h", F.xxhash64("role", "text"))
    keys = ["conv_id", "turn", "role", "text", "row", "copy"]
    # no number of partitions is named, so Spark's own sizing of shuffles holds
    ordered = (keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select("conv_id", "turn", "role", "text", "kind", "h"))
    first = scratch.save(ordered.mapInArrow(_first_pass(id_type), f"conv_id {id_sql}, {RESULT}, part int, pos long, {_ROW}"),
                         "first")
    done = first.where("part is null").select("conv_id", *_names(RESULT))
    edge = first.where("part is not null").select("conv_id", "part", "pos", *_names(_ROW))
    return done.unionAll(_joined(edge, id_sql, id_type, scratch))


def audit(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """Damage the rows, then repair what is left: one row per conversation."""
    return repaired(damage(conversations, conv_id, turn, role, text))
