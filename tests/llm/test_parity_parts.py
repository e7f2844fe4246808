"""Buckets of the Jaccard join: parted by the sketches of the pieces that follow, near copies compared once."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from regpanel.llm import parity_join as J


def long(x):
    return np.asarray(x, dtype=np.int64)


@pytest.mark.parametrize("similarity", [70, 80, 90])
def test_similar_sets_meet_where_their_followers_are_near(similarity):
    rng, bands, tried = np.random.default_rng(similarity), J.Bands(similarity), 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(2, 400), dtype=np.uint64))
        kept = a[rng.random(len(a)) >= rng.random() * (100 - similarity) / 100]
        b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, rng.integers(0, 1 + len(a) // 20), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or 100 * both < similarity * (len(a) + len(b) - both):
            continue
        (keys, near), (others, far) = J.piece_keys(a, bands), J.piece_keys(b, bands)
        _, i, j = np.intersect1d(keys, others, return_indices=True)
        assert (np.bitwise_count(near[i] ^ far[j]) <= J.RUN).any()
        tried += 1
    assert tried > 100


@pytest.mark.parametrize("matrix", [2, 64])
@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_parts_stream(monkeypatch, matrix, batch):
    monkeypatch.setattr(J, "MATRIX", matrix)
    rng = np.random.default_rng(batch)
    rows = sorted({(int(k), int(s)) for k, s in zip(rng.integers(-20, 20, 500) ** 3 // 90, rng.integers(0, 90, 500), strict=True)})
    base = rng.integers(-(1 << 63), 1 << 63, 4)
    near = {r: int(base[rng.integers(0, 4)] ^ (1 << int(rng.integers(0, 62)) | 1 << int(rng.integers(0, 62)))) for r in rows}
    want, of = [], defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    for left in of.values():
        while left:
            part = [left.pop(0)]
            for r in part:
                close = [x for x in left if ((near[r] ^ near[x]) & (1 << 64) - 1).bit_count() <= J.RUN]
                part += close
                left = [x for x in left if x not in close]
            if len(part) > 1:
                want.append(sorted(s for _, s in part))
    rows = sorted(rows + rows[::3])  # copies in other tasks
    state, out = J._Parts(), []
    for i in range(0, len(rows), batch):
        some = rows[i:i + batch]
        out.append(state.feed(long([k for k, _ in some]), long([s for _, s in some]), long([near[r] for r in some])))
    out.append(state.feed(long([]), long([]), long([]), end=True))
    key, sid = (np.concatenate(c) for c in zip(*out, strict=True))
    edge = np.flatnonzero(key[1:] != key[:-1]) + 1
    assert len(edge) + 1 == len(set(key.tolist()))
    assert sorted(x.tolist() for x in np.split(sid, edge)) == sorted(want)


@pytest.mark.parametrize("batch", [1, 4, 100])
def test_large_buckets_are_passed_on(monkeypatch, batch):
    """Of more than HELD members none is lost, whatever the sketches say."""
    monkeypatch.setattr(J, "HELD", 5)
    rng = random.Random(1)
    rows = [(k, s, rng.getrandbits(60)) for k, m in ((1, 40), (2, 1), (3, 2), (4, 30)) for s in range(m)]
    state, out = J._Parts(), []
    for i in range(0, len(rows), batch):
        out.append(state.feed(*(long(c) for c in zip(*rows[i:i + batch], strict=True))))
    out.append(state.feed(long([]), long([]), long([]), end=True))
    got = list(zip(*(np.concatenate(c).tolist() for c in zip(*out, strict=True)), strict=True))
    assert set(got) <= {r[:2] for r in rows} and len(got) == len(set(got))
    if batch < 5:
        assert got == [r[:2] for r in rows if r[0] in (1, 4)]


def test_texts_with_common_shingles_are_in_no_bucket(spark, monkeypatch):
    """Texts of their own that share a few words make no pairs, however many they are."""
    rng = random.Random(12)
    word = lambda: "w%d" % rng.randrange(10 ** 7)
    phrase = "to be or not to be".split()
    rows = [[word() for _ in range(40)] + phrase + [word() for _ in range(40)] for _ in range(300)]
    rows += [rows[7][:-2], rows[9][1:]]
    seen, save = {}, J.Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        if name == "shared":
            seen[name] = out.count()
        return out
    monkeypatch.setattr(J.Scratch, "save", counted)
    got = J.near_groups(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string"), 5, 80)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: {300: 7, 301: 9}.get(i, i) for i in range(302)}
    assert seen["shared"] < 100


def _rows(sets: list[np.ndarray], label: list[int]) -> pa.RecordBatch:
    n = len(sets)
    cols = [long([5] * n), long([0] * n), long([0] * n), long(range(n)), long([len(s) for s in sets]), long(label), long([-1] * n)]
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array([J.bucket_sketch(s) for s in sets], pa.binary())],
                                      names=["key", "x", "y", "sid", "n", "label", "block", "sketch"])


def test_near_copies_of_a_bucket_are_compared_until_joined(monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    copies = [np.unique(np.concatenate([base[rng.random(300) > 0.02], rng.integers(0, 1 << 62, 3, dtype=np.uint64)])) for _ in range(400)]
    others = [np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64)) for _ in range(3)]
    sets, compared, difference = [*copies, *others], [], J._Sketches.difference

    def counted(self, a, b):
        compared.append(len(a))
        return difference(self, a, b)
    monkeypatch.setattr(J._Sketches, "difference", counted)
    out = pa.Table.from_batches(J._compare(80, True)(iter([_rows(sets, list(range(403)))])))
    links = list(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
    group = list(range(403))
    for a, b in links:
        group = [group[b] if g == group[a] else g for g in group]
    assert len(links) == 399 and len(set(group[:400])) == 1 and len(set(group)) == 4
    assert sum(compared) < 403 * 402 / 2 / 10


def test_all_pairs_of_different_groups_where_no_forest_is_asked():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    sets = [np.unique(base[rng.random(200) > 0.01 * (i % 20)]) for i in range(60)]
    label = [int(x) for x in rng.integers(0, 7, 60)]
    out = pa.Table.from_batches(J._compare(80, False)(iter([_rows(sets, label)])))
    got = set(zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
    need = {(i, j) for j in range(60) for i in range(j) if label[i] != label[j]
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert need <= got and all(label[a] != label[b] for a, b in got) and len(need) > 100
