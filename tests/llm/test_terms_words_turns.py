"""Source divergence, word BPE and conversation repair against DuckDB, the tokenizer and brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from regpanel.llm import source_divergence, turn_repair, word_trie
from regpanel.llm.packing import read_vocabulary
from regpanel.llm.queries import ORACLE, QUERIES
from tests.llm.test_queries import corpus, prose, same

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ op11


def test_terms_are_counted_as_a_plain_counter_does():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcABZ é日 0_.{xxx", k=rng.randint(0, 60))) for _ in range(400)]
    texts += ["a" * n for n in range(70)] + ["é" * 700, "", "Z" * 5000]
    group = np.array([rng.randint(0, 3) for _ in texts])
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    count, docs = Counter(), Counter()
    for t, g in zip(texts, group.tolist(), strict=True):
        words = TERM.findall(t.translate(LOWER))
        count.update((g, w) for w in words)
        docs.update((g, w) for w in set(words))
    rows = [r for g, t, c, n in source_divergence.count_terms(np.frombuffer(b"".join(data), dtype=np.uint8), offsets, group)
            for r in zip(g.tolist(), t.to_pylist(), c.tolist(), n.tolist(), strict=True)]
    assert {r[:2]: r[2] for r in rows} == count and {r[:2]: r[3] for r in rows} == docs and len(rows) == len(count)


def test_radix_order_is_the_stable_order():
    w = np.random.default_rng(2).integers(0, 1 << 63, (2, 500), dtype=np.uint64) % np.uint64(1 << 33) & np.uint64(0x100010003)
    assert source_divergence.radix_order(list(w)).tolist() == np.lexsort((w[1], w[0])).tolist()


def test_shares_are_exact_beyond_64_bits():
    n, kept = 10**14, 7
    got = source_divergence._share(np.array([0, 3, 10**13 + 1]), n, kept)
    assert got.tolist() == [1 + 10**9 * (c + 2) // (n + 2 * kept) for c in (0, 3, 10**13 + 1)]


AUDIT = "doc_id long, text string, lang string, source string, term string, count int, slice int"


def divergence_rows():
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 5 else None, "x", 1, 2) for i, (_, t, *_) in enumerate(corpus())]
    rows += [(100 + i, f"alpha Beta beta{'z' * i} {'long' * 9} café {prose(30)}", "en", f"s{i % 6}", "x", 1, 2) for i in range(60)]
    return [*rows, rows[-1], rows[-1], (None, "alpha", "xx", "only", "x", 1, 2), (7, None, "en", "void", "x", 1, 2)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_divergence(spark, tables, partitions):
    d, c = tables(documents=(divergence_rows(), AUDIT))  # with columns that are named like the operator's own
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = QUERIES["op11_source_divergence"](spark, d)
        same(out, c.sql(ORACLE["op11_source_divergence"]))
        assert {r["part"] for r in out.select("part").distinct().collect()} == {"pair", "term"}
        assert out.where("lang = 'xx'").count() == 0  # one source, no term in ten documents
        assert out.where("lang = 'en' and source = 'void' and part = 'pair'").count() > 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_blocks_do_not_change_the_counts(spark, tables, monkeypatch):
    d, _ = tables(documents=(divergence_rows(), AUDIT))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    batches = docs.selectExpr("coalesce(lang, '') lang", "coalesce(source, '') source", "coalesce(text, '') text").toArrow().to_batches()

    def total(block):
        monkeypatch.setattr(source_divergence, "BLOCK", block)
        out = Counter()
        for b in source_divergence._counted(iter(batches)):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["term"]] += r["count"] + 1000 * r["docs"]
        return out
    assert total(1) == total(500) == total(1 << 30)


# ------------------------------------------------------------ op12


@pytest.fixture(scope="module")
def word_bpe():
    v = read_vocabulary(P.path("word_bpe_49k.json"))
    return word_trie.WordBpe(v), Tokenizer.from_str(v.decode())


def test_words_are_encoded_as_the_tokenizer_does(word_bpe):
    machine, tokenizer = word_bpe
    rng = random.Random(3)
    pieces = list("abcdeiorstnu'SLTM012 .,!<>|/w\n\t\r\x0b\x0c\x00\x1c\x1f\x7f\x85\xa0é́̈İΣσßäöüœÆﬁ日本語हिन्दी😀 　Ω①²½กำ")
    pieces += ["<|startoftext|>", "<|endoftext|>", "<|StartOfText|>", "'re", "'ll", "  ", "</w>", "w>"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choices("abcdefghinorstu", k=rng.randint(1, 30))) for _ in range(4000)]
    texts += ["a" * n for n in range(120)] + ["ab" * 3000, "x" * 20000, "é" * 5000, "", " \n "]
    for text, ids in zip(texts, machine.encode(texts), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert machine.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


def test_shared_prefixes_and_cache_limits_change_nothing(word_bpe, monkeypatch):
    machine, tokenizer = word_bpe
    words = sorted({w for w in prose(300).split() if w.isascii()} | {"in", "inn", "inner", "innermost", "inne"})
    monkeypatch.setattr(word_trie, "MAX_PAIRS", 3)
    monkeypatch.setattr(word_trie, "CACHE_CHUNKS", 2)
    for w, ids in machine.walk(words):
        assert ids == tokenizer.encode(w, add_special_tokens=False).ids if w.isalpha() else ids
    texts = [prose(20) for _ in range(20)]
    assert [list(machine.encode([t])) for t in texts] == [[" ".join(map(str, tokenizer.encode(t, add_special_tokens=False).ids))]
                                                          for t in texts]


def test_word_bpe(spark, tables, word_bpe, monkeypatch):
    _, tokenizer = word_bpe
    rows = corpus()
    d, _ = tables(documents=([(i, t, 1, "y") for i, t, *_ in rows], "doc_id long, text string, ids int, n_tokens string"))
    want = Counter()
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in QUERIES["op12_word_bpe"](spark, d).collect()) == want
    docs = spark.read.parquet(f"{d}/documents.parquet")
    coded = word_trie.encode(docs, P.path("word_bpe_49k.json"))
    back = word_trie.decode(coded, P.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] for r in back.collect() if r["doc_id"] not in (None, 0)}
    for r in coded.collect():
        if r["doc_id"] in text:
            assert len(r["ids"]) == r["n_tokens"] and text[r["doc_id"]] == tokenizer.decode(r["ids"], skip_special_tokens=False)


# ------------------------------------------------------------ op13


def least_edits(kinds):
    """Every way to edit, kept whole, dearer ones than 6 above a state's best left out."""
    now = {0: {(0, "")}}
    for k in [*kinds, None]:
        for _ in range(2):
            more = {p: set(v) for p, v in now.items()}
            for p, v in now.items():
                for i, q in turn_repair._NEXT[p].items():
                    if i != "s":
                        more.setdefault(q, set()).update((c + 3, s + "I") for c, s in v)
            now = more
        if k is None:
            return min(x for p in (0, 3) for x in now.get(p, ()))[1]
        cut, nxt = 3 * k.isupper(), {}
        for p, v in now.items():
            nxt.setdefault(p, set()).update((c + 4, s + "D") for c, s in v)
            for i, q in turn_repair._NEXT[p].items() if k not in "bx" else ():
                if i == k.lower():
                    nxt.setdefault(q, set()).update((c + cut, s + "K") for c, s in v)
                if i != "s":
                    nxt.setdefault(q, set()).update((c + 3 + cut, s + "R") for c, s in v)
        now = {p: {x for x in v if x[0] <= min(y[0] for y in v) + 6} for p, v in nxt.items()}


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(2)
    some = [a + b for a in turn_repair.KINDS for b in turn_repair.KINDS] + list(turn_repair.KINDS)
    some += ["".join(rng.choices(turn_repair.KINDS, k=rng.randint(3, 5))) for _ in range(150)]
    for k in some:
        assert "".join(turn_repair.repair(k)) == least_edits(k), k


def plain_pass(kinds):
    """The whole table of least letters, without dividing."""
    at = {0: (0, "")}
    for k in kinds:
        at = {q: min(ways) for q in range(4)
              if (ways := [(c + turn_repair.EDITS[k][p][q][0], s + turn_repair.EDITS[k][p][q][1])
                           for p, (c, s) in at.items() if turn_repair.EDITS[k][p][q][0] < turn_repair.FAR])}
    return min((c + turn_repair.ENDS[q][0], s + turn_repair.ENDS[q][1]) for q, (c, s) in at.items())[1]


def test_divided_edits_equal_the_whole_table():
    rng = random.Random(4)
    for _ in range(150):
        k = "".join(rng.choices(turn_repair.KINDS, k=rng.randint(1, 200)))
        assert "".join(turn_repair.repair(k)) == plain_pass(k)


def conversations():
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "", None, "underwriter"]
    texts = ["Yes.", "No!", "no stop", "", None, " \t", "Why? ", "x" * 3000 + ".", "a.b", "Grüße…", " "]
    rows = [(c, t, rng.choices(roles, [9, 9, 3, 1, 1, 1, 1])[0], rng.choice(texts), 1, "z")
            for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(900, t, ["user", "assistant"][t % 2], f"turn {t}.", 1, "z") for t in range(700)]
    rows += [(901, 3, "user", "the same.", 1, "z")] * 60 + [(902, None, "user", "t.", 1, "z"), (902, None, "assistant", "b.", 1, "z")]
    rows += [(None, 0, "user", "hi.", 1, "z"), (None, None, None, None, 1, "z"), (903, 9, "assistant", "q.", 1, "z"),
             (903, 2, "user", "q.", 1, "z"), (904, -5, "system", "s.", 1, "z")]
    rows += [(1000 + c, t, "user", "gone?", 1, "z") for c in range(40) for t in range(1)]
    rng.shuffle(rows)
    return rows


CONV = "conv_id long, turn long, role string, text string, part int, kind string"


@pytest.mark.parametrize("spread", [False, True])
def test_turn_repair(spark, tables, spread, monkeypatch):
    rows = conversations()
    d, c = tables(conversations=(rows, CONV))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(not spread).lower())
    try:
        out = QUERIES["op13_turn_repair"](spark, d)
        same(out, c.sql(ORACLE["op13_turn_repair"]))
        got = out.collect()
        assert len(got) == len({r[0] for r in rows})
        assert any(r["audit"] == "" and r["cost"] == 0 for r in got)  # all rows dropped
        assert all(re.fullmatch("(K|D|R|I)*", r["audit"]) for r in got)
    finally:
        spark.conf.set(key, "true")


def test_damage_of_plain_rows(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(5)]
    got = Counter((r["conv_id"], r["turn"], r["role"], r["text"], r["gone"])
                  for r in turn_repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want = Counter()
    for c, t, role, text in rows:
        how = zlib.crc32(f"{c}:{t}".encode()) % 20
        want[c, t, "user" if how == 4 else role, "" if how == 1 else "One Two Three" if how == 2 else text, how == 0] += 1 + (how == 3)
    assert got == want


# ------------------------------------------------------------ near duplicates by id and text


def test_keep_one_tells_rows_by_id_and_text(spark):
    from regpanel.llm import parity_join
    base, other = prose(80), prose(80)
    near = base + " tail"
    rows = [(1, base, "a"), (1, base, "a"), (2, near, "b"), (2, other, "b"), (3, other, "c"), (4, "", "d"), (4, None, "d"),
            (4, "", "d"), (None, base, "e"), (None, base, "e"), (5, near, "f"), (6, "three short words", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `#id` string")
    got = Counter(tuple(r) for r in parity_join.keep_one(docs).collect())
    # base goes to 1 (once), the unrelated text of 2 stays as the least of its own group, what has no words or id stays
    assert got == Counter([(1, base, "a"), (2, other, "b"), (4, "", "d"), (4, None, "d"), (4, "", "d"), (None, base, "e"),
                           (None, base, "e"), (6, "three short words", "g")])


def test_wide_sketches_never_overstate_a_difference():
    from regpanel.llm import parity_join as J
    rng = np.random.default_rng(8)
    for _ in range(60):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 3000), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 62, rng.integers(0, 900), dtype=np.uint64)]))
        differ = len(np.setxor1d(a, b))
        x, y = (np.frombuffer(J.wide_sketch(v), dtype=np.uint8) for v in (a, b))
        assert J.wide_difference(x, y) <= differ
        if len(a) > 500 and differ < len(a) // 4:
            assert J.wide_difference(x, y) > 0.6 * differ


# ------------------------------------------------------------ byte BPE of long texts and dropped states


def test_byte_bpe_of_long_texts_and_few_states(monkeypatch):
    import tiktoken

    from regpanel.llm import bpe
    path = P.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(read_vocabulary(path)), special_tokens={})
    enc = bpe.Encoder(read_vocabulary(path), P.PATTERN)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 50)  # the branch of long texts, some pieces at a time
    enc.machine.max_states = 200
    rng = random.Random(7)
    for _ in range(30):
        text = "".join(rng.choices("abcdeéßΣ日😀 \n\t.,'s0123", k=rng.randint(51, 900)))
        want = plain.encode_ordinary(text)
        parts = list(enc.stream(text))
        assert len(parts) > 1
        assert np.frombuffer(b"".join(parts), dtype="<u4").tolist() == want
        dec = bpe.Decoder(enc)
        assert "".join([dec.feed(p) for p in parts] + [dec.feed(b"", True)]) == text


def test_one_id_of_two_vectors_has_the_links_of_each(spark):
    from regpanel.llm import graph_dedup
    e = np.eye(6)
    rows = [(1, e[0], "a"), (1, e[1], "a"), (2, e[0] + 0.01 * e[2], "a"), (3, e[1] + 0.01 * e[3], "a"), (3, e[4], "a"), (4, e[4], "b")]
    df = spark.createDataFrame([(i, v.tolist(), x) for i, v, x in rows], "vec_id long, embedding array<double>, label string")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in graph_dedup.near_duplicates(df).collect())
    assert got == Counter([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)])
    assert all(r.audit_recall == 1 for r in graph_dedup.near_duplicates(df).collect())


def _dense(seed=5):
    """Unit vectors of tight groups, pairs and scattered rows."""
    from regpanel.llm import graph_dedup
    rng = np.random.default_rng(seed)
    middles = graph_dedup._unit(rng.normal(size=(8, 32)))
    groups = [m + rng.normal(size=(n, 32)) * 0.015 for m, n in zip(middles, (2, 2, 3, 20, 80, 150, 5, 2), strict=True)]
    return graph_dedup._unit(np.concatenate([*groups, rng.normal(size=(600, 32))]))


def _met(x, edges):
    from regpanel.llm import graph_dedup
    true = x @ x.T >= 0.98
    np.fill_diagonal(true, False)
    q, j = graph_dedup.Graph(x, edges).search(x, np.arange(len(x)), 0.98)
    return int(true[q, j].sum()) / int(true.sum())


def test_the_walk_finds_by_the_graph_alone():
    """Recall comes from the edges: without them it falls, with them nearly all links are met."""
    from regpanel.llm import graph_dedup
    x, none = _dense(), np.empty(0, np.int64)
    assert _met(x, graph_dedup.build(x)) >= 0.99
    assert _met(x, (none, none)) < 0.2


def test_pruned_lists_keep_the_nearest_and_the_degree():
    from regpanel.llm import graph_dedup
    x = _dense(6)
    src, dst = graph_dedup.build(x)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    assert np.bincount(src, minlength=len(x)).max() <= graph_dedup.DEGREE
    near = {}
    for a, b in zip(src.tolist(), dst.tolist(), strict=True):
        near.setdefault(a, []).append(b)
    assert all(s[i, near[i]].max() >= s[i].max() - 1e-5 for i in range(len(x)))
    for i in range(0, len(x), 37):  # brute force: walk the sorted pool, keep what no kept one is alpha times nearer to
        kept = []
        for j in np.argsort(-s[i], kind="stable")[:graph_dedup.POOL]:
            if len(kept) < graph_dedup.DEGREE and all(graph_dedup.ALPHA * (1 - s[k, j]) > 1 - s[i, j] for k in kept):
                kept.append(int(j))
        assert len(set(kept) & set(near[i])) >= len(kept) - 1  # ties in single precision


@pytest.mark.parametrize("broken", ["search", "deal"])
def test_shards_and_labels_of_low_recall_are_compared_whole(spark, monkeypatch, broken):
    """A graph without edges, or a deal that parts groups, costs no link."""
    from regpanel.llm import graph_dedup
    x = _dense(7)
    monkeypatch.setattr(graph_dedup, "TARGET", 200)
    monkeypatch.setattr(graph_dedup, "SHARD_ROWS", 500)
    if broken == "search":
        def lost(t):
            return pa.table({"src": [], "dst": []}, schema=pa.schema([("src", pa.int64()), ("dst", pa.int64())]))
        monkeypatch.setattr(graph_dedup, "_build", lost)
    else:
        monkeypatch.setattr(graph_dedup, "OVERLAP", 1)
        # centres within the tight groups part them
        monkeypatch.setattr(graph_dedup, "_centres", lambda reps: {("1", 32): (0, x[[10, 40, 60, 90, 120, 150, 180, 220]])})
    got = graph_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                                                            "vec_id long, embedding array<double>, label int")).collect()
    true = x @ x.T >= 0.98
    np.fill_diagonal(true, False)
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(true.sum(axis=1).tolist()))
    assert all(r.audit_recall == 1 for r in got)
    assert (got[0].walk_recall < 0.5) == (broken == "search")


@pytest.mark.parametrize("shard", [1, 256])
def test_passages_at_odd_places_by_ranges_and_automata(spark, monkeypatch, shard):
    """Passages of 30 to 60 words cut at random, texts that begin or end within them, repeated and near-equal rows."""
    from regpanel.llm import substring
    monkeypatch.setattr(substring, "SHARD", shard)
    rng = random.Random(23)
    word = lambda k: "w%d" % rng.randrange(k)
    passages = [[word(40) for _ in range(70)] for _ in range(3)]
    rows = []
    for i in range(160):
        p = rng.choice(passages)
        a = rng.randrange(0, 25)
        cut = p[a:a + rng.randint(30, 60)]
        if rng.random() < 0.3:
            cut[rng.randrange(len(cut))] = "changed"
        t = [word(5000) for _ in range(rng.choice((0, 0, 3, 40)))] + cut + [word(5000) for _ in range(rng.choice((0, 0, 5, 40)))]
        rows.append((i, " ".join(t)))
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300, None), (301, "")]
    seen = Counter()
    for _, t in rows:
        w = (t or "").split()
        seen.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
    want = {}
    for i, t in rows:
        w = (t or "").split()
        gone = {j for s in range(len(w) - 34) if seen[tuple(w[s:s + 35])] > 1 for j in range(s, s + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substring.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_large_texts_with_a_common_passage_are_no_candidates(spark, monkeypatch):
    """The bucket sketches of large sets are not full: texts that share only a passage are told apart in the bucket."""
    from regpanel.llm import parity_join as J
    rng = random.Random(31)
    word = lambda: "w%d" % rng.randrange(10 ** 6)
    passage = [word() for _ in range(150)]
    rows = [(i, [word() for _ in range(3000)] + passage) for i in range(12)]
    rows += [(100, rows[0][1][:2900]), (101, rows[0][1][300:])]  # near copies of the first one
    seen, save = {}, J.Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        if name.startswith("screened"):
            seen[name] = out.count()
        return out
    monkeypatch.setattr(J.Scratch, "save", counted)
    got = J.near_groups(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 0 if i > 99 else i for i, _ in rows}
    assert sum(seen.values()) <= 3


def test_bucket_sketches_of_several_sizes():
    from regpanel.llm import parity_join as J
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (1, 40, 900, 1100, 2500, 5000)]
    rows = [J.bucket_sketch(s) for s in sets]
    a, b = (x.ravel() for x in np.meshgrid(range(6), range(6)))
    got = J._Sketches(rows).difference(a, b)
    bits = [np.frombuffer(r, dtype=np.uint8) for r in rows]
    assert got.tolist() == [J.wide_difference(bits[i], bits[j]) for i, j in zip(a, b, strict=True)]
    assert all(d <= len(np.setxor1d(sets[i], sets[j])) for d, i, j in zip(got, a, b, strict=True))


def test_states_of_added_words_give_their_statistics():
    from regpanel.llm import substring
    rng = random.Random(3)
    for _ in range(200):
        rows = [[rng.randrange(4) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 6))]
        weights = [rng.randint(1, 2) for _ in rows]
        full, some = substring.Automaton(), substring.Automaton()
        for m in (full, some):
            for w in rows:
                m.add(w)
        for i, w in enumerate(rows):
            full.own(w, i, weights[i])
        paths = [some.own(w, i, weights[i], enough=2) for i, w in enumerate(rows)]
        for w, path in zip(rows, paths, strict=True):
            assert list(some.held(path, 0, 2)) == list(enumerate(full.statistics(w, 2)))


def test_anchors_are_the_first_least_grams(monkeypatch):
    from regpanel.llm import substring
    rng = np.random.default_rng(6)
    for n, kinds in ((34, 9), (35, 9), (36, 2), (400, 1), (400, 3), (700, 10 ** 6)):
        w = rng.integers(0, kinds, n).astype(np.uint64)
        g = substring.gram_hashes(w, 8)
        want = sorted({i + int(g[i:i + 28].argmin()) for i in range(n - 34)})
        gram, pos = substring.anchors(w, 35)
        assert pos.tolist() == want and (gram == g[pos]).all()


def test_kept_words_are_joined_by_one_space():
    from regpanel.llm import substring
    for text in ("", " ", "a", "\ta  bc\n", "a b c", "é\r\nß  ", "x" * 300 + " y"):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        starts, ends = substring.word_bounds(data)
        assert substring._joined(data, starts, ends).decode() == " ".join(re.findall(r"[^\x20\x09-\x0D]+", text))
        assert substring._joined(data, starts[1:], ends[1:]).decode() == " ".join(re.findall(r"[^\x20\x09-\x0D]+", text)[1:])
