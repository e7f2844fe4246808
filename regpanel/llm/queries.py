"""The queries of the operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regpanel.llm import (bpe, graph_dedup, html_extract, license_scan, packing, parity_join, quality, secret_scan, sharding,
                          source_divergence, substring, turn_repair, word_trie)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ("the of and to in is that for on are with as be by this was it or at from an have not they which der die das "
         "und zu den ist von mit sich des auf für im dem ein eine als nicht de la le et les en un du une que est pour "
         "dans par sur pas au avec ce el y a los se del las por con no su para es al lo como más").split()


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query("op1_embedding_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.c) AS component_id, min(r.c) = r.vec_id AS kept,
       CAST(1.0 AS DOUBLE) AS audit_recall
FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id""")
def op1_embedding_near_dedup(spark, d):
    return graph_dedup.near_duplicates(_table(spark, d, "embeddings")).drop("walk_recall")


@_query("op2_substring_dedup", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
v AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
g AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM v) WHERE c > 1),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
m AS (SELECT p.doc_id, p.i, p.x,
             max(g.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS last
      FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.i = p.i),
k AS (SELECT doc_id, count(*) FILTER (last IS NOT NULL) AS n_removed,
             string_agg(x, ' ' ORDER BY i) FILTER (last IS NULL) AS t FROM m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op2_substring_dedup(spark, d):
    return substring.report(_table(spark, d, "documents"))


@_query("op3_byte_bpe")
def op3_byte_bpe(spark, d):
    import public_tokenizers
    return bpe.round_trip(_table(spark, d, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@_query("op4_ngram_jaccard_join", """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 1, 2)),
                                                    lambda i: array_to_string(w[i:i + 2], ' '))) AS g
      FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op4_ngram_jaccard_join(spark, d):
    return parity_join.near_groups(_table(spark, d, "documents"), k=3, similarity=90)


@_query("op5_packing")
def op5_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"), _tokenizer("word_bpe_49k.json"), with_ids=False)


_PHRASES = ", ".join(f"({i}, '{label}', {str(i < len(license_scan.BASE)).lower()}, '{phrase}')"
                     for i, (label, phrase) in enumerate([*license_scan.BASE, *license_scan.TEMPLATES]))


@_query("op6_license_scan", f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t(template, label, is_base, phrase) AS (VALUES {_PHRASES}),
u AS (SELECT *, string_split(phrase, ' ') AS tw FROM t),
g AS (SELECT template, label, is_base, len(tw) - 2 AS n, i - 1 AS tpos, array_to_string(tw[i:i + 2], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(tw) - 1)) AS i FROM u)),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS pos FROM d),
k AS (SELECT doc_id, pos, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS gram
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
h AS (SELECT doc_id, template, label, is_base, n, pos - tpos AS diag, bit_or(CAST(1 AS BIGINT) << tpos) AS m, min(pos) AS first
      FROM k JOIN g USING (gram) GROUP BY ALL),
e AS (SELECT *, bit_count(m) = n AS exact, lag(diag) OVER (PARTITION BY doc_id, template ORDER BY diag) AS before FROM h),
i AS (SELECT *, sum(CASE WHEN diag - before <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, template ORDER BY diag) AS island
      FROM e),
s AS (SELECT doc_id, template, label, is_base, exact, island, CASE WHEN exact THEN diag END AS at, min(first) AS first,
             bit_count(bit_or(m)) / CAST(any_value(n) AS DOUBLE) AS score
      FROM i GROUP BY ALL),
f AS (SELECT * FROM s WHERE exact OR (NOT is_base AND score >= 0.8))
SELECT d.doc_id, len(any_value(w)) AS n_words, count(*) FILTER (is_base) AS n_base, min(first) FILTER (is_base) AS first_word,
       max(first) FILTER (is_base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0) AS score
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""")
def op6_license_scan(spark, d):
    return license_scan.license_report(_table(spark, d, "documents"))


@_query("op7_sharding")
def op7_sharding(spark, d):
    s = sharding.assign_shards(_table(spark, d, "documents"))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@_query("op8_quality_rules", f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS v,
             lead(x, 4) OVER o IS NOT NULL AS whole
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS c FROM k WHERE whole),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE c > 1)
      GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         len(list_filter(w, lambda x: x IN ({", ".join(f"'{x}'" for x in _STOP)}))) AS n_stop
  FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2.0 * n_words AND 15.0 * n_words AND n_symbols <= 0.1 * n_words
       AND n_dup_lines <= 0.5 * n_lines AND (n_words < 50 OR n_stop >= 2) AS kept
FROM f""")
def op8_quality_rules(spark, d):
    return quality.quality_report(_table(spark, d, "documents"))


@_query("op9_html_extraction")
def op9_html_extraction(spark, d):
    return html_extract.extract(_table(spark, d, "pages"))


@_query("op10_secret_scan")
def op10_secret_scan(spark, d):
    return secret_scan.report(_table(spark, d, "documents"))


@_query("op11_source_divergence", """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 2)) // (n.n + 2 * l.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.c + 2)) // (l.n + 2 * l.v) AS q
      FROM n JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
o AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(o.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN o ON o.lang = a.lang AND o.source = a.source AND o.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 10""")
def op11_source_divergence(spark, d):
    return source_divergence.divergence(_table(spark, d, "documents"))


@_query("op12_word_bpe")
def op12_word_bpe(spark, d):
    return word_trie.round_trip(_table(spark, d, "documents"), _tokenizer("word_bpe_49k.json"))


def _repair_sql() -> str:
    """The repair as one recursive pass over the rows with the least (cost, edits, text) of each of the four states."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    role = {"u": "user", "a": "assistant"}
    far = "CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, t VARCHAR))"

    def plus(x, cost, letter, line):
        return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'e': {x}.e || '{letter}', 't': {x}.t || {line}}} END"

    def least(xs):
        return f"list_min(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL))" if xs else far

    def inserted(q, x):  # what an insert gives from the vector x0..x3
        step = {2: (0, 1, 3), 3: (2,)}.get(q, ())
        who = role[{2: "u", 3: "a"}.get(q, "u")]
        return least([f"{x}{q}", *[plus(f"{x}{p}", 3, "I", f"chr(10) || '{who}:'") for p in step]])

    def row(q):
        ways = [plus(f"j{q}", 4, "D", "''")]
        for (p, i), to in after.items():
            if to == q:
                keep = plus(f"j{p}", "cut", "K", "chr(10) || role || ':' || text")
                ways.append(f"CASE WHEN NOT gone_only AND initial = '{i}' THEN {keep} END")
                if i != "s":
                    new = plus(f"j{p}", "3 + cut", "R", f"chr(10) || '{role[i]}:' || text")
                    ways.append(f"CASE WHEN NOT gone_only THEN {new} END")
        return least(ways)

    vec = lambda f: ", ".join(f(q) for q in range(4))
    once = f"SELECT * REPLACE ({vec(lambda q: inserted(q, 's') + f' AS s{q}')}) FROM"
    return f"""
WITH RECURSIVE z AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
bits AS (SELECT n, list_reduce(list_prepend(CAST(n AS UBIGINT), [CAST(i AS UBIGINT) FOR i IN range(8)]),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS v
         FROM (SELECT unnest(range(256)) AS n)),
tab AS (SELECT list(v ORDER BY n) AS tab FROM bits),
crc AS (SELECT key, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
                        [CAST(ascii(x) AS UBIGINT) FOR x IN string_split(key, '')]),
                lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS how
        FROM (SELECT DISTINCT key FROM z), tab),
r AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
             CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM (SELECT z.*, how, unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS copy FROM z JOIN crc USING (key))
      WHERE how <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
             regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS core, substr(role, 1, 1) AS initial
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r)),
f AS (SELECT *, CASE WHEN core = '' THEN 'b' WHEN nth > 1 THEN 'x' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 't'
                     ELSE '' END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS two FROM o),
k AS (SELECT conv_id, i, role, text, initial, fault IN ('b', 'x') AS gone_only, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS cut FROM f),
e AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'x') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'e': '', 't': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3
      FROM e
      UNION ALL
      SELECT conv_id, i, {vec(lambda q: row(q) + f' AS s{q}')}
      FROM (SELECT x.conv_id, x.i + 1 AS i, role, text, initial, gone_only, cut, x.s0 AS j0, x.s1 AS j1, x.s2 AS j2, x.s3 AS j3
            FROM ({once} ({once} w)) x JOIN k ON k.conv_id IS NOT DISTINCT FROM x.conv_id AND k.i = x.i + 1)),
a AS (SELECT conv_id, {least(['s0', 's3'])} AS best FROM ({once} ({once} (SELECT w.* FROM w JOIN e
      ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.i))))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id"""


@_query("op13_turn_repair", _repair_sql())
def op13_turn_repair(spark, d):
    return turn_repair.audit(_table(spark, d, "conversations"))
