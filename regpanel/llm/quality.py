"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in column expression over the text (no user
function, no shuffle): length, symbol, stop-word and line ratios, plus the
words covered by repeated 5-word windows.

Defined cases: a null text counts as empty (no words: it fails the length
rule); texts of any length are measured whole; repeated rows give one result
row each; an empty table gives an empty result; extra columns, whatever
their names, are ignored by :func:`quality_report` and kept by
:func:`quality_filter`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = """the of and to in is that for on are with as be by this was it or at from an have not they which
der die das und in zu den ist von mit sich des auf für im dem ein eine als nicht
de la le et les des en un du une que est pour dans par sur pas au avec ce
el y a los se del las por con no una su para es al lo como más""".split()


@dataclass(frozen=True)
class Rule:
    """Keep a document when ``low <= measure <= high``; documents with fewer
    than ``from_words`` words are not judged by the rule."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Production thresholds.
RULES = (
    Rule("n_words", low=10),
    Rule("mean_word_chars", low=2.0, high=15.0),
    Rule("symbols_per_word", high=0.1),
    Rule("dup_line_ratio", high=0.5),
    Rule("repeat_word_ratio", high=0.2),
    Rule("stop_words", low=2, from_words=50),
)


def _measures(df: DataFrame, text: str) -> DataFrame:
    """The counts, in columns named ``q.*`` so that no input column clashes."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = df.withColumns({
        "q.t": t,
        "q.words": F.filter(F.split(t, SPACE, -1), lambda w: w != ""),
        "q.lines": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines, tc = F.col("`q.words`"), F.col("`q.lines`"), F.col("`q.t`")
    n = F.size(words)
    gram = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)])
    df = df.withColumns({
        "q.n_words": n.cast("long"),
        "q.word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "q.n_symbols": (F.char_length(tc) - F.char_length(F.translate(tc, SYMBOLS, ""))).cast("long"),
        "q.n_lines": F.size(lines).cast("long"),
        "q.n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "q.stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))).cast("long"),
        "q.hashes": F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), gram)),
    })
    # windows sorted by hash, where any repeats: equal windows become neighbours
    h = F.col("`q.hashes`")
    at = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.withColumn("q.grams", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(at)))
    g = F.col("`q.grams`")
    twice = F.filter(g, lambda x, j: (F.get(g, j - 1)["h"] == x["h"]) | (F.get(g, j + 1)["h"] == x["h"]))
    df = df.withColumn("q.starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.col("`q.starts`"), F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(5), i - acc["last"])).alias("n"), i.alias("last")))
    return df.withColumn("q.n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))


def _verdict(rules) -> Column:
    c = lambda name: F.col(f"`q.{name}`")
    value = {
        "n_words": c("n_words"), "stop_words": c("stop_words"),
        "mean_word_chars": c("word_chars") / F.greatest(c("n_words"), F.lit(1)),
        "symbols_per_word": c("n_symbols") / F.greatest(c("n_words"), F.lit(1)),
        "dup_line_ratio": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
        "repeat_word_ratio": c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
    }
    ok = F.lit(True)
    for r in rules:
        v, judged = value[r.measure], F.lit(True)
        if r.low is not None:
            judged = judged & (v >= r.low)
        if r.high is not None:
            judged = judged & (v <= r.high)
        ok = ok & ((c("n_words") < r.from_words) | judged)
    return ok


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """One row per input row: the counts, base_failed and the verdict ``kept``."""
    m = _measures(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text")
    c = lambda name: F.col(f"`q.{name}`")
    failed = (c("n_words") < 10) | (100 * c("n_repeat_words") > 20 * c("n_words"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return m.select("doc_id", *[c(n).alias(n) for n in names], failed.alias("base_failed"),
                    (~failed & _verdict(rules)).alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass every rule, with the input's columns."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # the row number keeps Spark from moving the filter below the projection, where it
    # would write the split text into every lambda and split it anew for each word
    judged = _measures(docs, text).withColumns({"q.kept": _verdict(rules), "q.row": F.monotonically_increasing_id()})
    return judged.where(F.col("`q.kept`") & (F.col("`q.row`") >= 0)).select(*cols)
