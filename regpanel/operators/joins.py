"""Joins with dplyr defaults: NULL keys match NULL keys, left keys kept,
many-to-many fans out.  Whether a side is broadcast is left to
spark.sql.autoBroadcastJoinThreshold and to AQE, which know sizes in bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def join(left: DataFrame, right: DataFrame, on, how: str = "inner", null_safe: bool = True,
         suffix: tuple[str, str] = ("_x", "_y"), expect: str = "many") -> DataFrame:
    """dplyr-style *_join.

    ``on``: a name, a list of names / (left, right) pairs, or {left: right}.
    Output: all left columns, then right non-key columns; clashing non-key
    names get ``suffix``.  ``null_safe`` makes NULL keys match (``<=>``).
    ``expect="one"`` allows one right row per key (:func:`one_per_key`), checked
    while the join runs; :func:`join_conflicts` lists what it would raise on.
    """
    if expect not in ("one", "many"):
        raise ValueError("join: expect is 'one' or 'many'")
    pairs = _pairs(on)
    if expect == "one":
        right = one_per_key(right, [r for _, r in pairs], "join")
    lk = {l for l, _ in pairs}
    rk = {r for _, r in pairs}
    l_rest = [c for c in left.columns]
    r_rest = [c for c in right.columns if c not in rk]
    clash = (set(l_rest) - lk) & set(r_rest)
    L, R = left.alias("__l"), right.alias("__r")
    conds = [(F.col(f"__l.`{l}`").eqNullSafe(F.col(f"__r.`{r}`")) if null_safe
              else F.col(f"__l.`{l}`") == F.col(f"__r.`{r}`")) for l, r in pairs]
    j = L.join(R, reduce(lambda a, b: a & b, conds), how)
    out = [F.col(f"__l.`{c}`").alias(c + suffix[0] if c in clash else c) for c in l_rest]
    if how not in ("left_semi", "left_anti", "semi", "anti"):
        out += [F.col(f"__r.`{c}`").alias(c + suffix[1] if c in clash else c) for c in r_rest]
    return j.select(*out)


def one_per_key(df: DataFrame, keys: list[str], what: str = "table") -> DataFrame:
    """The rows of ``df``; raises, when it runs, where ``keys`` repeat (NULL
    equals NULL).  The count is taken in the aggregate that the following join
    or aggregate on ``keys`` is partitioned for, so nothing is read twice."""
    keys = list(dict.fromkeys(keys))
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit(None)
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(
        f"{what}: key {keys} is not unique; join_conflicts() lists the repeats"))).otherwise(row)
    g = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(one.alias("__row"))
    if not rest:  # the check has to stay in the plan
        return g.where(F.coalesce(F.col("__row").cast("string"), F.lit("")) == "").select(*keys)
    return g.select(*[F.col("__row")[c].alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns])


def join_conflicts(right: DataFrame, keys: list[str], left: DataFrame | None = None) -> DataFrame:
    """The dry form of ``expect="one"``: every key with more than one right
    row and how many it has; with ``left``, only keys that a left row has."""
    c = (right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))
    return c if left is None else join(c, left.select(*keys), keys, "left_semi")


def natural_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """Shared column names, in the order of ``a`` (dplyr natural join)."""
    bs = set(b.columns)
    return [c for c in a.columns if c in bs]


def left_join_chain(tables: list[DataFrame], by: list[str] | None = None,
                    null_safe: bool = True, expect: str = "many") -> DataFrame:
    """Reduce(left_join, tables): base is the first table; ``by=None`` joins on
    all shared names at each step (a shared measure name becomes a key)."""
    def step(acc, t):
        keys = by if by is not None else natural_keys(acc, t)
        if not keys:
            raise ValueError("left_join_chain: no shared columns")
        return join(acc, t, keys, "left", null_safe=null_safe, expect=expect)
    return reduce(step, tables[1:], tables[0])


def folded_join_chain(tables: list[DataFrame], null_safe: bool = True) -> DataFrame:
    """The natural :func:`left_join_chain` of tables with one row per key, with
    fewer joins: following tables that share the same columns with what is
    joined so far, and none with one another, are laid side by side in one
    aggregate on those columns and joined at once.  The keys are found step by
    step, as in the chain.  A table with repeated keys raises, when it runs."""
    acc, rest = tables[0], list(tables[1:])
    while rest:
        keys = natural_keys(acc, rest[0])
        if not keys:
            raise ValueError("folded_join_chain: no shared columns")
        run, new = [], set()
        while rest and natural_keys(acc, rest[0]) == keys and not new & set(rest[0].columns):
            new |= set(rest[0].columns) - set(keys)
            run.append(rest.pop(0))
        if len(run) == 1:
            acc = join(acc, run[0], keys, "left", null_safe=null_safe, expect="one")
            continue
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [t.withColumn("__no", F.lit(i)) for i, t in enumerate(run)])
        aggs = []
        for i, t in enumerate(run):
            many = F.count_if(F.col("__no") == i) > 1
            for c in (c for c in t.columns if c not in keys):
                value = F.first(F.when(F.col("__no") == i, F.col(f"`{c}`")), ignorenulls=True)
                aggs.append(F.when(many, F.raise_error(F.lit(f"chain: key {keys} is not unique"))).otherwise(value).alias(c))
        acc = join(acc, both.groupBy(*keys).agg(*aggs), keys, "left", null_safe=null_safe)
    return acc


def fold_as_pivot(long_df: DataFrame, keys: list[str], name_col: str, value_cols: list[str],
                  codes: list[str], base: str) -> DataFrame:
    """Keyed left-join fold over n measures held in one long table, done as a
    single conditional aggregation (one shuffle instead of n joins).

    Rows are kept for the keys present in the ``base`` measure, as the fold
    would.  (keys, name_col) must be unique: repeats raise, when it runs, out
    of the same aggregate.
    Output columns per code: ``code`` for the first value column,
    ``code + '_' + v`` for the others.
    """
    aggs = [F.max(F.when(F.col(name_col) == base, F.lit(1))).alias("__in_base")]
    for code in codes:
        of = F.col(name_col) == code
        for i, v in enumerate(value_cols):
            name = code if i == 0 else f"{code}_{v}"
            value = F.first(F.when(of, F.col(v)), ignorenulls=True)
            if i == 0:
                value = F.when(F.count_if(of) > 1, F.raise_error(F.lit(
                    f"fold: {keys} is not unique for {code}; join_conflicts() lists the repeats"))).otherwise(value)
            aggs.append(value.alias(name))
    return (long_df.where(F.col(name_col).isin(codes))
                   .groupBy(*keys).agg(*aggs)
                   .where(F.col("__in_base") == 1).drop("__in_base"))


def bind_cols_by_key(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """cbind + drop later duplicate names, re-aimed as a key join: each later
    table contributes only the names not seen before.  A later table with
    repeated keys raises (its rows have no one place); bind such tables by
    position (:func:`regpanel.sources.readers.read_with_ordinal` and
    :func:`bind_cols_by_position`)."""
    seen = list(tables[0].columns)
    acc = tables[0]
    for t in tables[1:]:
        new = [c for c in t.columns if c not in seen]
        if not new:
            continue
        acc = join(acc, t.select(*keys, *new), keys, "left", expect="one")
        seen += new
    return acc


def bind_cols_by_position(tables: list[DataFrame], ordinal: str = "__ord") -> DataFrame:
    """cbind + drop later duplicate names: rows with the same ``ordinal`` stand
    side by side, the first table that has a name gives the column.  One
    aggregate for all tables; a row that one of them lacks raises."""
    seen: list[str] = [ordinal]
    parts = []
    for t in tables:
        new = [c for c in t.columns if c not in seen]
        seen += new
        parts.append(t.select(ordinal, *new))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    short = F.when(F.count(F.lit(1)) != len(tables), F.raise_error(F.lit("bind: the tables differ in their number of rows")))
    first, *others = seen[1:]
    value = lambda c: F.first(F.col(f"`{c}`"), ignorenulls=True)
    g = both.groupBy(ordinal).agg(short.otherwise(value(first)).alias(first), *[value(c).alias(c) for c in others])
    return g


def recode_contains(x, rules: list[tuple[str, str]], default: Column | None = None) -> Column:
    """case_when(str_detect(x, pattern) ~ target, ..., .default = default):
    first matching rule wins; patterns are regular expressions."""
    xc = F.col(x) if isinstance(x, str) else x
    expr = None
    for pat, target in rules:
        cond = xc.rlike(pat)
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    dflt = xc if default is None else default
    return dflt if expr is None else expr.otherwise(dflt)


def text_key_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column,
                  extra_on: list[str] | None = None, how: str = "left") -> DataFrame:
    """Join on a normalised text key computed on both sides; the helper key
    is dropped and the left side's columns win."""
    extra_on = extra_on or []
    l2 = left.withColumn("__key", left_key)
    r2 = right.withColumn("__key", right_key)
    return join(l2, r2, ["__key", *extra_on], how).drop("__key")
