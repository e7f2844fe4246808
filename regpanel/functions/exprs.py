"""Column expressions with R semantics (NULL poisoning, lenient casts, ...).

Policy: NULL is the only missing value.  Divisions go through
``try_divide`` (x/0 -> NULL), logs of values <= 0 are NULL, NaN is turned
into NULL at the boundary.  Everything here is a built-in expression, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regpanel.constants import TRUNC_ELLIPSIS, TRUNC_WIDTH

# Text accepted as a number by R's as.numeric / as.integer (decimal form,
# optional exponent, surrounding blanks).  Hex and Inf are not accepted.
NUMERIC_TEXT = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """NaN -> NULL (R's is.na counts both; Spark aggregates propagate NaN)."""
    x = col(x)
    return F.when(~F.isnan(x), x)


def without_nan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN -> NULL in the floating columns of ``df`` (of ``cols``, if given):
    what every statistic applies first, wherever its table comes from."""
    floating = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}
    hit = floating if cols is None else floating & set(cols)
    if not hit:
        return df
    return df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) if c in hit else F.col(f"`{c}`") for c in df.columns])


def r_div(a, b) -> Column:
    """a / b with division by zero giving NULL instead of Inf/NaN or an error."""
    return F.try_divide(col(a), col(b))


def strict_sum(x) -> Column:
    """sum(x) without na.rm: one NULL in the group poisons the result."""
    x = col(x)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def strict_mean(x) -> Column:
    """mean(x) without na.rm."""
    x = col(x)
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def sum_na_rm(x) -> Column:
    """sum(x, na.rm=TRUE): an all-NULL group sums to 0 as in R."""
    return F.coalesce(F.sum(col(x)), F.lit(0))


def zero_as_missing(x) -> Column:
    """if_else(x == 0, NA, x)."""
    x = col(x)
    return F.when(x != 0, x)


def count_missing(x) -> Column:
    """sum(is.na(x)) as bigint."""
    return F.count_if(col(x).isNull()).cast("bigint")


def n_distinct_na(x) -> Column:
    """dplyr n_distinct(x): NULL counts as one more distinct value."""
    x = col(x)
    return (F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))).cast("bigint")


def as_num(x) -> Column:
    """Lenient as.numeric(text): non-numeric text -> NULL."""
    s = col(x).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def as_int_trunc(x) -> Column:
    """Lenient as.integer(text): parse as double, truncate toward zero,
    out-of-int-range -> NULL, non-numeric -> NULL."""
    d = as_num(x)
    return F.when((d > -2147483648.0) & (d < 2147483648.0), d.try_cast("int"))


def if_else3(cond: Column, yes, no) -> Column:
    """dplyr if_else: a NULL condition gives NULL (Spark's otherwise would fire)."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def log_pos(x, base: str = "e") -> Column:
    """log(x) for x > 0, else NULL (R gives -Inf/NaN)."""
    x = col(x)
    return F.when(x > 0, F.log10(x) if base == "10" else F.log(x))


def corr_safe(x, y) -> Column:
    """Pair-complete Pearson correlation, NULL when either side is constant."""
    x, y = col(x), col(y)
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def trunc_center(s, width: int = TRUNC_WIDTH, ellipsis: str = TRUNC_ELLIPSIS) -> Column:
    """stringr str_trunc(side="center"): ceil half on the left, floor half on the right."""
    s = col(s)
    keep = width - len(ellipsis)
    left, right = (keep + 1) // 2, keep // 2
    tail = F.substring(s, -right, right) if right else F.lit("")
    return F.when(F.length(s) > width,
                  F.concat(F.substring(s, 1, left), F.lit(ellipsis), tail)).otherwise(s)


def floor_div(a, b) -> Column:
    """R %/% on integers."""
    return F.floor(col(a) / col(b)).cast("bigint")


def floor_mod(a, b) -> Column:
    """R %% (floor modulo, sign of the divisor)."""
    return F.pmod(col(a), col(b))
