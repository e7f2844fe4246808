"""Period handling: years are canonicalised to int at the boundary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regpanel.functions.exprs import col


def year_to_date(y) -> Column:
    """as.Date(paste(y, "01", "01", sep="-")) with non-numeric years -> NULL."""
    yi = col(y).cast("string").try_cast("int")
    return F.when((yi >= 1) & (yi <= 9999), F.make_date(yi, F.lit(1), F.lit(1)))


def date_to_year_text(d) -> Column:
    """format(d, "%Y") -> string."""
    return F.date_format(col(d), "yyyy")


def year_int(d) -> Column:
    """lubridate year(d) -> int."""
    return F.year(col(d))


def year_sequence(start, end) -> Column:
    """seq.Date(start-01-01, end-01-01, by="1 year"): the array of the years'
    first days, from year columns or numbers; NULL if either is."""
    lo, hi = (F.make_date(F.lit(y) if isinstance(y, int) else col(y), F.lit(1), F.lit(1)) for y in (start, end))
    return F.sequence(lo, hi, F.expr("interval 1 year"))
