"""Spreadsheet cells tables ``(sheet, row_idx, col_idx, value)``, 1-based:
merged ranges, row slices and header rows, for all sheets at once.  Nothing
here depends on the order in which cells arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = ["sheet", "row_idx", "col_idx"]


def fill_merged(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every cell of a merged range takes the value of its upper left cell.

    ``ranges`` is ``(sheet, r0, c0, r1, c1)``, ends included.  The anchors'
    values are joined to the ranges (one row each) before those are opened
    into cells, rows first, so no array is larger than a range is high or
    wide; one aggregate then lets the range's value win over what a cell
    holds.  A range whose anchor is missing or blank gives blank cells.  Where
    ranges overlap, the one that begins first (row, then column) wins; cells
    outside of any range stay as they are."""
    anchor = cells.select("sheet", F.col("row_idx").alias("r0"), F.col("col_idx").alias("c0"), "value")
    opened = (ranges.select("sheet", "r0", "c0", "r1", "c1").join(anchor, ["sheet", "r0", "c0"], "left")
              .withColumn("row_idx", F.explode(F.sequence("r0", "r1")))
              .withColumn("col_idx", F.explode(F.sequence("c0", "c1"))))
    order = F.struct((-F.col("r0")).cast("int").alias("r"), (-F.col("c0")).cast("int").alias("c"))
    both = (cells.select(*CELL, "value", F.lit(None).cast("struct<r:int,c:int>").alias("__order"))
            .unionByName(opened.select(*CELL, "value", order.alias("__order"))))
    # a struct, so that a blank value is not skipped; a cell of its own (null order) is the least
    best = F.max_by(F.struct("value"), F.struct(F.col("__order").isNotNull().alias("m"), "__order"))
    return both.groupBy(*CELL).agg(best["value"].alias("value"))


def row_counts(cells: DataFrame) -> DataFrame:
    """(sheet, n_rows): the last row that holds a cell."""
    return cells.groupBy("sheet").agg(F.max("row_idx").alias("n_rows"))


def _last(n_rows: Column, last: int | None) -> Column:
    return n_rows if last is None else F.lit(last) if last > 0 else n_rows + last


def slice_rows(cells: DataFrame, first: int = 1, last: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Rows ``first`` to ``last`` of every sheet, numbered anew from 1.

    ``last`` is a row number, or None for the sheet's last row, or 0 or less
    for so many rows before it (-1: all but the last row).  End-relative slices
    take each sheet's own count, in the same plan; ``counts`` hands over counts
    that are at hand already."""
    c = cells
    if last is not None and last > 0:
        c = c.where(F.col("row_idx").between(first, last))
    else:
        c = c.where(F.col("row_idx") >= first)
        if last:
            c = (c.join(row_counts(cells) if counts is None else counts, "sheet")
                 .where(F.col("row_idx") <= _last(F.col("n_rows"), last)).drop("n_rows"))
    return c.withColumn("row_idx", (F.col("row_idx") - (first - 1)).cast("int"))


def header_names(cells: DataFrame, row: int, name: str = "name", blank: str | None = None) -> DataFrame:
    """(sheet, col_idx, name): one row per column of the header row."""
    value = F.col("value") if blank is None else F.coalesce("value", F.lit(blank))
    return cells.where(F.col("row_idx") == row).select("sheet", "col_idx", value.alias(name))


def row_to_names_long(cells: DataFrame, row: int, name: str = "name", header: DataFrame | None = None) -> DataFrame:
    """The rows below the header row, each cell with its column's name, for
    sheets whose headers differ: (sheet, row_idx, col_idx, name, value), rows
    numbered from 1 below the header.  Columns without a header cell have a
    NULL name."""
    head = header_names(cells, row, name) if header is None else header
    body = slice_rows(cells, row + 1)
    return body.join(head, ["sheet", "col_idx"], "left").select(*CELL, name, "value")


def unique_names(names: list[str | None]) -> list[str]:
    """Column names from header texts: NULL is ``NA``, repeats get ``_2``, ``_3``."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = "NA" if n is None else n
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def row_to_names(cells: DataFrame, row: int) -> DataFrame:
    """One table whose columns are named by the texts of a header row; the rows
    above it go.  Two phases: the header row (one value per column, read once)
    becomes the column list, then the body is pivoted on the column number in
    one aggregate.  All sheets must have the same header, else it raises; rows
    are (sheet, row_idx from 1 below the header, names...)."""
    head = (header_names(cells, row).groupBy("col_idx")
            .agg(F.min("name").alias("name"), F.count_distinct(F.coalesce("name", F.lit(""))).alias("n"))
            .orderBy("col_idx").collect())
    if any(h["n"] > 1 for h in head):
        raise ValueError("row_to_names: the sheets' headers differ")
    names = unique_names([h["name"] for h in head])
    body = slice_rows(cells, row + 1)
    at = [F.max(F.when(F.col("col_idx") == h["col_idx"], F.col("value"))).alias(n) for h, n in zip(head, names, strict=True)]
    return body.groupBy("sheet", "row_idx").agg(*at)
