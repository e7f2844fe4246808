"""Long <-> wide reshaping (R rows) and the two-level crosstab normaliser."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from regpanel.constants import MEASURE_MARKER
from regpanel.functions.exprs import as_int_trunc, as_num
from regpanel.functions.text import sanitize, split_nth
from regpanel.operators.cells import header_names, row_counts, slice_rows
from regpanel.session import scratch_path
from regpanel.sources.sinks import checkpoint_to


def pivot_longer(df: DataFrame, cols: list[str], names_to: str = "name",
                 values_to: str = "value", id_cols: list[str] | None = None,
                 value_type: str | None = None) -> DataFrame:
    """pivot_longer: NULL values are kept (DataFrame.unpivot keeps them).
    Value columns are cast to one type (double if all numeric, else string)."""
    if id_cols is None:
        id_cols = [c for c in df.columns if c not in set(cols)]
    if value_type is None:
        types = {f.name: f.dataType for f in df.schema.fields}
        value_type = "double" if all(isinstance(types[c], NumericType) for c in cols) else "string"
    d = df.select(*id_cols, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return d.unpivot(id_cols, cols, names_to, values_to)


def distinct_names(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a code column that will become column names."""
    return sorted((r[0] for r in df.select(column).distinct().collect()), key=lambda v: (v is None, v))


def pivot_wider(df: DataFrame, id_cols: list[str], names_from: str, values_from: str,
                values: list[str] | None = None, on_duplicate: str = "error") -> DataFrame:
    """pivot_wider with an explicit value list (column order = list order; a
    code with no data still gets an all-NULL column).

    on_duplicate: ``error`` raises, when the query runs, if an (id, name) cell has several values
    (R would build a list-column); ``first`` keeps one value; ``max`` keeps the
    largest.  NULL id groups are kept.
    """
    if values is None:
        values = distinct_names(df, names_from)
    agg = F.max(values_from) if on_duplicate == "max" else F.first(values_from, ignorenulls=True)
    if on_duplicate == "error":  # checked in the same aggregate, when it runs
        agg = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(
            "pivot_wider: values are not uniquely identified; use pivot_duplicates() to list them"))).otherwise(agg)
    return df.groupBy(*id_cols).pivot(names_from, values).agg(agg)


def pivot_duplicates(df: DataFrame, id_cols: list[str], names_from: str) -> DataFrame:
    """Report of (id, name) cells that hold more than one value."""
    return (df.groupBy(*id_cols, names_from).agg(F.count(F.lit(1)).alias("n_values"))
              .where(F.col("n_values") > 1))


# ------------------------------------------------------------ crosstab cells


def crosstab_normalise(cells: DataFrame, first_value_col: int = 3, n_bands: int | None = None,
                       value_type: str = "int", region_label: str = "region",
                       blank_region: str = "label") -> DataFrame:
    """Normalise two-level crosstab sheets held as a cells table
    ``(sheet, row_idx, col_idx, value)`` (1-based) into a long panel
    ``(sheet, variable, anio, sector, region, tramo, value)``.  Blank body
    cells are rows with a NULL value, and so are their panel rows.

    Layout per sheet: (1,1) names the measure after ``Variável - ``; row 3 holds
    the year and row 4 the sector in the first column of each merged block;
    row 5 holds the size-band labels; rows 6..n-1 hold region (col 1) and
    values (col >= ``first_value_col``); row n is a source note (dropped);
    column 2 is ignored.

    The (year, sector) header is forward-filled along columns and numbered
    by first appearance.  A body row with a blank region cell gets the
    literal ``region_label`` (``blank_region="label"``, the source's
    behaviour), the region of the nearest row above (``"ffill"``), or raises
    (``"reject"``).  A body column belongs to header group
    ``((col - first) div n_bands) mod n_groups + 1``.  All header tables hold
    one row per sheet column; the body cells are the slice of rows between the
    header and the source note.
    """
    fc, spark = first_value_col, cells.sparkSession
    c = cells.select("sheet", "row_idx", "col_idx", "value")
    # The header rows (1-5) and the region column are small (sheet width +
    # sheet height).  They are taken out in ONE pass and written, so the many
    # header tables below never rescan the cells.
    small = checkpoint_to(spark, c.where((F.col("row_idx") <= 5) | (F.col("col_idx") == 1)), scratch_path(spark, "headers"))
    last_row = checkpoint_to(spark, row_counts(c), scratch_path(spark, "row-counts"))
    measure = (small.where((F.col("row_idx") == 1) & (F.col("col_idx") == 1))
                    .select("sheet", sanitize(split_nth("value", MEASURE_MARKER, 2)).alias("variable")))

    head = (small.where(F.col("row_idx").isin(3, 4) & (F.col("col_idx") >= fc))
             .groupBy("sheet", "col_idx")
             .agg(F.max(F.when(F.col("row_idx") == 3, F.col("value"))).alias("__y"),
                  F.max(F.when(F.col("row_idx") == 4, F.col("value"))).alias("__s")))
    w = Window.partitionBy("sheet").orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    yr = F.trim(F.col("__y"))
    head = head.select("sheet", "col_idx",
                       F.last(F.when(yr.rlike("^[0-9]"), yr), ignorenulls=True).over(w).alias("anio"),
                       F.last("__s", ignorenulls=True).over(w).alias("sector"))
    groups = (head.groupBy("sheet", "anio", "sector").agg(F.min("col_idx").alias("__first"))
                  .select("sheet", "anio", "sector",
                          F.row_number().over(Window.partitionBy("sheet").orderBy("__first"))
                           .alias("group")))
    n_groups = groups.groupBy("sheet").agg(F.max("group").alias("__ng"))

    bands = header_names(small.where(F.col("col_idx") >= fc), 5, "tramo")
    if n_bands is None:
        nb = (bands.groupBy("sheet").agg(F.count_distinct("tramo").alias("__nb")))
    else:
        nb = bands.select("sheet").distinct().withColumn("__nb", F.lit(n_bands))

    # one per-sheet table: measure name, band count, group count; how the
    # header-sized tables are joined is left to Spark
    meta = nb.join(n_groups, "sheet").join(measure, "sheet")
    regions = (slice_rows(small.where(F.col("col_idx") == 1), 6, -1, last_row)
               .select("sheet", "row_idx", F.col("value").alias("region")))
    vals = slice_rows(c.where(F.col("col_idx") >= fc), 6, -1, last_row).join(meta, "sheet")
    cast = as_int_trunc("value") if value_type == "int" else as_num("value")
    if blank_region == "ffill":
        rows = vals.select("sheet", "row_idx").distinct().join(regions, ["sheet", "row_idx"], "left")
        w = Window.partitionBy("sheet").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
        regions = rows.select("sheet", "row_idx", F.last("region", ignorenulls=True).over(w).alias("region"))
    elif blank_region == "reject":
        blank = (vals.select("sheet", "row_idx").distinct()
                     .join(regions.where(F.col("region").isNotNull()), ["sheet", "row_idx"], "left_anti")
                     .limit(1).count())
        if blank:
            raise ValueError("crosstab_normalise: body row without a region cell")
    out = (vals.join(regions, ["sheet", "row_idx"], "left")
               .withColumn("region", F.coalesce(F.col("region"), F.lit(region_label)))
               .join(bands, ["sheet", "col_idx"])
               .withColumn("group", (F.pmod(F.floor((F.col("col_idx") - fc) / F.col("__nb")),
                                            F.col("__ng")) + 1).cast("int"))
               .join(groups, ["sheet", "group"]))
    return out.select("sheet", "variable", "anio", "sector", "region", "tramo", cast.alias("value"))


def panel_to_cells(long_panel: DataFrame, sheet_col: str, measure_title_col: str,
                   year_col: str, sector_col: str, region_col: str, band_col: str,
                   value_col: str, first_value_col: int = 3) -> DataFrame:
    """Lay a long panel out as crosstab cells (the inverse of
    :func:`crosstab_normalise`), used to build fixtures from real tables.

    A NULL value is a blank body cell, stored as a row.  Columns:
    blocks of (year, sector) in sorted order, bands in sorted order inside
    each block; rows: regions in sorted order from row 6; a source note in
    the last row.  Ordinals are dense ranks over the distinct labels of each
    sheet (dimension lists, not data), joined back to the value cells."""
    fc = first_value_col
    p = long_panel.select(F.col(sheet_col).alias("sheet"), F.col(measure_title_col).alias("__title"),
                          F.col(year_col).cast("string").alias("__y"),
                          F.col(sector_col).alias("__s"), F.col(region_col).alias("__r"),
                          F.col(band_col).alias("__b"), F.col(value_col).cast("string").alias("__v"))
    bands = p.select("sheet", "__b").distinct().withColumn(
        "__b_i", F.dense_rank().over(Window.partitionBy("sheet").orderBy("__b")))
    regions = p.select("sheet", "__r").distinct().withColumn(
        "__r_i", F.dense_rank().over(Window.partitionBy("sheet").orderBy("__r")))
    nb = bands.groupBy("sheet").agg(F.max("__b_i").alias("__nb"))
    blocks = (p.select("sheet", "__y", "__s").distinct()
               .withColumn("__g", F.dense_rank().over(Window.partitionBy("sheet").orderBy("__y", "__s")))
               .withColumn("__first_in_year",
                           F.row_number().over(Window.partitionBy("sheet", "__y").orderBy("__s")) == 1)
               .join(nb, "sheet")
               .withColumn("__c0", (F.lit(fc) + (F.col("__g") - 1) * F.col("__nb")).cast("int")))
    vals = (p.join(blocks, ["sheet", "__y", "__s"]).join(bands, ["sheet", "__b"])
             .join(regions, ["sheet", "__r"])
             .select("sheet", (F.col("__r_i") + 5).cast("int").alias("row_idx"),
                     (F.col("__c0") + F.col("__b_i") - 1).cast("int").alias("col_idx"),
                     F.col("__v").alias("value"), "__b"))
    value_cells = vals.select("sheet", "row_idx", "col_idx", "value")
    band_cells = vals.select("sheet", F.lit(5).alias("row_idx"), "col_idx", F.col("__b").alias("value")).distinct()
    year_cells = blocks.where("__first_in_year").select("sheet", F.lit(3).alias("row_idx"),
                                                       F.col("__c0").alias("col_idx"), F.col("__y").alias("value"))
    sector_cells = blocks.select("sheet", F.lit(4).alias("row_idx"), F.col("__c0").alias("col_idx"),
                                 F.col("__s").alias("value"))
    region_cells = regions.select("sheet", (F.col("__r_i") + 5).cast("int").alias("row_idx"),
                                  F.lit(1).alias("col_idx"), F.col("__r").alias("value"))
    title_cells = p.groupBy("sheet").agg(F.min("__title").alias("value")).select(
        "sheet", F.lit(1).alias("row_idx"), F.lit(1).alias("col_idx"), "value")
    note_cells = regions.groupBy("sheet").agg(F.max("__r_i").alias("__nr")).select(
        "sheet", (F.col("__nr") + 6).cast("int").alias("row_idx"), F.lit(1).alias("col_idx"),
        F.lit("Fonte: tabela gerada").alias("value"))
    parts = [title_cells, year_cells, sector_cells, band_cells, region_cells, value_cells, note_cells]
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out.select("sheet", F.col("row_idx").cast("int"), F.col("col_idx").cast("int"), "value")
