"""Scans (S rows) and parameterised dataset readers (X2-X4).

Known sources get an explicit schema; long coded facts are the canonical
storage form, scanned once with pushed-down dimension predicates."""

from __future__ import annotations

import csv
import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from regpanel.functions.dates import year_to_date
from regpanel.functions.exprs import nan_to_null
from regpanel.functions.text import separate_code_name
from regpanel.session import scratch_path
from regpanel.sources.sinks import checkpoint_to

NULL_TOKENS = ("", "NA")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             overrides: dict[str, str] | None = None, select: list[str] | None = None,
             infer: bool = False) -> DataFrame:
    """readr read_csv: header, ``""`` and ``NA`` are missing.  ``schema`` should
    be given for production sources (``infer`` is for exploration only);
    ``overrides`` are read types of single columns (a code read as string
    keeps its leading zeros), ``select`` prunes columns (pushed to the scan's
    ReadSchema for columnar formats)."""
    r = spark.read.option("header", True).option("nullValue", "NA")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is None:
        schema = r.option("inferSchema", infer).csv(path).schema
    types = {c: StructType.fromDDL(f"x {t}")[0].dataType for c, t in (overrides or {}).items()}
    schema = StructType([StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in schema.fields])
    df = r.schema(schema).csv(path)
    # Spark maps only one nullValue token; the other one is handled here.
    # NaN is missing too (R's is.na), and Spark aggregates would propagate it.
    def clean(f):
        t = f.dataType.simpleString()
        if t == "string":
            return F.when(F.col(f.name).isin(*NULL_TOKENS), None).otherwise(F.col(f.name)).alias(f.name)
        if t in ("double", "float"):
            return nan_to_null(f.name).alias(f.name)
        return F.col(f.name)
    df = df.select(*[clean(f) for f in df.schema.fields])
    if select:
        df = df.select(*select)
    return df


def read_csv_european(spark: SparkSession, path: str, numeric: list[str] = (),
                      encoding: str = "ISO-8859-1") -> DataFrame:
    """readr read_csv2: ``;`` separator, decimal comma, dot grouping.
    ISO-8859-1 decodes every Spanish letter like ISO-8859-3 and needs no
    legacy charset flag."""
    df = (spark.read.option("header", True).option("sep", ";").option("encoding", encoding)
          .option("nullValue", "NA").csv(path))
    return df.select(*[european_number(c).alias(c) if c in set(numeric) else F.col(c)
                       for c in df.columns])


def european_number(c) -> Column:
    """'1.234,5' -> 1234.5 ; non-numeric -> NULL."""
    x = F.col(c) if isinstance(c, str) else c
    t = F.replace(F.replace(F.trim(x), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(t.rlike(r"^[-+]?[0-9]*\.?[0-9]+$"), t.try_cast("double"))


def read_folder_with_name(spark: SparkSession, path: str, fmt: str = "parquet",
                          name_col: str = "source_file", name_from: str = "file", **opts) -> DataFrame:
    """One scan over a folder; the file's name (``name_from="dir"``: its
    folder's) is kept as a discriminator column (replaces list.files |> lapply(read))."""
    df = spark.read.format(fmt).options(**opts).load(path)
    part = r"/([^/]+)/[^/]+$" if name_from == "dir" else r"/([^/]+)$"
    return df.withColumn(name_col, F.regexp_extract(F.col("_metadata.file_path"), part, 1))


def read_with_ordinal(spark: SparkSession, path, fmt: str = "parquet", ordinal: str = "__ord",
                      schema: StructType | str | None = None, **opts) -> DataFrame:
    """Rows with their place (from 0) in file order: files by path, rows as they
    stand in them.  Places are prefix sums: every file's (or split's) row count
    gives where it begins, the row's place inside is added.  Parquet knows a
    row's place in its file; for other formats the rows are written once with
    the ids their scan gave them, so that a repeated task cannot renumber them.
    The running sum is over one row per split, never over the rows."""
    r = spark.read.format(fmt).options(**opts)
    df = (r.schema(schema) if schema is not None else r).load(path)
    file = F.col("_metadata.file_path").alias("__file")
    if fmt == "parquet":
        d = df.select("*", file, F.lit(0).cast("bigint").alias("__start"), F.col("_metadata.row_index").alias("__at"))
    else:
        d = df.select("*", file, F.col("_metadata.file_block_start").alias("__start"),
                      F.monotonically_increasing_id().alias("__at"))
        d = checkpoint_to(spark, d, scratch_path(spark, "ordinal"))
    splits = d.groupBy("__file", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__least"))
    before = F.sum("__n").over(Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1))
    base = splits.select("__file", "__start", (F.coalesce(before, F.lit(0)) - F.col("__least")).alias("__base"))
    base = checkpoint_to(spark, base, scratch_path(spark, "bases"))  # of known size, so that the rows need not move to meet it
    return d.join(base, ["__file", "__start"]).select((F.col("__base") + F.col("__at")).alias(ordinal), *df.columns)


def read_unlike_folder(spark: SparkSession, path: str, sep: str = ",", name_from: str = "file"
                       ) -> tuple[dict[int, tuple[str, list[str]]], DataFrame]:
    """A folder of delimited files whose headers differ, in one scan:
    {number: (name, header)} in the order of the names, and the rows as
    (file_no, values), values in the order of that file's header.

    The scan reads lines and writes them once; a file's first line is its
    header.  With ``name_from="dir"`` the files of one folder are parts of one
    table and must have one header.  Lines are split by Spark's CSV reader
    (quotes may hold the separator, values no line break); empty lines are
    skipped.  The driver gets one row per file."""
    lines = (spark.read.text(path).where(F.trim("value") != "")
             .select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                     F.monotonically_increasing_id().alias("__at"), "value"))
    lines = checkpoint_to(spark, lines, scratch_path(spark, "unlike"))
    heads = lines.groupBy("__file").agg(F.min(F.struct("__start", "__at", "value")).alias("h")).select("__file", "h.*").collect()
    parsed = {h["__file"]: next(csv.reader([h["value"]], delimiter=sep)) for h in heads}
    name = {f: f.rstrip("/").rsplit("/", 2)[-2 if name_from == "dir" else -1] for f in parsed}
    found: dict[int, tuple[str, list[str]]] = {}
    for i, n in enumerate(sorted(set(name.values()))):
        headers = [h for f, h in parsed.items() if name[f] == n]
        if any(h != headers[0] for h in headers):
            raise ValueError(f"read_unlike_folder: the parts of {n} have different headers")
        found[i] = n, headers[0]
    number = {n: i for i, (n, _) in found.items()}
    first = spark.createDataFrame([(number[name[h["__file"]]], h["__file"], h["__start"], h["__at"]) for h in heads],
                                  "file_no int, __file string, __hs long, __ha long")
    widest = max((len(h) for _, h in found.values()), default=1)
    v = F.from_csv("value", ", ".join(f"c{i} string" for i in range(widest)), {"sep": sep, "nullValue": "NA"})
    rows = (lines.join(first, "__file").where((F.col("__start") != F.col("__hs")) | (F.col("__at") != F.col("__ha")))
            .withColumn("__v", v).select("file_no", F.array(*[F.col("__v")[f"c{i}"] for i in range(widest)]).alias("values")))
    return found, rows


def read_cells(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Spreadsheet sheets landed as a cells table (sheet, row_idx, col_idx, value)."""
    schema = "sheet string, row_idx int, col_idx int, value string"
    return spark.read.format(fmt).schema(schema).option("header", True).load(path)


@dataclass(frozen=True)
class DatasetSpec:
    """One measure read from a long statistical-dataset table.

    ``filters``: {dimension: value or [values]} AND-ed; ``period``: the
    (inclusive) year range, honoured; ``geo``: region codes to keep."""
    dataset: str
    var_name: str
    filters: dict = field(default_factory=dict)
    period: tuple[int, int] | None = None
    geo: tuple[str, ...] | None = None

    def predicate(self, dataset_col: str = "dataset", time_col: str = "time",
                  geo_col: str = "geo") -> Column:
        p = F.col(dataset_col) == F.lit(self.dataset)
        for dim, v in self.filters.items():
            vals = list(v) if isinstance(v, (list, tuple, set)) else [v]
            p = p & F.col(dim).isin(vals)
        if self.period is not None:
            # a range on the column itself (not year(col)) so parquet can take it
            lo, hi = self.period
            p = p & (F.col(time_col) >= F.lit(datetime.date(lo, 1, 1))) \
                  & (F.col(time_col) < F.lit(datetime.date(hi + 1, 1, 1)))
        if self.geo is not None:
            p = p & F.col(geo_col).isin(list(self.geo))
        return p


def read_specs(facts: DataFrame, specs: list[DatasetSpec], regions: DataFrame,
               dataset_col: str = "dataset", time_col: str = "time", geo_col: str = "geo",
               value_col: str = "values", unit_col: str = "unit",
               region_id: str = "NUTS_ID", region_name: str = "NUTS_NAME") -> DataFrame:
    """ONE scan for all specs: OR of the spec predicates (pushed to parquet),
    a when-chain naming the measure, inner join to the region list, distinct.  Output long: (anio, id_region, region, variable, value, unit)."""
    pred = None
    name = None
    for s in specs:
        p = s.predicate(dataset_col, time_col, geo_col)
        pred = p if pred is None else pred | p
        name = F.when(p, F.lit(s.var_name)) if name is None else name.when(p, F.lit(s.var_name))
    f = facts.where(pred).select(F.col(time_col).alias("anio"), F.col(geo_col).alias("id_region"),
                                 name.alias("variable"), F.col(value_col).alias("value"),
                                 F.col(unit_col).alias("unit"))
    r = regions.select(F.col(region_id).alias("id_region"), F.col(region_name).alias("region"))
    return (f.join(r, "id_region")
             .select("anio", "id_region", "region", "variable", "value", "unit").distinct())


def read_national_file(df: DataFrame, region_col: str, period_col: str, total_col: str,
                       unit_col: str, var_name: str) -> DataFrame:
    """National file reader: lower-cased names, 'NN Name' split into code and
    region (fill left), Jan-1 date from the period, value and unit renamed."""
    d = df.toDF(*[c.lower() for c in df.columns])
    code, name = separate_code_name(region_col.lower())
    return d.select(year_to_date(F.col(period_col.lower())).alias("anio"), name.alias("region"),
                    F.col(total_col.lower()).alias(var_name),
                    F.col(unit_col.lower()).alias(f"{var_name}_unidad"))


def specs_from(table: list[tuple[str, str, dict]], geo: list[str] | None = None,
               period: tuple[int, int] | None = None) -> list[DatasetSpec]:
    """DatasetSpec list from (dataset id, measure name, filters) rows, e.g. the
    country spec lists in :mod:`regpanel.constants`."""
    return [DatasetSpec(ds, name, dict(f), period=period, geo=tuple(geo) if geo else None)
            for ds, name, f in table]
