"""Global prefix sums from per-partition totals.

A table is written once with each row's running totals inside its partition
(``part``, ``row_in_part``, ``before``); the totals of the partitions, one row
for each, are then summed up and joined back, which gives every row its global
position without a global sort or a single-task window.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_bases(table: DataFrame, amount: str) -> tuple[DataFrame, int, int]:
    """(part, base_row, base) of a written table, and the total rows and amount.

    Only one row per partition reaches the driver."""
    totals = (table.groupBy("part").agg(F.count("*").alias("n"), F.sum(amount).cast("long").alias("amount"))
              .orderBy("part").collect())
    rows = [0, *accumulate(r["n"] for r in totals)]
    amounts = [0, *accumulate(r["amount"] for r in totals)]
    bases = pa.table([pa.array([r["part"] for r in totals], pa.int32()), pa.array(rows[:-1], pa.int64()),
                      pa.array(amounts[:-1], pa.int64())], names=["part", "base_row", "base"])
    # from Arrow: rows of Python objects would be unpickled by a second set of Python workers
    return table.sparkSession.createDataFrame(bases), rows[-1], amounts[-1]
