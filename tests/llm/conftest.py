import duckdb
import pytest


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Writes rows as the tables a query reads; gives the folder and a DuckDB connection over it."""
    def make(**frames):
        d = str(tmp_path_factory.mktemp("tables"))
        c = duckdb.connect()
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{d}/{name}.parquet")
            c.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet/*.parquet')")
        return d, c
    return make
