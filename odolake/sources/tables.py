"""Table and query scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_if_absent(spark: SparkSession, table: str, schema: str, path: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet LOCATION '{path}'")


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def create_or_replace_view(spark: SparkSession, view: str, query: str) -> None:
    """A view of the catalog over tables of the catalog; an earlier one of the name is replaced."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")


def drop(spark: SparkSession, *names: str) -> None:
    """Forget views and tables; the files of a table with a location stay."""
    for name in names:
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")


def scan_query(spark: SparkSession, query: str, **values) -> DataFrame:
    """Rows of a query text; ``:name`` in it stands for the value of that name, which is never pasted into the text."""
    return spark.sql(query, args=values) if values else spark.sql(query)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """External table read in ``parts`` ranges of a numeric column. Connection settings come from the caller."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
        .load()
    )
