"""Writes of layers and tables. Every function is one atomic Spark write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_delimited(
    df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8", by: list[str] = (), single_file: bool = False
) -> None:
    """``;`` files with a header, in one folder per ``by`` value if given.

    ``single_file`` is for reports on request: one task then writes all rows, one after another.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("sep", sep).option("header", True).option("encoding", encoding)
    (writer.partitionBy(*by) if by else writer).csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Truncate and reload."""
    df.write.mode("overwrite").parquet(path)


def with_load_time(df: DataFrame, loaded_at: Column | None = None, name: str = "data_carga_banco") -> DataFrame:
    return df.withColumn(name, loaded_at if loaded_at is not None else F.current_timestamp())


def staged_insert(staging: DataFrame, path: str, name: str, prefix: str, loaded_at: Column | None = None) -> None:
    """Append a staging table, without the dummy prefix in ``name`` and with the run time."""
    clean = staging.withColumn(name, F.replace(F.col(name), F.lit(prefix), F.lit("")))
    append(with_load_time(clean, loaded_at, "data_execucao"), path)


def write_snapshot(df: DataFrame, path: str, run_id: str) -> None:
    """One folder per run; earlier runs stay, a repeated run replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")
