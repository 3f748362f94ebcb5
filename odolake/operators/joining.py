"""Join of a large table with aggregates when a few keys hold most of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SALTS = 16


def salted(df: DataFrame, salts: int = SALTS, name: str = "_salt") -> DataFrame:
    """Add a number below ``salts`` that depends on the row alone, so a retried task deals its rows as before."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return df.withColumn(name, F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))


def every_salt(df: DataFrame, salts: int = SALTS, name: str = "_salt") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def join_salted(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``left`` with ``right``, which has one narrow row per key, as aggregates do.

    The rows of one key of ``left`` meet ``salts`` copies of its row of ``right`` in as many tasks. If ``right`` is small,
    Spark sees its bytes when it is made and broadcasts it instead; no count is taken beforehand. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = [on] if isinstance(on, str) else list(on)
    return salted(left, salts).join(every_salt(right, salts), [*keys, "_salt"], how).drop("_salt")
