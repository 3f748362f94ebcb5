"""Sums over consecutive rows of a series, safe when one series holds most of the table, and mergeable later on.

``lag`` over a whole series would send that series to one task. Here a stretch of a series is folded into a state: its
first, second and last row and its sums. States that follow one another merge into the state of the longer stretch, and
the pair of rows that meets at their border is measured in the merge. A series is folded in steps of ``CHUNK`` sequence
numbers, then of ``CHUNK ** 2``, then whole. A window sees at most ``CHUNK`` rows in the first two steps and ``2 ** 23``
states in the last one, however sparse the numbering is. States can be kept and merged with those of rows that come later.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 1 << 20

Row = dict[str, Column]
Measure = Callable[[Row, Row], Column]


@dataclass(frozen=True)
class Fold:
    """What to keep of a series.

    ``seq`` is a whole number, unique within a series. A measure gets the previous and the current row as dicts of the
    columns ``cols`` and returns a whole number (see ``numbers.micro``); its sums are exact, so no way of cutting a
    series changes a result. ``second`` names columns whose value at the second row is wanted too. ``aggs`` adds plain
    extremes: name -> ("min" | "max", column).
    """

    keys: list[str]
    seq: str
    cols: list[str]
    measures: dict[str, Measure]
    second: list[str] = field(default_factory=list)
    aggs: dict[str, tuple[str, str]] = field(default_factory=dict)

    def _rows(self, df: DataFrame) -> DataFrame:
        """Every row as a state of its own."""
        whole = F.lit(None).cast("bigint")
        return df.select(
            *self.keys,
            F.lit(1).cast("bigint").alias("_n"),
            F.col(self.seq).alias("_first_seq"),
            F.col(self.seq).alias("_last_seq"),
            F.lit(False).alias("_overlaps"),
            whole.alias("_second_seq"),
            *[F.col(c).alias(f"_first_{c}") for c in dict.fromkeys([*self.cols, *self.second])],
            *[F.col(c).alias(f"_last_{c}") for c in self.cols],
            *[F.lit(None).cast(df.schema[c].dataType).alias(f"_second_{c}") for c in self.second],
            *[whole.alias(f"_in_{name}") for name in self.measures],
            *[F.col(c).alias(f"_agg_{name}") for name, (_, c) in self.aggs.items()],
        )

    def _merge(self, states: DataFrame, within: list[str], exact: bool = True) -> DataFrame:
        """One state for the states of each ``within``. Sums are decimals if ``exact``, else bigints."""
        along = Window.partitionBy(*within).orderBy("_first_seq", "_last_seq")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        laid = states.withColumns(
            {f"_prev_{c}": F.lag(f"_last_{c}").over(along) for c in self.cols}
            | {"_reached": F.max("_last_seq").over(before)}
        )
        later = F.col("_reached").isNotNull()
        second_at = F.when(later, F.col("_first_seq")).otherwise(F.col("_second_seq"))
        pick = {"min": F.min, "max": F.max}
        whole = (lambda c: c.cast("decimal(38,0)")) if exact else (lambda c: c)

        def total(name: str, measure: Measure) -> Column:
            previous = {c: F.col(f"_prev_{c}") for c in self.cols}
            current = {c: F.col(f"_first_{c}") for c in self.cols}
            border = F.coalesce(F.when(later, measure(previous, current)), F.lit(0))
            return F.sum(whole(F.coalesce(f"_in_{name}", F.lit(0))) + whole(border))

        def second(c: str) -> Column:
            return F.min_by(F.when(later, F.col(f"_first_{c}")).otherwise(F.col(f"_second_{c}")), second_at)

        return laid.groupBy(*within).agg(
            F.sum("_n").alias("_n"),
            F.min("_first_seq").alias("_first_seq"),
            F.max("_last_seq").alias("_last_seq"),
            F.bool_or(F.col("_overlaps") | F.coalesce(F.col("_reached") >= F.col("_first_seq"), F.lit(False))).alias("_overlaps"),
            F.min(second_at).alias("_second_seq"),
            *[F.min_by(f"_first_{c}", "_first_seq").alias(f"_first_{c}") for c in dict.fromkeys([*self.cols, *self.second])],
            *[F.max_by(f"_last_{c}", "_last_seq").alias(f"_last_{c}") for c in self.cols],
            *[second(c).alias(f"_second_{c}") for c in self.second],
            *[total(name, m).alias(f"_in_{name}") for name, m in self.measures.items()],
            *[pick[how](f"_agg_{name}").alias(f"_agg_{name}") for name, (how, _) in self.aggs.items()],
        )

    def states(self, df: DataFrame, chunk: int = CHUNK) -> DataFrame:
        """One state per series of the rows of ``df``."""
        out = self._rows(df)
        for width, exact in ((chunk, False), (chunk * chunk, True)):
            cut = out.withColumn("_chunk", F.col("_first_seq") - F.pmod(F.col("_first_seq"), F.lit(width)))
            out = self._merge(cut, [*self.keys, "_chunk"], exact).drop("_chunk")
        return self.merge(out)

    def merge(self, states: DataFrame) -> DataFrame:
        """One state per series out of states of separate stretches.

        Stretches must not interleave: where one begins before another ends, ``_overlaps`` is true and the sums miss
        pairs of neighbours; such a series has to be folded again from its rows.
        """
        return self._merge(states, self.keys)

    def facts(self, states: DataFrame) -> DataFrame:
        """``n_rows``, ``first_*``, ``last_*``, ``second_*``, sums and extremes of one state per series."""
        return states.select(
            *self.keys,
            F.col("_n").alias("n_rows"),
            *[F.col(f"_first_{c}").alias(f"first_{c}") for c in self.cols],
            *[F.col(f"_last_{c}").alias(f"last_{c}") for c in self.cols],
            *[F.col(f"_second_{c}").alias(f"second_{c}") for c in self.second],
            *[F.col(f"_in_{name}").alias(name) for name in self.measures],
            *[F.col(f"_agg_{name}").alias(name) for name in self.aggs],
        )


def fold_consecutive(
    df: DataFrame,
    keys: list[str],
    seq: str,
    cols: list[str],
    measures: dict[str, Measure],
    second: list[str] = (),
    aggs: dict[str, tuple[str, str]] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per series: ``n_rows``, ``first_*``/``last_*`` of ``cols``, the measure sums and extremes (see ``Fold``)."""
    fold = Fold(keys, seq, cols, measures, list(second), aggs or {})
    return fold.facts(fold.states(df, chunk))
