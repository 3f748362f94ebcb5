"""K-means on standardised features, with a result that depends on the rows alone.

Features are put on a grid of a millionth of a standard deviation. Coordinates are then whole numbers, sums of them are
exact, and every step gives the same bits whatever the order and the partitioning of the rows. Equal grid points are
counted once, so a hot point is one row.

Seeding is k-means||: a few rounds each keep points with a chance that grows with their cost, drawn by a hash of the
point and the seed, and the heaviest and farthest of the kept points become the first centroids. Each of Lloyd's steps
is one map-side combined aggregate of k rows, until no centroid moves. ``certificate`` checks that result by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from odolake.functions.numbers import exact_mean
from odolake.session import checkpoint

GRID = 1_000_000  # grid steps per standard deviation
ROUNDS = 2  # of sampling; each keeps about OVERSAMPLING * k points
OVERSAMPLING = 2
MAX_ITER = 300


def _apart(at: list[Column], spot: Column) -> Column:
    """Squared distance of the coordinates to a spot, an array of as many."""
    total = None
    for i, value in enumerate(at):
        gap = (value - spot[i]).cast("double")
        total = gap * gap if total is None else total + gap * gap
    return total


def _spots(spots: list[list[float]]) -> Column:
    """The spots as one array: as separate numbers they would make Spark compile every step anew."""
    return F.array(*[F.array(*[F.lit(float(v)) for v in spot]) for spot in spots])


def _nearest(at: list[Column], spots: list[list[float]]) -> Column:
    """(d, label) of the nearest spot; ties go to the lower label."""
    return F.array_min(F.transform(_spots(spots), lambda s, i: F.struct(_apart(at, s).alias("d"), i.alias("label"))))


@dataclass(frozen=True)
class KMeansFit:
    features: list[str]
    means: list[float]
    deviations: list[float]
    centroids: list[list[float]]  # in grid steps, in ascending order
    iterations: int
    converged: bool

    def known(self) -> Column:
        """False for rows with a missing feature."""
        known = F.lit(True)
        for f in self.features:
            known = known & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
        return known

    def grid(self) -> list[Column]:
        """Whole coordinates; a feature without any spread lies at 0."""
        out = []
        for f, mean, deviation in zip(self.features, self.means, self.deviations):
            scaled = (F.col(f).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)
            out.append(F.floor(scaled * F.lit(float(GRID)) + F.lit(0.5)))
        return out

    def label(self) -> Column:
        return _nearest(self.grid(), self.centroids)["label"] if self.centroids else F.lit(None).cast("int")

    def transform(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """Cluster number per row; rows with a missing feature are left out."""
        return df.where(self.known()).withColumn(name, self.label())

    def centres(self) -> list[dict[str, float]]:
        """Centroids in the units of the features."""
        return [
            {f: m + c / GRID * (s or 1.0) for f, m, s, c in zip(self.features, self.means, self.deviations, spot)}
            for spot in self.centroids
        ]

    def certificate(self, df: DataFrame) -> DataFrame:
        """Per cluster: rows, rows nearest to the own centroid, whether the centroid is its rows' mean, convergence.

        A fixed point has ``n_nearest = n_rows`` and ``is_mean`` everywhere and took fewer steps than the limit.
        """
        at = self.grid()
        names = [f"_g{i}" for i in range(len(at))]
        rows = self.transform(df, "cluster").select("cluster", *[g.alias(n) for g, n in zip(at, names)])
        spots, here = _spots(self.centroids), [F.col(n) for n in names]
        own = F.get(spots, F.col("cluster"))
        least = F.array_min(F.transform(spots, lambda s: _apart(here, s)))
        stats = rows.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum((_apart(here, own) <= least).cast("bigint")).alias("n_nearest"),
            *[F.sum(n).alias(n) for n in names],
        )
        is_mean = F.lit(True)
        for i, n in enumerate(names):
            is_mean = is_mean & (F.col(n).cast("double") / F.col("n_rows").cast("double") == own[i])
        return stats.select("cluster", "n_rows", "n_nearest", is_mean.alias("is_mean"), F.lit(self.converged).alias("converged"))


def _seeds(points: DataFrame, at: list[Column], k: int, seed: int) -> list[list[int]]:
    def drawn(step: int) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), F.lit(step), *at))

    spot = F.array(*at)
    first = points.agg(F.min(F.struct(drawn(0).alias("h"), spot.alias("spot")))).first()[0]
    if first is None:
        return []
    kept = [list(first.spot)]
    for step in range(1, ROUNDS + 1):
        cost = _nearest(at, kept)["d"]
        total = points.agg(F.sum(cost.cast("decimal(38,0)") * F.col("n"))).first()[0]
        if not total:
            break
        chance = F.conv(F.substring(drawn(step), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
        take = chance * F.lit(float(total)) < F.lit(float(OVERSAMPLING * k)) * F.col("n") * cost
        # About OVERSAMPLING * k points, whatever the number of rows.
        kept += [list(r.spot) for r in points.where(take).select(spot.alias("spot")).collect()]
    kept = sorted(map(list, {tuple(s) for s in kept}))
    weigh = points.groupBy(_nearest(at, kept)["label"].alias("i")).agg(F.sum("n").alias("n"))
    weights = {r.i: float(r.n) for r in weigh.collect()}
    apart = lambda a, b: sum(float(x - y) * float(x - y) for x, y in zip(a, b))
    chosen: list[int] = []
    while len(chosen) < min(k, len(kept)):
        worth = [
            weights.get(i, 0.0) * (min(apart(s, kept[j]) for j in chosen) if chosen else 1.0) for i, s in enumerate(kept)
        ]
        chosen.append(max((i for i in range(len(kept)) if i not in chosen), key=lambda i: (worth[i], -i)))
    return [kept[i] for i in chosen]


def fit_kmeans(df: DataFrame, features: list[str], k: int = 3, seed: int = 0, max_iter: int = MAX_ITER) -> KMeansFit:
    """K-means of the rows that have all ``features``; only k rows per step come to the driver.

    Fewer than ``k`` distinct rows give fewer clusters, no rows none. ``converged`` is False if ``max_iter`` steps did not
    reach a fixed point.
    """
    blank = KMeansFit(features, [0.0] * len(features), [1.0] * len(features), [], 0, True)
    rows = df.where(blank.known()).select(*[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    xs = [f"_x{i}" for i in range(len(features))]
    means = list(rows.agg(*[exact_mean(F.col(x)) for x in xs]).first())
    if means[0] is None:
        return blank
    spread = [F.sqrt(exact_mean((F.col(x) - F.lit(m)) * (F.col(x) - F.lit(m)))) for x, m in zip(xs, means)]
    deviations = list(rows.agg(*spread).first())

    scaled = KMeansFit(xs, means, deviations, [], 0, True)
    names = [f"g{i}" for i in range(len(xs))]
    points = rows.select(*[g.alias(n) for g, n in zip(scaled.grid(), names)])
    points = checkpoint(points.groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    at = [F.col(n) for n in names]
    centroids = [[float(v) for v in spot] for spot in _seeds(points, at, k, seed)]
    converged = False
    for step in range(1, max_iter + 1):
        labelled = points.select("n", *names, _nearest(at, centroids)["label"].alias("label"))
        mine = lambda value, i: F.sum(F.when(F.col("label") == i, value))
        sums = labelled.agg(
            *[F.array(mine(F.col("n"), i), *[mine(F.col(g) * F.col("n"), i) for g in names]) for i in range(len(centroids))]
        ).first()
        # A centroid without rows stays.
        moved = [[float(v) / float(n) for v in total] if n else old for (n, *total), old in zip(sums, centroids)]
        converged, centroids = moved == centroids, moved
        if converged:
            break
    return KMeansFit(features, means, deviations, sorted(centroids), step, converged)


def kmeans_clusters(df: DataFrame, features: list[str], k: int = 3, seed: int = 0) -> DataFrame:
    """Cluster number per row, numbered by ascending centroid; rows with a missing feature are left out."""
    stored = checkpoint(df)
    return fit_kmeans(stored, features, k, seed).transform(stored)
