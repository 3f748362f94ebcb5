"""Exact nearest place on the sphere for each point, by descending a tree packed along a space-filling curve.

Coordinates become unit vectors, so the straight-line distance orders places as the great-circle distance does, with
no seam at 180 degrees and none at the poles. Places are put in the order of a curve that winds through the cube around
the sphere and packed into leaves of ``LEAF_SPOTS``, leaves into nodes of ``FANOUT``, and so on, until at most ``FANOUT``
nodes are left. So every leaf is full wherever the places lie, and the tree is as deep as their number asks for. A node
keeps the bounding box of its places and one of them. A point starts with the top nodes, all at once, and keeps those
that can still hold its nearest place: the least possible distance to their box is not above the distance to the nearest
kept place. Below, it meets the children of the nodes that are left, by a join on the node; up to 2,048 places need none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.functions.distance import haversine_km
from odolake.operators.joining import join_salted
from odolake.operators.ordering import with_position
from odolake.session import checkpoint

LEAF_SPOTS = 32
FANOUT = 64
AXES = ("x", "y", "z")
_STEPS = 1 << 20  # of the curve along each axis, about 12 metres on Earth


def _vector(lat: Column, lon: Column) -> dict[str, Column]:
    up, around = F.radians(lat), F.radians(lon)
    return {"x": F.cos(up) * F.cos(around), "y": F.cos(up) * F.sin(around), "z": F.sin(up)}


def _with_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with finite coordinates, and their unit vectors."""
    placed = df.withColumns(_vector(F.col(lat), F.col(lon)))
    return placed.where(~F.isnan(F.col("x") + F.col("y") + F.col("z")))


def _spread(value: Column) -> Column:
    """The low 21 bits of a whole number, each followed by two zero bits."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def _curve() -> Column:
    """Place on the curve: the bits of the three coordinates in turn."""
    at = [F.least(F.floor((F.col(axis) + 1) / 2 * _STEPS), F.lit(_STEPS - 1)).cast("bigint") for axis in AXES]
    x, y, z = (_spread(a) for a in at)
    return x.bitwiseOR(F.shiftleft(y, 1)).bitwiseOR(F.shiftleft(z, 2))


def _tree(spots: DataFrame) -> DataFrame:
    """The spots with their number along the curve, from 0."""
    ordered = with_position(spots.withColumn("_curve", _curve()), ["_curve", "_plat", "_plon"], "_no")
    return checkpoint(ordered.select(*AXES, "_plat", "_plon", "_key", (F.col("_no") - 1).alias("_no")))


def _nodes(tree: DataFrame, width: int, *by: Column) -> DataFrame:
    """Box and one spot of every ``width`` spots that follow along the curve."""
    ends = [f(axis).alias(f"{end}{axis}") for axis in AXES for end, f in (("low_", F.min), ("high_", F.max))]
    own = [F.min_by(axis, "_no").alias(f"own_{axis}") for axis in AXES]
    return tree.groupBy(*by, F.expr(f"_no div {width}").alias("node")).agg(*ends, *own)


def _family(tree: DataFrame, width: int) -> DataFrame:
    """Per node of the level above the array of its nodes, at most ``FANOUT``."""
    above = F.expr(f"_no div {width * FANOUT}").alias("above")
    nodes = _nodes(tree, width, above)
    inner = F.collect_list(F.struct(*[c for c in nodes.columns if c != "above"])).alias("_inner")
    return nodes.groupBy(F.col("above").alias("node")).agg(inner)


def _measured(box: Column) -> Column:
    """A node with the least possible squared distance from the point to its places, and that to one of them."""
    near = far = F.lit(0.0)
    for axis in AXES:
        low, high, own, point = box[f"low_{axis}"], box[f"high_{axis}"], box[f"own_{axis}"], F.col(f"_{axis}")
        gap = F.greatest(low - point, point - high, F.lit(0.0))
        near, far = near + gap * gap, far + (own - point) * (own - point)
    return F.struct(box["node"].alias("node"), near.alias("near"), far.alias("far"))


def _within(bound: Column) -> Column:
    """The bound with room for rounding of the vectors."""
    return bound * F.lit(1 + 1e-9) + F.lit(1e-18)


def _opened(points: DataFrame) -> DataFrame:
    """One row per point and node of ``_inner`` that can hold the nearest place, as far as one row of a point tells."""
    points = points.withColumn("_inner", F.transform("_inner", _measured))
    points = points.withColumn("_bound", F.least("_bound", F.array_min(F.transform("_inner", lambda c: c["far"]))))
    nodes = F.filter("_inner", lambda c: c["near"] <= _within(F.col("_bound")))
    return points.select("_lat", "_lon", "_x", "_y", "_z", "_bound", F.inline(nodes)).drop("far")


def _kept(opened: DataFrame) -> DataFrame:
    """The rows left by the best bound of each point; a window holds the nodes left of one point."""
    opened = opened.withColumn("_bound", F.min("_bound").over(Window.partitionBy("_lat", "_lon")))
    return opened.where(F.col("near") <= _within(F.col("_bound")))


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    key: str,
    leaf_spots: int = LEAF_SPOTS,
    point_cols: tuple[str, str] = ("latitude", "longitude"),
    place_cols: tuple[str, str] = ("place_latitude", "place_longitude"),
) -> DataFrame:
    """Add the ``key`` of the place with the smallest great-circle distance; ties go to the smallest key.

    Looks each distinct coordinate up once and joins the answer back. Without finite coordinates, or without any
    place, the key is null. Longitudes may use any turn (190 is -170).
    """
    lat, lon = point_cols
    plat, plon = place_cols
    wanted = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    wanted = wanted.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    wanted = _with_vector(wanted, "_lat", "_lon")
    wanted = wanted.select("_lat", "_lon", *[F.col(axis).alias(f"_{axis}") for axis in AXES])
    # Places at one spot are equal but for the key, so the smallest key stands for all.
    spots = (
        places.where(F.col(plat).isNotNull() & F.col(plon).isNotNull())
        .groupBy(F.col(plat).alias("_plat"), F.col(plon).alias("_plon"))
        .agg(F.min(key).alias("_key"))
    )
    tree = _tree(_with_vector(spots, "_plat", "_plon"))
    widths, count = [leaf_spots], tree.count()
    while count > widths[-1] * FANOUT:
        widths.append(widths[-1] * FANOUT)

    # At most FANOUT nodes at the top, so all of them go to every point.
    nodes = _nodes(tree, widths[-1])
    top = nodes.agg(F.collect_list(F.struct(*nodes.columns)).alias("_inner"))
    found = _opened(wanted.withColumns({"_bound": F.lit(float("inf")), "_inner": top.scalar()}))
    for width in reversed(widths[:-1]):
        found = _kept(_opened(found.join(_family(tree, width), "node").drop("near", "node")))

    leaves = tree.select(F.expr(f"_no div {leaf_spots}").alias("node"), "_plat", "_plon", "_key")
    apart = haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
    best = (
        found.join(leaves, "node")
        .groupBy(F.col("_lat").alias(lat), F.col("_lon").alias(lon))
        .agg(F.min_by("_key", F.struct(apart, "_key")).alias(key))
    )
    # Many points may share one coordinate.
    return join_salted(points, best, [lat, lon], "left")
