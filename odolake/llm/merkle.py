"""Merkle manifest of a dataset: one tree per source, and one over the sources, with a witness for every row.

Trees grow by appending. Leaves of a source, in order, are cut into aligned blocks of ``ARITY ** HEIGHT``; a task
streams the leaves of a block into open runs. A leaf enters with an empty witness, attached to its own subtree. When
a run of ``ARITY`` subtrees is complete, the witnesses attached to each of them are extended by the roots of the
others, and all of them move on to the joined subtree, which is still open one level up. The end of the stream closes
short runs. A block's root is then appended to the tree above in the same way, as if it were a leaf, until a single
node is left, and the witness of the block extends those of its leaves. So no task holds more than a block, and a
witness is known without reading the rest of the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from odolake.llm.common import stored

ARITY = 3
HEIGHT = 7  # levels of a block, 2,187 leaves
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above bit 33

PATH = T.ArrayType(T.StructType([T.StructField("left", T.BinaryType()), T.StructField("right", T.BinaryType())]))

LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: of each field ``-`` if null, else its count of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _join(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


class Frontier:
    """Open runs of a growing tree, and the witnesses attached to their subtrees.

    A witness is a list of (left, right): the joined digests before and after the own one in its run, lowest level
    first. ``height`` is the level at which ``close`` stops; lone subtrees below it are joined alone.
    """

    def __init__(self, height: int):
        self.height = height
        self.runs: list[list[tuple[str, list[int]]]] = [[] for _ in range(height + 1)]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._add(0, digest, [len(self.witnesses) - 1])

    def _add(self, level: int, digest: str, attached: list[int]) -> None:
        self.runs[level].append((digest, attached))
        if len(self.runs[level]) == ARITY and level < self.height:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [digest for digest, _ in run]
        for i, (_, attached) in enumerate(run):
            sides = ("".join(digests[:i]), "".join(digests[i + 1 :]))
            for at in attached:
                self.witnesses[at].append(sides)
        self._add(level + 1, _join(digests), [at for _, attached in run for at in attached])

    def close(self) -> str:
        for level in range(self.height):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.height][0][0]


def height_of(count: int) -> int:
    """Levels above ``count`` leaves."""
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def _grow(height: int):
    """Arrow kernel over rows sorted by tree, block and pos: adds path, and root on the last row of each block."""
    side = pa.struct([("left", pa.binary()), ("right", pa.binary())])

    def finish(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        tree = Frontier(min(height, height_of(rows.column("count")[0].as_py())))
        for digest in rows.column("digest").to_pylist():
            tree.append(digest)
        root = tree.close()
        flat = [sides for witness in tree.witnesses for sides in witness]
        ends = [0, *accumulate(len(witness) for witness in tree.witnesses)]
        sides = pa.StructArray.from_arrays(
            [pa.array([bytes.fromhex(s[i]) for s in flat], pa.binary()) for i in (0, 1)], fields=list(side)
        )
        path = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sides)
        roots = pa.array([None] * (len(rows) - 1) + [root], pa.string())
        return iter(rows.append_column("path", path).append_column("root", roots).combine_chunks().to_batches())

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            start = 0
            own = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist()))
            for at, block in enumerate(own):
                if block != last:
                    held.append(batch.slice(start, at - start))
                    if last is not None:
                        yield from finish(held)
                    held, start, last = [], at, block
            held.append(batch.slice(start))
        if last is not None:
            yield from finish(held)

    return kernel


def climb(nodes: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Witnesses of the rows of (tree, pos, count, digest); ``pos`` runs from 0 to ``count - 1`` in each tree.

    Returns the rows with block and path, the witness inside their block, and (tree, block, rest, top): the witness of
    a block's root and the root of its tree. Names block, path and root are taken.
    """
    width = ARITY**height
    cut = nodes.withColumn("block", F.expr(f"pos div {width}"))
    cut = cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    schema = T.StructType([*cut.schema.fields, T.StructField("path", PATH), T.StructField("root", T.StringType())])
    grown = stored(cut.mapInArrow(_grow(height), schema), "witnesses")
    roots = grown.where("root IS NOT NULL").select(
        "tree",
        F.col("block").alias("pos"),
        F.expr(f"(count + {width - 1}) div {width}").alias("count"),
        F.col("root").alias("digest"),
    )
    grown = grown.drop("root")
    if roots.where("count > 1").isEmpty():
        return grown, roots.select("tree", F.col("pos").alias("block"), F.array().cast(PATH).alias("rest"), F.col("digest").alias("top"))
    lower, above = climb(roots, height)
    return grown, lower.join(above, ["tree", "block"]).select(
        "tree", F.col("pos").alias("block"), F.concat("path", "rest").alias("rest"), "top"
    )


def positions(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add pos (0, 1, ... in each tree by ``order``) and count, without a task that holds a whole tree.

    All rows are sorted once by tree and order; a row's number in its stretch of the sort and the rows of its tree in
    the stretches before make its position. The join is on (tree, stretch), so a large tree is no hot key.
    """
    at = F.monotonically_increasing_id()
    ordered = stored(rows.orderBy(tree, *order).withColumn("_at", at), "ordered")
    ordered = ordered.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    counts = ordered.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        tree,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("count"),
    )
    return ordered.join(counts, [tree, "_part"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "count")


def fold(digest: Column, path: Column) -> Column:
    """Root recomputed from a leaf's digest and its witness."""
    text = lambda side: F.lower(F.hex(side))
    return F.aggregate(path, digest, lambda own, side: F.sha2(F.concat(text(side["left"]), own, text(side["right"])), 256))


def siblings(path: Column) -> Column:
    """All digests of a witness, lowest level first and left to right, as one text."""
    return F.lower(F.array_join(F.transform(path, lambda side: F.concat(F.hex(side["left"]), F.hex(side["right"]))), ""))


def manifest(docs: DataFrame, columns: list[str] | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: row (struct of ``columns``, all by default), leaf, pos, count, path, subroot, root.

    A leaf is the digest of doc_id, source, lang, n_chars and text. The leaves of a source ascend by doc_id, null ids
    first, rows of the same id by digest. ``path`` is the witness from the leaf over the root of its source to
    ``root``, so ``fold(leaf, path)`` gives ``root``. Documents without source are a source of their own, the first;
    an empty source name comes next. A null field differs from an empty one. Very long texts only pass through the
    digest. Columns beyond the five are only carried, whatever their names. An empty table gives an empty table.
    """
    # Null sorts before all names, and a name before the longer ones that begin with it.
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    leaves = docs.select(
        F.struct(*(columns or docs.columns)).alias("row"), tree.alias("tree"), "doc_id", leaf([F.col(c) for c in LEAF_FIELDS]).alias("digest")
    )
    grown, above = climb(positions(leaves, "tree", ["doc_id", "digest"]).drop("doc_id"), height)
    above = stored(above, "blocks")
    subroots = above.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    sources, over = climb(positions(subroots, "tree", ["name"]), height)
    sources = sources.join(over, ["tree", "block"]).select(
        F.col("name").alias("tree"), F.concat("path", "rest").alias("end"), F.col("top").alias("all")
    )
    above = above.join(sources, "tree").select("tree", "block", F.concat("rest", "end").alias("rest"), "top", "all")
    return grown.join(above, ["tree", "block"]).select(
        "row",
        F.col("digest").alias("leaf"),
        "pos",
        "count",
        F.concat("path", "rest").alias("path"),
        F.col("top").alias("subroot"),
        F.col("all").alias("root"),
    )
