"""Shards of near equal bytes by sampled splitters and range partitioning.

Rows are ordered by (hash of the text, doc_id), so equal texts lie side by side. A size-weighted sample of the text
hashes gives splitters at equal quantiles, and every row is dealt to its range. Ranges that turn out too full, mostly
for a text with very many copies, are cut again by splitters drawn from their own rows on the whole key. Within a
range a window numbers the rows and adds up their bytes; the totals of the ranges before it make both global. A shard
then is a stretch of equal bytes of the whole order, so its limits do not depend on the sample, only the balance of
the tasks does.

A limit that falls into a group of equal texts moves to the nearer end of the group, so the group stays whole, unless
the group has more than ``1 / WHOLE_GROUPS`` of a shard's bytes; such a group is cut between rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.llm.common import stored

SHARDS = 16
WHOLE_GROUPS = 32
RANGE_ROWS = 16_384  # rows aimed at per range
MAX_RANGES = 1024  # ranges of the first cut; the bound of its sample is POINTS times as many
POINTS = 64  # sample points per range of the first cut
INNER_POINTS = 16  # sample points per part of a range that is cut again
OVERFULL = 2  # a range of this many times its share is cut again
SALTS = 16
_BLOCK = 32  # splitters looked through at once


def _keyed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """row (the carried columns), doc_id, k1 (60 bits of the text's md5; -1 for no text), size, text_crc32, tie."""
    data = F.col("text").cast("binary")
    k1 = F.conv(F.substring(F.md5(data), 1, 15), 16, 10).cast("long")
    return docs.select(
        F.struct(*columns).alias("row"),
        "doc_id",
        F.monotonically_increasing_id().alias("tie"),
        F.coalesce(k1, F.lit(-1).cast("long")).alias("k1"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(data, F.lit("").cast("binary"))).alias("text_crc32"),
    )


def _blocks(splitters: Column) -> Column:
    """A sorted array cut into blocks, so that a lookup reads one value per block and then one block."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(splitters), F.lit(1)), F.lit(_BLOCK))
    cut = F.transform(starts, lambda at: F.slice(splitters, at, _BLOCK))
    return F.when(F.size(splitters) > 0, cut)


def _at_most(blocks: Column, key: Column) -> Column:
    """How many splitters are not above ``key``; 0 without splitters."""
    block = F.size(F.filter(blocks, lambda b: F.element_at(b, 1) <= key))
    inside = F.size(F.filter(F.get(blocks, block - 1), lambda s: s <= key))
    return F.when(blocks.isNull() | (block <= 0), F.lit(0)).otherwise((block - 1) * _BLOCK + inside).cast("int")


def _points(size: Column, per_point: Column, seed: str) -> Column:
    """Sample points of a row: size / per_point on average, rounded up or down by a keyed hash."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "k1", "doc_id", "tie"), 11) / F.lit(2.0**53)
    return F.floor(size / per_point + draw).cast("long")


def _first_cut(keyed: DataFrame, total: int, ranges: int) -> Column:
    """Blocks of text hashes at the quantiles of a sample of about ``POINTS * ranges`` points."""
    per_point = F.lit(max(total, 1) / (POINTS * ranges))
    drawn = keyed.select("k1", _points(F.col("size"), per_point, "outer").alias("points")).where("points > 0")
    drawn = drawn.groupBy("k1").agg(F.sum("points").alias("points"))
    upto = F.sum("points").over(Window.orderBy("k1").rowsBetween(Window.unboundedPreceding, 0))
    crosses = drawn.withColumn("upto", upto).where(
        F.expr(f"upto div {POINTS} > (upto - points) div {POINTS}")
    )
    # At most MAX_RANGES numbers come to the driver.
    found = sorted(row.k1 for row in crosses.select("k1").collect())
    cut = [F.array(*[F.lit(k).cast("long") for k in found[i : i + _BLOCK]]) for i in range(0, len(found), _BLOCK)]
    return F.array(*cut) if cut else F.lit(None).cast("array<array<long>>")


def _inner_cuts(ranged: DataFrame, share: int) -> DataFrame:
    """(range, salt, blocks): splitters on the whole key in ranges that hold more than ``OVERFULL`` shares.

    Every part of such a range gets ``INNER_POINTS`` points. A text that only one splitter falls on is not cut: the
    splitter moves to its first row.
    """
    full = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > OVERFULL * share)
    # At most MAX_RANGES rows.
    inside = ranged.join(F.broadcast(full), "range").select("range", "k1", "doc_id", "tie", "size")
    drawn = inside.withColumn("points", _points(F.col("size"), F.lit(max(share, 1) / INNER_POINTS), "inner"))
    drawn = drawn.where("points > 0")
    order = Window.partitionBy("range").orderBy("k1", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    crosses = drawn.withColumn("upto", F.sum("points").over(order)).where(
        F.expr(f"upto div {INNER_POINTS} > (upto - points) div {INNER_POINTS}")
    )
    alone = F.count(F.lit(1)).over(Window.partitionBy("range", "k1")) == 1
    key = F.struct(
        "k1",
        F.when(~alone, F.col("doc_id")).alias("doc_id"),
        F.when(~alone, F.col("tie")).alias("tie"),
    )
    cuts = crosses.withColumn("key", key).groupBy("range").agg(_blocks(F.sort_array(F.collect_list("key"))).alias("blocks"))
    return cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _placed(docs: DataFrame, columns: list[str], range_rows: int) -> tuple[DataFrame, int]:
    """Stored rows with k1, size, text_crc32, start (bytes before the row) and place (rows before it), and all bytes."""
    keyed = stored(_keyed(docs, columns), "keyed")
    rows, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MAX_RANGES, max(1, -(-rows // range_rows)))
    ranged = stored(keyed.withColumn("range", _at_most(_first_cut(keyed, total, ranges), F.col("k1"))), "ranged")

    # Salted, as a text with very many copies is one range of the first cut.
    share = max(1, total * range_rows // max(rows, 1))
    salted = ranged.withColumn("salt", (F.col("tie") % SALTS).cast("int"))
    cut = salted.join(_inner_cuts(ranged, share), ["range", "salt"], "left").drop("salt")
    part = _at_most(F.col("blocks"), F.struct("k1", "doc_id", "tie"))
    parts = stored(cut.withColumn("part", part).drop("blocks"), "parts")

    sums = parts.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES rows
    whole = sums.groupBy("range").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    whole = whole.select("range", *[F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"{c}_0") for c in ("bytes", "n")])
    sums = sums.select("range", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_1") for c in ("bytes", "n")])
    sums = sums.join(F.broadcast(whole), "range")

    inside = Window.partitionBy("range", "part").orderBy("k1", "doc_id", "tie")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    run = parts.withColumn("upto", upto).withColumn("no", F.row_number().over(inside))
    placed = run.join(sums, ["range", "part"]).select(
        "row",
        "k1",
        "size",
        "text_crc32",
        (F.col("bytes_0") + F.col("bytes_1") + F.col("upto") - F.col("size")).alias("start"),
        (F.col("n_0") + F.col("n_1") + F.col("no") - 1).alias("place"),
    )
    return stored(placed, "placed"), total


def _limits(placed: DataFrame, total: int, shards: int) -> list[int]:
    """First byte of every shard but the first, in the order of all rows: ``shards - 1`` numbers."""
    even = [i * total // shards for i in range(1, shards)]
    covers = [(F.col("start") <= at) & (F.col("start") + F.col("size") > at) for at in sorted(set(even))]
    met = F.lit(False)
    for cover in covers:
        met = met | cover
    groups = placed.where(met).select("k1").distinct()  # one group per limit at most
    spans = placed.join(F.broadcast(groups), "k1").groupBy("k1").agg(F.min("start"), F.sum("size")).collect()
    limits = []
    for at in even:
        first, size = next(((s, n) for _, s, n in spans if s <= at < s + n), (at, 1))
        if size * shards * WHOLE_GROUPS <= total:
            at = first if 2 * (at - first) <= size else first + size
        limits.append(at)
    return limits


def shard_rows(docs: DataFrame, shards: int = SHARDS, columns: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row (struct of ``columns``), size, text_crc32, shard, slot.

    Shards hold near equal bytes (text in UTF-8 plus one byte a row). ``columns`` are the columns to carry, all by
    default; a column of any other name than doc_id and text is only carried. A null text has size 1 and the crc32
    of the empty text, and all null texts are one group. Null ids come first in a group; rows that repeat id and text
    lie side by side in either order. A row lies where its middle byte lies, so a very long text fills its shard and
    neighbours may stay empty. An empty table gives an empty table.
    """
    placed, total = _placed(docs, columns or docs.columns, range_rows)
    middle = 2 * F.col("start") + F.col("size")
    shard = F.lit(0)
    for at in _limits(placed, total, shards):
        shard = shard + (middle >= 2 * at).cast("int")
    dealt = placed.withColumn("shard", shard)
    firsts = dealt.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return dealt.join(F.broadcast(firsts), "shard").select(
        "row", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(dealt: DataFrame, path: str, file_rows: int = 100_000) -> None:
    """Write the result of ``shard_rows`` as folders shard=0, shard=1 and so on, in files of rows that follow by slot."""
    files = dealt.select("shard", "slot", "row").withColumn("file", F.expr(f"slot div {file_rows}"))
    files = files.repartition("shard", "file").sortWithinPartitions("shard", "slot").drop("file")
    files.write.partitionBy("shard").parquet(path)
