"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source has a weight; targets share out all words by weight, but stop at ``MAX_REPEATS`` times the source's own
words, and what is left over goes to the others by weight. A target is an integer number of blocks of equal size:
blocks go to the sources with the highest quotients target / (2 * seats + 1). A source is cut into shards by a keyed
hash of the document id, and the source's blocks go to its shards by the same rule, by words. Within a shard the
documents lie in a keyed order, and its blocks are taken one after another, round and round.

No step holds a source in one task: shards have about ``SHARD_DOCS`` documents, and only rows per shard or per source
meet in a window. Blocks are counted, never listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.llm.common import stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SHARD_DOCS = 4096
MAX_BLOCK = 1024
BLOCKS_PER_TARGET = 128  # a block is at most this part of the smallest target
WORD = r"[^\x20\x09-\x0D]+"


def apportion(parties: DataFrame, within: list[str], votes: str, seats: str, name: str, order: str) -> DataFrame:
    """Add ``name``: the seats of each party by highest quotients; ties go to the smaller ``order``.

    The divisor votes / (seats - parties / 2) gives at most ``seats`` by rounding, and these seats are those with the
    highest quotients. At most one seat per party is then left, so a few next quotients of each party are enough.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    sized = parties.withColumn("_all", F.sum(votes).over(group)).withColumn("_n", F.count(F.lit(1)).over(group))
    divisor = F.col("_all") / (F.col(seats) - F.col("_n") / 2)
    sized = sized.withColumn(
        "_sure",
        F.when((F.col("_all") > 0) & (F.col(seats) > F.col("_n") / 2), F.floor(F.col(votes) / divisor + 0.5))
        .otherwise(F.lit(0))
        .cast("long"),
    )
    # The first seats by rounding may sum to ``seats`` at most; guard the exact half against both roundings.
    sized = sized.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    share = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0))
    nexts = F.explode(F.sequence(F.lit(1), F.ceil(share * F.col("_n")).cast("int") + 2))
    tried = sized.where((F.col(votes) > 0) & (F.col("_left") > 0)).select(*within, order, votes, "_left", "_sure", nexts.alias("_k"))
    quotient = F.col(votes) / (2 * (F.col("_sure") + F.col("_k")) - 1)
    best = Window.partitionBy(*(within or [F.lit(0)])).orderBy(quotient.desc(), F.col(order).asc_nulls_last())
    won = (
        tried.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= F.col("_left"))
        .groupBy(*within, order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    keys = [*within, order]
    won = won.select(*[F.col(c).alias(f"_key_{c}") for c in keys], "_won")
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    joined = sized.join(won, on, "left")
    return joined.select(*parties.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias(name))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Add weight, target and whether it is capped to (source, source_size), by filling up by weight.

    In order of cap / weight the level of the uncapped sources rises; a source is capped if its own ratio lies below
    the level that holds when all before it are capped.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * repeats)
    fill = everything.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum(
        "_weight"
    ).over(from_here)
    levelled = ranked.withColumn("_level", level).withColumn("_below", F.col("_cap") / F.col("_weight") < level)
    final = F.min(F.when(~F.col("_below"), F.struct(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), F.col("source"), F.col("_level"))))
    levelled = levelled.withColumn("_final", final.over(everything)["_level"])
    return levelled.select(
        "source",
        "source_size",
        F.when(F.col("_below"), F.col("_cap").cast("double"))
        .otherwise(F.least(F.col("_final") * F.col("_weight"), F.col("_cap").cast("double")))
        .alias("target"),
        F.col("_below").alias("capped"),
    )


def mix(docs: DataFrame, seed: str = "mix", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, text_hash.

    A null or empty text has size 0 and nothing is taken of it. Documents without source are a source of their own,
    last in order. Rows without id and rows that repeat an id lie side by side in the keyed order, equal rows in
    either order. Other columns are ignored whatever their names. Without any words all targets are 0. Very long
    texts are only counted.
    """
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", size.alias("size"), hashed.alias("spot"), F.xxhash64("text").alias("text_hash"))
    sized = stored(sized, "sizes")

    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    wanted = targets(per_source.select("source", "source_size"))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy(F.lit(0)))
    block = F.least(F.lit(MAX_BLOCK), F.greatest(F.lit(1), F.floor(smallest / BLOCKS_PER_TARGET))).cast("long")
    wanted = wanted.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
    open_ = F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("target"))
    wanted = wanted.withColumn("open", open_)
    total = F.sum("open").over(Window.partitionBy(F.lit(0)))
    wanted = wanted.withColumn("seats", F.floor(total / F.col("block") + 0.5).cast("long"))
    plan = apportion(wanted, [], "open", "seats", "blocks", "source")
    counted = per_source.select(F.col("source").alias("_s"), F.ceil(F.col("docs") / shard_docs).alias("shards"))
    plan = plan.join(counted, F.col("source").eqNullSafe(F.col("_s")))
    plan = stored(plan.select("source", "source_size", "target", "capped", "block", "blocks", "shards"), "plan")

    named = plan.select(F.col("source").alias("_s"), "source_size", "target", "shards")
    shard = (F.conv(F.substring("spot", 1, 8), 16, 10).cast("long") % F.col("shards")).cast("int")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "spot", "source_size", "target", "text_hash", shard.alias("shard")
    )
    placed = stored(placed, "placed")

    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    rule = plan.select(F.col("source").alias("_s"), "capped", "block", "blocks")
    shards = shards.join(rule, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    shards = apportion(shards, ["source"], "words", "blocks", "quota", "shard")
    words = F.when(F.col("capped"), F.col("words") * MAX_REPEATS).otherwise(
        F.least(F.col("quota") * F.col("block"), F.col("words") * MAX_REPEATS)
    )
    shards = shards.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "words", words.alias("take"))

    lying = Window.partitionBy("source", "shard").orderBy("spot", "doc_id", "size", "text_hash")
    start = F.sum("size").over(lying.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    laid = placed.withColumn("start", start)
    joined = laid.join(shards, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    return joined.select("doc_id", "size", "source_size", "target", _taken().alias("taken"), "text_hash")


def _taken() -> Column:
    """Words of a document in the blocks dealt round its shard: full rounds and the part of the last one."""
    rounds = F.when(F.col("words") > 0, F.expr("take div words")).otherwise(F.lit(0))
    rest = F.when(F.col("words") > 0, F.col("take") % F.col("words")).otherwise(F.lit(0))
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("start")))
    return (rounds * F.col("size") + part).cast("long")
